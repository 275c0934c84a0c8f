"""Learning a subword vocabulary by likelihood: many candidate pieces, thinned out to the best ones.

A word is any of its segmentations into pieces, with the product of their probabilities. Training starts from
the most frequent stretches of symbols of all distinct words. Each round is expectation and maximisation: tasks
run forward and backward over the lattice of each distinct word and add up how often each piece is expected,
Spark sums these by piece, and the sums are the next probabilities; the likelihood of the words rises with each
round. Between rounds the pieces whose loss is least go: what the likelihood loses when the piece is written as
its best other segmentation. Single symbols stay, so every word keeps a segmentation.

Words stay distributed, one row per distinct word. The driver holds the pieces, ``seed_size`` at most.
Expectations are whole numbers of ``UNIT`` parts, so their sums, and with them the vocabulary, are the same for
any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.bpe import GAP, _BYTE_TOKEN
from quern.session import materialize

UNIT = 1_000_000
#: Distinct stretches that a task holds before it passes them on.
HELD = 500_000
#: Under this key a task passes on its log-likelihood; no piece is empty.
LIKELIHOOD = ""


@dataclass
class Unigram:
    """Pieces with their log-probability, and the words' log-likelihood after each round between cuts:
    ``rounds[k]`` lists those of the k-th cut's vocabulary."""

    scores: dict[str, float]
    rounds: list[list[float]]
    max_piece: int

    def vocabulary(self, spark) -> DataFrame:
        """``rank``, ``piece``, ``score``: the likeliest piece first."""
        ranked = sorted(self.scores.items(), key=lambda x: (-x[1], x[0]))
        return spark.createDataFrame([(k, p, s) for k, (p, s) in enumerate(ranked)], "rank int, piece string, score double")

    def word_pieces(self, words: DataFrame) -> DataFrame:
        """The columns of a word table (``symbols``) with ``pieces``, the likeliest segmentation, instead of ``symbols``."""
        scores, longest = self.scores, self.max_piece
        carried = [c for c in words.columns if c != "symbols"]
        schema = words.select(*carried, F.col("symbols").alias("pieces")).schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [best_pieces(s or [], scores, longest)[0] for s in batch.column(len(carried)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(carried)], pa.array(found, pa.list_(pa.string()))], schema.names)

        return words.select(*carried, "symbols").mapInArrow(run, schema)


def arcs(symbols: list[str], scores: dict[str, float], longest: int) -> Iterator[tuple[int, int, str, float]]:
    """``(from, to, piece, score)`` of every piece in the word, by start."""
    size = len(symbols)
    for i in range(size):
        piece = ""
        for j in range(i + 1, min(size, i + longest) + 1):
            piece += symbols[j - 1]
            score = scores.get(piece)
            if score is not None and (j == i + 1 or not _joins_bytes(symbols, i, j)):
                yield i, j, piece, score


def _joins_bytes(symbols: list[str], i: int, j: int) -> bool:
    """Whether a stretch holds a byte token, which no longer piece does."""
    return any(_BYTE_TOKEN.fullmatch(s) for s in symbols[i:j] if len(s) > 1)


def _added(a: float, b: float) -> float:
    """Logarithm of the sum of two numbers given by their logarithms."""
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def expected(symbols: list[str], scores: dict[str, float], longest: int) -> tuple[float, dict[str, float]]:
    """Log-probability of a word, and how often each piece is expected in it."""
    size, found = len(symbols), list(arcs(symbols, scores, longest))
    ahead, behind = [-math.inf] * (size + 1), [-math.inf] * (size + 1)
    ahead[0] = behind[size] = 0.0
    for i, j, _, score in found:  # by start, so what ends at i is complete
        ahead[j] = _added(ahead[j], ahead[i] + score)
    for i, j, _, score in reversed(found):
        behind[i] = _added(behind[i], behind[j] + score)
    total, out = ahead[size], {}
    if total > -math.inf:
        for i, j, piece, score in found:
            out[piece] = out.get(piece, 0.0) + math.exp(min(0.0, ahead[i] + score + behind[j] - total))
    return total, out


def best_pieces(symbols: list[str], scores: dict[str, float], longest: int, without: str | None = None) -> tuple[list[str], float]:
    """The likeliest segmentation and its log-probability; of equal ones that with the shorter last piece. Symbols
    that are no piece stand for themselves and add nothing."""
    size = len(symbols)
    best, back = [0.0] + [-math.inf] * size, [0] * (size + 1)
    for i, j, piece, score in arcs(symbols, scores, longest):
        if best[i] == -math.inf:
            best[i], back[i] = best[i - 1], i - 1
        if piece != without and (best[i] + score > best[j] or best[i] + score == best[j] and i > back[j]):
            best[j], back[j] = best[i] + score, i
    for j in range(1, size + 1):
        if best[j] == -math.inf:
            best[j], back[j] = best[j - 1], j - 1
    out, j = [], size
    while j:
        out.append("".join(symbols[back[j]:j]))
        j = back[j]
    return out[::-1], best[size]


def _stretches(words: DataFrame, longest: int) -> DataFrame:
    """``piece``, ``freq``, ``size``: every stretch of symbols, single ones included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], int] = {}

        def flush() -> pa.RecordBatch:
            pieces, sizes = [p for p, _ in held], [n for _, n in held]
            out = pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(sizes, pa.int32()), pa.array(list(held.values()), pa.int64())],
                                             ["piece", "size", "freq"])
            held.clear()
            return out

        for batch in batches:
            for spelling, freq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                symbols = spelling.split(GAP)
                for i in range(len(symbols)):
                    piece = ""
                    for j in range(i, min(len(symbols), i + longest)):
                        if j > i and (_BYTE_TOKEN.fullmatch(symbols[j]) or _BYTE_TOKEN.fullmatch(symbols[i])):
                            break
                        piece += symbols[j]
                        held[piece, j - i + 1] = held.get((piece, j - i + 1), 0) + freq
                if len(held) > HELD:
                    yield flush()
        yield flush()

    found = words.mapInArrow(run, "piece string, size int, freq bigint")
    return found.groupBy("piece").agg(F.min("size").alias("size"), F.sum("freq").alias("freq"))


def _expectations(words: DataFrame, scores: dict[str, float], longest: int) -> dict[str, int]:
    """How often each piece is expected over all words, in parts of ``UNIT``; the log-likelihood as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = {}
        for batch in batches:
            for spelling, freq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total, counts = expected(spelling.split(GAP), scores, longest)
                sums[LIKELIHOOD] = sums.get(LIKELIHOOD, 0) + freq * round(total * UNIT)
                for piece, count in counts.items():
                    sums[piece] = sums.get(piece, 0) + freq * round(count * UNIT)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.decimal128(38, 0))], ["piece", "n"])

    made = words.mapInArrow(run, "piece string, n decimal(38,0)").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: int(r["n"]) for r in made.collect()}


def _scores(counts: dict[str, int], single: set[str]) -> dict[str, float]:
    """Log-probabilities of expected counts. Pieces that are never expected go, single symbols stay."""
    counts = {p: n for p, n in counts.items() if n > 0} | {p: 1 for p in single if counts.get(p, 0) <= 0}
    total = math.log(sum(counts.values()))
    return {p: math.log(n) - total for p, n in counts.items()}


def cut(scores: dict[str, float], counts: dict[str, int], single: set[str], size: int, symbols_of, longest: int) -> dict[str, float]:
    """The single symbols and the pieces with the largest losses, ``size`` in all."""
    losses = []
    for piece, score in scores.items():
        if piece not in single:
            other = best_pieces(symbols_of(piece), scores, longest, without=piece)[1]
            losses.append((-counts.get(piece, 0) * (score - other), piece))
    kept = single | {p for _, p in sorted(losses)[:max(0, size - len(single))]}
    return _scores({p: counts.get(p, 0) for p in kept}, single)


def train_unigram(words: DataFrame, vocab_size: int, *, reserved: int = 0, seed_size: int = 100_000, longest: int = 16,
                  shrink: float = 0.75, rounds: int = 2, min_freq: int = 2) -> Unigram:
    """Learn from a word table (``symbols``, ``freq``): ``vocab_size`` tokens, ``reserved`` ones among them.

    ``seed_size`` candidates of at most ``longest`` symbols that occur ``min_freq`` times or more are cut to ``shrink``
    times their number after every ``rounds`` rounds, until the size is reached. There are never fewer pieces than
    single symbols. Byte tokens stay single.
    """
    spark = words.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    spelled = words.where(F.size("symbols") > 0).select(F.array_join("symbols", GAP).alias("spelling"), F.col("freq").cast("bigint").alias("freq"))
    spelled = materialize(spelled.repartition(parts, "spelling"), "unigram-words")
    stretches = materialize(_stretches(spelled, longest), "unigram-stretches")
    ones = {r["piece"]: r["freq"] for r in stretches.where("size = 1").collect()}  # Unicode bounds the symbols
    ranked = stretches.where(F.col("size") > 1).where(F.col("freq") >= min_freq).orderBy(F.desc(F.col("freq") * F.col("size")), "piece")
    seeds = {r["piece"]: r["freq"] for r in ranked.limit(max(0, seed_size - len(ones))).collect()}
    single = set(ones)
    if not single:
        return Unigram({}, [], longest)
    target = max(vocab_size - reserved, len(single))
    scores, history = _scores(seeds | ones, single), []

    def symbols_of(piece: str) -> list[str]:
        return list(piece)

    while True:
        seen, counts = [], {}
        for _ in range(rounds):
            counts = _expectations(spelled, scores, longest)
            seen.append(counts.pop(LIKELIHOOD, 0) / UNIT)
            scores = _scores(counts, single)
        history.append(seen)
        if len(scores) <= target:
            return Unigram(scores, history, longest)
        scores = cut(scores, counts, single, max(target, int(shrink * len(scores))), symbols_of, longest)
