"""Learning a subword vocabulary by pair merging, hundreds of merges to a round.

The state is a table of distinct words with their spelling in symbols, and a table of pair counts. A round:

1. The head of the pair ranking comes to the driver: ``per_round`` pairs and the next one, whose count
   bounds all others. The head is cut where the count falls, so no pair outside ties with one inside.
2. Each word is cut into its chains: longest stretches whose neighbours all are pairs of the head. Tasks sum
   equal chains; with their frequencies they say all that merging pairs of the head can change among each other.
   The head is halved until no more than ``max_chains`` distinct chains are left, so what reaches the driver
   is bounded.
3. The driver merges one pair at a time over the chains, as long as the best pair is above the bound. That is
   what one-by-one merging over all words does: a pair outside the head has at most the bound's count, and so
   has every pair that a merge forms from it, since each place of the new pair was one of the old. A merge
   whose result was a symbol before ends the round, as counts of that symbol are only partly known.
4. The words take over the merges. Words that changed give the counts of their old pairs with a minus and
   of their new ones with a plus; the pair counts are those of before with these changes, so words that no merge
   touched are neither exploded nor counted again.

The words end as a table of words and their pieces. Every table of a round is written and read back, so a lost
executor costs no earlier round.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import materialize

# Stands between the symbols of a word. Normalised text holds no control characters.
GAP = "\x01"
PER_ROUND = 1024
MAX_CHAINS = 200_000
#: Distinct chains that a task holds before it passes them on.
HELD = 100_000

_BYTE_TOKEN = re.compile("<0x[0-9A-F]{2}>")

Pair = tuple[str, str]


@dataclass
class Bpe:
    """``merges``: ``rank``, ``left``, ``right``, ``token``, ``freq``. ``pieces``: the columns of the word
    table with ``pieces``, the word's symbols after the last merge."""

    merges: DataFrame
    pieces: DataFrame


class Chains:
    """Weighted stretches of symbols, merged one pair at a time."""

    def __init__(self, chains: Sequence[tuple[list[str], int]]):
        self.symbols = [list(s) for s, _ in chains]
        self.freq = [f for _, f in chains]
        self.counts: dict[Pair, int] = {}
        self.where: dict[Pair, set[int]] = {}
        for at, symbols in enumerate(self.symbols):
            self._count(at, symbols, 1)
        self.ranking = [(-n, pair) for pair, n in self.counts.items()]
        heapq.heapify(self.ranking)

    def _count(self, at: int, symbols: list[str], sign: int) -> set[Pair]:
        pairs = list(zip(symbols, symbols[1:]))
        for pair in pairs:
            self.counts[pair] = self.counts.get(pair, 0) + sign * self.freq[at]
            if sign > 0:
                self.where.setdefault(pair, set()).add(at)
        return set(pairs)

    def best(self) -> tuple[Pair, int] | None:
        """The most frequent pair, ties by symbols."""
        while self.ranking:
            count, pair = self.ranking[0]
            if -count == self.counts.get(pair, 0) and count:
                return pair, -count
            heapq.heappop(self.ranking)
        return None

    def merge(self, pair: Pair) -> None:
        changed: set[Pair] = set()
        for at in self.where.pop(pair, ()):
            symbols = self.symbols[at]
            merged = joined(symbols, pair)
            if len(merged) < len(symbols):
                changed |= self._count(at, symbols, -1) | self._count(at, merged, 1)
                self.symbols[at] = merged
        for other in changed:
            if self.counts[other]:
                heapq.heappush(self.ranking, (-self.counts[other], other))


def joined(symbols: list[str], pair: Pair) -> list[str]:
    """Symbols with every place of the pair merged, from left to right."""
    out, i, last = [], 0, len(symbols) - 1
    while i <= last:
        if i < last and symbols[i] == pair[0] and symbols[i + 1] == pair[1]:
            out.append(pair[0] + pair[1])
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def apply_merges(symbols: list[str], ranks: dict[Pair, int]) -> list[str]:
    """Symbols after all merges, in their order."""
    done = -1
    while len(symbols) > 1:
        found = [r for r in map(ranks.get, zip(symbols, symbols[1:])) if r is not None and r > done]
        if not found:
            return symbols
        done = min(found)
        at = next(p for p in zip(symbols, symbols[1:]) if ranks.get(p) == done)
        symbols = joined(symbols, at)
    return symbols


def certain_merges(chains: Chains, first: Pair, bound: int, known: set[str], limit: int) -> list[tuple[Pair, int]]:
    """The next merges over all words, as far as the chains tell. ``first`` leads the ranking of all pairs."""
    out: list[tuple[Pair, int]] = []
    while len(out) < limit:
        top = chains.best()
        if top is None or top[1] <= bound and (out or top[0] != first):
            break
        out.append(top)
        token = top[0][0] + top[0][1]
        if token in known or _BYTE_TOKEN.fullmatch(token):
            break
        known.add(token)
        chains.merge(top[0])
    return out


def _signed_pairs(spelling: str, sign: int) -> DataFrame | Column:
    symbols = F.split(F.col(spelling), GAP)
    pairs = F.transform(F.sequence(F.lit(1), F.size(symbols) - 1), lambda i: F.struct(
        F.get(symbols, i - 1).alias("left"), F.get(symbols, i).alias("right"), (F.lit(sign) * F.col("freq")).alias("freq")))
    # No pair, no list; a text of one symbol would count from 1 down to 0.
    return F.when(F.contains(F.col(spelling), F.lit(GAP)), pairs).otherwise(F.array().cast("array<struct<left:string,right:string,freq:bigint>>"))


def _changed_counts(words: DataFrame) -> DataFrame:
    """Signed pair counts of the words that changed; all words of the first round have nothing before."""
    both = F.concat(_signed_pairs("spelling", 1), F.when(F.col("was").isNull(), F.array().cast(
        "array<struct<left:string,right:string,freq:bigint>>")).otherwise(_signed_pairs("was", -1)))
    pairs = words.where("changed").select(F.inline(both))
    return pairs.groupBy("left", "right").agg(F.sum("freq").alias("freq"))


def _chains(words: DataFrame, head: set[Pair]) -> DataFrame:
    """Distinct chains of the head's pairs with their frequency."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["chain", "freq"])
            held.clear()
            return out

        for batch in batches:
            for spelling, freq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                symbols, start = spelling.split(GAP), 0
                for at, pair in enumerate(zip(symbols, symbols[1:]), 1):
                    if pair not in head:
                        if at - start > 1:
                            chain = GAP.join(symbols[start:at])
                            held[chain] = held.get(chain, 0) + freq
                        start = at
                if len(symbols) - start > 1:
                    chain = GAP.join(symbols[start:])
                    held[chain] = held.get(chain, 0) + freq
            if len(held) > HELD:
                yield flush()
        yield flush()

    found = words.select("spelling", "freq").mapInArrow(run, "chain string, freq bigint")
    return found.groupBy("chain").agg(F.sum("freq").alias("freq"))


def _merged(words: DataFrame, merges: Sequence[Pair]) -> DataFrame:
    """The words with their new spelling, and the one before where it changed."""
    ranks = {pair: rank for rank, pair in enumerate(merges)}
    carried = [c for c in words.columns if c not in ("spelling", "was", "changed")]
    schema = words.select(*carried, "spelling", "was", "changed").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(len(carried)).to_pylist()
            new = []
            for spelling in old:
                symbols = spelling.split(GAP)
                new.append(GAP.join(apply_merges(symbols, ranks)) if any(p in ranks for p in zip(symbols, symbols[1:])) else spelling)
            changed = [a != b for a, b in zip(old, new, strict=True)]
            was = [a if c else None for a, c in zip(old, changed, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(carried)], pa.array(new, pa.string()), pa.array(was, pa.string()), pa.array(changed)], schema.names)

    return words.select(*carried, "spelling").mapInArrow(run, schema)


def train_bpe(words: DataFrame, merges: int | None = None, *, vocab_size: int | None = None, reserved: int = 0,
              min_freq: int = 1, per_round: int = PER_ROUND, max_chains: int = MAX_CHAINS) -> Bpe:
    """Learn from a word table (``symbols``, ``freq``, other columns stay): the merges, in the same order, of
    taking the most frequent pair (ties by left, then right symbol) one at a time.

    Either ``merges`` says how many, or ``vocab_size`` how many tokens there are in all: ``reserved`` ones, the
    symbols that words begin with, and one for each merge. Words without symbols take no part.
    """
    if (merges is None) == (vocab_size is None):
        raise ValueError("give either merges or vocab_size")
    spark = words.sparkSession
    checked = F.when(F.exists("symbols", lambda s: s.contains(GAP)), F.raise_error(F.lit("a word holds the separator \\x01")))
    rest = [c for c in words.columns if c not in ("symbols", "freq")]
    state = words.where(F.size("symbols") > 0).select(
        *rest, F.col("freq").cast("bigint").alias("freq"), F.array_join(F.coalesce(checked, F.col("symbols")), GAP).alias("spelling"),
        F.lit(None).cast("string").alias("was"), F.lit(True).alias("changed"))
    # An explicit partition count: the word table is small in bytes but costly to spell.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    state = materialize(state.repartition(parts, "spelling"), "bpe-words")
    if merges is None:
        merges = max(0, vocab_size - reserved - state.select(F.explode(F.split("spelling", GAP))).distinct().count())
    counts = materialize(_changed_counts(state).where("freq <> 0"), "bpe-pairs")
    learned: list[tuple] = []
    known: set[str] = set()
    size = per_round
    while len(learned) < merges:
        ranking = counts.where(F.col("freq") >= min_freq).orderBy(F.desc("freq"), "left", "right")
        top = [((r["left"], r["right"]), r["freq"]) for r in ranking.limit(size + 1).collect()]
        if not top:
            break
        bound = 0 if len(top) <= size else top[-1][1]
        head = [pair for pair, freq in top if freq > bound] or [pair for pair, _ in top[:size]]
        rows = _chains(state, set(head)).limit(max_chains + 1).collect()
        while len(rows) > max_chains and len(head) > 1:
            size = max(1, len(head) // 2)
            bound = top[size][1]
            head = [pair for pair, freq in top if freq > bound] or [pair for pair, _ in top[:size]]
            rows = _chains(state, set(head)).limit(max_chains + 1).collect()
        if len(rows) > max_chains:
            rows = [(GAP.join(head[0]), top[0][1])]  # one pair alone: its count is all there is to know
        chains = Chains([(row[0].split(GAP), row[1]) for row in rows])
        found = certain_merges(chains, top[0][0], max(bound, min_freq - 1), known, merges - len(learned))
        for (left, right), freq in found:
            learned.append((len(learned), left, right, left + right, freq))
        state = materialize(_merged(state, [pair for pair, _ in found]), "bpe-words")
        changes = counts.unionByName(_changed_counts(state))
        counts = materialize(changes.groupBy("left", "right").agg(F.sum("freq").alias("freq")).where("freq <> 0"), "bpe-pairs")
        size = min(per_round, 2 * size)
    made = spark.createDataFrame(learned, "rank int, left string, right string, token string, freq bigint")
    return Bpe(made, state.select(*rest, "freq", F.split("spelling", GAP).alias("pieces")))
