"""Quality classifier: votes of the nearest labelled documents in a latent space.

Features of a text are its terms, words (ASCII letters in lower case) and runs of ``GRAM`` bytes of
the whole text, each hashed to ``BUCKETS`` columns; beside them the counts of pairs of neighbouring
byte classes (letters by case, digits, spacing, each punctuation mark, bytes beyond ASCII) and of
words that repeat the word before, and the share of repeated lines. Runs of bytes stand for terms
where words are not spaced. Counts of a bounded labelled sample, weighted by their inverse document
frequency, give, by singular value decomposition, a latent space; sample vectors and projection travel
to every task, where each document's cosines to all sample vectors are computed in blocks. The nearest
``NEIGHBOURS`` vote with
a power of their similarity. The sample holds the labels in equal numbers where it can, and votes are
weighted by what each label's share is among the labelled rows.

The sample: the first ``SAMPLE`` ids of each label by the md5 of the id; that bound is a parameter.
Every document is scored.

Defined results: a null or empty text is scored as the text without counts, by the votes of all
sample rows alike; a label row that is null in id or label is left out; ids labelled twice take part
once per distinct label; without labels every score is 0.5; equal texts have equal scores.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import LOWER, free_name, map_texts, utf8

SAMPLE = 1500
DIMENSIONS = 48
NEIGHBOURS = 25
POWER = 8
KEEP = 0.7
BLOCK = 1024
#: Columns of the sample that are dense at a time.
COLUMNS = 512
#: Columns for hashed words, and as many for hashed runs of bytes; a power of two.
BUCKETS = 2048
GRAM = 4
#: Positions whose runs are hashed at a time.
CHUNK = 1 << 20


def _classes() -> tuple[bytes, int]:
    """Class of every byte: lower, upper, digit, space, line break, beyond ASCII, then each mark."""
    table, marks = bytearray(256), 7
    for b in range(256):
        c = chr(b)
        if "a" <= c <= "z":
            table[b] = 0
        elif "A" <= c <= "Z":
            table[b] = 1
        elif "0" <= c <= "9":
            table[b] = 2
        elif b == 32:
            table[b] = 3
        elif b == 10:
            table[b] = 4
        elif b >= 128:
            table[b] = 5
        elif b < 32 or b == 127:
            table[b] = 6
        else:
            table[b], marks = marks, marks + 1
    return bytes(table), marks


_TABLE, CLASSES = _classes()
#: Pairs, repeated words, repeated lines; then words and runs of bytes.
SHAPES = CLASSES * CLASSES + 2
WIDTH = SHAPES + 2 * BUCKETS


def _words(words: list[bytes]) -> np.ndarray:
    """Shares of the words by bucket."""
    counts = Counter(words)
    at = np.fromiter((zlib.crc32(w) % BUCKETS for w in counts), np.int64, len(counts))
    return np.bincount(at, np.fromiter(counts.values(), np.float64, len(counts)), BUCKETS) / len(words)


def _runs(text: bytes) -> np.ndarray:
    """Shares of the runs of ``GRAM`` bytes by bucket."""
    codes, out = np.frombuffer(text, np.uint8), np.zeros(BUCKETS, np.int64)
    last = len(codes) - GRAM + 1
    for at in range(0, last, CHUNK):
        end = min(at + CHUNK, last)
        run = np.zeros(end - at, np.uint32)
        for k in range(GRAM):
            run = run << 8 | codes[at + k:end + k]
        out += np.bincount((run * np.uint32(2654435761)) >> (33 - BUCKETS.bit_length()), minlength=BUCKETS)
    return out / last


def features(text: bytes) -> np.ndarray:
    """Square roots of shares, so that their cosine compares distributions."""
    out = np.zeros(WIDTH, np.float32)
    if len(text) > 1:
        codes = np.frombuffer(text.translate(_TABLE), np.uint8).astype(np.int32)
        pairs = codes[:-1] * CLASSES + codes[1:]
        out[:CLASSES * CLASSES] = np.bincount(pairs, minlength=CLASSES * CLASSES) / len(pairs)
    words = text.split()
    if len(words) > 1:
        out[SHAPES - 2] = sum(map(bytes.__eq__, words[1:], words)) / len(words)
        lines = [line for line in text.split(b"\n") if line]
        out[SHAPES - 1] = 1 - len(set(lines)) / len(lines)
    lower = text.translate(LOWER)
    if words:
        out[SHAPES:SHAPES + BUCKETS] = _words(lower.split())
    if len(text) >= GRAM:
        out[SHAPES + BUCKETS:] = _runs(lower)
    return np.sqrt(out)


class _Sample:
    """Weighted rows of the sample, kept as the places and values that are not zero. Dense copies are
    made of ``COLUMNS`` columns at a time."""

    def __init__(self, packed: Sequence[bytes]):
        sizes = [len(raw) // 6 for raw in packed]
        self.shape = len(packed), WIDTH
        self.rows = np.repeat(np.arange(len(packed), dtype=np.int32), sizes)
        self.places = np.concatenate([np.frombuffer(raw, np.uint16, n) for raw, n in zip(packed, sizes, strict=True)])
        self.values = np.concatenate([np.frombuffer(raw, np.float32, n, 2 * n) for raw, n in zip(packed, sizes, strict=True)])
        present = np.bincount(self.places[self.values > 0], minlength=WIDTH)
        self.weight = (1 + np.log((1 + len(packed)) / (1 + present))).astype(np.float32)
        self.values = self.values * self.weight[self.places]

    def columns(self) -> Iterator[tuple[slice, np.ndarray]]:
        for start in range(0, WIDTH, COLUMNS):
            end = min(start + COLUMNS, WIDTH)
            inside = (self.places >= start) & (self.places < end)
            dense = np.zeros((self.shape[0], end - start), np.float32)
            dense[self.rows[inside], self.places[inside].astype(np.int64) - start] = self.values[inside]
            yield slice(start, end), dense

    def products(self) -> np.ndarray:
        """Products of all pairs of rows."""
        out = np.zeros((self.shape[0], self.shape[0]), np.float32)
        for _, dense in self.columns():
            out += dense @ dense.T
        return out

    def right(self, dimensions: int) -> np.ndarray:
        """The right singular vectors, in columns, of the largest singular values that are not zero."""
        values, vectors = leading(self.products(), dimensions)
        vectors = vectors[:, values > max(values[0], 1e-12) * 1e-5].astype(np.float32)
        out = np.zeros((WIDTH, vectors.shape[1]), np.float32)
        for at, dense in self.columns():
            out[at] = dense.T @ vectors
        return out / np.maximum(np.linalg.norm(out, axis=0), 1e-12)

    def projected(self, projection: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[0], projection.shape[1]), np.float32)
        for at, dense in self.columns():
            out += dense @ projection[at]
        return out


def leading(square: np.ndarray, count: int, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, of a symmetric matrix without negative ones, and their
    vectors, by subspace iteration: a block of vectors is multiplied until its values stay."""
    size = len(square)
    width = min(size, count + 16)
    block = np.linalg.qr(np.random.default_rng(5).standard_normal((size, width)))[0].astype(np.float32)
    values = np.zeros(width)
    for _ in range(rounds):
        image = square @ block
        found, turn = np.linalg.eigh((block.T @ image).astype(np.float64))
        block = np.linalg.qr((image @ turn[:, ::-1]).astype(np.float64))[0].astype(np.float32)
        before, values = values, found[::-1]
        if np.abs(values - before)[:count].max() <= 1e-6 * max(values[0], 1e-30):
            break
    image = square @ block
    values, turn = np.linalg.eigh((block.T @ image).astype(np.float64))
    return values[::-1][:count], (block @ turn[:, ::-1])[:, :count]


class Neighbours:
    """Latent vectors of the labelled sample, and the votes of those nearest to a text. ``sample`` holds
    packed rows, or rows of features."""

    def __init__(self, sample: Sequence[bytes] | np.ndarray, labels: np.ndarray, share: float,
                 dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS, power: float = POWER):
        rows = _Sample([_packed(r) for r in sample] if isinstance(sample, np.ndarray) else sample)
        self.weight = rows.weight
        self.projection = rows.right(dimensions)
        self.vectors = _unit(rows.projected(self.projection))
        self.labels = labels.astype(np.float32)
        good = labels.mean()
        # Votes count as if labels came in their natural shares.
        up, down = share / max(good, 1e-9), (1 - share) / max(1 - good, 1e-9)
        self.prior = np.where(labels == 1, up, down).astype(np.float32)
        self.neighbours, self.power = min(neighbours, len(labels)), power

    def _latent(self, weighted: np.ndarray) -> np.ndarray:
        return _unit(weighted @ self.projection)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Share of the votes for label 1, for rows of features."""
        latent = self._latent(rows * self.weight)
        cosine = np.maximum(latent @ self.vectors.T, 0)
        nearest = np.argpartition(-cosine, self.neighbours - 1, axis=1)[:, :self.neighbours]
        close = np.take_along_axis(cosine, nearest, axis=1)
        empty = ~latent.any(axis=1)
        votes = (close ** self.power + 1e-12) * self.prior[nearest]
        score = (votes * self.labels[nearest]).sum(axis=1) / votes.sum(axis=1)
        score[empty] = (self.prior * self.labels).sum() / self.prior.sum()
        return score

    def build(self) -> Callable[[list[bytes]], list]:
        def work(texts: list[bytes]) -> list:
            scores = []
            for at in range(0, len(texts), BLOCK):
                rows = np.stack([features(t) for t in texts[at:at + BLOCK]])
                scores += self.score(rows).astype(float).clip(0, 1).tolist()
            return [scores]

        return work


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _packed(row: np.ndarray) -> bytes:
    """Places and values of what is not zero."""
    at = np.flatnonzero(row)
    return at.astype(np.uint16).tobytes() + row[at].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out, n = np.zeros(WIDTH, np.float32), len(raw) // 6
    out[np.frombuffer(raw, np.uint16, n)] = np.frombuffer(raw, np.float32, n, 2 * n)
    return out


def held_out(doc_id: str) -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE) -> Neighbours | None:
    """Learn from labelled rows that are not held out; at most ``2 * sample`` rows reach the driver,
    as the columns that are not zero, of a fixed width at most. None without labelled rows."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where(
        "id is not null and y in (0, 1)").where(~held_out("id")).distinct()
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not counts:
        return None
    # Each task keeps its own first rows ahead of the exchange, whatever share a label has.
    first = [known.where(F.col("y") == y).orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample) for y in (0, 1)]
    chosen = first[0].union(first[1])
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_packed(features(t)) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.binary())], ["id", "y", "v"])

    # Texts may repeat an id; one of them stays, whatever the order of rows.
    kind = docs.schema[doc_id].dataType.simpleString()
    vectors = rows.mapInArrow(run, f"id {kind}, y int, v binary")
    got = vectors.groupBy("id", "y").agg(F.min("v").alias("v")).orderBy("id", "y").collect()
    if not got:
        return None
    return Neighbours([bytes(r["v"]) for r in got], np.array([r["y"] for r in got]), counts.get(1, 0) / sum(counts.values()))


def with_quality(docs: DataFrame, model: Neighbours | None, text: str = "text",
                 name: str = "_quality", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with ``score``."""
    if model is None:
        name = free_name(docs, name)
        return docs.select(*(keep or docs.columns), F.struct(F.lit(0.5).alias("score")).alias(name)), name
    return map_texts(docs, text, model.build, "score double", name, keep)
