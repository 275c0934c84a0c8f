"""Benchmark decontamination with an FM-index per shard of training documents.

A shard is one Arrow batch of documents. Words become integers: the number of the word in the
benchmark, or 0. An occurrence holds benchmark words only, so runs of benchmark words that are
shorter than the shortest window leave the shard's text without a loss. What stays is indexed:
suffix order by prefix doubling, the transform's ranks in a wavelet matrix, every eighth position
kept. All windows are searched backwards at once; the rows they end in are located by walking to a
kept position, and the covered words are merged into spans.

Defined results: a null text has no words, an item without words has no window, an item without id
counts under the empty id, repeated items and documents count as the rows they are; an empty
benchmark or table gives unhit or no rows. Extra columns of either side are untouched. Bytes that are not
UTF-8 are parts of words; offsets count every byte that does not continue a character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import free_name, fresh_path, map_texts, stored

WINDOW = 13
SAMPLE = 8
#: Benchmark text that one pass searches; more is searched in further passes over the same rows.
BLOCK_BYTES = 16 * 1024 * 1024

RESULT = ("n_words bigint, n_hit bigint, items array<string>, "
          "spans array<struct<start: bigint, end: bigint>>")
#: Lower-case ASCII; every byte that is no part of a word becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class FMIndex:
    """Occurrences of integer phrases in an integer text; symbols are 0 and above."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        text = np.append(symbols.astype(np.int64) + 1, 0)  # the end sorts first
        self.n = n = len(text)
        order = suffix_order(text)
        bwt = text[order - 1]
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.bwt = bwt
        self.levels = []
        level = bwt
        for bit in range(int(text.max()).bit_length() - 1, -1, -1):
            ones = (level >> bit) & 1
            ranks = np.zeros(n + 1, np.int32)
            np.cumsum(ones, out=ranks[1:])
            zeros = n - int(ranks[-1])
            self.levels.append((bit, ranks, zeros))
            level = np.concatenate([level[ones == 0], level[ones == 1]])
        kept = order % sample == 0
        self.kept, self.kept_rank = kept, np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        start = np.zeros_like(at)
        for bit, ranks, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            r, s = ranks[at], ranks[start]
            at = np.where(one, zeros + r, at - r)
            start = np.where(one, zeros + s, start - s)
        return at - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For phrases of one length: index of each phrase that occurs, and its row interval."""
        phrases = phrases + 1
        found = np.flatnonzero((phrases < len(self.counts) - 1).all(axis=1))
        low = self.counts[phrases[found, -1]]
        high = self.counts[phrases[found, -1] + 1]
        for column in range(phrases.shape[1] - 2, -1, -1):
            some = low < high
            found, low, high = found[some], low[some], high[some]
            if not len(found):
                break
            c = phrases[found, column]
            low = self.counts[c] + self.rank(c, low)
            high = self.counts[c] + self.rank(c, high)
        some = low < high
        return found[some], low[some], high[some]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out = np.zeros(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            done = self.kept[rows]
            out[open_[done]] = self.positions[self.kept_rank[rows[done]]] + steps
            open_, rows = open_[~done], rows[~done]
            c = self.bwt[rows]
            rows = self.counts[c] + self.rank(c, rows)
            steps += 1
        return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order; the last symbol occurs once and is the smallest."""
    rank, width, n = np.unique(text, return_inverse=True)[1].astype(np.int64), 1, len(text)
    while True:
        second = np.zeros(n, np.int64)
        second[:-width] = rank[width:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if fresh[order[-1]] == n - 1 or width >= n:
            return order
        rank, width = fresh, width * 2


class Phrases:
    """The windows of a block of benchmark items as word numbers, grouped by length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            width = min(window, len(ids))
            for i in range(len(ids) - width + 1 if ids else 0):
                owners.setdefault(tuple(ids[i:i + width]), set()).add(item)
        self.owners = [sorted(s) for s in owners.values()]
        by_width: dict[int, list[int]] = {}
        keys = list(owners)
        for i, key in enumerate(keys):
            by_width.setdefault(len(key), []).append(i)
        self.groups = [(w, np.array(at), np.array([keys[i] for i in at])) for w, at in sorted(by_width.items())]
        self.least = min(by_width, default=0)

    def search(self, texts: list[bytes]) -> list[list]:
        """Number of words, hit words, items and spans of each text of a shard."""
        n_words, parts, places, owners = [], [], [], []
        for doc, text in enumerate(texts):
            words = words_of(text)
            n_words.append(len(words))
            if len(words) < self.least or not self.groups:
                continue
            ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
            edges = np.flatnonzero(np.diff(np.concatenate([[False], ids > 0, [False]])))
            for start, end in edges.reshape(-1, 2).tolist():
                if end - start >= self.least:
                    parts += [ids[start:end], [0]]
                    places += [np.arange(start, end + 1)]
                    owners.append((doc, end - start + 1))
        hits, items, spans = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
        if parts:
            text, place = np.concatenate(parts), np.concatenate(places)
            doc = np.repeat([d for d, _ in owners], [n for _, n in owners])
            index, cover = FMIndex(text), np.zeros(len(text) + 1, np.int64)
            for width, at, phrases in self.groups:
                found, low, high = index.search(phrases)
                n = high - low
                if not len(n):
                    continue
                rows = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                start = index.locate(rows)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + width, -1)
                pairs = np.unique(np.stack([doc[start], np.repeat(at[found], n)]), axis=1)
                for d, phrase in pairs.T.tolist():
                    items[d] += self.owners[phrase]
            hit = np.cumsum(cover)[:-1] > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            for start, end in edges.reshape(-1, 2).tolist():
                spans[doc[start]].append((int(place[start]), int(place[start]) + end - start))
                hits[doc[start]] += end - start
        chars = [_char_spans(t, s) if s else [] for t, s in zip(texts, spans, strict=True)]
        return [n_words, hits, [sorted(set(i)) for i in items], chars]


def _char_spans(text: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Word spans as code point offsets."""
    bounds = [m.span() for m in _WORD.finditer(text.translate(_WORD_BYTES))]
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(chars[bounds[a][0]]), "end": int(chars[bounds[b - 1][1]])} for a, b in spans]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> tuple[int, Iterator[list[tuple[str, bytes]]]]:
    """How many blocks of a bounded size, and the benchmark's items block by block, one at a time on the driver.

    The sizes are summed first. An item goes to the block that the hash of its text names; more than one
    block are written apart once, so that each is read alone.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")
    ).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    if count > 1:
        path = fresh_path(benchmark.sparkSession, "benchmark")
        block = F.pmod(F.xxhash64("text"), F.lit(count)).cast("int")
        items.withColumn("block", block).write.partitionBy("block").parquet(path)
        items = benchmark.sparkSession.read.schema("item string, text string, block int").parquet(path)
    parts = (items.where(F.col("block") == k) if count > 1 else items for k in range(count))
    return count, ([(r["item"], r["text"].encode()) for r in part.toLocalIterator()] for part in parts)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, name: str = "_found", keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """Every row of ``docs`` with a struct: words, hit words, items and merged spans (code points).

    Phrases reach the tasks in blocks of at most ``BLOCK_BYTES`` of benchmark text. A block is one pass over
    the rows, without a shuffle. With more blocks than one the rows are written after each pass with what
    they have so far, hit spans and items, so the driver holds one block and no plan holds two.
    """
    columns, so_far = keep or docs.columns, None
    docs = docs.select(*dict.fromkeys([*columns, text]))
    count, blocks = _blocks(benchmark, item_id, item_text)
    for block in blocks:
        if so_far is not None:
            docs = stored(docs, "contamination")
        phrases = Phrases(block, window)  # travels with the function; Spark broadcasts large ones
        docs, made = map_texts(docs, text, lambda phrases=phrases: phrases.search, RESULT, name, columns if count == 1 else None)
        if so_far is not None:
            docs = _merged(docs, text, so_far, made)
        so_far = so_far or made
    return docs.select(*columns, so_far), so_far


def _merged(docs: DataFrame, text: str, first: str, second: str) -> DataFrame:
    """What two passes found in a row, as the struct of the first."""
    a, b = F.col(first), F.col(second)
    spans = free_name(docs, "_merged")
    docs = docs.withColumn(spans, merge_spans(F.concat(a["spans"], b["spans"])))
    out = F.struct(a["n_words"].alias("n_words"), count_words(F.col(text), F.col(spans)).alias("n_hit"),
                   F.array_sort(F.array_distinct(F.concat(a["items"], b["items"]))).alias("items"), F.col(spans).alias("spans"))
    return docs.withColumn(first, out).drop(second, spans)


def merge_spans(spans):
    """Overlapping or touching spans of an array column as one."""
    ordered = F.array_sort(spans)
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"]), joined).otherwise(
            F.concat(done, F.array(span)))

    return F.aggregate(ordered, empty, add)


def count_words(text, spans):
    """Words inside spans, by the operator's word rule."""
    pattern = F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    one = lambda s: F.size(F.regexp_extract_all(F.substring(text, s["start"] + 1, s["end"] - s["start"]), pattern, F.lit(0)))
    return F.aggregate(F.transform(spans, one), F.lit(0), lambda a, b: a + b).cast("bigint")


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without its spans, whose offsets are those of ``find_contamination``."""
    starts = np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80), len(text)).tolist()
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:starts[start]])
        at = starts[end]
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")


def contaminated(found: Column) -> Column:
    """At least a twentieth of the words, and one at least, are hit."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)
