"""Exact top-k by inner product over norm buckets.

Components become integers, ``floor(1024 * x)``. Vectors are dealt out by length, longest first, ties
by id, so a task holds a few neighbouring lengths, cut into buckets of at most ``BUCKET`` vectors. For
a query with a known k-th score, a bucket needs a cosine of ``score / (query length * bucket length)``
at least: above one the bucket and all later ones are passed over. Otherwise the bucket is pruned by
length (only the prefix of vectors long enough at cosine one) when the threshold is low, or by
coordinates when it is high: in the query's largest coordinates a unit vector must lie inside
bounds that follow from the cosine. What is left gets its exact product. Bounds are widened by a
relative 1e-9 and pruning asks for a strictly smaller score, so ties stay.

Queries come in blocks of about ``BLOCK_BYTES`` of components; each block is one pass over the vectors, in
which a task meets a bucket with ``QUERIES`` queries at a time. A first pass over the longest vectors gives
every query a threshold to start from. A task returns at most k rows per query, and a block's rows are
written before the next block is read from its own folder, so the driver holds one block at a time.

Defined results: vectors that are null, or hold a null or non-finite component, take no part; only
vectors of the query's size are candidates; a zero vector scores zero with all; a component whose
integer does not fit 64 bits, or a product that does not, is an error; a null id is no query and ranks behind
all ids among ties; a query id that repeats is asked once, with its smallest vector; repeated rows are
candidates of their own, and only rows with the query's own id are left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import fresh_path, stored

SCALE = 1024
#: Integers of components stay below this in size, or the row is an error.
LIMIT = 1 << 63
QUERIES = 2048
#: Components of queries, eight bytes each, that one pass over the vectors takes along.
BLOCK_BYTES = 16 * 1024 * 1024
BUCKET = 2048
FIRST = 2048
FOCUS = 4
#: Local thresholds from which coordinates prune better than lengths.
SHARP = 0.5
LAST_ID = (1 << 63) - 1
QUERY = "id bigint, v array<bigint>, norm2 double"


def quantized(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(id, v, norm2)`` of the vectors that take part; the norm is of the integers."""
    x = F.col(vector)
    def scaled_one(c: Column) -> Column:
        y = c.cast("double") * SCALE
        return F.when(F.abs(y) < float(LIMIT), F.floor(y)).otherwise(F.raise_error(F.concat(F.lit("component does not fit 64 bits: "), c.cast("string"))))

    scaled = F.transform(x, scaled_one)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.when(x.isNotNull() & ~bad, x)
    df = df.select(F.col(vec_id).cast("bigint").alias("id"), whole.alias(vector)).where(F.col(vector).isNotNull())
    rows = df.select("id", scaled.cast("array<bigint>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return rows.select("id", "v", norm.alias("norm2"))


def products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer products; floating point where every partial sum is exact there, and Python's
    integers where one might not fit 64 bits."""
    top = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    if top < 2 ** 53:
        return (vectors.astype(np.float64) @ queries.astype(np.float64).T).astype(np.int64)
    if top < LIMIT:
        return vectors.astype(np.int64) @ queries.astype(np.int64).T
    return vectors.astype(object) @ queries.astype(object).T


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Search:
    """A block of queries of one size against buckets of vectors, longest bucket first."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.queries, self.k = ids, queries, k
        self.norm = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        #: Scores that a result must reach; nothing is known where they are the smallest integer.
        self.floor = np.full(len(ids), np.iinfo(np.int64).min) if floor is None else floor.copy()
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.verified = 0

    def bucket(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        """Search one bucket; its vectors are sorted by falling length."""
        longest = norms[0]
        reach = self.norm * longest * (1 + 1e-9)
        open_ = np.flatnonzero(reach >= self.floor)
        if not len(open_):
            return
        limit = self.floor[open_].astype(np.float64)
        local = np.divide(limit, self.norm[open_] * longest, out=np.full(len(open_), -1.0), where=self.norm[open_] * longest > 0)
        sharp = local >= SHARP
        plain = open_[~sharp]
        if len(plain):
            # Length pruning: one product for the prefix that the most patient query needs.
            need = np.divide(self.floor[plain].astype(np.float64), self.norm[plain], out=np.zeros(len(plain)), where=self.norm[plain] > 0)
            upto = len(norms) - int(np.searchsorted(norms[::-1], need.min() * (1 - 1e-9)))
            score = products(vectors[:upto], self.queries[plain])
            self.verified += score.size
            for column, q in enumerate(plain):
                self._take(q, ids[:upto], score[:, column])
        if sharp.any():
            unit = vectors / np.maximum(norms, 1e-300)[:, None]
            for q, cosine in zip(open_[sharp], local[sharp], strict=True):
                focus = np.argsort(-np.abs(self.queries[q]))[:FOCUS]
                direction = self.queries[q, focus] / self.norm[q]
                # |u - c q| is at most sqrt(1 - c^2) off the query's axis when the cosine is c or more.
                slack = np.sqrt(np.maximum(0.0, 1 - cosine ** 2)) * np.sqrt(np.maximum(0.0, 1 - direction ** 2)) + 1e-9
                low = np.where(direction >= 0, cosine * direction, direction) - slack
                high = np.where(direction >= 0, direction, cosine * direction) + slack
                inside = unit[:, focus]
                some = np.flatnonzero(((inside >= low) & (inside <= high)).all(axis=1))
                if len(some):
                    score = products(vectors[some], self.queries[q:q + 1])[:, 0]
                    self.verified += len(some)
                    self._take(q, ids[some], score)

    def _take(self, q: int, ids: np.ndarray, score: np.ndarray) -> None:
        if score.dtype == object:
            # Python's integers; a query's product with itself is not asked for and may be any size.
            other = ids != self.ids[q]
            ids, score = ids[other], score[other]
            if any(not -LIMIT < x < LIMIT for x in score):
                raise OverflowError("an inner product does not fit 64 bits")
            score = score.astype(np.int64)
        some = (score >= self.floor[q]) & (ids != self.ids[q])
        if not some.any():
            return
        ids, score = np.concatenate([self.found[q][0], ids[some]]), np.concatenate([self.found[q][1], score[some]])
        at = _best(ids, score, self.k)
        self.found[q] = ids[at], score[at]
        if len(at) == self.k:
            self.floor[q] = max(self.floor[q], score[at[-1]])


def _matrix(batch: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors and lengths of a table, for each vector size, longest first."""
    ids = batch["id"].fill_null(LAST_ID).to_numpy()
    norms = np.sqrt(batch["norm2"].to_numpy())
    lists = batch["v"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.values.to_numpy()
    starts = lists.offsets.to_numpy()[:-1]
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        rows = rows[np.lexsort((ids[rows], -norms[rows]))]
        out.append((ids[rows], flat[starts[rows][:, None] + np.arange(size)].reshape(len(rows), size), norms[rows]))
    return out


def _search_all(searches: list[Search], table: pa.Table) -> None:
    for ids, vectors, norms in _matrix(table):
        meets = [s for s in searches if s.queries.shape[1] == vectors.shape[1]]
        for at in range(0, len(ids) if meets else 0, BUCKET):
            for search in meets:
                search.bucket(ids[at:at + BUCKET], vectors[at:at + BUCKET], norms[at:at + BUCKET])


def _block(vectors: DataFrame, queries: pa.Table, first: pa.Table, k: int) -> DataFrame:
    """Best k of every query in each task, as ``(query_id, id, score)``."""
    start = [Search(ids[at:at + QUERIES], m[at:at + QUERIES], k) for ids, m, _ in _matrix(queries) for at in range(0, len(ids), QUERIES)]
    _search_all(start, first)
    plans = [(s.ids, s.queries, s.floor) for s in start]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(ids, m, k, floor) for ids, m, floor in plans]
        for batch in batches:
            if batch.num_rows:
                _search_all(searches, pa.Table.from_batches([batch]))
        for s in searches:
            n = [len(ids) for ids, _ in s.found]
            if sum(n):
                ids = np.concatenate([f[0] for f in s.found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(s.ids, n)), pa.array(ids, mask=ids == LAST_ID), pa.array(np.concatenate([f[1] for f in s.found]))],
                    ["query_id", "id", "score"])

    return vectors.mapInArrow(run, "query_id bigint, id bigint, score bigint")


def _blocks(queries: DataFrame) -> list[DataFrame]:
    """The queries dealt out by id to blocks of about ``BLOCK_BYTES``; more than one are written apart once."""
    size = 8 * (queries.agg(F.sum(F.size("v") + 1)).first()[0] or 0)
    count = -(-size // BLOCK_BYTES)
    if count <= 1:
        return [queries] * count
    path, block = fresh_path(queries.sparkSession, "query-blocks"), F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    queries.withColumn("block", block).write.partitionBy("block").parquet(path)
    apart = queries.sparkSession.read.schema(f"{QUERY}, block int").parquet(path)
    return [apart.where(F.col("block") == b) for b in range(count)]


def top_k(vectors: DataFrame, is_query: Column, vec_id: str, vector: str, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the rows that ``is_query`` picks, against all other rows."""
    queries = quantized(vectors.where(is_query & F.col(vec_id).isNotNull()), vec_id, vector)
    queries = stored(queries.groupBy("id").agg(F.min(F.struct("v", "norm2")).alias("q")).select("id", "q.v", "q.norm2"), "queries")
    # By length, then id: rows of one length do not have to share a task.
    dealt = stored(quantized(vectors, vec_id, vector).repartitionByRange(F.col("norm2").desc(), "id"), "vectors")
    first = dealt.orderBy(F.col("norm2").desc(), "id").limit(FIRST).toArrow()
    found = [stored(_block(dealt, block.select("id", "v", "norm2").toArrow(), first, k), "best") for block in _blocks(queries)]
    if not found:
        return dealt.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    every = functools.reduce(DataFrame.union, found)
    at = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    return every.withColumn("rank", at).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
