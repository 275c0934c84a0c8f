"""SimHash near-duplicates: BK-trees over fingerprints.

A fingerprint's bit is set when more than half of the hashes of the text's three-word shingles have
it. Texts link when their fingerprints differ in at most three bits. The rows reduce to distinct
fingerprints first, so copies of a text cost one row per task.

Shards: 64 bits in four blocks; fingerprints within three bits agree in one block at least, so each
fingerprint goes to four shards, named by block number and value. A shard of more than
``FULL_SHARD`` fingerprints is cut by the same argument once more, over the other 48 bits. Each
shard gets a BK-tree, in which a node's children are keyed by their Hamming distance to it, and
every fingerprint of the shard descends only along edges within the radius of its own distance. The
trees of all shards grow with the corpus, so they are not broadcast: tree and queries of a shard meet
in one task by its key. A task reads its shards in order of their keys and holds a run of them, not
its whole partition. It reports a run's links as stars, never as pairs, and the stars become components
by distributed contraction.

Defined results: a null or empty text has fingerprint zero, and zero links like any other; fewer than
three words are one shingle; repeated rows have equal fingerprints; null ids count as larger than all
others, so a component of null ids only has a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import LOWER, map_texts, stored, whole_groups
from quern.llm.graph import components

RADIUS = 3
SEED = 42
FULL_SHARD = 4096
#: Tree visits that one step of a descent holds at most, and hashes expanded to bits at once.
FRONTIER = 1 << 20
#: Rows that a task gathers before it builds the trees of their shards.
RUN_ROWS = 1 << 19
HASHES = 1 << 16


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text, unsigned."""
    words = text.translate(LOWER).split()  # ASCII white space: the space and \x09 to \x0D
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < 3:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        ends = (start + length)[2:].tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(start[:-2].tolist(), ends, strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES):
        block = np.array(hashes[at:at + HASHES], np.uint64)
        bits = np.unpackbits(block.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _signed(text: bytes) -> int:
    value = fingerprint(text)
    return value - (1 << 64) if value >= 1 << 63 else value


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "_simhash", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with ``fp``, the fingerprint as a signed long."""
    def build():
        return lambda texts: [[_signed(t) for t in texts]]

    return map_texts(docs, text, build, "fp bigint", name, keep)


class BKForest:
    """One BK-tree for each group of fingerprints, held as arrays.

    ``groups`` are sorted; the first row of each is its root. Rows descend all at once, one level a
    step: the first row to reach an empty place (node, distance) takes it.
    """

    def __init__(self, groups: np.ndarray, values: np.ndarray):
        self.values, n = values, len(values)
        first = np.concatenate([[True], groups[1:] != groups[:-1]])
        self.root = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        node, rows = self.root.copy(), np.flatnonzero(~first)
        parents, labels, children = [], [], []
        while len(rows):
            distance = np.bitwise_count(values[rows] ^ values[node[rows]]).astype(np.int64)
            key = node[rows] * 65 + distance
            taken, at = np.unique(key, return_index=True)
            parents.append(taken // 65), labels.append(taken % 65), children.append(rows[at])
            place = rows[at][np.searchsorted(taken, key)]
            node[rows] = place
            rows = rows[place != rows]
        edge = np.concatenate(parents) * 65 + np.concatenate(labels) if parents else np.zeros(0, np.int64)
        order = np.argsort(edge)
        self.edge = edge[order]
        self.child = np.concatenate(children)[order] if children else np.zeros(0, np.int64)

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a query row and a later row of its group within the radius, level by level."""
        stack = [(queries, self.root[queries])]
        while stack:
            query, node = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            distance = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
            hit = (distance <= radius) & (node > query)
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.edge, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edge, node * 65 + np.minimum(distance + radius, 64), side="right")
            width = high - low
            total = int(width.sum())
            if total:
                start = np.repeat(low - np.concatenate([[0], np.cumsum(width)[:-1]]), width)
                stack.append((np.repeat(query, width), self.child[start + np.arange(total)]))


def _roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge links into a forest of labels; each label is the smallest row of its tree."""
    while True:
        x, y = parent[a], parent[b]
        open_ = x != y
        if not open_.any():
            return parent
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def local_stars(groups: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(value, smallest value it is joined to)`` over all shards of a task."""
    order = np.lexsort((values, groups))
    groups, values = groups[order], values[order]
    forest = BKForest(groups, values)
    distinct, ids = np.unique(values, return_inverse=True)
    parent = np.arange(len(distinct))
    for at in range(0, len(values), FRONTIER // 16):
        for a, b in forest.near(np.arange(at, min(len(values), at + FRONTIER // 16)), radius):
            parent = _roots(parent, ids[a], ids[b])
    moved = parent != np.arange(len(distinct))
    return distinct[moved], distinct[parent[moved]]


def _block(value, start: int, width: int):
    return F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << width) - 1))


def _shards(nodes: DataFrame) -> DataFrame:
    """Each fingerprint once per shard: ``(shard, fp)``; over-full shards are cut again."""
    fp = F.col("fp")
    first = F.array(*(F.concat(F.lit(f"{i}:"), _block(fp, 16 * i, 16)) for i in range(4)))
    keyed = nodes.select("fp", F.posexplode(first).alias("block", "shard"))
    full = keyed.groupBy("shard").count().where(F.col("count") > FULL_SHARD).select("shard", F.lit(True).alias("full"))
    marked = keyed.join(full, "shard", "left")
    rest = [[b for b in range(64) if b // 16 != i] for i in range(4)]
    parts = [[bits[12 * j:12 * j + 12] for j in range(4)] for bits in rest]

    def part(bits):
        """A run of 12 bits out of the other 48, which may lie on both sides of the block."""
        runs, at = [], 0
        while at < 12:
            n = 1
            while at + n < 12 and bits[at + n] == bits[at] + n:
                n += 1
            runs.append(F.shiftleft(_block(fp, bits[at], n), at))
            at += n
        return sum(runs[1:], runs[0])

    second = F.lit(None)
    for i in range(4):
        cut = F.array(*(F.concat_ws(":", F.col("shard"), F.lit(j), part(parts[i][j])) for j in range(4)))
        second = F.when(F.col("block") == i, cut).otherwise(second)
    shards = F.when(F.col("full"), second).otherwise(F.array("shard"))
    return marked.select("fp", F.explode(shards).alias("shard"))


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Star links ``(a, b)`` that join all fingerprints ``fp`` within the radius; nodes are distinct.

    Radii above three would need more blocks and are refused.
    """
    if not 0 <= radius <= 3:
        raise ValueError("four blocks find fingerprints within three bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key", RUN_ROWS):
            a, b = local_stars(table["key"].to_numpy(), table["fp"].to_numpy().view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    # Two shards that share a hash only share a tree.
    keyed = _shards(nodes).select("fp", F.xxhash64("shard").alias("key"))
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def near_components(prints: DataFrame, doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, root, component_id)`` for rows ``(doc_id, fp)``: a fingerprint that names the
    component, and the smallest id that can be reached.

    ``prints`` is read several times and should be a stored table.
    """
    nodes = stored(prints.groupBy("fp").agg(F.min(doc_id).alias("least")), "fingerprints")
    roots = components(near_links(nodes.select("fp"), radius))
    grouped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    grouped = stored(grouped, "grouped")
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select(doc_id, "fp", "root", "component_id")


def survivors(grouped: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fp)`` of one row per component: the smallest id, null behind all, then the fingerprint."""
    first = F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), "fp")).alias("first")
    return grouped.groupBy("root").agg(first).select(F.col("first.id").alias("id"), F.col("first.fp").alias("fp"))


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
