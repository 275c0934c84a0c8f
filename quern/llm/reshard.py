"""Resharding by minimum-cost flow: fewest bytes moved from an old layout to new capacities.

A layout is a parquet table with a folder per shard and size class. Its blocks are the rows of one
shard and class (bytes up to the next power of two), so there are at most shards x 64 of them,
whatever the size of the table; only their counts and bytes come to the driver. The flow network: each
old shard sends its rows to the new shard of the same number for nothing, or block by block, at their
bytes, to a hub and from there to any shard. New shards take the rows per shard that are common to all,
and the remainder, one row each, where it is cheapest: for each old shard that is too large the row whose
move hangs on that choice is looked up, and has an arc of its own at its exact bytes. Within a block the
smallest rows move first, ties by their place in the files, so no plan moves fewer bytes.

Only blocks with moving rows are rewritten; the files of all other blocks stay as they are and are
part of the new layout. Slots number the rows of a new shard through its files. Law ``rows``: counts
differ by one at most.

Defined results: a null text has size 1 and checksum 0; repeated rows are rows of their own; extra
columns travel with their rows unless they have a name of the layout's own columns (then they are left
out); an empty table gives an empty layout.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import fresh_path, stored, text_or_empty

FILE_BYTES = 64 * 1024 * 1024
OWN = ("shard", "class", "size")


@dataclass
class Arc:
    to: int
    room: int
    cost: float
    back: int


def min_cost_flow(count: int, arcs: list[tuple[int, int, int, float]], source: int, sink: int) -> list[int]:
    """Flow on each arc ``(from, to, capacity, cost)`` of a maximum flow of least cost.

    Successive shortest paths; costs are not negative. A path is found by relaxing nodes from a queue.
    """
    graph: list[list[Arc]] = [[] for _ in range(count)]
    place = []
    for a, b, room, cost in arcs:
        place.append((a, len(graph[a])))
        graph[a].append(Arc(b, room, cost, len(graph[b])))
        graph[b].append(Arc(a, 0, -cost, len(graph[a]) - 1))
    while True:
        far = [float("inf")] * count
        via: list[Arc | None] = [None] * count
        far[source], queue, waiting = 0.0, [source], {source}
        while queue:
            a = queue.pop(0)
            waiting.discard(a)
            for arc in graph[a]:
                if arc.room and far[a] + arc.cost < far[arc.to] - 1e-9:
                    far[arc.to], via[arc.to] = far[a] + arc.cost, arc
                    if arc.to not in waiting:
                        waiting.add(arc.to)
                        queue.append(arc.to)
        if via[sink] is None:
            return [arcs[i][2] - graph[a][k].room for i, (a, k) in enumerate(place)]
        path, node = [], sink
        while node != source:
            arc = via[node]
            path.append(arc)
            node = graph[arc.to][arc.back].to
        push = min(arc.room for arc in path)
        for arc in path:
            arc.room -= push
            graph[arc.to][arc.back].room += push


def marginal_places(blocks: dict[tuple[int, int], tuple[int, int]], shards: int) -> dict[int, tuple[int, int]]:
    """``{old shard: (class, place in its block)}`` of the largest row that leaves a shard if it gets no row
    of the remainder, and stays if it gets one. Which shards get one is decided by the bytes of these rows."""
    even, out = sum(n for n, _ in blocks.values()) // shards, {}
    for s in sorted({s for s, _ in blocks if s < shards}):
        own = sorted((c, n) for (t, c), (n, _) in blocks.items() if t == s)
        place = sum(n for _, n in own) - even - 1
        for c, n in own:
            if 0 <= place < n:
                out[s] = c, place
            place -= n
    return out


def plan_moves(blocks: dict[tuple[int, int], tuple[int, int]], shards: int,
               marginal: dict[int, int] | None = None) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Rows that leave each block: ``{(shard, class): [(new shard, rows), …]}``, all else stays.

    ``blocks`` has rows and bytes by old shard and class, ``marginal`` the bytes of the rows that
    ``marginal_places`` names (default: the mean of their block). Old shards may be more or fewer than new ones.
    """
    old = sorted({s for s, _ in blocks})
    total = sum(n for n, _ in blocks.values())
    even, rest = divmod(total, shards)
    places = marginal_places(blocks, shards)
    source, sink, hub, more = 0, 1, 2, 3
    out = {s: 4 + i for i, s in enumerate(old)}
    into = {j: 4 + len(old) + j for j in range(shards)}
    arcs, arcs_of = [], {}
    for s in old:
        own = {c: v for (t, c), v in blocks.items() if t == s}
        n = sum(v[0] for v in own.values())
        arcs.append((source, out[s], n, 0.0))
        if s in into:
            arcs.append((out[s], into[s], n, 0.0))
        for c, (rows, size) in sorted(own.items()):
            parts = [(rows, size / rows)]
            if s in places:
                at, place = places[s]
                edge = float((marginal or {}).get(s, own[at][1] / own[at][0]))
                # Rows below the marginal one always move and rows above it never do.
                parts = ([(rows, min(size / rows, edge))] if c < at else [(rows, max(size / rows, edge))] if c > at else
                         [(place, min(size / rows, edge)), (1, edge), (rows - place - 1, max(size / rows, edge))])
            arcs_of[s, c] = range(len(arcs), len(arcs) + len(parts))
            arcs += [(out[s], hub, n, cost) for n, cost in parts]
    hub_at = {}
    for j in range(shards):
        hub_at[j] = len(arcs)
        arcs += [(hub, into[j], total, 0.0), (into[j], sink, even, 0.0), (into[j], more, 1, 0.0)]
    arcs.append((more, sink, rest, 0.0))
    flow = min_cost_flow(4 + len(old) + shards, arcs, source, sink)
    wanted = [[j, flow[at]] for j, at in hub_at.items() if flow[at]]
    moves: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for block, at in sorted(arcs_of.items()):
        left = sum(flow[k] for k in at)
        while left:
            take = min(left, wanted[0][1])
            moves[block].append((wanted[0][0], take))
            left, wanted[0][1] = left - take, wanted[0][1] - take
            if not wanted[0][1]:
                wanted.pop(0)
    return dict(moves)


def _marginal_sizes(rows: DataFrame, places: dict[int, tuple[int, int]]) -> dict[int, int]:
    """Bytes of the rows at the given places of their blocks, smallest rows first: counts by size over those
    blocks alone, of which there is one for each shard."""
    if not places:
        return {}
    spark = rows.sparkSession
    named = spark.createDataFrame([(s, c, place) for s, (c, place) in places.items()], "shard int, class int, _place bigint")
    counts = rows.select("shard", "class", "size").join(F.broadcast(named), ["shard", "class"]).groupBy("shard", "_place", "size").agg(F.count("*").alias("n"))
    # As many rows to a shard as its block has different sizes, which the class bounds.
    upto = F.sum("n").over(Window.partitionBy("shard").orderBy("size").rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("_upto", upto).where("_upto > _place").groupBy("shard").agg(F.min("size").alias("size"))
    return {r["shard"]: r["size"] for r in found.collect()}


def size_of(text: str) -> Column:
    return F.octet_length(text_or_empty(text)).cast("bigint") + 1


def size_class(size: Column) -> Column:
    """Number of binary digits."""
    return F.length(F.bin(size)).cast("int")


def write_layout(rows: DataFrame, path: str, shard: Column, text: str = "text") -> T.StructType:
    """Write ``rows`` as a layout under the given shard numbers, in files of about ``FILE_BYTES``;
    returns the layout's schema, which reading an empty one needs."""
    keep = [c for c in rows.columns if c.lower() not in OWN]
    sized = rows.select(*keep, shard.cast("int").alias("shard"), size_of(text).alias("size"))
    sized = sized.withColumn("class", size_class(F.col("size")))
    _write_blocks(sized, path)
    return sized.schema


def _write_blocks(sized: DataFrame, path: str) -> None:
    """Rows go to the task of their block and a salt that keeps the files of a block small."""
    stats = sized.groupBy("shard", "class").agg(F.sum("size").alias("bytes"))
    files = stats.select("shard", "class", F.ceil(F.col("bytes") / FILE_BYTES).cast("int").alias("_files"))
    salted = sized.join(F.broadcast(files), ["shard", "class"])  # shards x 64 rows at most
    salt = F.pmod(F.xxhash64(*sized.columns), F.col("_files").cast("bigint"))  # of the whole row, so a rerun deals alike
    count = max(1, files.agg(F.sum("_files")).first()[0] or 1)
    dealt = salted.withColumn("_salt", salt).repartition(count * 2, "shard", "class", "_salt")
    dealt.drop("_salt", "_files").write.partitionBy("shard", "class").parquet(path)


def read_layout(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of a layout with ``_file`` and ``_row``, which name a row's place."""
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def block_ranks(rows: DataFrame) -> DataFrame:
    """``(_file, _row, shard, class, rank)``: place of each row in its block, smallest rows first.

    Keys are range-sorted once and stored; a rank is the place in the slice less the first place of
    the block in it, plus the block's rows in earlier slices.
    """
    order = ["shard", "class", "size", "_file", "_row"]
    slices = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_slice"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    slices = stored(slices, "ranks")
    # One row per slice and block that meet: at most slices + blocks.
    starts = slices.groupBy("shard", "class", "_slice").agg(F.count("*").alias("_n"), F.min("_at").alias("_least"))
    before = Window.partitionBy("shard", "class").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("shard", "class", "_slice", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_shift"))
    return slices.join(F.broadcast(starts), ["shard", "class", "_slice"]).select(
        "_file", "_row", "shard", "class", (F.col("_at") + F.col("_shift")).alias("rank"))


def reshard(spark: SparkSession, old: str, new: str, shards: int, columns: list[Column] | None = None,
            schema: T.StructType | None = None) -> DataFrame:
    """Rows of the new layout: ``shard`` and ``slot`` beside the layout's columns, or beside ``columns``,
    which are evaluated ahead of the join that numbers the slots, so texts need not take part in it.

    Rewrites the blocks that rows leave into ``new``; other blocks are read where they are.
    """
    rows = read_layout(spark, old, schema)
    stats = rows.groupBy("shard", "class").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
    blocks = {(r["shard"], r["class"]): (r["n"], r["bytes"]) for r in stats}
    moves = plan_moves(blocks, shards, _marginal_sizes(rows, marginal_places(blocks, shards)))
    if moves:
        bounds = []
        for (s, c), to in moves.items():
            at = 0
            for j, n in to:
                bounds.append((s, c, at, at + n, j))
                at += n
        # A block has a row per new shard that it feeds: at most blocks x shards rows.
        table = spark.createDataFrame(bounds, "shard int, class int, low bigint, high bigint, to int")
        moving = F.broadcast(table.select("shard", "class").distinct())
        affected = rows.join(moving, ["shard", "class"], "left_semi")
        ranks = block_ranks(affected)
        to = ranks.join(F.broadcast(table), ["shard", "class"]).where("rank >= low and rank < high").select("_file", "_row", "to")
        placed = affected.join(to, ["_file", "_row"], "left").withColumn("shard", F.coalesce("to", "shard")).drop("to", "_file", "_row")
        _write_blocks(placed, new)
        # The folders of blocks are pruned, so files of rewritten blocks are not read again.
        kept = rows.join(moving, ["shard", "class"], "left_anti")
        rows = kept.unionByName(read_layout(spark, new, schema))
    files = rows.groupBy("shard", "_file").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(F.col("_file").alias("_name"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    if columns is not None:
        rows = rows.select(*columns, "shard", "_file", "_row")
    joined = rows.join(starts, F.col("_file") == F.col("_name"))
    return joined.withColumn("slot", F.col("_start") + F.col("_row")).drop("_start", "_name", "_file", "_row")


def rows_law(docs: DataFrame, shards: int = 8, old_shard: Column | None = None, text: str = "text",
             columns: list[Column] | None = None) -> DataFrame:
    """Write ``docs`` under their old shards (default: all in shard 0) and reshard them to counts at most one apart."""
    spark = docs.sparkSession
    old, new = fresh_path(spark, "layout"), fresh_path(spark, "layout")
    schema = write_layout(docs, old, F.lit(0) if old_shard is None else old_shard, text)
    return reshard(spark, old, new, shards, columns, schema)
