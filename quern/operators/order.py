"""Row order: global row numbers, first rows, samples.

Order columns must identify a row. First-come rules follow them, never the physical order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import materialize

# Up to this many rows a sort may keep its whole result in one task.
SMALL_LIMIT = 10_000
# Spark trims each task to its best k rows ahead of a window shuffle only while k stays below
# spark.sql.optimizer.windowGroupLimitThreshold, which is 1,000.
WINDOW_TRIM_LIMIT = 999
BROADCAST_BYTES = 8 * 1024 * 1024


def row_index(
    df: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "row_index"
) -> DataFrame:
    """Add the position (from 0) of each row by ``order``, counted inside each ``within`` group.

    The rows are range-partitioned and sorted once, so neither the whole table nor a large group
    has to fit into one task: a row's position is its place in its slice plus the number of rows in
    the slices before it. The slices are written out first because their bounds come from a sample
    and would differ if they were computed twice.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*within, *order]
    ranged = df.repartitionByRange(slices, *keys).sortWithinPartitions(*keys)
    ranged = ranged.select(
        "*",
        F.spark_partition_id().alias("_slice"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    stored = materialize(ranged, "row-index")

    if within:
        # One row per slice and group that meet; a large group is spread over its slices.
        before = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        meets = stored.groupBy("_slice", *within).agg(F.count("*").alias("_n"), F.min("_place").alias("_least"))
        meets = meets.select(
            F.col("_slice").alias("_s"), *(F.col(c).alias(f"_g{i}") for i, c in enumerate(within)),
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_shift"),
        )
        same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(within)]
        placed = stored.join(meets, reduce(and_, same, F.col("_slice") == F.col("_s")))
        return placed.select(*df.columns, (F.col("_shift") + F.col("_place")).alias(name))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: as many as there are shuffle partitions, whatever the data size.
    starts = stored.groupBy("_slice").agg(F.count("*").alias("_n")).select(
        "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    placed = stored.join(F.broadcast(starts), "_slice").withColumn(
        name, F.col("_start") + F.col("_place")
    )
    return placed.select(*df.columns, name)


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``order``; of rows alike in ``order`` at the end, any.

    Beyond ``SMALL_LIMIT`` only the order columns are numbered. The row at place ``n`` is the cut-off,
    and the table is filtered by it where it is scanned; no other column is sorted or written.
    """
    if n <= SMALL_LIMIT:
        return df.orderBy(*order).limit(n)
    numbered = row_index(df.select(*order), order, name="_at")
    key = F.struct(*order)
    cut = numbered.where(F.col("_at") == n - 1).select(key.alias("cut")).scalar()
    # Rows alike the cut-off: the places before them, and how many. None when the table ends before.
    last = numbered.where(key == cut).agg(F.min("_at").alias("ahead"), F.count("*").alias("alike")).first()
    if last["ahead"] is None:
        return df
    wanted = n - last["ahead"]
    if last["alike"] == wanted:
        return df.where(key <= cut)
    return df.where(key < cut).unionByName(df.where(key == cut).limit(wanted))


def head_per_group(df: DataFrame, n: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of each group; 0 keeps all rows.

    For small ``n`` each task trims to its own first ``n`` rows per group ahead of the shuffle, so
    a group that holds most of the table does not reach one task. Larger ``n`` numbers the group and
    order columns alone; the row at place ``n`` of each longer group is its cut-off, and the table is
    filtered by the cut-offs, which are broadcast while they are small. Of rows alike in ``order`` at the end
    of a group any stay, as many as are wanted; only such rows are numbered and written as a whole.
    """
    if n <= 0:
        return df
    if n <= WINDOW_TRIM_LIMIT:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return df.withColumn("_at", place).where(F.col("_at") <= n).drop("_at")
    numbered = materialize(row_index(df.select(*by, *(c for c in order if c not in by)), order, by, "_at"), "head-places")
    groups = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
    ends = numbered.where(F.col("_at") == n - 1).select(*groups, F.struct(*order).alias("_cut"))
    # How many rows are alike each cut-off, and how many of them are wanted.
    alike = numbered.join(ends, same).where(F.struct(*order) == F.col("_cut"))
    cuts = alike.groupBy(*(f"_g{i}" for i in range(len(by)))).agg(
        F.any_value("_cut").alias("_cut"), (F.lit(n) - F.min("_at")).alias("_wanted"), F.count("*").alias("_alike"))
    cuts = materialize(cuts, "head-cuts")
    sums = cuts.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size"), F.count_if(F.col("_alike") > F.col("_wanted")).alias("tied")).first()
    joined = df.join(F.broadcast(cuts) if (sums["size"] or 0) <= BROADCAST_BYTES else cuts, same, "left")
    key, at_cut = F.struct(*order), F.col("_alike") > F.col("_wanted")
    sure = joined.where(F.col("_cut").isNull() | (key < F.col("_cut")) | (key == F.col("_cut")) & ~at_cut).select(*df.columns)
    if not sums["tied"]:
        return sure
    tied = joined.where((key == F.col("_cut")) & at_cut).select(*df.columns, "_wanted")
    some = row_index(tied, order, by, "_at").where(F.col("_at") < F.col("_wanted")).select(*df.columns)
    return sure.unionByName(some)


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows as JSON text."""
    return head(df, n, order).select(*order, F.to_json(F.struct(*df.columns)).alias("json"))


def sample_rows(df: DataFrame, k: int, key: Column | str, seed: int) -> DataFrame:
    """``k`` rows without replacement, the same ones on every run and any partitioning.

    Rows are ranked by a hash of seed and ``key``; the key must identify the row.
    """
    key = F.col(key) if isinstance(key, str) else key
    ranked = df.withColumn("_draw", F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))))
    return head(ranked, k, ["_draw"]).drop("_draw")
