"""Writers. Row order inside each file follows the order columns where they are given."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quern.sources.readers import TSV_FORMAT, route_subdir


def _ordered(df: DataFrame, order: Sequence[str], columns: Sequence[str] | None) -> DataFrame:
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return df.select(*columns) if columns else df


def write_jsonl(
    df: DataFrame, path: str, order: Sequence[str] = (), columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """One JSON object per row; text stays UTF-8 and null fields are written."""
    writer = _ordered(df, order, columns).write.option("ignoreNullFields", "false")
    writer.partitionBy(*partition_by).json(path) if partition_by else writer.json(path)


def write_parquet(
    df: DataFrame, path: str, order: Sequence[str] = (), columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """The same rows as parquet."""
    writer = _ordered(df, order, columns).write
    writer.partitionBy(*partition_by).parquet(path) if partition_by else writer.parquet(path)


def write_corpus(df: DataFrame, path: str, line: str = "line", order: Sequence[str] = ()) -> None:
    """Plain text, one row per line, in order across the numbered files."""
    _ordered(df, order, [line]).write.text(path)


def write_tokens(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """``token<TAB>freq`` lines."""
    _ordered(df, order, ["token", "freq"]).write.options(**TSV_FORMAT).csv(path)


def dataset_file_name(dataset: str, split: str) -> str:
    """``owner/name`` and split as a file name."""
    return f"{dataset.replace('/', '_')}__{split}"


def clean_name(path: Column | str) -> Column:
    """The input file's name with ``_clean`` before its suffix."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.jsonl$", "_clean.jsonl")


def route_output(df: DataFrame, base: str, file: str = "_file", columns: Sequence[str] = ("text",),
                 order: Sequence[str] = ()) -> None:
    """Write cleaned rows to ``base/subdir=…/name=…``, taking both from each row's input path."""
    routed = df.withColumn("subdir", route_subdir(file)).withColumn("name", clean_name(file))
    write_jsonl(routed, base, order, [*columns, "subdir", "name"], partition_by=["subdir", "name"])


def write_dataset(df: DataFrame, base: str, subdir: str, partition_by: Sequence[str] = (), formats: Sequence[str] = ("jsonl", "parquet"),
                  **stats: Column) -> dict:
    """Write rows to ``base/subdir/<format>`` and then ``base/subdir/stats``: aggregates that the first write collects, as one
    JSON object. The statistics come last, so they mark a dataset that is complete.

    Rows are rebalanced by the folders they go to: Spark merges small ones and splits large ones to its advisory partition
    size, so a folder that holds most rows is written by many tasks. The plan of ``df`` runs once; each
    further format is written from the first.
    """
    if set(formats) - {"jsonl", "parquet"} or not formats:
        raise ValueError("formats are jsonl and parquet")
    spark, root, seen = df.sparkSession, f"{base.rstrip('/')}/{subdir}", Observation()
    observed = df.observe(seen, *(c.alias(name) for name, c in stats.items())) if stats else df
    rows = observed.hint("rebalance", *partition_by) if partition_by else observed.hint("rebalance")
    write = {"jsonl": write_jsonl, "parquet": write_parquet}
    first, *others = sorted(formats, reverse=True)  # parquet first: it keeps types
    write[first](rows, f"{root}/{first}", partition_by=partition_by)
    for name in others:
        again = spark.read.schema(df.schema).parquet(f"{root}/{first}")
        write[name](again.hint("rebalance", *partition_by) if partition_by else again, f"{root}/{name}", partition_by=partition_by)
    found = seen.get if stats else {}
    spark.createDataFrame([(json.dumps(found),)], "value string").coalesce(1).write.text(f"{root}/stats")
    return found


def split_totals(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split, and over all splits in the row whose split is null."""
    return df.rollup(split).agg(F.count("*").alias("rows"))
