"""Readers. Text-based ones add an order column, as first-come rules follow file and line order."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.chat import ChatTemplate, parse_template
from quern.session import materialize

ORDER = "_order"
MALFORMED = "_malformed"
TSV_FORMAT = {"sep": "\t", "quote": "", "escape": ""}


def file_order() -> Column:
    """File path, then block offset, then place in the block: the order of a sorted file listing.

    Only valid in the select that sits directly on the scan. The id alone would not do, as Spark
    reads large files first. Holds within one scan; ``with_line_numbers`` makes it independent of the scan.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def with_order(scan: DataFrame) -> DataFrame:
    """Add the order column and the file path to a file scan."""
    return scan.select("*", file_order().alias(ORDER), F.col("_metadata.file_path").alias("_file"))


def _valid_utf8(c: Column) -> Column:
    """Drop bytes that are not UTF-8 instead of replacing them."""
    return F.when(F.is_valid_utf8(c), c).otherwise(F.replace(F.make_valid_utf8(c), F.lit("�"), F.lit("")))


def with_line_numbers(rows: DataFrame) -> DataFrame:
    """``rows`` of a line reader with ``_order`` as ``(path, line)``: the number of the line in its file, from 0.

    ``file_order`` depends on how a scan is split and packed into tasks; this does not, so the order of
    one run can be stored and compared with that of another. The rows are written once, which fixes their
    ids. Ids are consecutive inside a block of a file, hence line = id - first id of the block + lines of the
    blocks before it. The counts are one row per block (128 MB as Spark splits by default).

    Pass every line of the files: rows left out before are not counted.
    """
    held = materialize(rows, "lines")
    path, block, row = (F.col(f"{ORDER}.{name}") for name in ("path", "block", "row"))
    blocks = held.groupBy(path.alias("_path"), block.alias("_block")).agg(F.min(row).alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_path", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = held.join(starts, (path == F.col("_path")) & (block == F.col("_block")))
    order = F.struct(path.alias("path"), (row + F.col("_shift")).alias("line"))
    return placed.select(*(order.alias(c) if c == ORDER else F.col(f"`{c}`") for c in rows.columns))


def read_lines(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Text lines of all files that match ``path``: ``_order``, ``_file``, ``line``.

    ``numbered`` gives orders that hold from one scan to the next, for a table of all lines written on the way.
    """
    scan = with_order(spark.read.text(path))
    lines = scan.select(ORDER, "_file", _valid_utf8(F.col("value")).alias("line"))
    return with_line_numbers(lines) if numbered else lines


def is_json_object(line: Column) -> Column:
    """True when the line holds one JSON object and nothing after it.

    The parser stops at the end of the first value, so the line is read as the only element of a
    list: text after the object then breaks the list. Repeated keys and ``NaN`` are legal here,
    which is why the strict VARIANT parser does not decide.
    """
    elements = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>")
    one = F.size(elements) == 1
    return F.coalesce(one & F.trim(line).startswith("{") & F.trim(line).endswith("}"), F.lit(False))


def read_jsonl(
    spark: SparkSession, path: str, schema: str | T.StructType, skip_malformed: bool = False, numbered: bool = False
) -> DataFrame:
    """One JSON object per line, read with a fixed schema; missing keys are null.

    Lines that hold no object come back with ``_malformed`` true and null fields, so a caller can
    count them; ``skip_malformed`` leaves them and blank lines out. Declare a field as ``variant``
    when its shape differs from row to row. ``numbered`` is that of ``read_lines``.
    """
    lines = read_lines(spark, path, numbered)
    if skip_malformed:
        lines = lines.where(is_json_object(F.col("line")))
    fields = F.from_json(F.col("line"), schema if isinstance(schema, str) else schema.simpleString())
    rows = lines.select(
        ORDER, "_file", (~is_json_object(F.col("line"))).alias(MALFORMED), fields.alias("_fields")
    )
    kept = F.when(~F.col(MALFORMED), F.col("_fields")).alias("_fields")
    return rows.select(ORDER, "_file", MALFORMED, kept).select(ORDER, "_file", MALFORMED, "_fields.*")


def read_splits(
    spark: SparkSession, base: str, subdir: str = "", splits: Sequence[str] = ("train", "validation", "test")
) -> DataFrame:
    """Parquet files under ``base/subdir/<split>/`` as one frame with a ``split`` column."""
    root = "/".join(p.rstrip("/") for p in (base, subdir) if p)
    out: DataFrame | None = None
    for split in splits:
        scan = with_order(spark.read.parquet(f"{root}/{split}/*.parquet")).withColumn("split", F.lit(split))
        out = scan if out is None else out.unionByName(scan, allowMissingColumns=True)
    if out is None:
        raise ValueError("no splits given")
    return out


def read_dataset(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """``.txt`` as one ``text`` row per line, anything else as JSON records.

    Without a ``schema`` the fields are inferred, which costs one more pass. A missing path fails.
    """
    if path.lower().endswith(".txt"):
        return read_lines(spark, path).withColumnRenamed("line", "text")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return with_order(reader.json(path))


def read_stats(spark: SparkSession, base: str, subdir: str) -> dict:
    """The statistics of a dataset that ``writers.write_dataset`` has completed; fails for any other."""
    return json.loads(spark.read.text(f"{base.rstrip('/')}/{subdir}/stats").first()["value"])


def read_template(spark: SparkSession, path: str) -> ChatTemplate:
    """A chat template from its JSON file, a setting of a few hundred bytes."""
    return parse_template(spark.read.text(path, wholetext=True).first()["value"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """First column of a token list ``token<TAB>freq``, in file order; blank lines are skipped."""
    rows = with_order(spark.read.options(**TSV_FORMAT).schema("token string, freq string").csv(path))
    return rows.where(F.coalesce(F.trim("token"), F.lit("")) != "").select(ORDER, "token")


def route_subdir(path: Column | str, marker: str = "fetch_data") -> Column:
    """The folder that follows ``marker`` in a path; a path without one is an error."""
    path = F.col(path) if isinstance(path, str) else path
    found = F.regexp_extract(path, f"(?:^|/){marker}/([^/]+)", 1)
    message = F.concat(F.lit(f"no folder after {marker!r} in "), path)
    return F.when(found != "", found).otherwise(F.raise_error(message))


#: Session setting with the tasks that costly jobs over few or large files are spread over.
TASKS = "spark.quern.tasks"


def tasks_of(spark: SparkSession) -> int | None:
    """The session's ``spark.quern.tasks``; none unless it is set."""
    value = spark.conf.get(TASKS, None)
    return int(value) if value else None


def spread(df: DataFrame, tasks: int | None, key: Sequence[str]) -> DataFrame:
    """``df`` dealt out to ``tasks`` tasks by ``key``, or as it is scanned where ``tasks`` is None.

    A file with one row group is one task, whatever its rows cost. ``key`` should identify a row, so that
    no task gets more than its share and a retried one gets the same rows.
    """
    return df if tasks is None else df.repartition(tasks, *key)
