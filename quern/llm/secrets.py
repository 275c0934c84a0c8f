"""Secret scans with an incremental ledger of blobs.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger is a parquet
table of what each rule version found in each blob. A scan takes the distinct blobs that the ledger
lacks for the current rule version, scans each once, and appends to the ledger; findings reach all
paths and versions by a join on the blob. Distinct blobs are reduced in each task ahead of the
shuffle, so a text that a third of the paths share costs one row per task.

Rules (fixed values of the task, offsets in code points, leftmost matches that do not overlap):
assign, access key, hex run. Byte tests skip texts that cannot match; they drop no match.

Defined results: a null text is the empty blob; equal texts, whatever path or version they have, share
one scan; null paths are kept; an empty table gives no rows and leaves the ledger unchanged; bytes that
are not UTF-8 count as U+FFFD in offsets, while the blob is addressed by its bytes.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import map_texts, text_or_empty

#: Name of the rules below; a change of rules needs a new name.
RULES = "base-1"
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IS_HEX = bytes(1 if b in b"0123456789abcdef" else 0 for b in range(256))
_HINTS = (b"passw", b"secret", b"token", b"api")

SPAN = "array<struct<kind: string, start: int, end: int>>"


def scan(text: bytes) -> list[dict]:
    """Findings of one text by start, then kind as listed."""
    lower = text.lower()
    assign = any(h in lower for h in _HINTS)
    access = b"AKIA" in text
    run = b"\x01" * 24 in text.translate(_IS_HEX)
    if not (assign or access or run):
        return []
    chars, found = text.decode("utf-8", "replace"), []
    if assign:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(chars) if len(m[2]) >= 6]
    if access:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(chars) if len(m[0]) >= 20]
    if run:
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(chars)]
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(found)]


def _scan_all():
    return lambda texts: [[scan(t) for t in texts]]


def blob_id(text: str) -> Column:
    return F.sha2(text_or_empty(text).cast("binary"), 256)


LEDGER = f"blob_id string, rules string, spans {SPAN}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; a folder without one is an empty ledger."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def update_ledger(history: DataFrame, ledger: str, text: str = "text", rules: str = RULES) -> None:
    """Scan the blobs of ``history`` that the ledger lacks under ``rules`` and append what is found.

    An append is one write: if it fails, its blobs are still unseen and the next run scans them.
    """
    spark = history.sparkSession
    # One row for each text and task leaves the map side.
    blobs = history.select(text_or_empty(text).alias("text")).distinct().select(blob_id("text").alias("blob_id"), "text")
    known = read_ledger(spark, ledger).where(F.col("rules") == rules).select("blob_id")
    unseen = blobs.join(known, "blob_id", "left_anti")
    found, name = map_texts(unseen, "text", _scan_all, f"spans {SPAN}", "_found", ["blob_id"])
    found.select("blob_id", F.lit(rules).alias("rules"), F.col(name)["spans"].alias("spans")).write.mode("append").parquet(ledger)


def findings(history: DataFrame, ledger: str, keys: list[str], text: str = "text", rules: str = RULES) -> DataFrame:
    """``keys`` of every row of ``history``, its blob and the blob's findings under ``rules``."""
    names = [f"_{i}" for i in range(len(keys))]
    paths = history.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), blob_id(text).alias("_blob"))
    # Blobs without findings need no partner, so the rows to join are few, and a blob is there once.
    seen = read_ledger(history.sparkSession, ledger).where((F.col("rules") == rules) & (F.size("spans") > 0))
    seen = seen.groupBy("blob_id").agg(F.first("spans").alias("spans"))
    joined = paths.join(seen.withColumnRenamed("blob_id", "_blob"), "_blob", "left")
    spans = F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    return joined.select(*(F.col(n).alias(k) for n, k in zip(names, keys, strict=True)), F.col("_blob").alias("blob_id"), spans)


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
