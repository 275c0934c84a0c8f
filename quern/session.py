"""Session settings and the shared scratch folder.

Iterative jobs (near-duplicate removal, subword learning, global row numbers) cut their lineage by
writing a parquet table into the folder named by ``spark.checkpoint.dir``. That folder must be
visible to every executor, so the tables outlive a lost executor and are never recomputed.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_FALLBACK: dict[str, str] = {}


def build_session(app_name: str = "quern", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; any of them can be overridden."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables of this application, below ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "dir" not in _FALLBACK:
            _FALLBACK["dir"] = tempfile.mkdtemp(prefix="quern-")
        root = _FALLBACK["dir"]
    return f"{root.rstrip('/')}/quern-{spark.conf.get('spark.app.id', 'app')}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return a scan of it.

    The returned frame has no lineage beyond the files, real size statistics for the planner, and
    the same rows on every read, so values such as partition ids taken before the write stay fixed.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize`` with aggregates that the write itself collects, so no scan follows for them.

    They are observed in the stage that writes, where each partition counts once, whatever is retried.
    """
    seen = Observation()
    named = [c.alias(name) for name, c in counts.items()]
    return materialize(df.observe(seen, *named), label), seen.get
