"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quern.session import scratch_dir

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and scan it: the lineage ends there."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores behind it while the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null counts as the empty text."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def map_texts(
    df: DataFrame, text: str, build: Callable[[], Callable[[list[bytes]], list]], result: str, name: str,
    keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """The columns ``keep`` (default: all) and a struct column with what ``build()`` makes of each text.

    ``build`` runs once per task; what it returns gets the texts of an Arrow batch as bytes and
    returns one list per field of ``result``. The struct has a name that ``df`` does not use, so no
    column of the input is shadowed. Returns the frame and that name.
    """
    name = free_name(df, name)
    made = T.StructType.fromDDL(result)
    at = df.columns.index(text)
    kept = [i for i, c in enumerate(df.columns) if keep is None or c in keep]
    schema = T.StructType([*(df.schema.fields[i] for i in kept), T.StructField(name, made, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        fields = list(to_arrow_schema(made))
        for batch in batches:
            columns = work(utf8(batch.column(at)))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
            struct = pa.StructArray.from_arrays(arrays, fields=fields)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), struct], [str(i) for i in range(len(kept) + 1)])

    positional = df.toDF(*(str(i) for i in range(len(df.columns))))
    plain = T.StructType([T.StructField(str(i), f.dataType, True) for i, f in enumerate(schema.fields)])
    return positional.mapInArrow(run, plain).toDF(*schema.names), name


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that cut no group of the sorted column ``key``."""
    held, count, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        fresh = np.flatnonzero(np.concatenate([[last is not None and keys[0] != last], keys[1:] != keys[:-1]]))
        last = keys[-1]
        if count + batch.num_rows >= rows and len(fresh):
            cut = int(fresh[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            batch, held, count = batch.slice(cut), [], 0
        held.append(batch)
        count += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the worker process; functions arrive anew with each task.
    Callers bound its size, and only keep what follows from its key."""
    return sys.__dict__.setdefault("_worker_stores", {}).setdefault(name, {})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str):
    return F.coalesce(F.col(column), F.lit(""))
