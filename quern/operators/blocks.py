"""Fixed-size blocks of token ids for pre-training."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quern.operators.order import row_index

# Ids of a row that go to a task's worker in one piece, and ids of blocks that come back at a time. Spark's batches count
# rows, so these bound what a worker holds, whatever the texts' length.
PIECE_IDS = 1024
MADE_IDS = 1 << 18


def pack_blocks(
    df: DataFrame, ids: str, block_size: int, order: Sequence[str], batch_rows: int = 1000,
    sep_id: int | None = None,
) -> DataFrame:
    """Concatenate the ids of each run of ``batch_rows`` rows and cut them into blocks.

    What is left over at the end of a batch is dropped. Returns ``batch``, ``block``, ``input_ids``,
    ``attention_mask`` and ``labels``. Rows with no ids take part in the batch count; null ids add nothing.
    ``sep_id`` adds a separator after each row. ``order`` must identify a row.

    Only order columns are numbered. The rows at the places where a slice of whole batches begins, one for each
    shuffle partition at most, come to the driver; every row finds its slice by comparing its order columns
    with theirs. Ids move once, to their slice, and each slice is cut in one pass over its sorted rows, in pieces, that
    holds less than a block and some blocks that are ready.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = row_index(df.select(*order), order, name="_at")
    rows = (numbered.agg(F.max("_at")).first()[0] or 0) + 1
    step = batch_rows * max(1, -(-rows // (batch_rows * slices)))
    starts = numbered.where(F.col("_at") % step == 0).orderBy("_at").select(*order).collect()
    kinds = [df.schema[c].dataType for c in order]

    def key(row) -> Column:
        return F.struct(*(F.lit(v).cast(kind).alias(c) for v, kind, c in zip(row, kinds, order, strict=True)))

    if len(starts) > 1:
        own = F.struct(*(F.col(c).cast(kind).alias(c) for c, kind in zip(order, kinds, strict=True)))
        place = F.size(F.filter(F.array(*map(key, starts[1:])), lambda start: start <= own))
    else:
        place = F.lit(0)
    body = F.col(ids) if sep_id is None else F.concat(F.col(ids), F.array(F.lit(sep_id).cast(df.schema[ids].dataType.elementType)))
    keys = [f"_k{i}" for i in range(len(order))]
    sliced = df.select(place.alias("_slice"), *(F.col(c).alias(k) for c, k in zip(order, keys, strict=True)), body.alias("_ids"))
    sliced = sliced.repartition(slices, "_slice").sortWithinPartitions("_slice", *keys)
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("block", T.LongType()), T.StructField("input_ids", df.schema[ids].dataType)])
    kind = to_arrow_schema(schema).field("input_ids").type

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, current, held, count, block = 0, None, [], 0, 0
        made: list[tuple[int, int, np.ndarray]] = []

        def ready() -> pa.RecordBatch:
            bounds = pa.array(np.arange(len(made) + 1, dtype=np.int32) * block_size)
            lists = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([w for _, _, w in made])).cast(kind.value_type))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in made]), pa.array([n for _, n, _ in made]), lists], schema.names)

        for part in batches:
            found = part.column(2)
            values = found.values.to_numpy(zero_copy_only=False)
            offsets, empty = found.offsets.to_numpy(), found.is_null().to_numpy(zero_copy_only=False)
            for k, (number, piece) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                if not piece:
                    # The first piece of a row.
                    at = at + 1 if current is not None and current[0] == number else 0
                    batch = (number * step + at) // batch_rows
                    if current != (number, batch):
                        current, held, count, block = (number, batch), [], 0, 0
                if empty[k]:
                    continue
                row = values[offsets[k]:offsets[k + 1]]
                held.append(row)
                count += len(row)
                if count >= block_size:
                    whole = np.concatenate(held)
                    for _ in range(count // block_size):
                        made.append((batch, block, whole[:block_size]))
                        whole, block = whole[block_size:], block + 1
                        if len(made) * block_size >= MADE_IDS:
                            yield ready()
                            made = []
                    held, count = [whole.copy()], len(whole)
            # What waits for the next batch does not keep this one.
            held = [np.concatenate(held)] if held else []
        if made:
            yield ready()

    # Rows are cut into pieces after the sort, so a row's pieces stay together even where the order has ties.
    pieces = F.when(F.size("_ids") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_ids") - 1) / PIECE_IDS).cast("int")),
        lambda i: F.slice("_ids", i * PIECE_IDS + 1, F.lit(PIECE_IDS))))
    full = sliced.select("_slice", F.posexplode_outer(pieces).alias("_piece", "_ids")).mapInArrow(cut, schema)
    return full.select(
        "batch", "block", "input_ids",
        F.array_repeat(F.lit(1), block_size).alias("attention_mask"),
        F.col("input_ids").alias("labels"),
    )
