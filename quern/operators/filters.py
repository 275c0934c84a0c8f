"""Row filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import _col, is_blank


def length_between(c: Column | str, lo: int, hi: int) -> Column:
    """Length in characters within both bounds."""
    return F.length(_col(c)).between(lo, hi)


def max_bytes(c: Column | str, n: int) -> Column:
    """UTF-8 size of at most ``n`` bytes."""
    return F.octet_length(_col(c)) <= n


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows in which no listed column is null or empty; whitespace counts as present."""
    for c in cols:
        df = df.where(F.coalesce(F.col(c), F.lit("")) != "")
    return df


def require_nonblank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows in which every listed column holds more than whitespace."""
    for c in cols:
        df = df.where(~is_blank(c))
    return df


def label_matches(label: Column | str, target: str) -> Column:
    """Label starts with the target, ignoring case. A null label (no verdict) passes."""
    label = _col(label)
    return label.isNull() | F.lower(label).startswith(target.lower())


# Bytes of texts that a classifier is given at a time; one text may be longer.
SCORED_BYTES = 1 << 20


def _portions(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of at most `SCORED_BYTES`, of one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        stop = max(int(np.searchsorted(ends, before + SCORED_BYTES, "right")), start + 1)
        yield texts.slice(start, stop - start)
        start = stop


def scorer_udf(load: Callable[[], Callable[[pd.Series], pd.Series]]):
    """An Arrow function from a classifier factory; ``load`` runs once per Python worker task.

    The classifier maps a batch of texts to labels, with null for a text it cannot score. A batch on
    which it fails is scored text by text; a text on which it fails has no verdict, so its row stays.
    Spark's batches count rows, not bytes; the classifier gets them in portions of `SCORED_BYTES`, so that what a
    worker holds of texts as Python values grows neither with the batch nor with the task.
    """
    def one(classify, text: str) -> str | None:
        try:
            return classify(pd.Series([text])).iloc[0]
        except Exception:  # whatever a classifier raises over a text is that text's failure
            return None

    @F.arrow_udf("string")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        classify = load()
        for batch in batches:
            scored = []
            for part in _portions(batch):
                texts = part.to_pandas()
                try:
                    labels = classify(texts)
                except Exception:
                    labels = pd.Series([one(classify, t) for t in texts], index=texts.index, dtype=object)
                scored.append(pa.Array.from_pandas(labels, type=pa.string()))
            yield pa.concat_arrays(scored) if scored else pa.array([], pa.string())

    return score


def label_filter(
    df: DataFrame,
    target: str,
    *,
    label: str | None = None,
    load: Callable[[], Callable[[pd.Series], pd.Series]] | None = None,
    model: PipelineModel | None = None,
    text: str = "text",
    max_chars: int | None = None,
) -> DataFrame:
    """Keep rows whose label starts with ``target``; rows without a verdict stay.

    The label is a column, or comes from a classifier that sees the whole text, or its first
    ``max_chars`` characters:
    ``load`` for a batch function, ``model`` for a fitted pipeline that reads the text column and
    writes a string column ``label``.
    """
    if label is not None:
        return df.where(label_matches(label, target))
    shown = F.col(text) if max_chars is None else F.substring(F.col(text), 1, max_chars)
    if load is not None:
        scored = df.withColumn("_label", scorer_udf(load)(shown))
        return scored.where(label_matches("_label", target)).drop("_label")
    if model is not None:
        whole = df.withColumn("_whole", F.col(text)).withColumn(text, shown)
        kept = model.transform(whole).where(label_matches("label", target))
        return kept.withColumn(text, F.col("_whole")).select(*df.columns)
    raise ValueError("give a label column, a classifier factory or a fitted pipeline")
