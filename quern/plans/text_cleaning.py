"""Text cleaning: normalise, filter by turns and length, deduplicate, filter by label, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import (
    coalesce_text, content_md5, dialog_size, dialog_to_text, normalize_text, once,
)
from quern.operators.dedup import dedup_exact
from quern.operators.filters import label_filter
from quern.operators.neardup import dedup_near
from quern.session import materialize_counted
from quern.sources.readers import MALFORMED


# Longest text a length can count; a limit for texts is the caller's choice.
NO_LIMIT = 2**31 - 1


@dataclass(frozen=True)
class CleanParams:
    """Limits and switches of a cleaning job."""

    text_fields: Sequence[str] = ("text",)
    min_chars: int = 5
    max_chars: int = NO_LIMIT
    # Most turns of a dialog; None sets no limit.
    max_turns: int | None = None
    # Whether a row without text takes that of its dialog.
    read_dialogs: bool = True
    dedup: bool = False
    near_dedup: bool = False
    jaccard_threshold: float = 0.9
    # Deduplicate inside each value of these columns, such as the input file.
    scope: Sequence[str] = ()
    # Further columns that go with the text.
    keep: Sequence[str] = ()
    # Label filter: a target, and a label column or a classifier.
    target: str | None = None
    label: str | None = None
    classifier: Callable | None = None
    # Characters that the classifier sees; None shows the whole text.
    classifier_chars: int | None = None


# Drop reasons in the order in which a row is tested.
ROW_REASONS = ("malformed", "too_many_turns", "no_text", "empty_after_clean", "too_short", "too_long")


@dataclass(frozen=True)
class CleanResult:
    """Rows as prepared, then after each stage, and the counts that writing them has brought."""

    order: str
    prepared: DataFrame
    unique: DataFrame
    distinct: DataFrame
    kept: DataFrame
    counts: dict[str, int]

    def stats(self) -> DataFrame:
        """One row: the total, the rows dropped per reason, the rows kept. Only stages that were not written
        are counted here."""
        n = dict(self.counts)
        if "total" not in n:
            n |= self.prepared.agg(*(c.alias(name) for name, c in reason_counts().items())).first().asDict()
        passed = n["total"] - sum(n[r] for r in ROW_REASONS)
        sizes = [passed]
        for name, df, before in (("unique", self.unique, None), ("distinct", self.distinct, self.unique), ("kept", self.kept, self.distinct)):
            sizes.append(n[name] if name in n else sizes[-1] if df is before else df.count())
        row = (n["total"], *(n[r] for r in ROW_REASONS), *(a - b for a, b in zip(sizes, sizes[1:])), sizes[-1])
        names = ("total", *ROW_REASONS, "dedup", "near_dedup", "sentiment_filtered", "kept")
        return self.prepared.sparkSession.createDataFrame([row], ", ".join(f"{c} bigint" for c in names))

    def reasons(self) -> DataFrame:
        """``order`` and ``drop_reason`` of every input row; null means kept.

        Each stage marks the rows that reached it; one aggregate by the order key, which is unique, finds the
        last stage of each row.
        """
        stages = [(self.prepared.where(F.col("drop_reason").isNull()), 0), (self.unique, 1), (self.distinct, 2), (self.kept, 3)]
        marks = [df.select(self.order, F.lit(stage).alias("stage"), F.lit(None).cast("string").alias("reason")) for df, stage in stages]
        failed = self.prepared.where(F.col("drop_reason").isNotNull()).select(self.order, F.lit(0).alias("stage"), F.col("drop_reason").alias("reason"))
        last = reduce(DataFrame.unionByName, [failed, *marks]).groupBy(self.order).agg(F.max("stage").alias("stage"), F.max("reason").alias("reason"))
        left = F.when(F.col("stage") == 0, "dedup").when(F.col("stage") == 1, "near_dedup").when(F.col("stage") == 2, "sentiment_filtered")
        return last.select(self.order, F.coalesce("reason", left).alias("drop_reason"))


def reason_counts() -> dict[str, Column]:
    """Aggregates over prepared rows: the total and the rows of each reason."""
    return {"total": F.count("*"), **{r: F.count_if(F.coalesce(F.col("drop_reason") == r, F.lit(False))) for r in ROW_REASONS}}


def prepare(df: DataFrame, order: str, params: CleanParams) -> DataFrame:
    """``order``, the kept columns, the normalised ``text``, and ``drop_reason`` (null if it passes)."""
    raw = coalesce_text(df, params.text_fields)
    turns: Column = F.lit(None).cast("int")
    if "dialog" in df.columns:
        kind = df.schema["dialog"].dataType
        turns = dialog_size("dialog", kind)
    if "dialog" in df.columns and params.read_dialogs:
        raw = F.coalesce(raw, F.when(turns.isNotNull(), dialog_to_text("dialog", kind)))
    malformed = F.col(MALFORMED) if MALFORMED in df.columns else F.lit(False)
    extra = [c for c in dict.fromkeys([*params.scope, *params.keep]) if c != "text"]
    labels = [params.label] if params.label and params.label not in extra else []
    rows = df.select(
        order, *extra, *labels, malformed.alias("_bad"), turns.alias("_turns"),
        once(normalize_text(raw)).alias("text"),
    )
    text = F.col("text")
    reason = (
        F.when(F.col("_bad"), "malformed")
        .when(F.col("_turns") > (NO_LIMIT if params.max_turns is None else params.max_turns), "too_many_turns")
        .when(text.isNull(), "no_text")
        .when(text == "", "empty_after_clean")
        .when(F.length(text) < params.min_chars, "too_short")
        .when(F.length(text) > params.max_chars, "too_long")
    )
    return rows.select(order, *extra, *labels, "text", reason.alias("drop_reason"))


def clean_corpus(df: DataFrame, order: str, params: CleanParams = CleanParams()) -> CleanResult:
    """Run the job. ``order`` is one column that identifies and orders the rows.

    The label filter comes last: a row it removes still suppresses later duplicates. With
    deduplication or a label filter the prepared rows are written once: stages and reasons read that table,
    so the input is scanned once and its order keys stay what they were. What is written is counted as it is.
    """
    prepared, counts = prepare(df, order, params), {}
    if params.dedup or params.near_dedup or params.target:
        prepared, counts = materialize_counted(prepared, "clean-prepared", **reason_counts())
    passed = prepared.where(F.col("drop_reason").isNull()).drop("drop_reason")
    unique = dedup_exact(passed, content_md5("text"), [order], params.scope) if params.dedup else passed
    distinct = unique
    if params.near_dedup:
        unique, size = materialize_counted(unique, "clean-unique", unique=F.count("*"))
        counts |= size
        distinct = dedup_near(unique, order, "text", params.jaccard_threshold, scope=params.scope)
    kept = distinct
    if params.target:
        kept = label_filter(distinct, params.target, label=params.label, load=params.classifier,
                            max_chars=params.classifier_chars)
        if params.classifier is not None:
            # Scored once, whatever reads the result.
            kept, size = materialize_counted(kept, "clean-kept", kept=F.count("*"))
            counts |= size
    extra = [c for c in dict.fromkeys([*params.scope, *params.keep]) if c != "text"]
    columns = [order, *extra, "text"]
    kept = kept if kept.columns == columns else kept.select(*columns)
    distinct = kept if not params.target else distinct
    return CleanResult(order, prepared, unique, distinct, kept, counts)
