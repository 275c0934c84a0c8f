"""Line corpus for tokenizer training: documents or lines in, distinct clean lines out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import content_md5, explode_lines, normalize_text, once
from quern.operators.dedup import dedup_exact
from quern.operators.order import head
from quern.session import materialize_counted


@dataclass(frozen=True)
class CorpusParams:
    min_chars: int = 10
    max_chars: int = 2**31 - 1
    # Stop after this many kept lines; 0 keeps all.
    max_lines: int = 0
    # Read this many documents; 0 reads all.
    sample_limit: int = 0


def _up_to(order: Sequence[str], last) -> Column:
    """Rows at or before ``last`` in lexicographic order."""
    out = F.lit(True)
    for c in reversed(order):
        out = (F.col(c) < F.lit(last[c])) | ((F.col(c) == F.lit(last[c])) & out)
    return out


@dataclass(frozen=True)
class CorpusResult:
    order: Sequence[str]
    params: CorpusParams
    prepared: DataFrame
    kept: DataFrame
    counts: dict[str, int]

    def stats(self) -> DataFrame:
        """One row of counts. With a line cap they cover the input up to the last kept line, which takes a scan of
        the reasons; else writing the tables has counted them."""
        n = dict(self.counts)
        if self.params.max_lines and n["kept"] >= self.params.max_lines:
            last = self.kept.orderBy(*(F.desc(c) for c in self.order)).select(*self.order).first()
            seen = self.prepared.where(_up_to(self.order, last))
            n |= seen.agg(*(c.alias(name) for name, c in _reason_counts().items())).first().asDict()
        row = (n["total_lines"], *(n[r] for r in REASONS), n["total_lines"] - sum(n[r] for r in REASONS) - n["kept"], n["kept"])
        names = ("total_lines", *REASONS, "duplicates", "kept")
        return self.prepared.sparkSession.createDataFrame([row], ", ".join(f"{c} bigint" for c in names))

    def log(self) -> DataFrame:
        """The counts with the parameters and the time."""
        p = self.params
        return self.stats().select(
            "*", F.lit(p.min_chars).alias("min_chars"), F.lit(p.max_chars).alias("max_chars"),
            F.lit(p.max_lines).alias("max_lines"), F.lit(p.sample_limit).alias("sample_limit"),
            F.current_timestamp().alias("timestamp"),
        )


REASONS = ("empty_after_clean", "too_short", "too_long")


def _reason_counts() -> dict[str, Column]:
    return {"total_lines": F.count("*"), **{r: F.count_if(F.coalesce(F.col("drop_reason") == r, F.lit(False))) for r in REASONS}}


def clean_lines(
    lines: DataFrame, order: Sequence[str], params: CorpusParams = CorpusParams(), line: str = "line"
) -> CorpusResult:
    """Normalise, filter by length, drop repeated lines anywhere in the corpus, cap.

    Prepared and kept lines are written once and counted as they are written.
    """
    rows = lines.select(*order, once(normalize_text(line)).alias("line"))
    reason = (
        F.when(F.col("line") == "", "empty_after_clean")
        .when(F.length("line") < params.min_chars, "too_short")
        .when(F.length("line") > params.max_chars, "too_long")
    )
    prepared, counts = materialize_counted(rows.withColumn("drop_reason", reason), "lines-prepared", **_reason_counts())
    passed = prepared.where(F.col("drop_reason").isNull()).drop("drop_reason")
    kept = dedup_exact(passed, content_md5("line"), order)
    if params.max_lines:
        kept = head(kept, params.max_lines, order)
    kept, size = materialize_counted(kept, "lines-kept", kept=F.count("*"))
    return CorpusResult(order, params, prepared, kept, counts | size)


def build_corpus(
    docs: DataFrame, text: str, order: Sequence[str], params: CorpusParams = CorpusParams()
) -> CorpusResult:
    """The line corpus of a table of documents."""
    if params.sample_limit:
        docs = head(docs, params.sample_limit, order)
    return clean_lines(explode_lines(docs, text, order), [*order, "line_no"], params)
