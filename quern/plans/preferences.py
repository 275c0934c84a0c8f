"""Preference triples: cleaning, alias columns, length budgets, prompt tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import content_md5, normalize_ws, once
from quern.operators.dedup import dedup_exact
from quern.operators.filters import require_nonblank
from quern.operators.neardup import dedup_near
from quern.session import materialize_counted

# Column names a preference record may use, most preferred first.
ALIASES = {
    "prompt": ("prompt", "question", "query"),
    "chosen": ("chosen", "response_chosen", "answer"),
    "rejected": ("rejected", "response_rejected", "negative"),
}


@dataclass(frozen=True)
class PreferenceParams:
    prompt_key: str = "prompt"
    chosen_key: str = "chosen"
    rejected_key: str = "rejected"
    min_chars: int = 5
    max_chars: int = 2**31 - 1
    dedup: bool = False
    near_dedup: bool = False
    jaccard_threshold: float = 0.9

    @property
    def keys(self) -> tuple[str, str, str]:
        return self.prompt_key, self.chosen_key, self.rejected_key


@dataclass(frozen=True)
class PreferenceResult:
    params: PreferenceParams
    prepared: DataFrame
    unique: DataFrame
    distinct: DataFrame
    kept: DataFrame
    counts: dict[str, int]

    def stats(self) -> DataFrame:
        """One row: counts per reason and the parameters. Only stages that were not written are counted here."""
        n, p = dict(self.counts), self.params
        if "total" not in n:
            n |= self.prepared.agg(*(c.alias(name) for name, c in _reason_counts().items())).first().asDict()
        passed = n["total"] - n["missing"] - n["length"]
        unique = n["unique"] if "unique" in n else self.unique.count() if p.dedup else passed
        distinct = self.distinct.count() if p.near_dedup else unique
        row = (n["total"], distinct, n["length"], n["missing"], passed - unique, unique - distinct, p.min_chars, p.max_chars, p.dedup,
               p.near_dedup, float(p.jaccard_threshold), *p.keys)
        return self.prepared.sparkSession.createDataFrame([row], (
            "total bigint, kept bigint, dropped_len bigint, dropped_missing bigint, dropped_dup bigint, dropped_near_dup bigint, "
            "min_chars bigint, max_chars bigint, dedup boolean, near_dedup boolean, jaccard_threshold double, "
            "prompt_key string, chosen_key string, rejected_key string"))


def _reason_counts() -> dict[str, Column]:
    return {"total": F.count("*"), **{r: F.count_if(F.coalesce(F.col("drop_reason") == r, F.lit(False))) for r in ("missing", "length")}}


def clean_preferences(
    df: DataFrame, order: str, params: PreferenceParams = PreferenceParams()
) -> PreferenceResult:
    """Drop incomplete and out-of-length triples, then exact and near copies.

    Missing values are tested before normalisation, so a value of spaces passes. Length and
    similarity are those of the three texts joined by newlines.
    """
    present = [F.coalesce(F.col(c), F.lit("")) != "" for c in params.keys]
    clean = [F.coalesce(normalize_ws(c), F.lit("")).alias(c) for c in params.keys]
    rows = df.select(
        order,
        (~(present[0] & present[1] & present[2])).alias("_missing"),
        once(F.struct(*clean, F.concat_ws("\n", *clean).alias("_joined"))).alias("_t"),
    ).select(order, "_missing", "_t.*")
    length = F.length("_joined")
    reason = F.when(F.col("_missing"), "missing").when(
        ~length.between(params.min_chars, params.max_chars), "length"
    )
    prepared = rows.select(order, *params.keys, "_joined", reason.alias("drop_reason"))
    counts: dict[str, int] = {}
    if params.dedup or params.near_dedup:
        # Stages read this table and the write counts it; the input is scanned once.
        prepared, counts = materialize_counted(prepared, "preference-prepared", **_reason_counts())
    passed = prepared.where(F.col("drop_reason").isNull()).drop("drop_reason")
    unique = dedup_exact(passed, content_md5("_joined"), [order]) if params.dedup else passed
    distinct = unique
    if params.near_dedup:
        unique, size = materialize_counted(unique, "preference-unique", unique=F.count("*"))
        counts |= size
        distinct = dedup_near(unique, order, "_joined", params.jaccard_threshold)
    return PreferenceResult(params, prepared, unique, distinct, distinct.select(order, *params.keys), counts)


def preference_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``prompt``, ``chosen``, ``rejected`` from whichever alias holds text; empty where none does."""
    def pick(names: Sequence[str]) -> Column:
        found = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
        return F.coalesce(*found, F.lit(""))

    return df.select(*keep, *(pick(names).alias(name) for name, names in ALIASES.items()))


def dpo_dataset(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Aliased triples in which no part is blank."""
    return require_nonblank(preference_columns(df, keep), list(ALIASES))


def length_budget(df: DataFrame, tokenizer, max_length: int = 1024, keep: Sequence[str] = ()) -> DataFrame:
    """Token counts of a triple, and whether the prompt exceeds half of ``max_length`` or a prompt
    with its answer exceeds all of it."""
    sized = df.select(
        *keep, *(F.size(tokenizer.tokens(c)).alias(f"{c}_tokens") for c in ("prompt", "chosen", "rejected"))
    )
    longest = F.greatest("chosen_tokens", "rejected_tokens")
    return sized.select(
        "*",
        (F.col("prompt_tokens") > max_length // 2).alias("prompt_over"),
        (F.col("prompt_tokens") + longest > max_length).alias("total_over"),
    )


def prompt_table(
    df: DataFrame, prompt_key: str, tokenizer, max_prompt_length: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Prompts for reinforcement learning, flagged when longer than the limit."""
    prompts = df.select(*keep, F.col(prompt_key).alias("prompt"))
    return prompts.withColumn("too_long", F.size(tokenizer.tokens("prompt")) > max_prompt_length)
