"""Quality rules with verdicts on hosts, in Column functions alone.

Every document gets the measures of its whole text and the rules it fails. The failures of each rule are
counted by host; a host's rate is shrunk by a beta prior that is estimated from all hosts, so that a few
documents do not condemn a host and many speak for themselves. A host whose shrunk rate of a rule is above
``LIMIT`` is condemned by that rule. The verdicts are joined back: a document goes where it fails a base
rule, or where it fails a strict rule and its host is condemned by that rule. So a document with a blemish
stays on a host where that is rare and goes where it is the habit; documents without a blemish stay anywhere.

Base rules: fewer than ``LEAST_WORDS`` words, or more than ``REPEATED`` percent of the words in windows of
``WINDOW`` words that the text holds twice or more. Strict rules:

* ``short``: fewer than ``STRICT_WORDS`` words
* ``repeats``: more than ``STRICT_REPEATED`` percent of the words in repeated windows
* ``symbols``: more than ``SYMBOLS`` percent of the words' characters are of ``#*$%&|<>``
* ``lines``: repeated lines, as many as ``LINES`` percent of the lines with a word or more
* ``lengths``: a mean word length outside ``LENGTHS``; not asked of texts with letters that are written
  without spaces

The prior is that of the method of moments: with ``f`` failures among ``n`` documents of each of ``H``
hosts, ``N`` documents, ``m = sum f / N`` and ``S = sum f * f / n - N * m * m``, the share of the variance
between hosts is ``(S - (H - 1) * m * (1 - m)) / (m * (1 - m) * (N - sum n * n / N - (H - 1)))`` and the
prior counts as ``1 / share - 1`` documents of rate ``m``. With no variance beyond chance, or one host, it
counts as ``N`` documents.

Counts are summed in each task ahead of the exchange, so a host of any size is a row per task. Only condemned hosts are joined:
broadcast while they are fewer than ``BROADCAST`` rows, else in a shuffled join that Spark splits where a host
is large; documents without a host pass by it.

Defined results: a null text has no words and fails for that; a null host is no host, its documents are
judged by the base rules and are not counted; repeated rows count as often as they occur; no documents give
no rows; bytes that are not UTF-8 are matched as Spark reads them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import free_name, stored

WINDOW = 5
LEAST_WORDS = 10
REPEATED = 20
STRICT_WORDS = 20
STRICT_REPEATED = 10
SYMBOLS = 5
LINES = 30
LENGTHS = (3, 10)
LIMIT = 0.2
BROADCAST = 100_000

RULES = ("short", "repeats", "symbols", "lines", "lengths")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = " \t\n\x0b\x0c\r"
_MARKS = r"[#*$%&|<>]"
#: Scripts written without spaces: Thai, Lao, Myanmar, Khmer, Japanese, Chinese.
_UNSPACED = r"[฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of ``WINDOW`` words that occur twice or more, the first time included.

    Windows are compared by 64-bit hashes of their words, within one text. Places are looked at only where
    the text has equal ones; then equal hashes are neighbours once sorted with their places, and each place
    adds the words up to the next one, ``WINDOW`` at most."""
    none = F.lit(0).cast("bigint")

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - (WINDOW - 1)), lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW))))

    def places(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, p, k: F.coalesce(F.get(s, k)["h"] == p["h"], F.lit(False))
        return _let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda p, k: same(s, p, k - 1) | same(s, p, k + 1)), lambda p: p["i"])))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, none, lambda a, x: a + x)

    some = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(_let(places(h), covered))
    return F.when(F.size(words) <= WINDOW, none).otherwise(_let(windows(words), some))


def measures(text: Column) -> list[Column]:
    """Structs with the counts over words and over lines, and what is counted in the text as a whole."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != "")
    of_words = lambda w: F.struct(
        F.size(w).cast("bigint").alias("n"), F.length(F.array_join(w, "")).cast("bigint").alias("chars"), repeated_words(w).alias("repeated"))
    of_lines = lambda x: F.struct(F.size(x).cast("bigint").alias("n"), F.size(F.array_distinct(x)).cast("bigint").alias("distinct"))
    return [
        _let(split_words(text), of_words).alias("words"), _let(lines, of_lines).alias("lines"),
        F.regexp_count(text, F.lit(_MARKS)).cast("bigint").alias("n_symbols"), text.rlike(_UNSPACED).alias("unspaced"),
    ]


def measured(docs: DataFrame, text: str = "text", name: str = "_measures") -> tuple[DataFrame, str]:
    """All columns, and a struct with the measures, ``base_failed`` and ``failed_<rule>``."""
    name = free_name(docs, name)
    rows = docs.withColumn(name, F.struct(*measures(F.col(text))))
    got = F.col(name)
    rows = rows.withColumn(name, F.struct(
        got["words"]["n"].alias("n_words"), got["words"]["chars"].alias("word_chars"), got["n_symbols"].alias("n_symbols"),
        (got["lines"]["n"] - got["lines"]["distinct"]).alias("n_dup_lines"), got["words"]["repeated"].alias("n_repeat_words"),
        got["lines"]["n"].alias("n_lines"), got["unspaced"].alias("unspaced")))
    n, chars, repeated, again = got["n_words"], got["word_chars"], got["n_repeat_words"], got["n_dup_lines"]
    fails = {
        "short": n < STRICT_WORDS,
        "repeats": 100 * repeated > STRICT_REPEATED * n,
        "symbols": 100 * got["n_symbols"] > SYMBOLS * chars,
        "lines": (again > 0) & (100 * again >= LINES * got["n_lines"]),
        "lengths": ~got["unspaced"] & ((chars < LENGTHS[0] * n) | (chars > LENGTHS[1] * n)),
    }
    base = (n < LEAST_WORDS) | (100 * repeated > REPEATED * n)
    return rows.withColumn(name, F.struct(
        *(got[m].alias(m) for m in MEASURES), base.alias("base_failed"), *(fails[r].alias(f"failed_{r}") for r in RULES))), name


@dataclass
class Prior:
    """What every host starts from: so many documents of that rate."""

    rate: dict[str, float] = field(default_factory=dict)
    documents: dict[str, float] = field(default_factory=dict)


def host_counts(rows: DataFrame, name: str, host: str = "source") -> DataFrame:
    """``host``, ``n`` and ``f_<rule>``: documents and failures of each host, from measured rows."""
    counts = [F.sum(F.col(name)[f"failed_{r}"].cast("bigint")).alias(f"f_{r}") for r in RULES]
    return rows.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), *counts)


def prior(hosts: DataFrame) -> Prior:
    """One row of sums over all hosts reaches the driver."""
    sums = [F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum((F.col("n") * F.col("n")).cast("double")).alias("nn")]
    for r in RULES:
        sums += [F.sum(f"f_{r}").alias(f"f_{r}"), F.sum((F.col(f"f_{r}") * F.col(f"f_{r}")).cast("double") / F.col("n")).alias(f"ff_{r}")]
    got, out = hosts.agg(*sums).first(), Prior()
    many, total = got["hosts"], got["n"] or 0
    for r in RULES:
        rate = got[f"f_{r}"] / total if total else 0.0
        chance, share = rate * (1 - rate), 0.0
        free = total - got["nn"] / total - (many - 1) if total else 0.0
        if chance > 0 and many > 1 and free > 0:
            spread = got[f"ff_{r}"] - total * rate * rate
            share = (spread - (many - 1) * chance) / (chance * free)
        out.rate[r] = rate
        # Rounded, so that the order of a sum does not decide.
        out.documents[r] = round(min(max(1 / share - 1, 0.0), float(total)), 6) if share > 1e-12 else float(total)
    return out


def verdicts(hosts: DataFrame, known: Prior, limit: float = LIMIT) -> DataFrame:
    """``host`` and, for each rule, the shrunk rate ``rate_<rule>`` and whether the host is condemned by it."""
    out = hosts
    for r in RULES:
        shrunk = (F.col(f"f_{r}") + F.lit(known.rate[r] * known.documents[r])) / (F.col("n") + F.lit(known.documents[r]))
        out = out.withColumn(f"rate_{r}", F.round(shrunk, 9)).withColumn(f"condemned_{r}", F.round(shrunk, 9) > F.lit(limit))
    return out.select("host", "n", *(f"{c}_{r}" for r in RULES for c in ("rate", "condemned")))


def condemned(rows: DataFrame, name: str, host: str = "source", limit: float = LIMIT) -> DataFrame:
    """``host`` and ``condemned_<rule>`` of the hosts that a rule condemns. Counts of hosts are written once."""
    hosts = stored(host_counts(rows, name, host), "hosts")
    found = verdicts(hosts, prior(hosts), limit)
    return found.where(F.greatest(*(F.col(f"condemned_{r}") for r in RULES))).select("host", *(f"condemned_{r}" for r in RULES))


def judged(rows: DataFrame, name: str, bad: DataFrame, host: str = "source", kept: str = "_kept") -> tuple[DataFrame, str]:
    """Measured rows with whether they stay: no base rule fails, and no strict one that condemns the host."""
    kept = free_name(rows, kept)
    bad = bad.select(F.col("host").alias("_bad_host"), F.struct(*(f"condemned_{r}" for r in RULES)).alias("_bad"))
    got, against = F.col(name), F.col("_bad")
    guilty = F.greatest(*(F.coalesce(got[f"failed_{r}"] & against[f"condemned_{r}"], F.lit(False)) for r in RULES))
    small = bad.limit(BROADCAST).count() < BROADCAST
    met = rows.where(F.col(host).isNotNull()).join(F.broadcast(bad) if small else bad, F.col(host) == F.col("_bad_host"), "left")
    met = met.select(*rows.columns, (~got["base_failed"] & ~guilty).alias(kept))
    nowhere = rows.where(F.col(host).isNull()).select(*rows.columns, (~got["base_failed"]).alias(kept))
    return met.unionByName(nowhere), kept


def with_verdicts(docs: DataFrame, text: str = "text", host: str = "source", name: str = "_measures", kept: str = "_kept",
                  limit: float = LIMIT) -> tuple[DataFrame, str, str]:
    """All columns, the struct of measures and whether the row stays, with the names of these two. Texts are
    measured for the counts and again for the verdicts, and never shuffled while hosts are broadcast."""
    rows, name = measured(docs, text, name)
    out, kept = judged(rows, name, condemned(rows, name, host, limit), host, kept)
    return out, name, kept
