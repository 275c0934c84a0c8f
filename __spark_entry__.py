"""Registered queries with the SQL that checks them.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` maps the same name to
DuckDB SQL over the same tables. A query without SQL is checked by brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import chat, shingles, text as tx
from quern.functions.tokens import CharTokenizer, WhitespaceTokenizer, mlm_mask, truncate, with_special
from quern.operators import filters, order, unigram, vocab
from quern.operators.blocks import pack_blocks
from quern.operators.bpe import train_bpe
from quern.operators.dedup import dedup_exact
from quern.operators.neardup import dedup_near
from quern.plans import classifier, incremental, line_corpus, preferences, text_cleaning, training_sets
from quern.session import materialize, scratch_dir
from quern.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

WORDS, CHARS = WhitespaceTokenizer(), CharTokenizer()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


# ---------------------------------------------------------------- tables and shared SQL

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As scanned, or spread over the tasks that the session asks for."""
    return readers.spread(table(spark, sf_dir, "documents"), readers.tasks_of(spark), ["doc_id"])


def norm(x: str) -> str:
    """Normalisation in RE2, which has no class intersection: spacing to space first, then delete."""
    x = rf"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    x = rf"regexp_replace({x}, '\[([^\]]+)\]\(([^)]+)\)', '\1', 'g')"
    x = rf"regexp_replace({x}, '[\t\n\r]', ' ', 'g')"
    x = (rf"regexp_replace({x}, '[\p{{C}}\p{{Zl}}\p{{Zp}}\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}"
         rf"\x{{202F}}\x{{205F}}\x{{3000}}]', '', 'g')")
    return f"trim(regexp_replace({x}, ' +', ' ', 'g'), ' ')"


WS = r"[\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]+"


def norm_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'), ' ')"


def shingle_list(x: str) -> str:
    """Distinct character 3-grams of a text, from its list of characters."""
    c = f"string_split({x}, '')"
    return (f"(select list_distinct(list_transform(range(1, greatest(len(c) - 2, 1) + 1), "
            f"lambda i: concat(c[i], c[i + 1], c[i + 2]))) from (select {c} as c))")


def near_ctes(source: str, t: float = 0.9, scope: str = "0") -> str:
    """CTEs from ``source(id, text)`` to ``gone(id)``: rows with an earlier surviving similar row,
    decided one by one in id order over the rows that have a similar earlier row."""
    return f"""
    sh as materialized (select id, {scope} as g, {shingle_list('text')} as s from {source}),
    edges as materialized (
      select a, b from (
        select x.id as a, y.id as b, len(x.s) as n, len(y.s) as m, len(list_intersect(x.s, y.s)) as k
        from sh x join sh y on x.id < y.id and x.g = y.g and len(x.s) >= {t} * len(y.s) and len(y.s) >= {t} * len(x.s))
      where k / (n + m - k) >= {t}),
    nodes as materialized (
      select b, list(a) as earlier, row_number() over (order by b) as rn from edges group by b),
    walk(rn, gone) as (
      select 0::bigint, []::bigint[]
      union all
      select n.rn, case when len(list_filter(n.earlier, lambda x: not list_contains(w.gone, x))) > 0
                        then list_append(w.gone, n.b) else w.gone end
      from walk w join nodes n on n.rn = w.rn + 1),
    gone as materialized (select unnest(gone) as id from (select gone from walk order by rn desc limit 1))"""


DOC_NORM = f"select doc_id, source, {norm('text')} as text from documents"


# ---------------------------------------------------------------- projections

@query("normalize_docs", f"select doc_id, {norm('text')} as text from documents")
def normalize_docs(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.normalize_text("text").alias("text"))


@query("normalize_pages", f"select page_id, {norm('html')} as text from pages")
def normalize_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.normalize_text("html").alias("text"))


@query("strip_html", "select page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') as text from pages")
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_html("html").alias("text"))


@query("strip_md_links", r"""
    select doc_id, regexp_replace('see [' || lang || '](' || source || ') ' || text,
                                  '\[([^\]]+)\]\(([^)]+)\)', '\1', 'g') as text from documents""")
def strip_md_links(spark, sf_dir):
    linked = F.concat(F.lit("see ["), "lang", F.lit("]("), "source", F.lit(") "), "text")
    return docs(spark, sf_dir).select("doc_id", tx.strip_md_links(linked).alias("text"))


@query("strip_nonprintable", r"""
    select doc_id, regexp_replace(lang || chr(12288) || source || chr(8203) || chr(7) || text,
      '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\p{Cf}\p{Co}\p{Zl}\p{Zp}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]',
      '', 'g') as text from documents""")
def strip_nonprintable(spark, sf_dir):
    odd = F.concat("lang", F.lit("　"), "source", F.lit("​\x07"), "text")
    return docs(spark, sf_dir).select("doc_id", tx.strip_nonprintable(odd).alias("text"))


@query("normalize_ws", f"""
    select conv_id, turn, {norm_ws("chr(12288) || role || chr(160) || chr(133) || text || chr(28)")} as text
    from conversations""")
def normalize_ws(spark, sf_dir):
    odd = F.concat(F.lit("　"), "role", F.lit(" \x85"), "text", F.lit("\x1c"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.normalize_ws(odd).alias("text"))


@query("coalesce_fields", """
    select p_partkey, coalesce(case when p_size > 40 then p_type end,
      nullif(concat_ws(chr(10), nullif(p_name, ''), case when p_size > 20 then nullif(p_brand, '') end), ''))
      as text from part""")
def coalesce_fields(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") > 40, F.col("p_type")).alias("text"), "p_name",
        F.when(F.col("p_size") > 20, F.col("p_brand")).otherwise("").alias("brand"),
    )
    return part.select("p_partkey", tx.coalesce_text(part, ["p_name", "brand"]).alias("text"))


@query("content_md5", """
    select doc_id, md5(text) as text_md5, md5(lang || chr(10) || source || chr(10) || text) as triple_md5
    from documents""")
def content_md5(spark, sf_dir):
    return docs(spark, sf_dir).select(
        "doc_id", tx.content_md5("text").alias("text_md5"),
        tx.content_md5("lang", "source", "text").alias("triple_md5"),
    )


@query("shingle_count", f"select doc_id, len({shingle_list('text')})::bigint as n from documents")
def shingle_count(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.size(shingles.shingles("text")).cast("bigint").alias("n"))


@query("jaccard_turns", f"""
    with p as (select a.conv_id, a.turn, {shingle_list('a.text')} as x, {shingle_list('b.text')} as y
      from conversations a join conversations b on b.conv_id = a.conv_id and b.turn = a.turn + 1)
    select conv_id, turn, round(len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))), 9)
      as similarity from p""")
def jaccard_turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", shingles.shingles("text").alias("s"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("s").alias("next"))
    pairs = turns.join(following, ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", F.round(shingles.jaccard("s", "next"), 9).alias("similarity"))


LINES = r"""lines as (
      select doc_id, i - 1 as line_no, line from (
        select doc_id, unnest(string_split(text, chr(10))) as line,
               generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
      where regexp_matches(line, '[^\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]'))"""


@query("doc_lines", f"with {LINES} select doc_id, line_no::bigint as line_no, line from lines")
def doc_lines(spark, sf_dir):
    lines = tx.explode_lines(docs(spark, sf_dir), "text", ["doc_id"])
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


# ---------------------------------------------------------------- filters, heads and samples

@query("length_filter", "select doc_id, n_chars from documents where length(text) between 5 and 2000")
def length_filter(spark, sf_dir):
    return docs(spark, sf_dir).where(filters.length_between("text", 5, 2000)).select("doc_id", "n_chars")


@query("byte_filter", "select doc_id from documents where strlen(text) <= 24000")
def byte_filter(spark, sf_dir):
    return docs(spark, sf_dir).where(filters.max_bytes("text", 24000)).select("doc_id")


@query("turn_filter", """
    select conv_id, count(*) as turns from conversations group by conv_id having count(*) <= 6""")
def turn_filter(spark, sf_dir):
    dialogs = messages(spark, sf_dir, max_turns=6)
    return dialogs.select("conv_id", F.size("messages").cast("bigint").alias("turns"))


LABELLED = """select d.doc_id, d.text, case quality when 1 then 'POSITIVE' when 0 then 'negative' end as label
    from documents d left join labels l using (doc_id)"""


def labelled(spark, sf_dir) -> DataFrame:
    label = F.when(F.col("quality") == 1, "POSITIVE").when(F.col("quality") == 0, "negative")
    marks = table(spark, sf_dir, "labels").select("doc_id", label.alias("label"))
    return docs(spark, sf_dir).join(marks, "doc_id", "left")


@query("label_filter", f"""
    select doc_id, label from ({LABELLED}) where label is null or lower(label) like 'positive%'""")
def label_filter(spark, sf_dir):
    return filters.label_filter(labelled(spark, sf_dir), "positive", label="label").select("doc_id", "label")


def comma_classifier():
    """Labels by punctuation; texts without any letter e get no verdict."""
    def classify(texts):
        marks = texts.str.count(",") * 100 > texts.str.len()
        return marks.map({True: "Positive", False: "Negative"}).where(texts.str.contains("e", regex=False), None)

    return classify


@query("label_filter_scored", """
    select doc_id from (select doc_id, substring(text, 1, 512) as t from documents)
    where t not like '%e%' or (length(t) - length(replace(t, ',', ''))) * 100 > length(t)""")
def label_filter_scored(spark, sf_dir):
    kept = filters.label_filter(docs(spark, sf_dir).select("doc_id", "text"), "positive", load=comma_classifier, max_chars=512)
    return kept.select("doc_id")


@query("head_per_source", """
    select source, doc_id from documents
    qualify row_number() over (partition by source order by doc_id) <= 20""")
def head_per_source(spark, sf_dir):
    return order.head_per_group(docs(spark, sf_dir).select("source", "doc_id"), 20, ["source"], ["doc_id"])


@query("head_per_lang_large", """
    select lang, doc_id from documents
    qualify row_number() over (partition by lang order by doc_id) <= 1500""")
def head_per_lang_large(spark, sf_dir):
    return order.head_per_group(docs(spark, sf_dir).select("lang", "doc_id"), 1500, ["lang"], ["doc_id"])


@query("head_lines", f"with {LINES} select doc_id, line_no::bigint as line_no from lines order by 1, 2 limit 5000")
def head_lines(spark, sf_dir):
    return order.head(doc_lines(spark, sf_dir), 5000, ["doc_id", "line_no"]).select("doc_id", "line_no")


@query("head_lines_large", f"with {LINES} select doc_id, line_no::bigint as line_no from lines order by 1, 2 limit 20000")
def head_lines_large(spark, sf_dir):
    return order.head(doc_lines(spark, sf_dir), 20000, ["doc_id", "line_no"]).select("doc_id", "line_no")


@query("preview_docs", "select doc_id, lang, source from documents order by doc_id limit 5")
def preview_docs(spark, sf_dir):
    rows = order.preview(docs(spark, sf_dir), ["doc_id"], 5)
    fields = F.from_json("json", "lang string, source string")
    return rows.select("doc_id", fields["lang"].alias("lang"), fields["source"].alias("source"))


@query("ml_label_filter")
def ml_label_filter(spark, sf_dir):
    """A classifier that Spark trains on all labelled rows but every fourth by id, as the filter of all rows."""
    rows = labelled(spark, sf_dir)
    model = classifier.fit_labels(rows.where("label is not null and doc_id % 4 <> 0"), "text", "label")
    return filters.label_filter(rows.drop("label"), "positive", model=model).select("doc_id", "text")


@query("label_filter_whole", """
    select doc_id from documents
    where text not like '%e%' or (length(text) - length(replace(text, ',', ''))) * 100 > length(text)""")
def label_filter_whole(spark, sf_dir):
    kept = filters.label_filter(docs(spark, sf_dir).select("doc_id", "text"), "positive", load=comma_classifier)
    return kept.select("doc_id")


@query("sample_lines", f"""
    with {LINES} select doc_id, line_no::bigint as line_no from lines
    order by md5('42:' || doc_id || '-' || line_no) limit 20""")
def sample_lines(spark, sf_dir):
    return line_sample(spark, sf_dir).select("doc_id", "line_no")


def line_sample(spark, sf_dir, first: int = 0) -> DataFrame:
    """20 of the lines that are not blank: of all lines, or of the ``first`` ones."""
    lines = docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line_no", F.col("line_no").cast("bigint"))
    if first:
        lines = order.head(lines, first, ["doc_id", "line_no"])
    return order.sample_rows(lines.where(~tx.is_blank("line")), 20, F.concat_ws("-", "doc_id", "line_no"), 42)


@query("calib_sample_stripped", """
    select doc_id, text from documents where length(text) > 100 order by doc_id limit 128""")
def calib_sample_stripped(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", F.concat(F.lit("\u3000\n "), "text", F.lit("\t" * 120)).alias("text"))
    return training_sets.calibration_sample(rows, 128, ["doc_id"], strip=True)


@query("calib_sample", "select doc_id, text from documents where length(text) > 100 order by doc_id limit 128")
def calib_sample(spark, sf_dir):
    return training_sets.calibration_sample(docs(spark, sf_dir).select("doc_id", "text"), 128, ["doc_id"])


# ---------------------------------------------------------------- deduplication

@query("dedup_exact", f"""
    select doc_id from ({DOC_NORM}) qualify row_number() over (partition by md5(text) order by doc_id) = 1""")
def dedup_exact_docs(spark, sf_dir):
    return dedup_exact(normalize_docs(spark, sf_dir), tx.content_md5("text"), ["doc_id"]).select("doc_id")


@query("dedup_exact_per_source", f"""
    select source, doc_id from ({DOC_NORM})
    qualify row_number() over (partition by source, md5(text) order by doc_id) = 1""")
def dedup_exact_per_source(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "source", tx.normalize_text("text").alias("text"))
    return dedup_exact(rows, tx.content_md5("text"), ["doc_id"], ["source"]).select("source", "doc_id")


UNIQUE = f"""base as materialized (select doc_id as id, text from ({DOC_NORM})
      qualify row_number() over (partition by text order by doc_id) = 1)"""


@query("dedup_near", f"""
    with recursive {UNIQUE}, {near_ctes('base')}
    select id as doc_id, md5(text) as text_md5 from base where id not in (select id from gone)""")
def dedup_near_docs(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", tx.once(tx.normalize_text("text")).alias("text"))
    unique = materialize(dedup_exact(rows, tx.content_md5("text"), ["doc_id"]), "unique")
    return dedup_near(unique, "doc_id").select("doc_id", F.md5("text").alias("text_md5"))


@query("dedup_near_07", f"""
    with recursive {UNIQUE}, {near_ctes('base', 0.7)}
    select id as doc_id from base where id not in (select id from gone)""")
def dedup_near_07(spark, sf_dir):
    """A threshold of 0.7: parts hold few shingles, so it matters that rare ones are keys."""
    rows = docs(spark, sf_dir).select("doc_id", tx.once(tx.normalize_text("text")).alias("text"))
    unique = materialize(dedup_exact(rows, tx.content_md5("text"), ["doc_id"]), "unique")
    return dedup_near(unique, "doc_id", threshold=0.7).select("doc_id")


@query("dedup_batches", f"""
    with recursive {UNIQUE}, {near_ctes('base')}
    select id as doc_id, md5(text) as text_md5 from base where id not in (select id from gone)""")
def dedup_batches(spark, sf_dir):
    """Documents that come in two batches, the later one against the index of the earlier one."""
    rows = docs(spark, sf_dir).select("doc_id", tx.once(tx.normalize_text("text")).alias("text"))
    index = incremental.CorpusIndex(spark, _fresh(spark, "index"))
    middle = rows.agg(F.percentile("doc_id", 0.5).alias("p")).first()["p"]
    early = index.add(rows.where(F.col("doc_id") <= middle), "doc_id", 0)
    late = index.add(rows.where(F.col("doc_id") > middle), "doc_id", 1)
    return early.kept.unionByName(late.kept).select("doc_id", F.md5("text").alias("text_md5"))


# ---------------------------------------------------------------- text cleaning job

def clean_ctes(lo: int = 5, hi: int = 2000) -> str:
    return f"""
    n as materialized (select doc_id as id, label, {norm('text')} as text from ({LABELLED})),
    r as materialized (select id, label, text, case when text = '' then 'empty_after_clean'
        when length(text) < {lo} then 'too_short' when length(text) > {hi} then 'too_long' end as reason from n),
    u as materialized (select id, label, text from r where reason is null
        qualify row_number() over (partition by text order by id) = 1),
    {near_ctes('u')},
    d as materialized (select * from u where id not in (select id from gone)),
    k as materialized (select * from d where label is null or lower(label) like 'positive%')"""


CLEAN = text_cleaning.CleanParams(max_chars=2000, dedup=True, near_dedup=True, target="positive", label="label")


@query("dedup_near_per_source", f"""
    with recursive base as materialized (select doc_id as id, source, text from ({DOC_NORM})
      qualify row_number() over (partition by source, text order by doc_id) = 1), {near_ctes('base', scope='source')}
    select id as doc_id, source from base where id not in (select id from gone)""")
def dedup_near_per_source(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "source", tx.once(tx.normalize_text("text")).alias("text"))
    unique = materialize(dedup_exact(rows, tx.content_md5("text"), ["doc_id"], ["source"]), "unique")
    return dedup_near(unique, "doc_id", "text", 0.9, scope=["source"]).select("doc_id", "source")


@query("clean_corpus", f"with recursive {clean_ctes()} select id as doc_id, text from d")
def clean_corpus(spark, sf_dir):
    params = text_cleaning.CleanParams(max_chars=2000, dedup=True, near_dedup=True)
    return text_cleaning.clean_corpus(docs(spark, sf_dir), "doc_id", params).kept.select("doc_id", "text")


@query("clean_corpus_labelled", f"with recursive {clean_ctes()} select id as doc_id, text from k")
def clean_corpus_labelled(spark, sf_dir):
    return text_cleaning.clean_corpus(labelled(spark, sf_dir), "doc_id", CLEAN).kept.select("doc_id", "text")


@query("clean_stats", f"""
    with recursive {clean_ctes()}
    select (select count(*) from r) as total, 0::bigint as malformed, 0::bigint as too_many_turns,
      0::bigint as no_text,
      (select count(*) from r where reason = 'empty_after_clean') as empty_after_clean,
      (select count(*) from r where reason = 'too_short') as too_short,
      (select count(*) from r where reason = 'too_long') as too_long,
      (select count(*) from r where reason is null) - (select count(*) from u) as dedup,
      (select count(*) from u) - (select count(*) from d) as near_dedup,
      (select count(*) from d) - (select count(*) from k) as sentiment_filtered,
      (select count(*) from k) as kept""")
def clean_stats(spark, sf_dir):
    return text_cleaning.clean_corpus(labelled(spark, sf_dir), "doc_id", CLEAN).stats()


@query("clean_reasons", f"""
    with recursive {clean_ctes()}
    select r.id as doc_id, case when reason is not null then reason when u.id is null then 'dedup'
      when d.id is null then 'near_dedup' when k.id is null then 'sentiment_filtered' end as drop_reason
    from r left join u on u.id = r.id left join d on d.id = r.id left join k on k.id = r.id""")
def clean_reasons(spark, sf_dir):
    return text_cleaning.clean_corpus(labelled(spark, sf_dir), "doc_id", CLEAN).reasons()


@query("clean_dialogs", f"""
    with t as (select conv_id, string_agg(text, chr(10) order by turn) as text, count(*) as n
               from conversations group by conv_id)
    select conv_id, text from (select conv_id, n, {norm('text')} as text from t)
    where n <= 6 and length(text) between 5 and 4000
    qualify row_number() over (partition by text order by conv_id) = 1""")
def clean_dialogs(spark, sf_dir):
    params = text_cleaning.CleanParams(max_turns=6, max_chars=4000, dedup=True)
    dialogs = messages(spark, sf_dir).withColumnRenamed("messages", "dialog")
    return text_cleaning.clean_corpus(dialogs, "conv_id", params).kept.select("conv_id", "text")


# ---------------------------------------------------------------- line corpus

CORPUS = f"""{LINES},
    p as (select doc_id, line_no, line, case when line = '' then 'empty_after_clean'
            when length(line) < 10 then 'too_short' when length(line) > 2000 then 'too_long' end as reason
          from (select doc_id, line_no, {norm('line')} as line from lines)),
    k as (select doc_id, line_no, line from p where reason is null
          qualify row_number() over (partition by line order by doc_id, line_no) = 1)"""


def corpus(spark, sf_dir, **params) -> line_corpus.CorpusResult:
    return line_corpus.build_corpus(docs(spark, sf_dir), "text", ["doc_id"], line_corpus.CorpusParams(max_chars=2000, **params))


def _line_columns(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line")


@query("corpus_lines", f"with {CORPUS} select doc_id, line_no::bigint as line_no, line from k")
def corpus_lines(spark, sf_dir):
    return _line_columns(corpus(spark, sf_dir).kept)


@query("corpus_lines_capped", f"""
    with {CORPUS} select doc_id, line_no::bigint as line_no, line from k order by doc_id, line_no limit 3000""")
def corpus_lines_capped(spark, sf_dir):
    return _line_columns(corpus(spark, sf_dir, max_lines=3000).kept)


def corpus_stats_sql(upto: str) -> str:
    return f"""select count(*) as total_lines, count(*) filter (reason = 'empty_after_clean') as empty_after_clean,
      count(*) filter (reason = 'too_short') as too_short, count(*) filter (reason = 'too_long') as too_long,
      count(*) filter (p.reason is null and c.doc_id is null) as duplicates, count(c.doc_id) as kept
    from p left join k c on c.doc_id = p.doc_id and c.line_no = p.line_no {upto}"""


@query("corpus_stats", f"with {CORPUS} {corpus_stats_sql('')}")
def corpus_stats(spark, sf_dir):
    return corpus(spark, sf_dir).stats()


@query("corpus_stats_capped", f"""
    with {CORPUS}, e as (select doc_id, line_no from k order by 1, 2 limit 1 offset 2999)
    {corpus_stats_sql('where (select count(*) from e) = 0 or (p.doc_id, p.line_no) <= (select (doc_id, line_no) from e)')}""")
def corpus_stats_capped(spark, sf_dir):
    return corpus(spark, sf_dir, max_lines=3000).stats()


# ---------------------------------------------------------------- conversations

def messages(spark, sf_dir, max_turns: int = 0) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return training_sets.collect_messages(turns, "conv_id", "turn", "role", "text", max_turns)


def sharegpt(spark, sf_dir) -> DataFrame:
    """Conversations with ShareGPT field and speaker names."""
    def turn(m: Column) -> Column:
        speaker = F.when(m["role"] == "user", "human").when(m["role"] == "assistant", "gpt").otherwise(m["role"])
        return F.struct(speaker.alias("from"), m["content"].alias("value"))

    return messages(spark, sf_dir).select("conv_id", F.transform("messages", turn).alias("conversations"))


def exploded(df: DataFrame, column: str) -> DataFrame:
    rows = df.select("conv_id", F.posexplode(column).alias("pos", "m"))
    return rows.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


MESSAGES_SQL = """
    select conv_id, row_number() over (partition by conv_id order by turn) - 1 as pos, role, text as content
    from conversations"""


@query("conversation_messages", MESSAGES_SQL)
def conversation_messages(spark, sf_dir):
    return exploded(messages(spark, sf_dir), "messages")


@query("sharegpt_messages", MESSAGES_SQL)
def sharegpt_messages(spark, sf_dir):
    rows = sharegpt(spark, sf_dir)
    return exploded(rows.select("conv_id", chat.sharegpt_to_messages("conversations").alias("messages")), "messages")


@query("dialog_text", """
    select conv_id, string_agg(text, chr(10) order by turn) filter (trim(text) <> '') as text
    from conversations group by conv_id""")
def dialog_text(spark, sf_dir):
    rows = messages(spark, sf_dir)
    return rows.select("conv_id", tx.dialog_to_text("messages", rows.schema["messages"].dataType).alias("text"))


#: Kind of an item by conversation and turn: text, object, null, object without content, object with a number.
DIALOG_KIND = "(conv_id + turn) % 5"


def mixed_dialogs(spark, sf_dir) -> DataFrame:
    """Conversations as JSONL lists of mixed items, every eleventh as an object instead, read as VARIANT, kept in parquet."""
    path, kind, quoted = _fresh(spark, "dialogs"), F.expr(DIALOG_KIND), F.regexp_extract(F.to_json(F.array("text")), r"(?s)^\[(.*)\]$", 1)
    item = (F.when(kind == 0, quoted).when(kind == 1, F.to_json(F.struct("role", F.col("text").alias("content"))))
            .when(kind == 2, "null").when(kind == 3, F.to_json(F.struct("role"))).otherwise(F.to_json(F.struct(F.col("turn").alias("content")))))
    items = table(spark, sf_dir, "conversations").select("conv_id", "turn", item.alias("item")).groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "item"))), lambda x: x["item"]).alias("items"))
    listed = F.concat(F.lit("["), F.concat_ws(",", "items"), F.lit("]"))
    dialog = F.when(F.col("conv_id") % 11 == 0, F.concat(F.lit('{"items":'), listed, F.lit("}"))).otherwise(listed)
    line = F.concat(F.lit('{"conv_id":'), "conv_id", F.lit(',"dialog":'), dialog, F.lit("}"))
    items.select(line.alias("value")).write.text(f"{path}/jsonl")
    rows = readers.read_jsonl(spark, f"{path}/jsonl", "conv_id bigint, dialog variant", skip_malformed=True)
    writers.write_parquet(rows, f"{path}/parquet", columns=["conv_id", "dialog"])
    return spark.read.schema("conv_id bigint, dialog variant").parquet(f"{path}/parquet")


DIALOG_ITEMS = f"""
    i as (select conv_id, turn, row_number() over (partition by conv_id order by turn) - 1 as place,
        case when {DIALOG_KIND} in (1, 3) then role end as role,
        case when {DIALOG_KIND} in (0, 1) then text when {DIALOG_KIND} = 4 then turn::varchar end as text
      from conversations)"""


@query("dialog_variant", f"""
    with {DIALOG_ITEMS} select conv_id, case when conv_id % 11 <> 0 then count(*) end as turns,
      case when conv_id % 11 <> 0 then coalesce(string_agg(text, chr(10) order by turn) filter (trim(text) <> ''), '') end as text
    from i group by conv_id""")
def dialog_variant(spark, sf_dir):
    rows = mixed_dialogs(spark, sf_dir)
    kind = rows.schema["dialog"].dataType
    return rows.select("conv_id", tx.dialog_size("dialog", kind).cast("bigint").alias("turns"), tx.dialog_to_text("dialog", kind).alias("text"))


@query("dialog_turns", f"with {DIALOG_ITEMS} select conv_id, place as turn, role, text from i where conv_id % 11 <> 0")
def dialog_turns(spark, sf_dir):
    rows = tx.explode_dialog(mixed_dialogs(spark, sf_dir), "dialog", ["conv_id"])
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")


def spaced(spark, sf_dir) -> DataFrame:
    """Messages whose content has white space of many kinds around it."""
    def turn(m: Column) -> Column:
        content = F.concat(F.lit("\t"), m["content"], F.lit(" \n\u3000\x85"))
        return F.struct(F.concat(F.lit("\u2003"), m["role"]).alias("role"), content.alias("content"))

    return messages(spark, sf_dir).select("conv_id", F.transform("messages", turn).alias("messages"))


def stripped(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


@query("messages_text", f"""
    select conv_id, string_agg({stripped("role || ': ' || chr(9) || text")}, chr(10) order by turn) as text
    from conversations group by conv_id""")
def messages_text(spark, sf_dir):
    return spaced(spark, sf_dir).select("conv_id", chat.messages_to_text("messages").alias("text"))


SHAREGPT_LINE = "case role when 'user' then 'User' when 'assistant' then 'Assistant' else role end || ': ' || text || chr(10) || chr(9)"


@query("sharegpt_text", f"""
    select conv_id, string_agg({stripped(SHAREGPT_LINE)}, chr(10) order by turn) as text
    from conversations group by conv_id""")
def sharegpt_text(spark, sf_dir):
    turns = sharegpt_spaced(spark, sf_dir)
    return turns.select("conv_id", chat.sharegpt_to_text("conversations").alias("text"))


def sharegpt_spaced(spark, sf_dir) -> DataFrame:
    def turn(t: Column) -> Column:
        return F.struct(t["from"].alias("from"), F.concat(t["value"], F.lit("\n\t")).alias("value"))

    return sharegpt(spark, sf_dir).select("conv_id", F.transform("conversations", turn).alias("conversations"))


@query("extract_text_chat", f"""
    select conv_id, case when conv_id % 3 = 0 then 'own ' || conv_id
      else string_agg({stripped(SHAREGPT_LINE)}, chr(10) order by turn) end as text
    from conversations group by conv_id""")
def extract_text_chat(spark, sf_dir):
    own = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("own "), F.col("conv_id"))).otherwise(" \u3000")
    rows = sharegpt_spaced(spark, sf_dir).withColumn("text", own)
    return rows.select("conv_id", training_sets.extract_text(rows).alias("text"))


@query("extract_text", r"""
    select doc_id, regexp_replace(case when lang = 'fr' then 'note ' || source else text end,
      '^[\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]+|[\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]+$', '', 'g') as text from documents""")
def extract_text(spark, sf_dir):
    rows = docs(spark, sf_dir).select(
        "doc_id",
        F.when(F.col("lang") == "de", " 　\n").alias("title"),
        F.when(F.col("lang") == "fr", F.array(F.lit("note"), F.lit(None).cast("string"), "source")).alias("parts"),
        "text",
    )
    return rows.select("doc_id", training_sets.extract_text(rows, ["title", "parts", "text"]).alias("text"))


QA = """qa as (select u.conv_id, u.turn, u.text as question, a.text as answer from conversations u
      join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
      where u.role = 'user' and a.role = 'assistant')"""


def qa(spark, sf_dir) -> DataFrame:
    """User turns with the assistant turn that follows."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    replies = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return asked.join(replies, ["conv_id", "turn"])


def instructions(spark, sf_dir) -> DataFrame:
    even = F.col("turn") % 4 == 0
    return qa(spark, sf_dir).select(
        "conv_id", "turn", F.when(even, "Answer the question.").otherwise("").alias("instruction"),
        F.col("question").alias("input"), F.when(even, F.col("answer")).alias("output"),
        F.col("answer").alias("response"),
    )


@query("instruction_messages", f"""
    with {QA} select conv_id, turn, case when turn % 4 = 0 then 'Answer the question.' || chr(10) || question
      else question end as prompt, answer from qa""")
def instruction_messages(spark, sf_dir):
    rows = instructions(spark, sf_dir)
    built = rows.select("conv_id", "turn", chat.instruction_to_messages(rows).alias("m"))
    return built.select("conv_id", "turn", F.col("m")[0]["content"].alias("prompt"), F.col("m")[1]["content"].alias("answer"))


@query("chatml_pair", f"""
    with {QA} select conv_id, turn, '<|im_start|>user' || chr(10) || question || '<|im_end|>' || chr(10)
      || '<|im_start|>assistant' || chr(10) || answer || '<|im_end|>' as text from qa""")
def chatml_pair(spark, sf_dir):
    return qa(spark, sf_dir).select("conv_id", "turn", chat.chatml_pair("question", "answer").alias("text"))


def template_sql(case: str, where: str = "") -> str:
    return f"""select conv_id, string_agg({case}, '' order by turn) {where} as text
      from conversations group by conv_id"""


CHATML_SQL = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>'"


@query("render_chatml", template_sql(CHATML_SQL))
def render_chatml(spark, sf_dir):
    return messages(spark, sf_dir).select(
        "conv_id", chat.render_template("messages", chat.TEMPLATES["chatml"]).alias("text"))


@query("render_chatml_named_only", template_sql(
    f"case when role = 'system' then {CHATML_SQL} else text end"))
def render_chatml_named_only(spark, sf_dir):
    return messages(spark, sf_dir).select(
        "conv_id", chat.render_template("messages", chat.TEMPLATES["chatml"], named_only=True).alias("text"))


@query("render_baichuan", template_sql(
    "case when role = 'assistant' then '<reserved_107>' else '<reserved_106>' end || text"))
def render_baichuan(spark, sf_dir):
    return messages(spark, sf_dir).select(
        "conv_id", chat.render_template("messages", chat.TEMPLATES["baichuan2"]).alias("text"))


@query("render_chatglm", template_sql(
    "case role when 'system' then '[gMASK]sop<|system|>' when 'user' then '<|user|>' else '<|assistant|>' end || chr(10) || text"))
def render_chatglm(spark, sf_dir):
    return messages(spark, sf_dir).select(
        "conv_id", chat.render_template("messages", chat.TEMPLATES["chatglm3"]).alias("text"))


@query("prompt_text", f"""
    select conv_id, coalesce(text, '') as text from ({template_sql(CHATML_SQL, "filter (role <> 'assistant')")})""")
def prompt_text(spark, sf_dir):
    return messages(spark, sf_dir).select(
        "conv_id", chat.prompt_text("messages", chat.TEMPLATES["chatml"]).alias("text"))


SFT = f"""f as (select conv_id, string_agg({CHATML_SQL}, '' order by turn) as t,
        length(coalesce(string_agg({CHATML_SQL}, '' order by turn) filter (role <> 'assistant'), '')) as p
      from conversations group by conv_id),
    i as (select conv_id, least(p, 1024) as p,
        list_transform(string_split(t, ''), lambda c: unicode(c))[1:1024] as ids from f)"""
SFT_LABELS = """list_transform(range(1, 1025), lambda j: case when j <= p or j > len(ids) then -100 else ids[j] end)"""


def sft(spark, sf_dir) -> DataFrame:
    texts = training_sets.sft_texts(messages(spark, sf_dir), chat.TEMPLATES["chatml"], ["conv_id"])
    return training_sets.sft_records(texts, CHARS, 1024, ["conv_id"])


def joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), ",")


@query("sft_ids", f"""
    with {SFT} select conv_id, array_to_string(list_transform(range(1, 1025), lambda j: coalesce(ids[j], 0)), ',') as ids,
      least(len(ids), 1024)::bigint as used from i""")
def sft_ids(spark, sf_dir):
    used = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    return sft(spark, sf_dir).select("conv_id", joined("input_ids").alias("ids"), used.alias("used"))


@query("sft_labels", f"with {SFT} select conv_id, array_to_string({SFT_LABELS}, ',') as labels from i")
def sft_labels(spark, sf_dir):
    return sft(spark, sf_dir).select("conv_id", joined("labels").alias("labels"))


@query("training_columns", f"""
    with {SFT} select array_to_string(list_transform(range(1, 1025), lambda j: coalesce(ids[j], 0)), ',') as input_ids,
      array_to_string(list_transform(range(1, 1025), lambda j: case when j <= len(ids) then 1 else 0 end), ',') as attention_mask,
      array_to_string({SFT_LABELS}, ',') as labels from i""")
def training_columns(spark, sf_dir):
    rows = training_sets.training_columns(sft(spark, sf_dir))
    return rows.select(*(joined(c).alias(c) for c in rows.columns))


SFT_SPECIAL = f"""f as (select conv_id, string_agg({CHATML_SQL}, '' order by turn) as t,
        count(*) filter (role <> 'assistant') as asked,
        length(coalesce(string_agg({CHATML_SQL}, '' order by turn) filter (role <> 'assistant'), '')) as p
      from conversations group by conv_id),
    i as (select conv_id,
        case when asked = 0 then 0 else least(p + length('<|im_start|>assistant') + 1 + 2, 1024) end as p,
        [1] || list_transform(string_split(t, ''), lambda c: unicode(c))[1:1022] || [2] as ids from f)"""


def sft_special(spark, sf_dir) -> DataFrame:
    """With begin and end ids, and prompts that end where the answer opens."""
    texts = training_sets.sft_texts(messages(spark, sf_dir), chat.TEMPLATES["chatml"], ["conv_id"], generation=True)
    return training_sets.sft_records(texts, CHARS, 1024, ["conv_id"], before=[1], after=[2])


@query("sft_ids_special", f"""
    with {SFT_SPECIAL} select conv_id, array_to_string(list_transform(range(1, 1025), lambda j: coalesce(ids[j], 0)), ',') as ids,
      least(len(ids), 1024)::bigint as used from i""")
def sft_ids_special(spark, sf_dir):
    used = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    return sft_special(spark, sf_dir).select("conv_id", joined("input_ids").alias("ids"), used.alias("used"))


@query("sft_labels_special", f"with {SFT_SPECIAL} select conv_id, array_to_string({SFT_LABELS}, ',') as labels from i")
def sft_labels_special(spark, sf_dir):
    return sft_special(spark, sf_dir).select("conv_id", joined("labels").alias("labels"))


SFT_OPEN = "length('<|im_start|>assistant') + 1"


@query("sft_labels_spans", f"""
    with m as (select conv_id, turn, role, {CHATML_SQL} as t from conversations),
    s as (select conv_id, string_agg(t, '' order by turn) as t, string_agg(case when role = 'assistant'
        then repeat('0', {SFT_OPEN}) || repeat('1', length(t) - ({SFT_OPEN})) else repeat('0', length(t)) end, '' order by turn) as k
      from m group by conv_id),
    l as (select conv_id, k, list_transform(string_split(t, ''), lambda c: unicode(c))[1:1022] as ids from s),
    w as (select conv_id, [-100] || list_transform(range(1, len(ids) + 1), lambda j: case when k[j] = '1' then ids[j] else -100 end) || [2] as w from l)
    select conv_id, array_to_string(list_transform(range(1, 1025), lambda j: coalesce(w[j], -100)), ',') as labels from w""")
def sft_labels_spans(spark, sf_dir):
    """Every answer keeps its labels, behind what opens it; begin and end ids around the record."""
    rows = training_sets.sft_span_records(
        messages(spark, sf_dir), chat.TEMPLATES["chatml"], CHARS, 1024, ["conv_id"], before=[1], after=[2])
    return rows.select("conv_id", joined("labels").alias("labels"))


# ---------------------------------------------------------------- preferences

PAIRS = f"""{QA},
    p0 as (select (q.conv_id * 1000 + q.turn) * 4 as pair_id, question as prompt, answer as chosen, a.text as rejected
      from qa q left join conversations a on a.conv_id = q.conv_id and a.turn = q.turn + 3 and a.role = 'assistant'),
    pairs as (select pair_id + c as pair_id, prompt, case when c = 2 then chosen || ' +' else chosen end as chosen,
      rejected from p0 cross join range(3) t(c)),
    pn as (select pair_id, coalesce(prompt, '') = '' or coalesce(chosen, '') = '' or coalesce(rejected, '') = '' as missing,
      {norm_ws('prompt')} as prompt, {norm_ws('chosen')} as chosen, {norm_ws('rejected')} as rejected from pairs),
    pj as (select *, prompt || chr(10) || chosen || chr(10) || rejected as text from pn),
    pr as materialized (select pair_id, prompt, chosen, rejected, text, case when missing then 'missing'
      when length(text) not between 5 and 4000 then 'length' end as reason from pj),
    pu as materialized (select pair_id as id, prompt, chosen, rejected, text from pr where reason is null
      qualify row_number() over (partition by text order by pair_id) = 1)"""


def triples(spark, sf_dir) -> DataFrame:
    """Question, answer, and the conversation's next answer as the rejected one; each triple comes
    three times, once with a slightly longer answer, so that both kinds of copies occur."""
    turns = table(spark, sf_dir, "conversations")
    later = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 3).alias("turn"), F.col("text").alias("rejected"))
    rows = qa(spark, sf_dir).join(later, ["conv_id", "turn"], "left")
    copy = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy")
    rows = rows.select("conv_id", "turn", "question", "answer", "rejected", copy)
    return rows.select(
        ((F.col("conv_id") * 1000 + F.col("turn")) * 4 + F.col("copy")).alias("pair_id"),
        F.col("question").alias("prompt"),
        F.when(F.col("copy") == 2, F.concat("answer", F.lit(" +"))).otherwise(F.col("answer")).alias("chosen"),
        "rejected",
    )


PREF_COLUMNS = ["pair_id", "prompt", "chosen", "rejected"]


@query("pref_clean", f"with {PAIRS} select id as pair_id, prompt, chosen, rejected from pu")
def pref_clean(spark, sf_dir):
    params = preferences.PreferenceParams(max_chars=4000, dedup=True)
    return preferences.clean_preferences(triples(spark, sf_dir), "pair_id", params).kept.select(*PREF_COLUMNS)


@query("pref_dedup_near", f"""
    with recursive {PAIRS}, {near_ctes('pu')}
    select id as pair_id, prompt, chosen, rejected from pu where id not in (select id from gone)""")
def pref_dedup_near(spark, sf_dir):
    params = preferences.PreferenceParams(max_chars=4000, dedup=True, near_dedup=True)
    return preferences.clean_preferences(triples(spark, sf_dir), "pair_id", params).kept.select(*PREF_COLUMNS)


@query("pref_stats", f"""
    with recursive {PAIRS}, {near_ctes('pu')}
    select (select count(*) from pr) as total, (select count(*) from pu) - (select count(*) from gone) as kept,
      (select count(*) from pr where reason = 'length') as dropped_len,
      (select count(*) from pr where reason = 'missing') as dropped_missing,
      (select count(*) from pr where reason is null) - (select count(*) from pu) as dropped_dup,
      (select count(*) from gone) as dropped_near_dup, 5::bigint as min_chars, 4000::bigint as max_chars,
      true as dedup, true as near_dedup, 0.9::double as jaccard_threshold,
      'prompt' as prompt_key, 'chosen' as chosen_key, 'rejected' as rejected_key""")
def pref_stats(spark, sf_dir):
    params = preferences.PreferenceParams(max_chars=4000, dedup=True, near_dedup=True)
    return preferences.clean_preferences(triples(spark, sf_dir), "pair_id", params).stats()


def aliased(spark, sf_dir) -> DataFrame:
    odd = F.col("pair_id") % 8 == 0
    return triples(spark, sf_dir).select(
        "pair_id", F.when(odd, "").otherwise(F.col("prompt")).alias("question"),
        F.when(odd, F.col("prompt")).alias("query"), F.col("chosen").alias("answer"),
        F.when(odd, "  ").otherwise(F.col("rejected")).alias("negative"),
    )


ALIASED = f"""{PAIRS}, al as (select pair_id, prompt, chosen, coalesce(case when pair_id % 8 = 0 then '  '
      else rejected end, '') as rejected from pairs)"""


@query("pref_alias", f"with {ALIASED} select * from al")
def pref_alias(spark, sf_dir):
    return preferences.preference_columns(aliased(spark, sf_dir), ["pair_id"])


@query("pref_valid", f"""
    with {ALIASED} select * from al where {norm_ws('prompt')} <> '' and {norm_ws('chosen')} <> ''
      and {norm_ws('rejected')} <> ''""")
def pref_valid(spark, sf_dir):
    return preferences.dpo_dataset(aliased(spark, sf_dir), ["pair_id"])


@query("dpo_budget", f"""
    with {ALIASED}, s as (select pair_id, length(prompt) as prompt_tokens, length(chosen) as chosen_tokens,
      length(rejected) as rejected_tokens from al)
    select *, prompt_tokens > 512 as prompt_over,
      prompt_tokens + greatest(chosen_tokens, rejected_tokens) > 1024 as total_over from s""")
def dpo_budget(spark, sf_dir):
    return preferences.length_budget(pref_alias(spark, sf_dir), CHARS, 1024, ["pair_id"])


@query("prompt_table", f"""
    with {QA} select conv_id, turn, question as prompt, length(question) > 512 as too_long from qa""")
def prompt_table(spark, sf_dir):
    return preferences.prompt_table(qa(spark, sf_dir), "question", CHARS, 512, ["conv_id", "turn"])


# ---------------------------------------------------------------- token ids and blocks

@query("token_counts", f"""
    select doc_id, len(list_filter(string_split({norm('text')}, ' '), lambda w: w <> ''))::bigint as n from documents""")
def token_counts(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.size(WORDS.tokens(tx.normalize_text("text"))).cast("bigint").alias("n"))


@query("trunc_ids", """
    select doc_id, array_to_string(list_transform(string_split(substring(text, 1, 256), ''), lambda c: unicode(c)), ',')
      as ids from documents""")
def trunc_ids(spark, sf_dir):
    ids = docs(spark, sf_dir).select("doc_id", truncate(CHARS.ids("text"), 256).alias("ids"))
    return ids.select("doc_id", joined("ids").alias("ids"))


@query("trunc_ids_special", """
    select doc_id, '1,' || array_to_string(list_transform(string_split(substring(text, 1, 254), ''), lambda c: unicode(c)), ',') || ',2'
      as ids from documents""")
def trunc_ids_special(spark, sf_dir):
    ids = docs(spark, sf_dir).select("doc_id", with_special(CHARS.ids("text"), [1], [2], 256).alias("ids"))
    return ids.select("doc_id", joined("ids").alias("ids"))


@query("pack_blocks_special", f"""
    with d as (select (row_number() over (order by doc_id) - 1) // 100 as batch, doc_id, text from documents where
        regexp_matches(text, '[^\\s\\x{{0B}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]')),
    s as (select batch, doc_id, [1] || list_transform(string_split(regexp_replace(text, '^{WS}|{WS}$', '', 'g'), ''),
      lambda c: unicode(c)) || [2] as ids from d),
    c as (select batch, doc_id, unnest(ids) as id, generate_subscripts(ids, 1) as i from s),
    p as (select batch, row_number() over (partition by batch order by doc_id, i) - 1 as pos, id from c)
    select batch, pos // 512 as block, md5(string_agg(id::varchar, ',' order by pos)) as ids
    from p group by all having count(*) = 512""")
def pack_blocks_special(spark, sf_dir):
    blocks = training_sets.pretraining_blocks(docs(spark, sf_dir), CHARS, ["doc_id"], 512, batch_rows=100, before=[1], after=[2])
    return blocks.select("batch", "block", F.md5(joined("labels")).alias("ids"))


@query("pack_blocks", f"""
    with d as (select (row_number() over (order by doc_id) - 1) // 100 as batch, doc_id, text from documents where
        regexp_matches(text, '[^\\s\\x{{0B}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]')),
    s as (select batch, doc_id, regexp_replace(text, '^{WS}|{WS}$', '', 'g') as text from d),
    c as (select batch, doc_id, unnest(string_split(text, '')) as ch,
                 generate_subscripts(string_split(text, ''), 1) as i from s),
    p as (select batch, row_number() over (partition by batch order by doc_id, i) - 1 as pos, unicode(ch) as id from c)
    select batch, pos // 512 as block, md5(string_agg(id::varchar, ',' order by pos)) as ids
    from p group by all having count(*) = 512""")
def pack_blocks_docs(spark, sf_dir):
    blocks = training_sets.pretraining_blocks(docs(spark, sf_dir), CHARS, ["doc_id"], 512, batch_rows=100)
    return blocks.select("batch", "block", F.md5(joined("labels")).alias("ids"))


def _bits(part: int) -> str:
    return f"('0x' || substr(digest, {8 * part + 1}, 8))::bigint"


@query("mlm_mask", f"""
    with c as (select doc_id, unnest(string_split(substring(text, 1, 256), '')) as ch,
        generate_subscripts(string_split(substring(text, 1, 256), ''), 1) as i from documents),
    g as (select *, md5('0:' || doc_id || ':' || (i - 1)) as digest from c),
    m as (select doc_id, i, unicode(ch) as x, {_bits(0)} % 1000000 < 150000 and ch not in (' ', chr(10)) as chosen,
        {_bits(1)} % 1000000 as act, {_bits(2)} % 50000 as other from g)
    select doc_id,
      string_agg((case when not chosen then x when act < 800000 then 1 when act < 900000 then other else x end)::varchar, ',' order by i) as input_ids,
      string_agg((case when chosen then x else -100 end)::varchar, ',' order by i) as labels
    from m group by doc_id""")
def mlm_mask_docs(spark, sf_dir):
    ids = docs(spark, sf_dir).select("doc_id", truncate(CHARS.ids("text"), 256).alias("ids"))
    masked = ids.select("doc_id", tx.once(mlm_mask("ids", "doc_id", vocab_size=50_000, mask_id=1, special_ids=(32, 10))).alias("m"))
    return masked.select("doc_id", "m.input_ids", "m.labels").select("doc_id", joined("input_ids").alias("input_ids"), joined("labels").alias("labels"))


@query("calib_trunc", """
    select doc_id, substring(text, 1, 256) as text from documents where length(text) > 100 order by doc_id limit 128""")
def calib_trunc(spark, sf_dir):
    return calib_sample(spark, sf_dir).select("doc_id", training_sets.truncate_text("text", CHARS, 256).alias("text"))


# ---------------------------------------------------------------- vocabulary

def normalized(spark, sf_dir) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", tx.normalize_text("text").alias("text"))


CHAR_COVERAGE = f"""cc as (select char, count(*) as freq from (
        select unnest(string_split(text, '')) as char from ({DOC_NORM})) where char not in ('', ' ') group by char),
    cv as (select char, freq, row_number() over w as rank,
        coalesce(sum(freq) over (w rows between unbounded preceding and 1 preceding), 0) as before,
        sum(freq) over () as total from cc window w as (order by freq desc, char)),
    cover as (select char, freq, rank from cv where before < total * 0.9995)"""


@query("char_coverage", f"with {CHAR_COVERAGE} select char, freq, rank::bigint as rank from cover")
def char_coverage(spark, sf_dir):
    chars = vocab.char_vocab(normalized(spark, sf_dir), "text", 0.9995)
    return chars.withColumn("rank", F.col("rank").cast("bigint"))


@query("byte_fallback", f"""
    with {CHAR_COVERAGE} select char, freq, array_to_string(list_transform(range(1, strlen(char) + 1),
      lambda i: '<0x' || hex(encode(char))[2 * i - 1:2 * i] || '>'), '') as tokens
    from cc where char not in (select char from cover)""")
def byte_fallback(spark, sf_dir):
    rows = normalized(spark, sf_dir)
    rare = vocab.byte_fallback(rows, "text", vocab.char_vocab(rows, "text", 0.9995))
    return rare.select("char", "freq", F.array_join("tokens", "").alias("tokens"))


WORD_COUNTS = rf"""wc as materialized (select word, count(*) as freq from (
        select unnest(string_split(regexp_replace(text, '(\p{{Nd}})', ' \1 ', 'g'), ' ')) as word from ({DOC_NORM}))
      where word <> '' group by word)"""


@query("word_counts", f"with {WORD_COUNTS} select * from wc")
def word_counts(spark, sf_dir):
    return vocab.word_counts(normalized(spark, sf_dir), "text")


def _scripts(text: str) -> str:
    """Texts of the table in the letters of three scripts, by id."""
    return (f"case doc_id % 3 when 0 then {text} when 1 then translate({text}, 'aeinorst', '的一是不了人我在') "
            f"else translate({text}, 'aeinorst', 'กขคงจฉชซ') end")


@query("word_counts_script", rf"""
    with t as (select {_scripts('text')} as text from ({DOC_NORM})),
    m as (select unnest(regexp_extract_all('▁' || replace(text, ' ', ' ▁'), '{vocab.script_words(re2=True)}')) as word from t where text <> '')
    select word, count(*) as freq from m group by word""")
def word_counts_script(spark, sf_dir):
    """Words by script, with a mark where a space or the text's start stood before them."""
    text = F.expr(_scripts("text"))
    return vocab.word_counts_by_script(normalized(spark, sf_dir).select(text.alias("text")), "text")


@query("bpe_pairs", f"""
    with {WORD_COUNTS}, s as (select freq, string_split(word, '') as c from wc where length(word) > 1),
    p as (select freq, unnest(list_transform(range(1, len(c)), lambda i: c[i] || chr(1) || c[i + 1])) as pair from s)
    select split_part(pair, chr(1), 1) as "left", split_part(pair, chr(1), 2) as "right", sum(freq)::bigint as freq
    from p group by pair""")
def bpe_pairs(spark, sf_dir):
    return vocab.pair_counts(vocab.word_symbols(word_counts(spark, sf_dir)))


BPE_MERGES = 100
NORM_KNOWN = f"""known as materialized (select distinct token from (
      select unnest(string_split({norm('text')}, ' ')) as token from benchmark) where token <> '')"""


def bpe_steps(merges: int) -> str:
    """The word table after each merge, one pair at a time: ``step`` (k, word, freq, s and the pair merged)."""
    return rf"""{LINES}, bl as (select doc_id, line_no, {norm('line')} as text from lines),
    bw as materialized (select doc_id, line_no, word, pos from (
      select doc_id, line_no, unnest(c) as word, generate_subscripts(c, 1) - 1 as pos from (
        select doc_id, line_no, list_filter(string_split(regexp_replace(text, '(\p{{Nd}})', ' \1 ', 'g'), ' '), lambda x: x <> '') as c from bl))),
    wc as materialized (select word, count(*) as freq from bw group by word),
    cc as (select char, count(*) as freq from (select unnest(string_split(text, '')) as char from bl) where char not in ('', ' ') group by char),
    cv as (select char, freq, coalesce(sum(freq) over (order by freq desc, char rows between unbounded preceding and 1 preceding), 0) as before,
      sum(freq) over () as total from cc),
    cover as (select char as known from cv where before < total * 0.9995),
    ch as (select word, freq, unnest(string_split(word, '')) as c, generate_subscripts(string_split(word, ''), 1) as i from wc),
    w as materialized (select word, freq, string_agg(case when known is not null then chr(1) || c || chr(1) else
        array_to_string(list_transform(range(1, strlen(c) + 1), lambda j: chr(1) || '<0x' || hex(encode(c))[2 * j - 1:2 * j] || '>' || chr(1)), '')
        end, '' order by i) as s
      from ch left join cover on c = known group by word, freq),
    step as (
      select 0 as k, word, freq, s, null::varchar as l, null::varchar as r, null::hugeint as n from w
      union all
      select k + 1, word, step.freq, replace(s, chr(1) || t.l || chr(1) || chr(1) || t.r || chr(1), chr(1) || t.l || t.r || chr(1)), t.l, t.r, t.n
      from step, (
        select p[1] as l, p[2] as r, sum(freq) as n from (
          select freq, unnest(list_transform(range(1, len(c)), lambda i: [c[i], c[i + 1]])) as p
          from (select freq, string_split(trim(s, chr(1)), chr(1) || chr(1)) as c from step)) group by p
        order by n desc, l, r limit 1) t
      where k < {merges})"""


BPE_PIECES = f"""{bpe_steps(BPE_MERGES)},
    pieces as materialized (select word, freq, string_split(trim(s, chr(1)), chr(1) || chr(1)) as pieces from step where k = {BPE_MERGES})"""


def bpe_model(spark, sf_dir, **options):
    """Merges over every line of every document; no line is too long. The SQL merges one pair at a time."""
    lines = tx.explode_lines(docs(spark, sf_dir), "text", ["doc_id"])
    rows = lines.select(tx.once(tx.normalize_text("line")).alias("line"))
    words = materialize(vocab.word_counts(rows, "line"), "words")
    symbols = vocab.word_symbols(words, vocab.char_vocab(words, "word", 0.9995, "freq"))
    return train_bpe(symbols, **(options or {"merges": BPE_MERGES}))


@query("bpe_vocab", f"""
    with recursive {bpe_steps(BPE_MERGES)}
    select distinct (k - 1)::int as rank, l as "left", r as "right", l || r as token, n::bigint as freq from step where k > 0""")
def bpe_vocab(spark, sf_dir):
    return bpe_model(spark, sf_dir).merges


@query("bpe_word_pieces", f"""
    with recursive {BPE_PIECES} select word, freq, array_to_string(pieces, ' ') as pieces from pieces""")
def bpe_word_pieces(spark, sf_dir):
    return bpe_model(spark, sf_dir).pieces.select("word", "freq", F.array_join("pieces", " ").alias("pieces"))


@query("bpe_line_tokens", f"""
    with recursive {BPE_PIECES},
    t as (select doc_id, line_no, flatten(list(pieces order by pos)) as tokens from bw join pieces using (word) group by doc_id, line_no)
    select doc_id, line_no::bigint as line_no, coalesce(len(tokens), 0)::bigint as n_tokens, coalesce(array_to_string(tokens, ' '), '') as tokens
    from bl left join t using (doc_id, line_no)""")
def bpe_line_tokens(spark, sf_dir):
    """Every line of every document in the learned pieces."""
    table_ = vocab.PieceTable(bpe_model(spark, sf_dir).pieces)
    lines = normal_lines(spark, sf_dir)
    found = table_.encode(lines, "line", ["doc_id", "line_no"])
    return found.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.size("tokens").cast("bigint").alias("n_tokens"),
                        F.array_join("tokens", " ").alias("tokens"))


BPE_LINES = f"""{BPE_PIECES},
    broken as (select doc_id, line_no from bw left join pieces using (word) group by doc_id, line_no
      having sum(coalesce(len(pieces), 1)) > 3 or bool_or(pieces is null))"""


@query("fragmented_tokens_bpe", f"""
    with recursive {BPE_LINES},
    t as (select doc_id, line_no, unnest(c) as token, generate_subscripts(c, 1) - 1 as pos from (
      select doc_id, line_no, list_filter(string_split(text, ' '), lambda x: x <> '') as c from bl join broken using (doc_id, line_no))),
    f as (select token, count(*) as freq, min((doc_id, line_no, pos)) as seen from t group by token)
    select token, freq, seen[1]::bigint as doc_id, seen[2]::bigint as line_no, seen[3]::bigint as "at" from f""")
def fragmented_tokens_bpe(spark, sf_dir):
    """Words on lines that the learned pieces break up."""
    pieces = vocab.PieceTable(bpe_model(spark, sf_dir).pieces)
    found = vocab.fragmented_token_freq(normal_lines(spark, sf_dir), "line", ["doc_id", "line_no"], pieces, WORDS, 3)
    seen = F.col("first_seen")
    return found.select("token", "freq", *(seen[c].cast("bigint").alias(c) for c in ("doc_id", "line_no", "at")))


@query("extend_vocab_bpe", f"""
    with recursive {NORM_KNOWN}, {BPE_PIECES},
    t as (select doc_id, line_no, unnest(c) as token, len(c) as n from (
      select doc_id, line_no, list_filter(string_split(text, ' '), lambda x: x <> '') as c from bl)),
    hit as (select doc_id, line_no from t left join known k using (token) group by doc_id, line_no having max(n) > 3 or bool_or(k.token is null)),
    p as (select doc_id, line_no, pos, unnest(pieces) as token, generate_subscripts(pieces, 1) - 1 as piece
      from bw join hit using (doc_id, line_no) join pieces using (word)),
    f as (select token, count(*) as freq, min((doc_id, line_no, pos, piece)) as seen from p group by token),
    v as (select token, row_number() over (order by token) - 1 as id from known),
    c as (select token, row_number() over (order by freq desc, seen) - 1 + (select count(*) from known) as id
      from f where freq >= 5 and token not in (select token from known))
    select token, id::bigint as id, false as added from v union all select token, id::bigint, true from c""")
def extend_vocab_bpe(spark, sf_dir):
    """The vocabulary with learned pieces that are frequent on lines which its words break up."""
    known = benchmark_words(spark, sf_dir)
    aux = vocab.PieceTable(bpe_model(spark, sf_dir).pieces)
    freq = vocab.fragmented_token_freq(normal_lines(spark, sf_dir), "line", ["doc_id", "line_no"], WORDS, aux, 3, known)
    base = order.row_index(known, ["token"], name="id")
    return vocab.extend_vocab(base, vocab.candidate_tokens(freq, base, 5), [-F.col("freq"), "first_seen"])


@query("bpe_vocab_large")
def bpe_vocab_large(spark, sf_dir):
    """A vocabulary of 4,256 tokens with 256 reserved for bytes; one merge at a time would take SQL hours."""
    return bpe_model(spark, sf_dir, vocab_size=4256, reserved=256).merges


def unigram_model(spark, sf_dir):
    lines = normal_lines(spark, sf_dir)
    words = materialize(vocab.word_counts(lines, "line"), "words")
    symbols = materialize(vocab.word_symbols(words, vocab.char_vocab(words, "word", 0.9995, "freq")), "symbols")
    return unigram.train_unigram(symbols, 2000, seed_size=20_000, shrink=0.5), symbols


@query("unigram_vocab")
def unigram_vocab(spark, sf_dir):
    """Expectation and maximisation have no SQL form; the tests run a sequential version."""
    model, _ = unigram_model(spark, sf_dir)
    return model.vocabulary(spark).select("rank", "piece", F.round("score", 9).alias("score"))


@query("unigram_word_pieces")
def unigram_word_pieces(spark, sf_dir):
    model, symbols = unigram_model(spark, sf_dir)
    return model.word_pieces(symbols).select("word", "freq", F.array_join("pieces", " ").alias("pieces"))


def normal_lines(spark, sf_dir) -> DataFrame:
    lines = tx.explode_lines(docs(spark, sf_dir), "text", ["doc_id"])
    return lines.select("doc_id", "line_no", tx.once(tx.normalize_text("line")).alias("line"))


NORM_LINES = f"""{LINES},
    nl as materialized (select doc_id, line_no, line from (select doc_id, line_no, {norm('line')} as line from lines)
      where line <> ''),
    {NORM_KNOWN},
    tokens as (select doc_id, line_no, unnest(string_split(line, ' ')) as token,
      generate_subscripts(string_split(line, ' '), 1) - 1 as pos, len(string_split(line, ' ')) as n from nl),
    hit as (select doc_id, line_no from tokens left join known k using (token)
      group by doc_id, line_no having max(n) > 3 or bool_or(k.token is null)),
    freqs as materialized (select token, count(*) as freq, min((doc_id, line_no, pos)) as first_seen
      from tokens join hit using (doc_id, line_no) group by token)"""


def benchmark_words(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark")
    return rows.select(F.explode(WORDS.tokens(tx.normalize_text("text"))).alias("token")).distinct()


def token_freq(spark, sf_dir) -> DataFrame:
    known = benchmark_words(spark, sf_dir)
    return vocab.fragmented_token_freq(normal_lines(spark, sf_dir), "line", ["doc_id", "line_no"], WORDS, WORDS, 3, known)


@query("fragmented_tokens", f"""
    with {NORM_LINES} select token, freq, first_seen[1]::bigint as doc_id, first_seen[2]::bigint as line_no, first_seen[3]::bigint as "at" from freqs""")
def fragmented_tokens(spark, sf_dir):
    seen = F.col("first_seen")
    return token_freq(spark, sf_dir).select(
        "token", "freq", *(seen[c].cast("bigint").alias(c) for c in ("doc_id", "line_no", "at")))


@query("candidate_tokens", f"""
    with {NORM_LINES} select token, freq, row_number() over (order by freq desc, first_seen) as place
    from freqs where freq >= 5 and token not in (select token from known)""")
def candidate_tokens(spark, sf_dir):
    found = vocab.candidate_tokens(token_freq(spark, sf_dir), benchmark_words(spark, sf_dir), 5)
    ranked = found.withColumn("down", -F.col("freq"))
    placed = order.row_index(ranked, ["down", "first_seen"], name="at")
    return placed.select("token", "freq", (F.col("at") + 1).alias("place"))


@query("extend_vocab", f"""
    with {NORM_LINES}, v as (select token, row_number() over (order by token) - 1 as id from known),
    c as (select token, row_number() over (order by freq desc, first_seen) - 1 + (select count(*) from known) as id
      from freqs where freq >= 5 and token not in (select token from known))
    select token, id::bigint as id, false as added from v union all select token, id::bigint, true from c""")
def extend_vocab(spark, sf_dir):
    base = order.row_index(benchmark_words(spark, sf_dir), ["token"], name="id")
    found = vocab.candidate_tokens(token_freq(spark, sf_dir), base, 5)
    return vocab.extend_vocab(base, found, [-F.col("freq"), "first_seen"])


@query("tokenizer_compare", f"""
    with {LINES}, s as (select line from lines
      order by md5('42:' || doc_id || '-' || line_no) limit 20)
    select count(*) as samples, round(avg(length(line)), 6) as avg_len_base,
      round(avg(len(list_filter(string_split(line, ' '), lambda w: w <> ''))), 6) as avg_len_new,
      round(avg(len(list_filter(string_split(line, ' '), lambda w: w <> ''))) - avg(length(line)), 6) as delta_len from s""")
def tokenizer_compare(spark, sf_dir):
    report = vocab.compare_tokenizers(line_sample(spark, sf_dir), "line", CHARS, WORDS)
    return report.select("samples", *(F.round(c, 6).alias(c) for c in ("avg_len_base", "avg_len_new", "delta_len")))


# ---------------------------------------------------------------- sources and sinks

@query("source_totals", "select source as split, count(*) as rows from documents group by rollup (source)")
def source_totals(spark, sf_dir):
    return writers.split_totals(docs(spark, sf_dir).select(F.col("source").alias("split")))


def _fresh(spark: SparkSession, label: str) -> str:
    import uuid

    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


@query("jsonl_roundtrip", "select doc_id, text, lang, false as malformed from documents")
def jsonl_roundtrip(spark, sf_dir):
    path = _fresh(spark, "jsonl")
    writers.write_jsonl(docs(spark, sf_dir), path, ["doc_id"], ["doc_id", "text", "lang"])
    rows = readers.read_jsonl(spark, path, "doc_id bigint, text string, lang string")
    return rows.select("doc_id", "text", "lang", F.col(readers.MALFORMED).alias("malformed"))


@query("jsonl_malformed", """
    select case when doc_id % 3 = 2 then doc_id end as doc_id, doc_id % 3 <> 2 as malformed from documents""")
def jsonl_malformed(spark, sf_dir):
    """Every third line is a list, every third an object with text behind it."""
    path, n = _fresh(spark, "lines"), F.col("doc_id").cast("string")
    record = F.concat(F.lit('{"doc_id": '), n, F.lit("}"))
    line = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("["), n, F.lit("]"))).when(
        F.col("doc_id") % 3 == 1, F.concat(record, F.lit(" tail"))).otherwise(record)
    docs(spark, sf_dir).select(line.alias("value")).write.text(path)
    rows = readers.read_jsonl(spark, path, "doc_id bigint")
    return rows.select("doc_id", F.col(readers.MALFORMED).alias("malformed"))


@query("route_roundtrip", """
    select doc_id, text, source as subdir, lang || '_clean.jsonl' as name from documents""")
def route_roundtrip(spark, sf_dir):
    path = _fresh(spark, "routed")
    file = F.concat(F.lit("/data/fetch_data/"), "source", F.lit("/"), "lang", F.lit(".jsonl"))
    writers.route_output(docs(spark, sf_dir).withColumn("_file", file), path, columns=["doc_id", "text"])
    rows = spark.read.schema("doc_id bigint, text string, subdir string, name string").json(path)
    return rows.select("doc_id", "text", "subdir", "name")


@query("sink_roundtrip", """
    with r as (select doc_id, text, source from documents)
    select 'jsonl' as format, doc_id, text, source, (select count(*) from r) as kept from r
    union all select 'parquet', doc_id, text, source, (select count(*) from r) from r""")
def sink_roundtrip(spark, sf_dir):
    """Rows of one pass as JSONL and parquet below a folder of their own, with the statistics that mark them complete."""
    base, rows = _fresh(spark, "sink"), docs(spark, sf_dir).select("doc_id", "text", "source")
    writers.write_dataset(rows, base, "pretrain", partition_by=["source"], kept=F.count("*"))
    stats = readers.read_stats(spark, base, "pretrain")
    schema = "doc_id bigint, text string, source string"
    jsonl = spark.read.schema(schema).json(f"{base}/pretrain/jsonl").select(F.lit("jsonl").alias("format"), "doc_id", "text", "source")
    parquet = spark.read.schema(schema).parquet(f"{base}/pretrain/parquet").select(F.lit("parquet").alias("format"), "doc_id", "text", "source")
    return jsonl.unionByName(parquet).withColumn("kept", F.lit(stats["kept"]).cast("bigint"))


@query("dataset_roundtrip", """
    select doc_id::varchar as text from documents union all select lang || doc_id as text from documents""")
def dataset_roundtrip(spark, sf_dir):
    """The same reader over a text file and a JSON file."""
    base = _fresh(spark, "dataset")
    docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("value")).write.text(f"{base}.txt")
    docs(spark, sf_dir).select(F.concat("lang", F.col("doc_id").cast("string")).alias("text")).write.json(f"{base}.json")
    return readers.read_dataset(spark, f"{base}.txt").select("text").union(readers.read_dataset(spark, f"{base}.json").select("text"))


@query("splits_roundtrip", """
    select case lang when 'en' then 'train' when 'de' then 'validation' else 'test' end as split, doc_id, text
    from documents""")
def splits_roundtrip(spark, sf_dir):
    base = _fresh(spark, "splits")
    split = F.when(F.col("lang") == "en", "train").when(F.col("lang") == "de", "validation").otherwise("test")
    rows = docs(spark, sf_dir).select("doc_id", "text", split.alias("split"))
    for name in ("train", "validation", "test"):
        part = rows.where(F.col("split") == name).drop("split")
        writers.write_parquet(part, f"{base}/pretrain/{name}", ["doc_id"])
    return readers.read_splits(spark, base, "pretrain").select("split", "doc_id", "text")


@query("corpus_roundtrip", f"""
    with {CORPUS} select row_number() over (order by doc_id, line_no) as place, line from k""")
def corpus_roundtrip(spark, sf_dir):
    path = _fresh(spark, "corpus")
    writers.write_corpus(corpus(spark, sf_dir).kept, path, "line", ["doc_id", "line_no"])
    lines = readers.read_lines(spark, path)
    placed = order.row_index(lines, [readers.ORDER], name="at")
    return placed.select((F.col("at") + 1).alias("place"), "line")


@query("numbered_lines", f"""
    with {CORPUS} select row_number() over (order by doc_id, line_no) as place, line, true as gapless from k""")
def numbered_lines(spark, sf_dir):
    """Lines by file and line number; ``gapless`` where the places of a file's lines follow its numbers."""
    path = _fresh(spark, "numbered")
    writers.write_corpus(corpus(spark, sf_dir).kept, path, "line", ["doc_id", "line_no"])
    placed = order.row_index(readers.read_lines(spark, path, numbered=True), [readers.ORDER], name="at")
    file, start = F.col(f"{readers.ORDER}.path"), F.col("at") - F.col(f"{readers.ORDER}.line")
    files = placed.groupBy(file.alias("path")).agg((F.min(start) == F.max(start)).alias("gapless"))
    # A row per file that was written: the lines need no shuffle to meet it.
    return placed.join(F.broadcast(files), file == F.col("path")).select((F.col("at") + 1).alias("place"), "line", "gapless")


@query("tokens_roundtrip", f"""
    with {WORD_COUNTS} select row_number() over (order by freq desc, word) as place, word as token from wc""")
def tokens_roundtrip(spark, sf_dir):
    path = _fresh(spark, "tokens")
    words = word_counts(spark, sf_dir).withColumnRenamed("word", "token").withColumn("down", -F.col("freq"))
    writers.write_tokens(words, path, ["down", "token"])
    placed = order.row_index(readers.read_tokens(spark, path), [readers.ORDER], name="at")
    return placed.select((F.col("at") + 1).alias("place"), "token")


# ---------------------------------------------------------------- training-data operators

try:
    import corpus_pipeline
    from quern.llm import registry
except ModuleNotFoundError as missing:
    # Only these two may be absent; any other missing module is an error.
    if missing.name not in ("corpus_pipeline", "quern.llm", "quern.llm.registry"):
        raise
else:
    _QUERIES.update(registry.QUERIES)
    _SQL.update(registry.SQL)
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Clean the documents table: normalise, filter by length, remove exact and near copies."""
    return clean_corpus(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
