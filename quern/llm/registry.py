"""The queries of this package and the SQL that checks them, by the names they are registered under.

A query without SQL is tested against a brute-force version in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import (
    archives, decontaminate, hosts, pieces, pii, quality, reshard, runs, secrets, simhash, tokentree, topk, whitening,
)
from quern.llm.common import fresh_path, read_table, stored, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHARDS = 8


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    archives.write_arc(pages, arc, "page_id", "url", "html")
    archives.convert(spark, arc, warc)
    found = archives.with_targets(archives.read_warc(spark, warc))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


OP1 = """
    with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as d from pages),
    m as (select d, max(page_id) as top from p where n >= 1000 group by d)
    select page_id, n::bigint as payload_bytes, p.d as payload_digest,
      case when page_id <> top then 'revisit' else 'response' end as record_type,
      case when page_id <> top then top end as refers_to
    from p left join m on p.d = m.d and n >= 1000"""


def op2_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout holds a source per shard, so that it is as uneven as the sources are."""
    docs = read_table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(SHARDS))
    crc = F.crc32(text_or_empty("text").cast("binary")).alias("text_crc32")
    rows = reshard.rows_law(docs, SHARDS, old, columns=[F.col("doc_id"), F.col("size"), crc])
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, name = pieces.with_digests(documents(spark, sf_dir), pieces.PieceVocabulary(PIECES), keep=["doc_id"])
    return rows.select("doc_id", f"{name}.*")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = read_table(spark, sf_dir, "benchmark")
    rows, name = decontaminate.find_contamination(documents(spark, sf_dir), benchmark, keep=["doc_id"])
    found = F.col(name)
    return rows.select(
        "doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"), F.size(found["items"]).cast("bigint").alias("n_items"),
        decontaminate.items_digest(found["items"]).alias("items_sha256"), decontaminate.contaminated(found).alias("contaminated"))


def _words(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP4 = f"""
    with b as (select item_id, {_words('text')} as w from benchmark),
    v as (select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as phrase
          from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from b where len(w) > 0)),
    d as (select doc_id, {_words('text')} as w from documents),
    p as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as phrase
          from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from v) where len(w) >= n)),
    f as (select doc_id, i, n, item_id from p join v using (n, phrase)),
    h as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from (select distinct doc_id, i, n from f)) group by doc_id),
    t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
          from (select distinct doc_id, item_id::varchar as item from f) group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
      sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from d left join h using (doc_id) left join t using (doc_id)"""


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, "vec_id", "embedding", 10)


OP5 = """
    with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
               where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
          from v q, v c where q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
    select query_id, rank::int as rank, vec_id, score from r where rank <= 10"""


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first scan of a new ledger: every blob is unseen."""
    docs, ledger = documents(spark, sf_dir), fresh_path(spark, "ledger")
    secrets.update_ledger(docs, ledger)
    found = secrets.findings(docs, ledger, ["doc_id"])
    spans = secrets.spans_text(F.col("spans"))
    counts = [secrets.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def _found(k: int, kind: str, pattern: str, least: int, group: int) -> str:
    """Matches with places: pieces between matches and matches alternate."""
    p = pattern.replace("'", "''")
    return f"""
      select doc_id, {k} as k, '{kind}' as kind, a, a + length(m[i]) as b from (
        select doc_id, m, g, i, (list_sum(list_transform(s[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint as a
        from (select doc_id, m, g, s, unnest(range(1, len(m) + 1)) as i from (
          select doc_id, regexp_extract_all(t, '{p}') as m, regexp_extract_all(t, '{p}', {group}) as g,
            string_split_regex(t, '{p}') as s from d)))
      where length(g[i]) >= {least}"""


_ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
_ASSIGN = rf"({_ANY_CASE}|[aA][pP][iI]_?[kK][eE][yY])[""" + r"""\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"""
OP6 = f"""
    with d as (select doc_id, coalesce(text, '') as t from documents),
    f as ({_found(1, 'assign', _ASSIGN, 6, 2)} union all {_found(2, 'access', 'AKIA[A-Z0-9]+', 20, 0)}
          union all {_found(3, 'hex', '[0-9a-f]+', 24, 0)}),
    s as (select doc_id, count(*) filter (k = 1) as n_assign, count(*) filter (k = 2) as n_access, count(*) filter (k = 3) as n_hex,
            string_agg(kind || ':' || a || ':' || b, ',' order by a, k) as spans from f group by doc_id)
    select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
      sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans from d left join s using (doc_id)"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, name = simhash.with_fingerprint(documents(spark, sf_dir), keep=["doc_id"])
    prints = stored(rows.select("doc_id", F.col(name)["fp"].alias("fp")), "prints")
    return simhash.near_components(prints).select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    rows, name = quality.with_quality(docs, model, keep=["doc_id"])
    score = F.col(name)["score"]
    return rows.select("doc_id", quality.held_out("doc_id").alias("held_out"), score.alias("score"),
                       (score >= quality.KEEP).cast("int").alias("predicted"))


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its edits, and how much was encoded again."""
    vocabulary = tokentree.Vocabulary(RANKS, public_tokenizers.PATTERN)
    docs, tree = tokentree.with_tree(documents(spark, sf_dir), vocabulary)
    docs = docs.withColumn("_edits", tokentree.sample_edits("text", "doc_id"))
    rows, name = tokentree.apply_edits(docs, tree, "_edits", vocabulary, keep=["doc_id", "text"])
    found = F.col(name)
    return rows.select("doc_id", F.length(text_or_empty("text")).cast("bigint").alias("n_chars"),
                       *(found[c].alias(c) for c in ("n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded")))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows, name = pii.with_pii(docs, pii.fit(docs), keep=["doc_id"])
    base, spans = F.col(name)["base"], F.col(name)["spans"]
    counts = [secrets.count_kind(base, k).alias(f"n_{k}") for k in pii.KINDS]
    return rows.select("doc_id", *counts, F.sha2(secrets.spans_text(base), 256).alias("base_sha256"), secrets.spans_text(spans).alias("spans"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures are written once, without texts; counts by host and verdicts read that table."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows, name = hosts.measured(docs)
    rows = stored(rows.drop("text"), "measures")
    rows, kept = hosts.judged(rows, name, hosts.condemned(rows, name))
    got = F.col(name)
    return rows.select("doc_id", *(got[m].alias(m) for m in hosts.MEASURES), got["base_failed"].alias("base_failed"), F.col(kept).alias("kept"))


_RULES = {
    "short": f"n_words < {hosts.STRICT_WORDS}",
    "repeats": f"100 * n_repeat_words > {hosts.STRICT_REPEATED} * n_words",
    "symbols": f"100 * n_symbols > {hosts.SYMBOLS} * word_chars",
    "lines": f"n_dup_lines > 0 and 100 * n_dup_lines >= {hosts.LINES} * n_lines",
    "lengths": f"not unspaced and (word_chars < {hosts.LENGTHS[0]} * n_words or word_chars > {hosts.LENGTHS[1]} * n_words)",
}


def _shrunk(r: str) -> str:
    share = f"(ff_{r} - n * m_{r} * m_{r} - (hosts - 1) * m_{r} * (1 - m_{r})) / (m_{r} * (1 - m_{r}) * (n - nn / n - (hosts - 1)))"
    ok = f"m_{r} > 0 and m_{r} < 1 and hosts > 1 and n - nn / n - (hosts - 1) > 0"
    weight = f"case when {ok} and {share} > 1e-12 then round(least(greatest(1 / ({share}) - 1, 0), n), 6) else n end"
    return f"select host, round((f_{r} + m_{r} * w) / (h.n + w), 9) > {hosts.LIMIT} as bad_{r} from h, (select *, {weight}::double as w from s)"


OP12 = rf"""
    with d as (select doc_id, source as host, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                 list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from documents),
    g as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as p from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d where len(w) > 5)),
    r as (select doc_id, count(distinct place) as n from (
            select doc_id, unnest(range(i, i + 5)) as place from (select doc_id, i, count(*) over (partition by doc_id, p) as k from g) where k > 1) group by doc_id),
    v as (select doc_id, host, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
            coalesce(r.n, 0)::bigint as n_repeat_words, len(l) as n_lines,
            regexp_matches(t, '[\x{{0E00}}-\x{{0EFF}}\x{{1000}}-\x{{109F}}\x{{1780}}-\x{{17FF}}\x{{3040}}-\x{{30FF}}\x{{3400}}-\x{{4DBF}}\x{{4E00}}-\x{{9FFF}}]') as unspaced
          from d left join r using (doc_id)),
    f as (select *, n_words < {hosts.LEAST_WORDS} or 100 * n_repeat_words > {hosts.REPEATED} * n_words as base_failed,
            {', '.join(f'({c}) as x_{r}' for r, c in _RULES.items())} from v),
    h as (select host, count(*) as n, {', '.join(f'count(*) filter (x_{r}) as f_{r}' for r in hosts.RULES)} from f where host is not null group by host),
    s as (select *, {', '.join(f'sf_{r} / n as m_{r}' for r in hosts.RULES)} from (select count(*) as hosts, sum(n) as n, sum(n::double * n) as nn,
            {', '.join(f'sum(f_{r}) as sf_{r}, sum(f_{r}::double * f_{r} / n) as ff_{r}' for r in hosts.RULES)} from h)),
    {', '.join(f'b_{r} as ({_shrunk(r)})' for r in hosts.RULES)}
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      not base_failed and not ({' or '.join(f'(x_{r} and coalesce(bad_{r}, false))' for r in hosts.RULES)}) as kept
    from f {' '.join(f'left join b_{r} using (host)' for r in hosts.RULES)}"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", runs.folded("text", "doc_id").alias("text"))
    rows, name = runs.with_runs(docs, keep=["doc_id"])
    found = F.col(name)["runs"]
    rows = rows.select(
        "doc_id", F.size(found).cast("bigint").alias("n_runs"), runs.longest(found).alias("best"),
        F.sha2(runs.lines(found), 256).alias("runs_sha256"), F.sha2(F.col(name)["collapsed"], 256).alias("collapsed_sha256"))
    return rows.selectExpr(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", "1000 * best.length div best.period as exponent_milli",
        "runs_sha256", "collapsed_sha256")


_CRC = """xor(list_reduce(list_prepend(4294967295::ubigint, flatten(list_transform(string_split(doc_id::varchar, ''),
    lambda c: list_transform(range(0, 8), lambda k: ((ascii(c) >> k::int) & 1)::ubigint)))),
    lambda c, b: case when (xor(c, b) & 1::ubigint) = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end), 4294967295::ubigint)::bigint"""
OP13 = rf"""
    with d as (select doc_id, {_CRC} as h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    p as (select *, h // 10 as g, len(w) as n from d),
    a as (select *, g % n as a from p where h % 10 = 0 and n > 0),
    t as (select doc_id, w from p where h % 10 <> 0 or n = 0 union all
          select doc_id, list_transform(range(0, n), lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) from a),
    x as (select doc_id, n, unnest(w) as word, unnest(range(0, n)) as i from (select doc_id, w, len(w) as n from t)),
    e as (select l.doc_id, r.i - l.i as q, l.i from x l join x r on l.doc_id = r.doc_id and l.word = r.word and r.i > l.i and 2 * (r.i - l.i) <= l.n),
    s as (select doc_id, q, min(i) as start, count(*) + q as length
          from (select *, i - row_number() over (partition by doc_id, q order by i) as island from e) group by doc_id, q, island),
    f as (select doc_id, start, length, min(q) as period from s where length >= greatest(12, 2 * q) group by doc_id, start, length),
    b as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed,
            first({{'start': start, 'length': length, 'period': period}} order by length desc, start, period) as best from f group by doc_id),
    c as (select distinct doc_id, unnest(range(start + period, start + length)) as i from f),
    k as (select x.doc_id, string_agg(word, ' ' order by x.i) as kept from x left join c on x.doc_id = c.doc_id and x.i = c.i where c.i is null group by x.doc_id)
    select t.doc_id, coalesce(n_runs, 0)::bigint as n_runs, best.start::bigint as start, best.length::bigint as length, best.period::bigint as period,
      (1000 * best.length // best.period)::bigint as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
    from t left join b using (doc_id) left join k using (doc_id)"""


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_arc_to_warc, op2_reshard, op3_sentencepiece, op4_decontaminate, op5_top_k, op6_secret_ledger, op7_simhash,
    op8_quality, op9_edit_counts, op10_personal_data, op11_whitening, op12_host_rules, op13_periodic_runs)}
SQL = {"op1_arc_to_warc": OP1, "op4_decontaminate": OP4, "op5_top_k": OP5, "op6_secret_ledger": OP6, "op12_host_rules": OP12, "op13_periodic_runs": OP13}
