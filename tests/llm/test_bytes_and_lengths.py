"""Bytes that are not UTF-8, and texts of a megabyte, through the operators that `test_long_texts` leaves out."""

import hashlib
import time

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quern.llm import archives, decontaminate, pieces, registry, runs, secrets, simhash, tokentree
from quern.llm.common import fresh_path

BAD = [b"\xff\xfe password=abc123xyz \x80end", b"\xc3", b"plain caf\xc3\xa9", b"one two \xe4\xbd three four \xf0\x9f\x98", b""]


def bad_rows(spark):
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(BAD)], "doc_id bigint, raw binary")
    return rows.select("doc_id", F.col("raw").cast("string").alias("text"))


def test_pieces_of_odd_bytes(spark):
    vocabulary = pieces.PieceVocabulary(registry.PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    out, name = pieces.with_digests(bad_rows(spark), vocabulary, keep=["doc_id"])
    for row in out.collect():
        want = library.encode(BAD[row["doc_id"]].decode("utf-8", "replace"), add_bos=True, add_eos=True)
        assert row[name]["n_tokens"] == len(want)
        assert row[name]["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
    assert pieces.check(bad_rows(spark), vocabulary, registry.PIECES).count() == 0


def test_secrets_of_odd_bytes(spark):
    ledger = fresh_path(spark, "ledger")
    secrets.update_ledger(bad_rows(spark), ledger)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.findings(bad_rows(spark), ledger, ["doc_id"]).collect()}
    assert got == {0: [("assign", 3, 21)], 1: [], 2: [], 3: [], 4: []}


def test_edits_of_odd_bytes(spark):
    vocabulary = tokentree.Vocabulary(registry.RANKS, public_tokenizers.PATTERN)
    counter, _ = vocabulary.counter()
    df, tree = tokentree.with_tree(bad_rows(spark), vocabulary)
    put = F.col("text").alias("put")
    df = df.withColumn("edits", F.array(F.struct(F.lit(2).alias("at"), F.lit(1).alias("cut"), put)))
    out, name = tokentree.apply_edits(df, tree, "edits", vocabulary, keep=["doc_id"])
    for row in out.collect():
        text = BAD[row["doc_id"]].decode("utf-8", "replace")
        edited = text[:2] + text + text[3:]
        assert row[name]["n_tokens"] == len(counter.encoding.encode_ordinary(text))
        assert row[name]["n_tokens_edited"] == len(counter.encoding.encode_ordinary(edited)) and row[name]["n_chars_edited"] == len(edited)


def test_counts_follow_the_vocabulary_not_its_path(tmp_path):
    """Two vocabularies under one path: the second one's counts are its own."""
    path, lines = tmp_path / "ranks", open(registry.RANKS, "rb").read().splitlines()
    counts = []
    for some in (lines, lines[:256]):
        path.write_bytes(b"\n".join(some))
        counter, _ = tokentree.Vocabulary(str(path), public_tokenizers.PATTERN).counter()
        counts.append(counter["hello"])
    assert counts[1] == 5 > counts[0]


def test_contamination_of_odd_bytes(spark):
    item = spark.createDataFrame([("i", "two"), ("j", "three four")], "item_id string, text string")
    out, name = decontaminate.find_contamination(bad_rows(spark), item)
    got = {r["doc_id"]: r[name] for r in out.collect()}
    assert [got[3]["n_hit"], got[3]["items"]] == [3, ["i", "j"]] and got[0]["n_hit"] == got[1]["n_hit"] == 0
    spans = [(s["start"], s["end"]) for s in got[3]["spans"]]
    assert decontaminate.remove_spans(BAD[3], spans) == b"one  \xe4\xbd  \xf0\x9f\x98".decode("utf-8", "replace")


def test_fingerprints_and_runs_of_odd_bytes(spark):
    prints, name = simhash.with_fingerprint(bad_rows(spark))
    found, other = runs.with_runs(bad_rows(spark))
    assert prints.count() == found.count() == len(BAD)


LONG = {"words": "some words of a very long text " * 33_000, "one word": "x" * 1_000_000, "digits": "0123456789abcdef" * 62_500,
        "unspaced": "的一是不了人我在有他" * 100_000, "lines": "\n" * 1_000_000}


@pytest.mark.parametrize("name", LONG)
def test_megabytes_take_linear_time(spark, name):
    """Archives, contamination, secrets and fingerprints of one long text beside a short one."""
    text, start = LONG[name], time.time()
    df = spark.createDataFrame([(1, "http://a.org/", text), (2, "http://b.org/", "short text")], "doc_id bigint, url string, text string")
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    archives.write_arc(df, arc, "doc_id", "url", "text")
    archives.convert(spark, arc, warc)
    back = {r["key"]: r for r in archives.with_targets(archives.read_warc(spark, warc)).collect()}
    assert back[1]["payload_bytes"] == len(text.encode()) and back[1]["payload_digest"] == hashlib.sha1(text.encode()).hexdigest()

    item = spark.createDataFrame([("i", "words of a very long")], "item_id string, text string")
    found, field = decontaminate.find_contamination(df.select("doc_id", "text"), item)
    hits = {r["doc_id"]: r[field] for r in found.collect()}
    assert hits[1]["n_hit"] == text.count("words of a very long") * 5 and hits[2]["n_hit"] == 0

    ledger = fresh_path(spark, "ledger")
    secrets.update_ledger(df, ledger)
    spans = {r["doc_id"]: r["spans"] for r in secrets.findings(df, ledger, ["doc_id"]).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in spans[1]] == ([("hex", 0, len(text))] if name == "digits" else [])

    prints, field = simhash.with_fingerprint(df.select("doc_id", "text"))
    assert len({r[field]["fp"] for r in prints.collect()}) == 2
    assert time.time() - start < 60
