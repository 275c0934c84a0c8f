"""Periodic runs against comparing all lags."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from quern.llm import runs

DOCS = "doc_id bigint, text string, start string, _runs string"


def brute(words):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= max(12 - q, q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def words(r):
    kind, n = r.randint(0, 6), r.randint(0, 600)
    if kind == 0:
        return [r.choice("ab") for _ in range(n)]
    if kind == 1:
        unit = [r.choice("abcdefghij") for _ in range(r.randint(1, 200))]
        return (unit * 10)[:n]
    if kind == 2:  # runs of one period that touch out of step
        unit = [r.choice("ab") for _ in range(r.randint(1, 6))]
        run = unit * r.randint(5, 60)
        return (run + run[:r.randint(0, 6)] + r.choice([[], ["a"], ["z"]])) * r.randint(1, 4)
    if kind == 3:
        a, b = "a", "ab"
        while len(b) < n:
            a, b = b, b + a
        return list(b[:n])
    if kind == 4:
        return ["x"] * r.randint(0, 250) + [r.choice("abx") for _ in range(60)] + ["x"] * r.randint(0, 250)
    if kind == 5:
        unit = (["a"] * r.randint(1, 40) + ["b"]) * r.randint(1, 9) + [r.choice("abc")]
        return (unit * r.randint(1, 6))[:800]
    out = [r.choice("ab") for _ in range(8)]
    for _ in range(r.randint(3, 7)):
        out = out + out[:r.randint(1, len(out))]
    return out[:800]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_lags(seed):
    r = random.Random(seed)
    texts = [words(r) for _ in range(70)]
    got = list(runs.runs_of([" ".join(t).encode() for t in texts]))
    for t, (split, found) in zip(texts, got, strict=True):
        assert [w.decode() for w in split] == t
        assert found == brute(t), t


def test_groups_of_texts_change_nothing(monkeypatch):
    r = random.Random(9)
    texts = [" ".join(words(r)).encode() for _ in range(20)]
    whole = [x for _, x in runs.runs_of(texts)]
    monkeypatch.setattr(runs, "TOGETHER", 1)
    assert [x for _, x in runs.runs_of(texts)] == whole


@pytest.mark.parametrize("text, count", [
    (b"a " * 1_000_000, 1), (b"a b " * 200_000 + b"a " + b"a b " * 200_000, 199_999),
    (b" ".join(b"%d" % (i * i % 7919) for i in range(400_000)), 1)])
def test_very_long_texts(text, count):
    (split, found), = runs.runs_of([text])
    assert len(found) == count
    if count == 1:
        assert found[0][1] == len(split)


def test_frame_with_awkward_rows(spark):
    texts = ["a b " * 10, "one two three", "\t\x0b" + "x\n" * 20 + "\x1cy z", "é " * 12, ""]
    rows = [(i, t, "s", "r") for i, t in enumerate(texts)] + [(0, texts[0], None, None), (None, "a " * 12, None, None), (9, None, None, None)]
    out, name = runs.with_runs(spark.createDataFrame(rows, DOCS))
    got = {(r["doc_id"], r["text"]): r[name] for r in out.collect()}
    assert name == "_runs_" and out.count() == len(rows) and len(got) == len(rows) - 1
    first = got[0, texts[0]]
    assert [tuple(x) for x in first["runs"]] == [(0, 20, 2)] and first["collapsed"] == "a b" and first["n_words"] == 20
    assert [tuple(x) for x in got[2, texts[2]]["runs"]] == [(0, 20, 1)]
    assert got[2, texts[2]]["collapsed"] == "x \x1cy z"
    assert [tuple(x) for x in got[3, texts[3]]["runs"]] == [(0, 12, 1)]
    assert got[9, None]["n_words"] == 0 and got[9, None]["runs"] == [] and got[9, None]["collapsed"] == ""
    assert runs.with_runs(spark.createDataFrame([], DOCS))[0].collect() == []
    raw = spark.createDataFrame([(bytearray(b"\xff " * 12),)], "raw binary").select(F.col("raw").cast("string").alias("text"))
    assert runs.with_runs(raw)[0].first()["_runs"]["collapsed"] == "�"


def test_longest_prefers_small_start_then_period(spark):
    df = spark.createDataFrame([([(5, 12, 1), (3, 20, 4), (1, 20, 9), (1, 20, 3)],), ([],)], f"runs array<{runs.RUN}>")
    first, none = df.select(runs.longest(F.col("runs")).alias("r"), runs.lines(F.col("runs")).alias("t")).collect()
    assert tuple(first["r"]) == (1, 20, 3) and none["r"] is None
    assert first["t"] == "5,12,1\n3,20,4\n1,20,9\n1,20,3\n" and none["t"] == ""


def test_folded_words(spark):
    text = "  ".join(f"w{i}" for i in range(50))
    ids = [*range(60), None]
    df = spark.createDataFrame([(i, text) for i in ids] + [(i, "") for i in ids] + [(i, None) for i in ids], "doc_id bigint, text string")
    for r in df.select("doc_id", "text", runs.folded("text", "doc_id").alias("t")).collect():
        h = 1 if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 or not r["text"]:
            assert (r["t"] or "") == (r["text"] or "")
            continue
        w, g = r["text"].split(), h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        assert r["t"] == " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(len(w)))
