"""Host rules against counting in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import hosts

DOCS = "doc_id bigint, text string, source string, _measures string, _kept int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    spots, seen = {}, set()
    for i in range(len(words) - 4):
        spots.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in spots.values():
        if len(at) > 1:
            seen.update(k for i in at for k in range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, marks, again = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    unspaced = any("฀" <= c <= "໿" or "一" <= c <= "鿿" for c in text)
    fails = (n < 20, 100 * len(seen) > 10 * n, 100 * marks > 5 * chars, again > 0 and 100 * again >= 30 * len(lines),
             not unspaced and (chars < 3 * n or chars > 10 * n))
    return n, chars, marks, again, len(seen), n < 10 or 100 * len(seen) > 20 * n, fails


def brute_kept(rows):
    """Verdicts of (host, text) rows."""
    found = [(h, brute(t)) for h, t in rows]
    kept = [not m[5] for _, m in found]
    by = {}
    for h, m in found:
        if h is not None:
            by.setdefault(h, []).append(m[6])
    total = sum(map(len, by.values()))
    for r in range(5):
        f = {h: sum(x[r] for x in v) for h, v in by.items()}
        rate = sum(f.values()) / total if total else 0
        chance, many = rate * (1 - rate), len(by)
        free = total - sum(len(v) ** 2 for v in by.values()) / total - (many - 1) if total else 0
        share = 0
        if chance > 0 and many > 1 and free > 0:
            share = (sum(f[h] ** 2 / len(v) for h, v in by.items()) - total * rate * rate - (many - 1) * chance) / (chance * free)
        weight = min(max(1 / share - 1, 0), total) if share > 1e-12 else total
        bad = {h for h, v in by.items() if round((f[h] + rate * weight) / (len(v) + weight), 9) > hosts.LIMIT}
        kept = [k and not (m[6][r] and h in bad) for k, (h, m) in zip(kept, found)]
    return kept


def sample(seed=3):
    r = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "a", "wörter", "ひらがな", "zeta"]
    def prose(n):
        return " ".join(r.choice(words) + str(r.randint(0, 99)) for _ in range(n))

    rows = []
    for host, junk, n in (("good", 0.02, 150), ("marks", 0.7, 60), ("lines", 0.6, 40), ("few", 1.0, 2), ("hot", 0.05, 300), (None, 0.5, 20)):
        for _ in range(n):
            text = prose(r.randint(25, 60))
            if r.random() < junk:
                text = {"lines": "\n".join([prose(12), prose(12), prose(12)] + ["one more line here"] * 2), "few": prose(15)}.get(host, text + " " + "#$%" * 20)
            rows.append((host, text))
    rows += [("good", None), ("good", ""), ("good", "a b c d e " * 5), ("good", "x " * 40), (None, None), ("good", "的一是不了 " * 30), ("", prose(30))]
    return rows


@pytest.mark.parametrize("broadcast", [hosts.BROADCAST, 0])
def test_verdicts_equal_counting(spark, monkeypatch, broadcast):
    monkeypatch.setattr(hosts, "BROADCAST", broadcast)
    rows = sample()
    df = spark.createDataFrame([(i, t, h, "m", 1) for i, (h, t) in enumerate(rows)], DOCS).repartition(5)
    out, name, kept = hosts.with_verdicts(df)
    assert out.columns == [*df.columns, name, kept] and (name, kept) == ("_measures_", "_kept_")
    want = brute_kept(rows)
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, (h, t) in enumerate(rows):
        assert tuple(got[i][name][m] for m in hosts.MEASURES) + (got[i][name]["base_failed"],) == brute(t)[:6], t
        assert got[i][kept] == want[i], (h, t, brute(t))
    # Blemishes go where they are the habit and stay elsewhere; two documents do not condemn a host.
    blemished = {h: {got[i][kept] for i, (x, t) in enumerate(rows) if x == h and t and "#$%" in t} for h in ("hot", "marks")}
    assert blemished == {"hot": {True}, "marks": {False}}
    assert all(got[i][kept] for i, (h, t) in enumerate(rows) if not any(brute(t)[6]) and not brute(t)[5])


def test_small_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert hosts.with_verdicts(empty)[0].collect() == []
    one = spark.createDataFrame([(1, "word " * 30, "a", "", 0)] * 2, DOCS)
    out, _, kept = hosts.with_verdicts(one)
    assert [r[kept] for r in out.collect()] == [False, False]
    nowhere = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(30)), None, "", 0)], DOCS)
    out, _, kept = hosts.with_verdicts(nowhere)
    assert [r[kept] for r in out.collect()] == [True]


def test_long_text_and_many_repeats(spark):
    texts = ["a " * 200_000, " ".join(f"w{i}" for i in range(200_000)), "one two three four five " * 20_000, " ".join(f"w{i % 1000}" for i in range(50_000))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows, name = hosts.measured(df)
    got = [r[name]["n_repeat_words"] for r in rows.select(name).collect()]
    assert sorted(got) == sorted([200_000, 0, 100_000, 50_000])


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b", "h")], "doc_id bigint, text string, source string")
    out, *_ = hosts.with_verdicts(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)
    assert out.select(F.col("doc_id")).first()["doc_id"] == 1
