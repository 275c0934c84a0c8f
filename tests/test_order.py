import random

import pytest
from pyspark.sql import functions as F

from quern.operators import filters, order
from quern.session import materialize


def shuffled(spark, n, seed=0):
    ids = list(range(0, 7 * n, 7))
    random.Random(seed).shuffle(ids)
    return spark.createDataFrame([(i, f"g{0 if i % 3 else i % 5}") for i in ids], "id bigint, g string")


def test_row_index(spark):
    df = shuffled(spark, 5000)
    rows = order.row_index(df, ["id"], name="at").collect()
    assert len(rows) == 5000 and all(r["id"] == 7 * r["at"] for r in rows)


def test_row_index_within_groups(spark):
    rows = order.row_index(shuffled(spark, 3000), ["id"], ["g"], "at").collect()
    by_group = {}
    for r in rows:
        by_group.setdefault(r["g"], []).append((r["id"], r["at"]))
    for members in by_group.values():
        assert [at for _, at in sorted(members)] == list(range(len(members)))


def test_null_groups_are_groups(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 3 else "a", "x" * i) for i in range(300)], "id int, g string, wide string").repartition(5)
    at = {r["id"]: r["at"] for r in order.row_index(df, ["id"], ["g"], "at").collect()}
    assert at == {i: i // 3 if i % 3 == 0 else i - i // 3 - 1 for i in range(300)}
    small = sorted(r["id"] for r in order.head_per_group(df, 120, ["g"], ["id"]).collect())
    for size in (order.BROADCAST_BYTES, 0):
        monkeypatch.setattr(order, "BROADCAST_BYTES", size)
        monkeypatch.setattr(order, "WINDOW_TRIM_LIMIT", 10)
        large = order.head_per_group(df, 120, ["g"], ["id"])
        assert sorted(r["id"] for r in large.collect()) == small and large.columns == df.columns
    assert len(small) == 220


def test_large_and_small_heads_agree(spark, monkeypatch):
    df = shuffled(spark, 2000)
    want = sorted(r["id"] for r in order.head(df, 700, ["id"]).collect())
    groups = sorted(tuple(r) for r in order.head_per_group(df, 150, ["g"], ["id"]).collect())
    monkeypatch.setattr(order, "SMALL_LIMIT", 10)
    monkeypatch.setattr(order, "WINDOW_TRIM_LIMIT", 10)
    assert sorted(r["id"] for r in order.head(df, 700, ["id"]).collect()) == want == [7 * i for i in range(700)]
    assert sorted(tuple(r) for r in order.head_per_group(df, 150, ["g"], ["id"]).collect()) == groups
    assert order.head_per_group(df, 0, ["g"], ["id"]).count() == 2000
    assert order.head(df, 10**7, ["id"]).count() == 2000


def test_large_head_with_nulls_ties_and_wide_rows(spark, monkeypatch):
    monkeypatch.setattr(order, "SMALL_LIMIT", 0)
    written = []
    monkeypatch.setattr(order, "materialize", lambda df, label: written.append(df.columns) or materialize(df, label))
    rows = [(None, 2), (None, 1), ("a", None), ("a", 5), ("a", 5), ("a", 5), ("b", 0)]
    df = spark.createDataFrame([(x, y, "text" * 9) for x, y in rows], "x string, y int, text string").repartition(3)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0))
    for n in range(1, 10):
        got = [(r["x"], r["y"]) for r in order.head(df, n, ["x", "y"]).collect()]
        assert sorted(got, key=str) == sorted(ordered[:n], key=str)
    assert order.head(df.limit(0), 5, ["x", "y"]).count() == 0
    assert all("text" not in columns for columns in written)


def test_large_head_by_a_struct(spark, monkeypatch):
    monkeypatch.setattr(order, "SMALL_LIMIT", 0)
    df = shuffled(spark, 300).select(F.struct((F.col("id") % 5).alias("a"), "id").alias("place"), "id")
    want = sorted((i % 5, i) for i in range(0, 2100, 7))[:70]
    assert sorted((r["place"]["a"], r["id"]) for r in order.head(df, 70, ["place"]).collect()) == want


def test_trimming_holds_up_to_the_limit(spark):
    def plan(n):
        return order.head_per_group(shuffled(spark, 10), n, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()

    assert "WindowGroupLimit" in plan(order.WINDOW_TRIM_LIMIT)
    assert "row_number" not in plan(order.WINDOW_TRIM_LIMIT + 1)


def test_sample_is_stable(spark):
    df = shuffled(spark, 500)
    picks = [sorted(r["id"] for r in order.sample_rows(d, 20, "id", 42).collect()) for d in (df, df.repartition(3))]
    assert picks[0] == picks[1] and len(set(picks[0])) == 20
    assert picks[0] != sorted(r["id"] for r in order.sample_rows(df, 20, "id", 43).collect())


def test_preview(spark):
    rows = order.preview(shuffled(spark, 50), ["id"], 2).collect()
    assert [r["json"] for r in rows] == ['{"id":0,"g":"g0"}', '{"id":7,"g":"g0"}']


def test_label_prefix(spark):
    for label, target, want in (("POSITIVE", "positive", True), ("positive", "pos", True),
                                ("NEGATIVE", "positive", False), (None, "positive", True), ("", "positive", False)):
        df = spark.createDataFrame([(label,)], "label string")
        assert (filters.label_filter(df, target, label="label").count() == 1) == want


def test_label_filter_sees_the_whole_text_or_a_given_part(spark):
    def load():
        return lambda texts: texts.map(lambda t: "positive" if "!" in t else "negative")

    df = spark.createDataFrame([(1, "!" + "a" * 600), (2, "a" * 600 + "!")], "id int, text string")
    assert [r["id"] for r in filters.label_filter(df, "positive", load=load, max_chars=512).collect()] == [1]
    assert filters.label_filter(df, "positive", load=load).count() == 2


def test_failed_scoring_keeps_the_row(spark):
    def load():
        def classify(texts):
            if texts.str.contains("bad").any():
                raise ValueError("cannot score")
            return texts.map(lambda t: "positive" if "!" in t else "negative")

        return classify

    df = spark.createDataFrame([(1, "!"), (2, "bad"), (3, "no")], "id int, text string").coalesce(1)
    assert [r["id"] for r in filters.label_filter(df, "positive", load=load).collect()] == [1, 2]


def test_classifier_gets_texts_in_portions_of_bytes(spark, monkeypatch):
    """Whatever Spark's batches hold, what the classifier is given at a time stays small; nulls and long texts included."""
    monkeypatch.setattr(filters, "SCORED_BYTES", 1000)

    def load():
        return lambda texts: texts.map(lambda t: None if t is None else f"positive {len(texts)}" if len(t) < 500 else f"positive {len(texts)} long")

    rows = [(i, None if i % 50 == 7 else "é" * (700 if i % 20 == 3 else 45)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    got = {r["id"]: r["label"] for r in df.select("id", filters.scorer_udf(load)("text").alias("label")).collect()}
    assert len(got) == 200 and all((got[i] is None) == (t is None) for i, t in rows)
    assert max(int(v.split()[1]) for v in got.values() if v) <= 13
    assert all(v == "positive 1 long" for v in (got[i] for i, t in rows if t and len(t) == 700))
    assert filters.label_filter(df, "positive", load=load).count() == 200


def test_label_filter_with_fitted_pipeline(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer

    stage = SQLTransformer(statement="select *, case when text like 'good%' then 'Positive' else 'Negative' end as label from __THIS__")
    df = spark.createDataFrame([(1, "good " + "x" * 600), (2, "bad")], "id int, text string")
    got = filters.label_filter(df, "positive", model=Pipeline(stages=[stage]).fit(df)).collect()
    assert [(r["id"], len(r["text"])) for r in got] == [(1, 605)] and got[0].asDict().keys() == {"id", "text"}


def test_missing_and_blank(spark):
    df = spark.createDataFrame([("a", "b"), (" ", "b"), ("", "b"), (None, "b"), ("　", "b")], "p string, c string")
    assert filters.drop_missing(df, ["p", "c"]).count() == 3
    assert filters.require_nonblank(df, ["p", "c"]).count() == 1


@pytest.mark.parametrize("n", [998, 999, 1000, 1001])
def test_head_per_group_gives_n_rows_of_tied_order(spark, n):
    rows = [("tied", 1, i) for i in range(1500)] + [("mixed", i // 300, i) for i in range(2000)] + [("short", 1, i) for i in range(40)] + [(None, 2, i) for i in range(1200)]
    df = spark.createDataFrame(rows, "g string, o int, v int").repartition(4)
    got = order.head_per_group(df, n, ["g"], ["o"]).collect()
    per = {}
    for r in got:
        per.setdefault(r["g"], []).append((r["o"], r["v"]))
    assert {g: len(v) for g, v in per.items()} == {"tied": n, "mixed": n, "short": 40, None: n}
    assert all(len(set(v)) == len(v) for v in per.values())
    assert sorted(o for o, _ in per["mixed"]) == [i // 300 for i in range(n)]
