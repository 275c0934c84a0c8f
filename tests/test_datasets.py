"""Datasets written with statistics, words by script, and the trained label filter."""

import pytest
from pyspark.sql import functions as F

from quern.operators import vocab
from quern.operators.filters import label_filter
from quern.plans.classifier import fit_labels
from quern.sources import readers, writers

SF = "/root/testdata/sf0.01"


def test_dataset_of_a_skewed_source(spark, tmp_path):
    """A folder with nearly all rows is written by several tasks, small ones by one each; counts are those of a recount."""
    base, size = str(tmp_path / "out"), 64 * 1024
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 50 == 0, F.concat(F.lit("s"), F.col("id") % 3)).otherwise("big").alias("source"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(16)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(size))
    try:
        stats = writers.write_dataset(df, base, "a/b", ["source"], rows=F.count("*"), chars=F.sum(F.length("text")))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert stats == {"rows": 20_000, "chars": 20_000 * 64} == readers.read_stats(spark, base, "a/b")
    for kind, load in (("jsonl", spark.read.schema(df.schema).json), ("parquet", spark.read.schema(df.schema).parquet)):
        got = load(f"{base}/a/b/{kind}")
        assert sorted(map(tuple, got.select("id", "source", "text").collect())) == sorted(map(tuple, df.collect()))
        files = got.groupBy("source", F.input_file_name()).agg(F.count("*").alias("n")).collect()
        assert sum(r["source"] == "big" for r in files) > 3
        assert all(sum(r["source"] == s for r in files) <= 2 for s in ("s0", "s1", "s2"))
        assert max(r["n"] for r in files) < 20_000 / 3


def test_dataset_without_statistics_or_with_one_format(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, text string")
    assert writers.write_dataset(df, str(tmp_path / "x"), "d", formats=["jsonl"]) == {}
    assert spark.read.json(str(tmp_path / "x/d/jsonl")).count() == 2 and not (tmp_path / "x/d/parquet").exists()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        readers.read_stats(spark, str(tmp_path / "x"), "none")
    with pytest.raises(ValueError):
        writers.write_dataset(df, str(tmp_path / "y"), "d", formats=["csv"])


@pytest.mark.parametrize("text, words", [
    ("hello world", ["▁hello", "▁world"]), ("我在北京，你呢？", ["▁我在北京", "，", "你呢", "？"]), ("ภาษาไทย ดี", ["▁ภาษาไทย", "▁ดี"]),
    ("iPhone手机2024年 ok", ["▁iPhone", "手机", "2", "0", "2", "4", "年", "▁ok"]), ("Привет,мир!", ["▁Привет", ",", "мир", "!"]),
    ("東京タワーへ", ["▁東京タワ", "ー", "へ"]), ("café x", ["▁café", "▁x"]), ("", []), ("  　 ", []), ("a\n b", ["▁a", "▁b"]), (None, None),
])
def test_words_by_script(one, text, words):
    assert one(vocab.split_by_script("t"), text) == words


def test_classifier_on_held_out_rows(spark):
    """Trained on three of four labelled rows, all of them; the other fourth is judged."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("quality is not null")
    rows = rows.select("doc_id", "text", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label"))
    model = fit_labels(rows.where("doc_id % 4 <> 0"), "text", "label")
    held = rows.where("doc_id % 4 = 0")
    judged = model.transform(held.withColumnRenamed("label", "truth"))
    right, total = judged.select(F.count_if(F.col("label") == F.col("truth")), F.count("*")).first()
    assert right >= 0.9 * total and total > 50
    kept = label_filter(held.drop("label"), "good", model=model)
    assert kept.columns == ["doc_id", "text"] and kept.count() == judged.where("label = 'good'").count()
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert model.transform(odd).count() == 2
    with pytest.raises(ValueError):
        fit_labels(rows.where("label = 'good'"), "text", "label")
