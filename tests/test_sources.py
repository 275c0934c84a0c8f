import json

import pytest
from pyspark.sql import functions as F

from quern.functions import text
from quern.plans.text_cleaning import CleanParams, clean_corpus
from quern.sources import readers, writers


def test_jsonl_lines_of_every_kind(spark, tmp_path):
    lines = ['{"text":"a"}', "", "[1]", "bad", '{"text":null}', '{"text":5}', '{"text":"a"} x', '{"text":"a"}{"text":"b"}',
             '{"text":"x","text":"last"}', '  {"text":"spaced","v":NaN}  ', '{"dialog":["q",{"content":"r"}]}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    rows = readers.read_jsonl(spark, str(tmp_path / "*.jsonl"), "text string, dialog variant").orderBy("_order").collect()
    assert [r["text"] for r in rows if not r["_malformed"]] == ["a", None, "5", "last", "spaced", None]
    assert [i for i, r in enumerate(rows) if r["_malformed"]] == [1, 2, 3, 6, 7]
    assert readers.read_jsonl(spark, str(tmp_path), "text string", skip_malformed=True).count() == 6


def test_order_follows_file_names_not_sizes(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n2\n")
    (tmp_path / "b.txt").write_text("\n".join(str(i) for i in range(3, 3000)))
    rows = readers.read_lines(spark, str(tmp_path / "*.txt")).orderBy("_order").collect()
    assert [int(r["line"]) for r in rows] == list(range(1, 3000))


def test_line_numbers_do_not_depend_on_the_scan(spark, tmp_path):
    """Blocks of 100 bytes and whole files number alike; blank, long and last lines without a break count."""
    lines = {"a": [f"a{i}" * (i % 40) for i in range(300)], "b": ["", "", "x" * 1000, "end"], "c": ["only"]}
    for name, content in lines.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(content))
    (tmp_path / "empty.txt").write_text("")
    seen = []
    for size in ("100", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "50")
        try:
            rows = readers.read_lines(spark, str(tmp_path / "*.txt"), numbered=True)
            seen.append(sorted((r["_order"]["path"].rsplit("/", 1)[1][0], r["_order"]["line"], r["line"]) for r in rows.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] == [(f, i, x) for f in "abc" for i, x in enumerate(lines[f])]


def test_numbered_records_keep_the_numbers_of_their_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('bad\n{"n":1}\n\n{"n":2}\n')
    rows = readers.read_jsonl(spark, str(tmp_path), "n int", skip_malformed=True, numbered=True).orderBy("_order").collect()
    assert [(r["_order"]["line"], r["n"]) for r in rows] == [(1, 1), (3, 2)]


MIXED = [' ["a",{"role":"u","content":"b"},null,{"content":5},{"role":"x"},7,true,[1,"z"],{"content":null},{"content":{"k":1}}," "]',
         '{"content":"no list"}', "null", "[]", '"text"', '["only"]']


@pytest.mark.parametrize("stored", [False, True])
def test_variant_dialogs(spark, tmp_path, stored):
    """Mixed items of a VARIANT column, as parsed and as stored in parquet."""
    df = spark.createDataFrame([*enumerate(MIXED), (6, None)], "id int, j string").select("id", F.try_parse_json("j").alias("dialog"))
    if stored:
        writers.write_parquet(df, str(tmp_path / "v"))
        df = spark.read.parquet(str(tmp_path / "v"))
    kind = df.schema["dialog"].dataType
    rows = df.select("id", text.dialog_size("dialog", kind).alias("n"), text.dialog_to_text("dialog", kind).alias("t")).orderBy("id").collect()
    assert [r["n"] for r in rows] == [11, None, None, 0, None, 1, None]
    assert [r["t"] for r in rows] == ['a\nb\n5\n7\ntrue\n[1,"z"]\n{"k":1}', None, None, "", None, "only", None]
    turns = text.explode_dialog(df, "dialog", ["id"]).orderBy("id", "turn").collect()
    assert [(r["turn"], r["role"], r["text"]) for r in turns if r["id"] == 0] == [
        (0, None, "a"), (1, "u", "b"), (2, None, None), (3, None, "5"), (4, "x", None), (5, None, "7"), (6, None, "true"),
        (7, None, '[1,"z"]'), (8, None, None), (9, None, '{"k":1}'), (10, None, " ")]
    assert [r["id"] for r in turns if r["id"]] == [5]


def test_invalid_utf8_is_dropped(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"ok\xff\xfe!\nfine \xe4\xbd\xa0\n")
    assert [r["line"] for r in readers.read_lines(spark, str(tmp_path)).orderBy("_order").collect()] == ["ok!", "fine 你"]


def test_files_are_deduplicated_on_their_own(spark, tmp_path):
    for name, texts in (("a", ["same text", "same text", "only a"]), ("b", ["same text", "only b"])):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"text": t}) + "\n" for t in texts))
    rows = readers.read_jsonl(spark, str(tmp_path), "text string")
    def texts(scope):
        kept = clean_corpus(rows, "_order", CleanParams(dedup=True, near_dedup=True, scope=scope)).kept
        return [r["text"] for r in kept.orderBy("_order").collect()]
    assert texts(["_file"]) == ["same text", "only a", "same text", "only b"]
    assert texts([]) == ["same text", "only a", "only b"]


def test_splits(spark, tmp_path):
    for split, cols in (("train", "a int, b string"), ("validation", "a int"), ("test", "a int")):
        data = [(1, "x")] if "b" in cols else [(2,)]
        spark.createDataFrame(data, cols).write.parquet(str(tmp_path / "pretrain" / split))
    rows = readers.read_splits(spark, str(tmp_path), "pretrain").orderBy("split").collect()
    assert [(r["split"], r["a"], r["b"]) for r in rows] == [("test", 2, None), ("train", 1, "x"), ("validation", 2, None)]
    totals = writers.split_totals(readers.read_splits(spark, str(tmp_path), "pretrain"))
    assert {r["split"]: r["rows"] for r in totals.collect()} == {"train": 1, "validation": 1, "test": 1, None: 3}


def test_read_dataset_by_suffix(spark, tmp_path):
    (tmp_path / "c.txt").write_text("a\nb\n")
    (tmp_path / "c.jsonl").write_text('{"text":"x","n":1}\n')
    assert [r["text"] for r in readers.read_dataset(spark, str(tmp_path / "c.txt")).orderBy("_order").collect()] == ["a", "b"]
    assert readers.read_dataset(spark, str(tmp_path / "c.jsonl")).first()["n"] == 1
    with pytest.raises(Exception):
        readers.read_dataset(spark, str(tmp_path / "missing.jsonl")).collect()


def test_jsonl_output_is_plain_utf8(spark, tmp_path):
    df = spark.createDataFrame([(2, "你好", None), (1, "é\n", "x")], "id int, text string, opt string")
    writers.write_jsonl(df, str(tmp_path / "out"), ["id"])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).splitlines()
    assert lines == ['{"id":1,"text":"é\\n","opt":"x"}', '{"id":2,"text":"你好","opt":null}']


def test_tokens_and_corpus(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a"b', 9), (2, "▁x", 5), (3, "#", 4)], "o int, token string, freq bigint")
    writers.write_tokens(df, str(tmp_path / "tok"), ["o"])
    assert [r["token"] for r in readers.read_tokens(spark, str(tmp_path / "tok")).orderBy("_order").collect()] == ['a"b', "▁x", "#"]
    (tmp_path / "hand.tsv").write_text("one\t5\n\ntwo\n")
    assert [r["token"] for r in readers.read_tokens(spark, str(tmp_path / "hand.tsv")).orderBy("_order").collect()] == ["one", "two"]
    writers.write_corpus(df.withColumnRenamed("token", "line"), str(tmp_path / "txt"), order=["o"])
    assert [r["line"] for r in readers.read_lines(spark, str(tmp_path / "txt")).orderBy("_order").collect()] == ['a"b', "▁x", "#"]


def test_routing(spark, tmp_path):
    df = spark.createDataFrame([("/x/fetch_data/reward/d__train.jsonl", "t")], "_file string, text string")
    assert df.select(readers.route_subdir("_file")).first()[0] == "reward"
    writers.route_output(df, str(tmp_path / "o"))
    assert [p.parent.parent.name + "/" + p.parent.name for p in (tmp_path / "o").rglob("part-*")] == ["subdir=reward/name=d__train_clean.jsonl"]
    assert writers.dataset_file_name("owner/set", "train") == "owner_set__train"
    with pytest.raises(Exception, match="no folder after"):
        df.select(readers.route_subdir(F.lit("/elsewhere/d.jsonl"))).collect()
