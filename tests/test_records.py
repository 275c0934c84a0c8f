import json
import random

import pytest
from pyspark.sql import functions as F

from quern.functions import chat, tokens
from quern.functions.tokens import CharTokenizer, WhitespaceTokenizer
from quern.operators import order
from quern.operators import blocks
from quern.operators.blocks import pack_blocks
from quern.plans import preferences, training_sets
from quern.session import materialize
from quern.sources.readers import read_template

MESSAGES = "messages array<struct<role string, content string>>"
TALK = [("system", "S"), ("user", "U"), ("assistant", "A"), ("tool", "T")]


@pytest.mark.parametrize("name, want", [
    ("chatml", "<|im_start|>system\nS<|im_end|><|im_start|>user\nU<|im_end|><|im_start|>assistant\nA<|im_end|>T"),
    ("baichuan2", "<reserved_106>S<reserved_106>U<reserved_107>AT"),
    ("chatglm3", "[gMASK]sop<|system|>\nS<|user|>\nU<|assistant|>\nAT"),
    ("deepseek", "<｜begin▁of▁sentence｜>S\n\nUser: U\n\nAssistant: A<｜end▁of▁sentence｜>T"),
    ("llama3", "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|><|start_header_id|>user"
               "<|end_header_id|>\n\nU<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nA<|eot_id|>T"),
])
def test_templates(spark, name, want):
    row = spark.createDataFrame([(TALK,)], MESSAGES)
    assert row.select(chat.render_template("messages", chat.TEMPLATES[name])).first()[0] == want


@pytest.mark.parametrize("name", list(chat.TEMPLATES))
def test_template_file_equals_the_one_in_code(spark, tmp_path, name):
    known = chat.TEMPLATES[name]
    path = tmp_path / f"{name}.json"
    made = {"messages": [{"role": r, "template": t} for r, t in known.roles.items()], "separator": known.separator, "stop_tokens": []}
    path.write_text(json.dumps(made))
    found = read_template(spark, str(path))
    assert dict(found.roles) == dict(known.roles) and found.separator == known.separator
    assert not known.generation or found.generation == known.generation


def test_template_file_with_little_in_it():
    assert chat.parse_template("{}") == chat.ChatTemplate({}, "", "")
    bare = chat.parse_template('{"messages": [{"role": "assistant", "template": "fixed"}], "separator": "\\n"}')
    assert (bare.separator, bare.generation) == ("\n", "")


def test_named_only_leaves_bare_content(spark):
    row = spark.createDataFrame([(TALK,)], MESSAGES)
    got = row.select(chat.render_template("messages", chat.TEMPLATES["llama3"], named_only=True)).first()[0]
    assert got.endswith("S<|eot_id|>UAT")


def test_plain_text_and_roles(spark):
    row = spark.createDataFrame([([("human", "h"), ("gpt", None), ("other", "o"), (None, "n")],)],
                                "c array<struct<`from` string, value string>>")
    assert row.select(chat.sharegpt_to_text("c")).first()[0] == "User: h\nAssistant:\nother: o\n: n"
    got = row.select(chat.sharegpt_to_messages("c").alias("m")).first()["m"]
    assert [(m["role"], m["content"]) for m in got] == [("user", "h"), ("assistant", ""), ("other", "o"), ("", "n")]


@pytest.mark.parametrize("record, prompt, answer", [
    ({"instruction": "I", "input": "N", "output": "O"}, "I\nN", "O"),
    ({"instruction": "I", "input": "", "response": "R"}, "I", "R"),
    ({"input": "N", "output": "O"}, "N", "O"),
    ({"instruction": "", "input": "N", "output": None, "response": "R"}, "N", "R"),
])
def test_instruction_shapes(spark, record, prompt, answer):
    row = spark.createDataFrame([record], ", ".join(f"{k} string" for k in record))
    m = row.select(chat.instruction_to_messages(row).alias("m")).first()["m"]
    assert [(x["role"], x["content"]) for x in m] == [("user", prompt), ("assistant", answer)]
    texts = training_sets.sft_texts(row, chat.TEMPLATES["chatml"], []).first()
    assert texts["full_text"] == texts["prompt_text"] + answer + "<|im_end|>"


def test_extract_text_falls_through(spark):
    rows = spark.createDataFrame(
        [(1, " a ", ["x"], None), (2, "　", ["x", None, "y"], None), (3, None, [], [("user", "q"), ("assistant", "r")]), (4, "", None, None)],
        f"id int, text string, parts array<string>, {MESSAGES}")
    got = [r["t"] for r in rows.select("id", training_sets.extract_text(rows, ["text", "parts"]).alias("t")).orderBy("id").collect()]
    assert got == ["a", "x y", "user: q\nassistant: r", ""]
    assert training_sets.pretraining_texts(rows, ["id"], ["text", "parts"]).count() == 3


def test_sft_record_lengths_and_labels(spark):
    rows = spark.createDataFrame([(1, "abcdef", "abc"), (2, "abcdefghijkl", "abcdefghijk"), (3, "ab", "")],
                                 "id int, full_text string, prompt_text string")
    got = {r["id"]: r for r in training_sets.sft_records(rows, CharTokenizer(), 8, ["id"]).collect()}
    assert got[1]["input_ids"] == [97, 98, 99, 100, 101, 102, 0, 0]
    assert got[1]["attention_mask"] == [1] * 6 + [0] * 2
    assert got[1]["labels"] == [-100] * 3 + [100, 101, 102] + [-100] * 2
    assert got[2]["labels"] == [-100] * 8 and got[2]["attention_mask"] == [1] * 8
    assert got[3]["labels"] == [97, 98] + [-100] * 6
    assert training_sets.training_columns(training_sets.sft_records(rows, CharTokenizer(), 8, ["id"])).columns == \
        ["input_ids", "attention_mask", "labels"]


def test_max_turns_before_gathering(spark):
    turns = spark.createDataFrame([(1, t, "user", "x") for t in range(5)] + [(2, t, "user", "y") for t in (1, 0)],
                                  "conv int, turn int, role string, content string")
    got = training_sets.collect_messages(turns, "conv", "turn", "role", "content", max_turns=3).collect()
    assert [(r["conv"], len(r["messages"])) for r in got] == [(2, 2)]


@pytest.mark.parametrize("block, batch, sep", [(7, 10, None), (16, 3, None), (5, 1000, 99), (1, 4, None)])
def test_pack_blocks_equals_a_loop(spark, block, batch, sep):
    rng = random.Random(block)
    rows = [(i * 3, [rng.randint(1, 50) for _ in range(rng.choice([0, 1, 4, 30]))]) for i in range(60)]
    shuffled = rng.sample(rows, len(rows))
    got = pack_blocks(spark.createDataFrame(shuffled, "o bigint, ids array<int>"), "ids", block, ["o"], batch, sep)
    want = []
    for start in range(0, len(rows), batch):
        line = [x for _, ids in rows[start:start + batch] for x in (ids + [sep] if sep else ids)]
        want += [(start // batch, at // block, line[at:at + block]) for at in range(0, len(line) - block + 1, block)]
    found = sorted((r["batch"], r["block"], r["input_ids"]) for r in got.collect())
    assert found == want
    assert all(r["labels"] == r["input_ids"] and r["attention_mask"] == [1] * block for r in got.collect())


def test_pack_blocks_takes_rows_in_pieces(spark, monkeypatch):
    """Long rows go to the worker in pieces and blocks come back a few at a time; rows tied in order stay whole."""
    monkeypatch.setattr(blocks, "PIECE_IDS", 5)
    monkeypatch.setattr(blocks, "MADE_IDS", 24)
    rng = random.Random(8)
    rows = [(i, [rng.randint(1, 50) for _ in range(rng.choice([0, 1, 5, 10, 93]))]) for i in range(40)]
    got = pack_blocks(spark.createDataFrame(rows, "o bigint, ids array<int>"), "ids", 8, ["o"], 7)
    want = []
    for start in range(0, len(rows), 7):
        line = [x for _, ids in rows[start:start + 7] for x in ids]
        want += [(start // 7, at // 8, line[at:at + 8]) for at in range(0, len(line) - 7, 8)]
    assert sorted((r["batch"], r["block"], r["input_ids"]) for r in got.collect()) == want
    tied = spark.createDataFrame([(0, [1] * 12), (0, [2] * 12)], "o bigint, ids array<int>")
    line = [x for r in sorted(pack_blocks(tied, "ids", 6, ["o"], 7).collect(), key=lambda r: r["block"]) for x in r["input_ids"]]
    assert line in ([1] * 12 + [2] * 12, [2] * 12 + [1] * 12)
    assert "Generate" in got._jdf.queryExecution().executedPlan().toString()


def test_pack_blocks_numbers_rows_by_order_alone(spark, monkeypatch):
    """Null ids and a null order value keep their place in the batch count; no ids are written."""
    written = []
    monkeypatch.setattr(order, "materialize", lambda df, label: written.append(df.columns) or materialize(df, label))
    rows = spark.createDataFrame([(None, 1, [1, 2]), ("a", 1, None), ("a", 2, [3]), ("b", 0, []), ("c", 0, [4, 5])],
                                 "x string, y int, ids array<int>")
    got = pack_blocks(rows, "ids", 2, ["x", "y"], batch_rows=3)
    assert sorted((r["batch"], r["block"], r["input_ids"]) for r in got.collect()) == [(0, 0, [1, 2]), (1, 0, [4, 5])]
    assert written == [["x", "y", "_slice", "_place"]]


def test_mlm_mask_rates_and_repeatability(spark):
    rows = spark.range(300).select("id", F.transform(F.sequence(F.lit(10), F.lit(209)), lambda x: x.cast("int")).alias("ids"))
    def run(df):
        m = tokens.mlm_mask("ids", "id", vocab_size=5000, mask_id=3, special_ids=(10, 11))
        return {r["id"]: (r["m"]["input_ids"], r["m"]["labels"]) for r in df.select("id", m.alias("m")).collect()}
    first = run(rows)
    assert first == run(rows.repartition(5))
    original = list(range(10, 210))
    chosen = [(o, x) for ids, labels in first.values() for o, x, y in zip(original, ids, labels) if y != -100]
    kept = [(o, x) for ids, labels in first.values() for o, x, y in zip(original, ids, labels) if y == -100]
    assert all(o == x for o, x in kept) and not any(o in (10, 11) for o, _ in chosen)
    assert abs(len(chosen) / (300 * 198) - 0.15) < 0.01
    assert abs(sum(x == 3 for _, x in chosen) / len(chosen) - 0.8) < 0.02
    assert abs(sum(x == o for o, x in chosen) / len(chosen) - 0.1) < 0.02


def test_char_tokenizer_round_trip(one):
    chars = CharTokenizer()
    assert one(chars.ids("t"), "é😀你") == [233, 128512, 20320]
    assert one(chars.decode(chars.ids("t")), "é😀你 a") == "é😀你 a"
    assert one(chars.ids("t"), "") == []
    assert one(training_sets.truncate_text("t", chars, 2), "é😀你") == "é😀"
    assert one(WhitespaceTokenizer().tokens("t"), "  a  b ") == ["a", "b"]


def test_answer_spans(spark):
    template = chat.ChatTemplate({"user": "U:{content}", "assistant": "A:{content}"}, "|", "A:")
    turns = [[("user", "hi"), ("assistant", "yo"), ("assistant", None), ("tool", "x"), ("assistant", "é")], [], [("assistant", "abcdefghij")]]
    rows = [(i, [{"role": r, "content": c} for r, c in t]) for i, t in enumerate(turns)]
    df = spark.createDataFrame(rows, "id int, messages array<struct<role: string, content: string>>")
    made = training_sets.sft_span_records(df, template, CharTokenizer(), 12, ["id"], pad_id=7, before=[1], after=[2])
    got = {r["id"]: r for r in made.collect()}
    whole = {r["id"]: r["t"] for r in df.select("id", chat.render_template("messages", template).alias("t")).collect()}
    for i, row in got.items():
        text = [1, *map(ord, whole[i][:10]), 2]
        assert row["input_ids"] == text + [7] * (12 - len(text)) and sum(row["attention_mask"]) == len(text)
    learned = {i: "".join(chr(x) for x in r["labels"] if x > 2) for i, r in got.items()}
    assert whole[0] == "U:hi|A:yo|A:|x|A:é" and learned == {0: "yo", 1: "", 2: "abcdefgh"}
    assert [r["labels"].count(2) for r in got.values()] == [1, 1, 1]


def test_preference_counts(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, "q", base, "r"), (2, "q", " " + base, "r "), (3, "q", base + " x", "r"), (4, "q", None, "r"),
            (5, "　", "c", "r"), (6, "", "c", "r"), (7, "q", "z" * 5000, "r"), (8, "q", "other", "r")]
    df = spark.createDataFrame(rows, "id bigint, prompt string, chosen string, rejected string")
    result = preferences.clean_preferences(df, "id", preferences.PreferenceParams(max_chars=4000, dedup=True, near_dedup=True))
    stats = result.stats().first().asDict()
    want = {"total": 8, "kept": 2, "dropped_len": 2, "dropped_missing": 2, "dropped_dup": 1, "dropped_near_dup": 1}
    assert {k: stats[k] for k in want} == want
    assert sorted(r["id"] for r in result.kept.collect()) == [1, 8]


def test_preference_aliases(spark):
    df = spark.createDataFrame([("", "Q", "A", None), ("P", None, "", " ")], "prompt string, question string, answer string, negative string")
    rows = preferences.preference_columns(df).collect()
    assert [tuple(r) for r in rows] == [("Q", "A", ""), ("P", "", " ")]
    assert preferences.dpo_dataset(df).count() == 0
