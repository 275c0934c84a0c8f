import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.functions.tokens import WhitespaceTokenizer
from quern.operators import bpe, vocab
from quern.plans.line_corpus import CorpusParams, clean_lines
from quern.plans.text_cleaning import CleanParams, clean_corpus


def merges_one_by_one(words, count):
    table = {w: (list(w), f) for w, f in words}
    out = []
    for _ in range(count):
        pairs = Counter()
        for symbols, freq in table.values():
            for pair in zip(symbols, symbols[1:]):
                pairs[pair] += freq
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        out.append((*best, pairs[best]))
        for symbols, _ in table.values():
            i = 0
            while i < len(symbols) - 1:
                if (symbols[i], symbols[i + 1]) == best:
                    symbols[i:i + 2] = ["".join(best)]
                i += 1
    return out


@pytest.mark.parametrize("seed, alphabet, per_round, max_chains", [
    (1, "abc", 8, 10**6), (2, "abcdefgh", 1000, 10**6), (3, "aab", 20, 40), (4, "etaoin😀", 40, 10**6), (5, "ab", 1000, 1)])
def test_bpe_equals_one_by_one_merging(spark, seed, alphabet, per_round, max_chains):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))): rng.randint(1, 40) for _ in range(150)}
    rows = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    count = 12 if max_chains == 1 else 60
    made = bpe.train_bpe(vocab.word_symbols(rows), count, per_round=per_round, max_chains=max_chains)
    got = made.merges.orderBy("rank").collect()
    want = merges_one_by_one(words.items(), count)
    assert [(r["left"], r["right"], r["freq"]) for r in got] == want
    ranks = {(a, b): k for k, (a, b, _) in enumerate(want)}
    pieces = {r["word"]: r["pieces"] for r in made.pieces.collect()}
    assert pieces == {w: bpe.apply_merges(list(w), ranks) for w in words}


def test_bpe_of_a_vocabulary_size(spark):
    rows = spark.createDataFrame([("abab", 5), ("abc", 3), ("c", 9), ("", 4)], "word string, freq bigint")
    made = vocab.learn_bpe(vocab.word_symbols(rows).where("word <> ''"), vocab_size=7, reserved=2)
    assert [r["token"] for r in made.orderBy("rank").collect()] == ["ab", "abab"]
    with pytest.raises(ValueError):
        vocab.learn_bpe(rows)


def test_a_symbol_made_twice_ends_the_round(spark):
    """``abc`` comes from a + bc and from ab + c; its counts need all words."""
    words = {"abcx": 50, "bcq": 60, "zab": 58, "abcy": 40, "bc": 30, "ab": 30, "abc": 20, "xabc": 30}
    rows = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    got = vocab.learn_bpe(vocab.word_symbols(rows), 8).orderBy("rank").collect()
    assert [(r["left"], r["right"], r["freq"]) for r in got] == merges_one_by_one(words.items(), 8)


@pytest.mark.parametrize("broadcast_rows", [1000, 1])
def test_piece_table(spark, broadcast_rows):
    pieces = spark.createDataFrame([("the", ["th", "e"]), ("cat", ["cat"]), ("2", ["2"]), ("sat", ["s", "a", "t"])], "word string, pieces array<string>")
    table = vocab.PieceTable(pieces, broadcast_rows=broadcast_rows)
    lines = ["the cat", "cat", "", None, "the cat sat", "dog", "cat 22", "cat cat cat cat", "cat cat cat"]
    df = spark.createDataFrame(list(enumerate(lines)), "o bigint, line string")
    got = {r["o"]: r["tokens"] for r in table.encode(df, "line", ["o"]).collect()}
    assert got == {0: ["th", "e", "cat"], 1: ["cat"], 2: [], 3: [], 4: ["th", "e", "cat", "s", "a", "t"], 5: ["<unk>"],
                   6: ["cat", "2", "2"], 7: ["cat"] * 4, 8: ["cat"] * 3}
    assert {r["o"] for r in table.broken_up(df, "line", ["o"], 3).collect()} == {4, 5, 7}
    words = vocab.fragmented_token_freq(df, "line", ["o"], table, WhitespaceTokenizer(), 3)
    assert {r["token"]: r["freq"] for r in words.collect()} == {"the": 1, "cat": 5, "sat": 1, "dog": 1}
    both = vocab.fragmented_token_freq(df, "line", ["o"], table, table, 3)
    assert {r["token"]: (r["freq"], tuple(r["first_seen"])) for r in both.collect()} == {
        "th": (1, (4, 0, 0)), "e": (1, (4, 0, 1)), "cat": (5, (4, 1, 0)), "s": (1, (4, 2, 0)), "a": (1, (4, 2, 1)), "t": (1, (4, 2, 2)),
        "<unk>": (1, (5, 0, 0))}


def test_bpe_stops_when_nothing_is_left(spark):
    rows = spark.createDataFrame([("ab", 2), ("c", 9)], "word string, freq bigint")
    assert [r["token"] for r in vocab.learn_bpe(vocab.word_symbols(rows), 10).collect()] == ["ab"]


def test_word_symbols_with_byte_fallback(spark):
    words = spark.createDataFrame([("aé", 3), ("b", 1)], "word string, freq bigint")
    known = spark.createDataFrame([("a",), ("b",)], "char string")
    got = {r["word"]: r["symbols"] for r in vocab.word_symbols(words, known).collect()}
    assert got == {"aé": ["a", "<0xC3>", "<0xA9>"], "b": ["b"]}


def test_char_vocab_is_the_smallest_cover(spark):
    df = spark.createDataFrame([("a" * 90 + "b" * 9 + "c" + " " * 50,)], "t string")
    assert [r["char"] for r in vocab.char_vocab(df, "t", 0.9).orderBy("rank").collect()] == ["a"]
    assert [r["char"] for r in vocab.char_vocab(df, "t", 0.95).orderBy("rank").collect()] == ["a", "b"]
    assert vocab.char_vocab(df, "t", 1.0).count() == 3
    assert vocab.byte_fallback(df, "t", vocab.char_vocab(df, "t", 0.95)).first()["tokens"] == ["<0x63>"]


def test_digits_split(spark):
    df = spark.createDataFrame([("in 2024 a1b",)], "t string")
    assert {r["word"]: r["freq"] for r in vocab.word_counts(df, "t").collect()} == {
        "in": 1, "2": 2, "0": 1, "4": 1, "a": 1, "1": 1, "b": 1}
    assert vocab.word_counts(df, "t", split_digits=False).count() == 3


def test_candidates_follow_the_line_rule(spark):
    lines = ["a b c d", "a b", "a zz", "", "  ", "b q q q q", "a"]
    df = spark.createDataFrame(list(enumerate(lines)), "o bigint, line string")
    known = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, id bigint")
    freq = vocab.fragmented_token_freq(df, "line", ["o"], WhitespaceTokenizer(), WhitespaceTokenizer(), 3, known)
    assert {r["token"]: r["freq"] for r in freq.collect()} == {"a": 2, "b": 2, "c": 1, "d": 1, "zz": 1, "q": 4}
    found = vocab.candidate_tokens(freq, known, 1).orderBy("freq", "first_seen", ascending=[False, True]).collect()
    assert [r["token"] for r in found] == ["q", "d", "zz"]
    grown = vocab.extend_vocab(known, freq.where("freq >= 1"), ["first_seen"]).orderBy("id").collect()
    assert [(r["token"], r["id"], r["added"]) for r in grown[3:]] == [("d", 3, True), ("zz", 4, True), ("q", 5, True)]


def test_line_cap_limits_the_counts(spark):
    lines = ["x", "first line here", "", "first line here", "second line here", "third line here", "y"]
    df = spark.createDataFrame(list(enumerate(lines)), "o bigint, line string").repartition(4)
    capped = clean_lines(df, ["o"], CorpusParams(max_lines=2))
    assert [r["line"] for r in capped.kept.orderBy("o").collect()] == ["first line here", "second line here"]
    assert capped.stats().first().asDict() == {
        "total_lines": 5, "empty_after_clean": 1, "too_short": 1, "too_long": 0, "duplicates": 1, "kept": 2}
    whole = clean_lines(df, ["o"], CorpusParams(max_lines=9)).stats().first().asDict()
    assert whole["total_lines"] == 7 and whole["kept"] == 3


def test_cleaning_accounts_for_every_row(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(0, "hello world", None, None), (1, None, None, None), (2, "<b></b>", None, None), (3, "abc", None, None),
            (4, "x" * 3000, None, None), (5, "hello  world", None, None), (6, long, None, "negative"),
            (7, long + " a", None, None), (8, None, ["only turn here"], None), (9, "text", ["a", "b"], None),
            (10, long, None, "positive"), (11, "fresh text", None, "Positive!")]
    df = spark.createDataFrame(rows, "id bigint, text string, dialog array<string>, label string")
    params = CleanParams(max_chars=2000, max_turns=1, dedup=True, near_dedup=True, target="positive", label="label")
    result = clean_corpus(df, "id", params)
    stats = result.stats().first().asDict()
    assert stats == {"total": 12, "malformed": 0, "too_many_turns": 1, "no_text": 1, "empty_after_clean": 1, "too_short": 1,
                     "too_long": 1, "dedup": 2, "near_dedup": 1, "sentiment_filtered": 1, "kept": 3}
    assert sorted(r["id"] for r in result.kept.collect()) == [0, 8, 11]
    reasons = {r["id"]: r["drop_reason"] for r in result.reasons().collect()}
    assert len(reasons) == 12 and reasons[10] == "dedup" and reasons[7] == "near_dedup" and reasons[6] == "sentiment_filtered"
    again = clean_corpus(result.kept, "id", CleanParams(max_chars=2000, dedup=True, near_dedup=True)).stats().first().asDict()
    assert again["kept"] == again["total"] == 3


def test_dialogs_are_kept_unless_asked_otherwise(spark):
    df = spark.createDataFrame([(1, ["a long turn"]), (2, ["p", "q", "r"])], "id bigint, dialog array<string>")
    assert {r["id"]: r["text"] for r in clean_corpus(df, "id", CleanParams()).kept.collect()} == {1: "a long turn", 2: "p q r"}
    unread = clean_corpus(df, "id", CleanParams(read_dialogs=False)).stats().first()
    assert unread["no_text"] == 2 and unread["kept"] == 0
    capped = clean_corpus(df, "id", CleanParams(max_turns=1, dedup=True))
    assert capped.stats().first()["too_many_turns"] == 1 and capped.kept.count() == 1
    assert {r["id"]: r["drop_reason"] for r in capped.reasons().collect()} == {1: None, 2: "too_many_turns"}


def test_writing_counts_what_it_writes(spark):
    rows = [(i, f"text number {i % 7}" if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, text string").repartition(6)
    result = clean_corpus(df, "id", CleanParams(dedup=True, near_dedup=True))
    stats = result.stats().first()
    assert result.counts["total"] == 100 and result.counts["no_text"] == 20 and result.counts["unique"] == 7
    assert (stats["total"], stats["no_text"], stats["dedup"], stats["kept"]) == (100, 20, 73, 7 - stats["near_dedup"])


def test_characters_of_counted_words_are_those_of_the_texts(spark):
    df = spark.createDataFrame([("ab a 12",), ("b　ü  ab a",), ("",), (None,), ("ab ab 7",)], "t string")
    words = vocab.word_counts(df, "t")
    got = {tuple(r) for r in vocab.char_vocab(words, "word", 0.9, "freq").collect()}
    assert got == {tuple(r) for r in vocab.char_vocab(df, "t", 0.9).collect()} and got


def test_words_by_script_are_split_once_for_equal_stretches(spark):
    df = spark.createDataFrame([(" ab的一 ab的一\t12 x",), ("▁ ▁ab กข",), ("  ",), ("",), (None,), ("ab的一 é́!",)] * 3, "t string")
    plain = df.select(F.explode(vocab.split_by_script("t")).alias("word")).groupBy("word").count()
    counted = vocab.word_counts_by_script(df, "t")
    assert {tuple(r) for r in counted.collect()} == {tuple(r) for r in plain.collect()}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "stretch" in plan and plan.count("Aggregate") == 2


def test_fragmented_lines_are_made_once(spark):
    rows = [(i, "known words here and more of them" if i % 2 else "odd") for i in range(20)]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    df = spark.createDataFrame(rows, "id bigint, line string").withColumn("line", counted("line"))
    known = spark.createDataFrame([("known",)], "token string")
    found = vocab.fragmented_token_freq(df, "line", ["id"], WhitespaceTokenizer(), WhitespaceTokenizer(), 3, known)
    assert {r["token"]: r["freq"] for r in found.collect()}["odd"] == 10
    assert seen.value <= 2 * 20  # the filter and the select of one scan


def test_piece_table_over_packs(spark, monkeypatch):
    """Texts meet the pieces of their pack's words; no text is taken apart into rows of words."""
    monkeypatch.setattr(vocab, "PACK_PARTS", 1)
    pieces = spark.createDataFrame([(f"w{i}", [f"w{i % 7}", "x" * (i % 3 + 1)]) for i in range(0, 400, 2)], "word string, pieces array<string>")
    table, learned = vocab.PieceTable(pieces, split_digits=False), {r["word"]: r["pieces"] for r in pieces.collect()}
    rng = random.Random(3)
    rows = [(i, k, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(9)))) for i in range(60) for k in range(3)]
    rows[5], long = (1, 2, None), " ".join(f"w{rng.randrange(400)}" for _ in range(600_000))  # of several packs
    rows += [(None, 0, "w2 w1"), (70, None, " w4\t w6 "), (71, 0, long), (72, 0, "w8 w8")]
    df = spark.createDataFrame(rows, "a bigint, b int, t string")
    found = table.encode(df.repartition(3), "t", ["a", "b"])
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert dict(found.dtypes) == {"a": "bigint", "b": "int", "tokens": "array<string>"}
    want = {(a, b): [p for w in (t or "").split() for p in learned.get(w, ["<unk>"])] for a, b, t in rows}
    got = found.collect()
    assert len(got) == len(rows) and {(r["a"], r["b"]): r["tokens"] for r in got} == want


def test_piece_table_of_blank_and_repeated_texts(spark):
    pieces = spark.createDataFrame([("a", ["p"]), ("b", ["q", "r"])], "word string, pieces array<string>")
    table = vocab.PieceTable(pieces)
    encoded = lambda rows: sorted((r["o"] or 0, r["tokens"]) for r in table.encode(spark.createDataFrame(rows, "o bigint, t string"), "t", ["o"]).collect())
    assert encoded([]) == []
    assert encoded([(1, " "), (2, None)]) == [(1, []), (2, [])]
    # Texts of one order are one text, word by word.
    assert encoded([(1, "a b"), (1, "b c"), (None, "a"), (None, "a"), (2, "b")]) == [
        (0, ["p", "p"]), (1, ["p", "q", "r", "<unk>", "q", "r"]), (2, ["q", "r"])]
