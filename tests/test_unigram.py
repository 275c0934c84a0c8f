"""Unigram training against summing over all segmentations."""

import math
import random

import pytest

from quern.operators import unigram, vocab


def segmentations(symbols, longest):
    if not symbols:
        yield []
    for n in range(1, min(longest, len(symbols)) + 1):
        if n > 1 and any(s.startswith("<0x") for s in symbols[:n]):
            return
        for rest in segmentations(symbols[n:], longest):
            yield ["".join(symbols[:n]), *rest]


def expectations(words, scores, longest):
    counts, likelihood = {}, 0
    for symbols, freq in words:
        known = [s for s in segmentations(symbols, longest) if all(p in scores for p in s)]
        weight = [math.exp(sum(scores[p] for p in s)) for s in known]
        likelihood += freq * round(math.log(sum(weight)) * unigram.UNIT)
        own = {}
        for s, w in zip(known, weight):
            for p in s:
                own[p] = own.get(p, 0) + w / sum(weight)
        for p, n in own.items():
            counts[p] = counts.get(p, 0) + freq * round(n * unigram.UNIT)
    return counts, likelihood / unigram.UNIT


def sequential(words, size, longest, shrink, rounds, seed_size, min_freq=2):
    """The same training word by word."""
    freq, length = {}, {}
    for symbols, n in words:
        for i in range(len(symbols)):
            for j in range(i + 1, min(len(symbols), i + longest) + 1):
                if j == i + 1 or not any(s.startswith("<0x") for s in symbols[i:j]):
                    piece = "".join(symbols[i:j])
                    freq[piece], length[piece] = freq.get(piece, 0) + n, j - i
    single = {p for p in freq if length[p] == 1}
    rest = sorted((p for p in freq if p not in single and freq[p] >= min_freq), key=lambda p: (-freq[p] * length[p], p))
    kept = single | set(rest[:max(0, seed_size - len(single))])

    def scored(counts):
        counts = {p: n for p, n in counts.items() if n > 0} | {p: 1 for p in single if counts.get(p, 0) <= 0}
        return {p: math.log(n) - math.log(sum(counts.values())) for p, n in counts.items()}

    scores, history = scored({p: freq[p] for p in kept}), []
    while True:
        seen = []
        for _ in range(rounds):
            counts, likelihood = expectations(words, scores, longest)
            seen.append(likelihood)
            scores = scored(counts)
        history.append(seen)
        if len(scores) <= max(size, len(single)):
            return scores, history
        loss = {}
        for p in scores:
            if p not in single:
                others = [sum(scores[q] for q in s) for s in segmentations(list(p), longest) if p not in s and all(q in scores for q in s)]
                loss[p] = counts.get(p, 0) * (scores[p] - max(others))
        keep = max(size, len(single), int(shrink * len(scores))) - len(single)
        kept = single | set(sorted(loss, key=lambda p: (-loss[p], p))[:keep])
        scores = scored({p: counts.get(p, 0) for p in kept})


def sample(seed):
    r = random.Random(seed)
    units = ["ab", "abc", "ing", "the", "er", "x", "ba"]
    return sorted({"".join(r.choice(units) for _ in range(r.randint(1, 4)))[:9]: r.randint(1, 30) for _ in range(60)}.items())


@pytest.mark.parametrize("seed, size", [(1, 25), (2, 14)])
def test_training_equals_the_sequential_version(spark, seed, size):
    words = sample(seed)
    rows = spark.createDataFrame(words, "word string, freq bigint").repartition(5)
    made = unigram.train_unigram(vocab.word_symbols(rows), size, longest=5, shrink=0.6, seed_size=90)
    scores, history = sequential([(list(w), n) for w, n in words], size, 5, 0.6, 2, 90)
    assert made.scores == pytest.approx(scores, rel=1e-9) and len(made.scores) == size
    assert [len(h) for h in made.rounds] == [len(h) for h in history]
    for mine, want in zip(made.rounds, history, strict=True):
        assert mine == pytest.approx(want, rel=1e-9)
    pieces = {r["word"]: r["pieces"] for r in made.word_pieces(vocab.word_symbols(rows)).collect()}
    for word, _ in words:
        best = max(sum(scores[p] for p in s) for s in segmentations(list(word), 5) if all(p in scores for p in s))
        assert "".join(pieces[word]) == word and sum(scores[p] for p in pieces[word]) == pytest.approx(best)


def test_likelihood_rises_with_every_round(spark):
    rows = spark.createDataFrame(sample(3), "word string, freq bigint")
    made = unigram.train_unigram(vocab.word_symbols(rows), 30, rounds=6, longest=6, shrink=0.5)
    assert len(made.rounds) > 1
    for seen in made.rounds:
        assert all(b >= a - 1e-3 for a, b in zip(seen, seen[1:]))


def test_byte_tokens_stay_single_and_small_tables(spark):
    rows = spark.createDataFrame([("aé", ["a", "<0xC3>", "<0xA9>"], 9), ("aa", ["a", "a"], 50), ("", [], 3)], "word string, symbols array<string>, freq bigint")
    made = unigram.train_unigram(rows, 10)
    assert set(made.scores) == {"a", "aa", "<0xC3>", "<0xA9>"}
    made.scores["aa"] = made.scores["a"]
    assert {r["word"]: r["pieces"] for r in made.word_pieces(rows).collect()} == {"aé": ["a", "<0xC3>", "<0xA9>"], "aa": ["aa"], "": []}
    assert unigram.train_unigram(rows.limit(0), 10).scores == {}
    assert unigram.best_pieces(["q", "a", "a"], made.scores, 4)[0] == ["q", "aa"]


def test_long_word():
    scores = {"a": -1.0, "aa": -1.5}
    total, counts = unigram.expected(["a"] * 5000, scores, 16)
    assert total < 0 and counts["a"] + 2 * counts["aa"] == pytest.approx(5000)
