"""Texts of a megabyte, invalid UTF-8, and the arrays that stand for features of segments."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import pii, quality

WORDS = re.compile(r"\S+")


@pytest.fixture(scope="module")
def field():
    return pii.Field().fit([pii._example(t, a, b, s) for t, s in pii._templates(count=25) for a, b in pii.regions(t)])


def brute_regions(text):
    out = []
    for m in WORDS.finditer(text):
        if re.search("[0-9@]", m[0]):
            if out and text[out[-1][1]:m.start()] in (" ", "  "):
                out[-1] = (out[-1][0], m.end())
            else:
                out.append(m.span())
    return out


def test_regions_are_words_with_digits():
    r = random.Random(4)
    for _ in range(500):
        text = "".join(r.choice(["a", "bc", "1", "@", " ", "  ", "   ", "\n", "\t", "é", "中", "　", "."]) for _ in range(r.randint(0, 40)))
        assert pii.regions(text) == brute_regions(text)


@pytest.mark.parametrize("text, base", [
    ("x" * 1_000_000, 0), ("的一是不了人我在有他" * 100_000 + "1", 0), ("a " * 500_000 + "1", 0),
    ("\n".join(f"user{i}@host.com" for i in range(20_000)), 20_000), ("9" * 1_000_000, 0), ("@" * 1_000_000, 0),
])
def test_long_texts_take_linear_time(field, text, base):
    start = time.time()
    found = pii.all_spans(text, field)
    assert len(found[0]) == base and time.time() - start < 30


def test_features_are_those_of_the_span():
    """The arrays against what the names of the features say, span by span."""
    r = random.Random(8)
    texts = ["".join(r.choice(["12", "7", "255", "0300", "abc", "Z", "@", ".", "-", " ", "(", ")", "+", "é", "4111111111111111", "x.org"])
                     for _ in range(r.randint(1, 14))) for _ in range(120)]
    found = [("pre " + t + " post", 4, 4 + len(t)) for t in texts]
    atoms = pii.Atoms(found)
    i, j, rows = atoms.segments(0, len(atoms.at))
    names = {n: rows[:, k] for k, n in enumerate(pii._FEATURES)}
    by_shape, by_marks = {}, {}
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        span = atoms.text[atoms.at[a]:atoms.end[b - 1]]
        digits = re.sub("[^0-9]", "", span)
        parts = span.split(".")
        assert names["digits"][k] == min(len(digits), 20)
        assert names["luhn"][k] == (14 <= len(digits) <= 19 and pii.luhn(digits))
        assert names["octets"][k] == (len(parts) == 4 and all(p.isascii() and p.isdigit() and pii._octet(p) for p in parts))
        assert names["at"][k] == span.count("@") * 2 + bool(span.count("@") == 1 and pii._DOMAIN.fullmatch(span.partition("@")[2]))
        assert names["size"][k] == min(len(span) // 4, 12) and names["letters"][k] == any(c.isalpha() for c in span)
        shape = re.sub("[0-9]+", lambda m: "9" * min(len(m[0]), 5), re.sub("[A-Za-z]+", "a", span))
        assert by_shape.setdefault(shape, names["shape"][k]) == names["shape"][k]
        marks = "".join(sorted(set(re.sub("[A-Za-z0-9]", "", span))))
        assert by_marks.setdefault(marks, names["marks"][k]) == names["marks"][k]
    assert len(set(by_shape.values())) == len(by_shape) and len(set(by_marks.values())) == len(by_marks)


def test_regions_decoded_together_or_alone(field):
    r = random.Random(2)
    texts = ["".join(r.choice(["a1@b.co", "555-123-4567 ", "(555) 123-4567", " x ", "12.5", "\n", "1.2.3.4 "]) for _ in range(r.randint(0, 30))) for _ in range(80)]
    assert pii.all_spans_of(texts, field) == [pii.all_spans(t, field) for t in texts]


def test_bytes_that_are_not_utf8(spark, field):
    rows = spark.createDataFrame([(1, bytearray(b"\xff\xfe call +49 (632) 555-4827"))], "doc_id int, raw binary")
    out, name = pii.with_pii(rows.select("doc_id", F.col("raw").cast("string").alias("text")), field)
    assert [(s["kind"], s["start"], s["end"]) for s in out.first()[name]["base"]] == [("phone", 8, 26)]


def test_leading_vectors_are_those_of_the_decomposition():
    rows = np.random.default_rng(3).random((90, quality.WIDTH)).astype(np.float32) * np.linspace(3, 0.1, 90, dtype=np.float32)[:, None]
    sample = quality._Sample([quality._packed(r) for r in rows])
    weighted = rows * sample.weight
    assert np.allclose(sample.products(), weighted @ weighted.T, rtol=1e-4)
    _, values, right = np.linalg.svd(weighted.astype(np.float64), full_matrices=False)
    got = sample.right(10)
    assert np.allclose(np.abs((got.T @ right[:10].T)).max(axis=0)[:4], 1, atol=1e-2)
    assert np.linalg.norm(weighted @ got) == pytest.approx(np.linalg.norm(values[:10]), rel=1e-4)
    empty = quality.Neighbours([b"", b""], np.array([0, 1]), 0.5)
    assert empty.score(np.zeros((1, quality.WIDTH), np.float32)) == pytest.approx([0.5])
