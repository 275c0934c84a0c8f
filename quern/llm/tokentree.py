"""Edit-aware token counts.

A document's pre-tokens are grouped by ``LEAF``; a segment tree holds characters and tokens of every
group and the sums of its subtrees (level by level, root last). An edit replaces a range of characters.
Re-encoding starts at the group with the last pre-token that cannot have seen the edit, and ends where
a new pre-token boundary falls on an old group boundary behind the edit: from there the scan sees the
same characters as before. A pre-token is decided by its own characters and at most two behind it (white
space gives its last character to the word that follows), so a group that ends two characters before
the edit stays. Only the sums above re-encoded groups change.

Edits of a document apply in order, each to the text that the one before left. Counts equal those of
encoding the edited text anew; the tests compare them with the library.

Defined results: a null or empty text has no tokens and an empty tree; positions are code points,
clipped to the text; null edits change nothing; equal rows have equal trees; bytes that are not UTF-8
count as U+FFFD, in texts and in what edits put in.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quern.llm.common import free_name, map_texts, text_or_empty, utf8, worker_store

LEAF = 32
KEPT_COUNTS = 400_000
#: Characters behind a pre-token that its end may depend on.
AHEAD = 2

TREE = "chars array<int>, tokens array<int>"
EDIT = "array<struct<at: int, cut: int, put: string>>"
#: Edits as Arrow hands them over, ``put`` as bytes.
_EDITS = pa.list_(pa.struct([("at", pa.int64()), ("cut", pa.int64()), ("put", pa.large_binary())]))


class Counter(dict):
    """Tokens of a pre-token; kept in the worker process up to a bound."""

    def __init__(self, encoding: tiktoken.Encoding):
        self.encoding = encoding

    def __missing__(self, piece: str) -> int:
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) <= 48:
            if len(self) >= KEPT_COUNTS:
                self.clear()
            self[piece] = n
        return n


class Vocabulary:
    """Merge ranks and the pre-token pattern; the ranks file is read on the driver."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = f.read()
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        #: Counts that a worker keeps hold for these ranks and this pattern, whatever file they are read from.
        self.pattern, self.key = pattern, hashlib.sha256(ranks + b"\0" + pattern.encode()).hexdigest()

    def counter(self) -> tuple[Counter, regex.Pattern]:
        store = worker_store("token-counts")
        if self.key not in store:
            store[self.key] = Counter(tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}))
        return store[self.key], regex.compile(self.pattern)


class TokenTree:
    """Characters and tokens of groups of pre-tokens, with subtree sums."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = _levels(chars), _levels(tokens)

    @classmethod
    def of(cls, text: str, counter: Counter, pattern: regex.Pattern) -> TokenTree:
        pieces = pattern.findall(text)
        counts = list(map(counter.__getitem__, pieces))
        sizes = list(map(len, pieces))
        at = range(0, len(pieces), LEAF)
        return cls([sum(sizes[i:i + LEAF]) for i in at], [sum(counts[i:i + LEAF]) for i in at])

    @property
    def total(self) -> int:
        return self.tokens[-1][0] if self.tokens[0] else 0

    def leaf(self, place: int) -> tuple[int, int]:
        """The group that holds a character, by walking down the sums, and the group's first character."""
        node, start = 0, 0
        for level in range(len(self.chars) - 2, -1, -1):
            node *= 2
            if place >= start + self.chars[level][node] and node + 1 < len(self.chars[level]):
                start += self.chars[level][node]
                node += 1
        return node, start

    def edit(self, text: str, at: int, cut: int, put: str, counter: Counter, pattern: regex.Pattern) -> tuple[str, int]:
        """Apply an edit to tree and text; returns the new text and the characters encoded again."""
        at = min(max(at, 0), len(text))
        cut = min(max(cut, 0), len(text) - at)
        edited = text[:at] + put + text[at + cut:]
        if not self.chars[0]:
            fresh = TokenTree.of(edited, counter, pattern)
            self.chars, self.tokens = fresh.chars, fresh.tokens
            return edited, len(edited)
        first, start = self.leaf(max(0, at - AHEAD))
        last, behind = self.leaf(min(at + cut, len(text) - 1))
        # The first old group boundary behind the edit, as a place in the new text.
        next_leaf, boundary = last + 1, behind + self.chars[0][last] + len(put) - cut
        chars, tokens, n, m, pos, stop = [], [], 0, 0, start, None
        for match in pattern.finditer(edited, start):
            while boundary < match.start() and next_leaf < len(self.chars[0]):
                boundary += self.chars[0][next_leaf]
                next_leaf += 1
            if match.start() == boundary and match.start() >= at + len(put):
                stop = next_leaf
                break
            n, m, pos = n + 1, m + counter[match[0]], match.end()
            if n == LEAF:
                chars.append(pos - start - sum(chars))
                tokens.append(m)
                n = m = 0
        if n:
            chars.append(pos - start - sum(chars))
            tokens.append(m)
        self._replace(first, len(self.chars[0]) if stop is None else stop, chars, tokens)
        return edited, sum(chars)

    def _replace(self, first: int, stop: int, chars: list[int], tokens: list[int]) -> None:
        """Exchange groups; sums above them are made anew, and those behind only when places shift."""
        same = stop - first == len(chars)
        for levels, new in ((self.chars, chars), (self.tokens, tokens)):
            levels[0][first:stop] = new
            if same:
                low, high = first, first + len(new)
                for k in range(1, len(levels)):
                    low, high = low // 2, (high + 1) // 2
                    for i in range(low, min(high, len(levels[k]))):
                        levels[k][i] = sum(levels[k - 1][2 * i:2 * i + 2])
            else:
                keep = first
                for k in range(1, len(levels)):
                    keep //= 2
                    levels[k][keep:] = [sum(levels[k - 1][i:i + 2]) for i in range(2 * keep, len(levels[k - 1]), 2)]
                while len(levels[-1]) > 1:
                    levels.append([sum(levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
                while len(levels) > 1 and len(levels[-2]) <= 1:
                    levels.pop()


def _levels(leaves: list[int]) -> list[list[int]]:
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([sum(levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def with_tree(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", name: str = "_tree",
              keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with the groups of each text's tree; sums follow from them."""
    def build() -> Callable[[list[bytes]], list]:
        counter, pattern = vocabulary.counter()

        def work(texts: list[bytes]) -> list:
            trees = [TokenTree.of(t.decode("utf-8", "replace"), counter, pattern) for t in texts]
            return [[t.chars[0] for t in trees], [t.tokens[0] for t in trees]]

        return work

    return map_texts(docs, text, build, TREE, name, keep)


def apply_edits(docs: DataFrame, tree: str, edits: str, vocabulary: Vocabulary, text: str = "text",
                name: str = "_edited", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The columns ``keep`` (default: all) and a struct: the tree behind the edits, token counts before and after, characters
    of the edited text and characters that were encoded again."""
    name = free_name(docs, name)
    result = T.StructType.fromDDL(f"{TREE}, n_tokens bigint, n_tokens_edited bigint, n_chars_edited bigint, n_chars_encoded bigint")
    kept = [i for i, c in enumerate(docs.columns) if keep is None or c in keep]
    fields = [T.StructField(str(k), docs.schema.fields[i].dataType, True) for k, i in enumerate(kept)]
    schema = T.StructType([*fields, T.StructField(str(len(kept)), result, True)])
    places = [docs.columns.index(c) for c in (text, tree, edits)]

    def run(batches):
        counter, pattern = vocabulary.counter()
        kind = to_arrow_schema(schema).field(len(kept)).type
        for batch in batches:
            made = []
            texts, trees, edited = (batch.column(p) for p in places)
            for raw, groups, changes in zip(utf8(texts), trees.to_pylist(), edited.cast(_EDITS).to_pylist(), strict=True):
                body = raw.decode("utf-8", "replace")
                grown = TokenTree(groups["chars"] or [], groups["tokens"] or [])
                before, encoded = grown.total, 0
                for e in changes or []:
                    if e is not None:
                        body, n = grown.edit(body, e["at"] or 0, e["cut"] or 0, (e["put"] or b"").decode("utf-8", "replace"), counter, pattern)
                        encoded += n
                made.append({"chars": grown.chars[0], "tokens": grown.tokens[0], "n_tokens": before, "n_tokens_edited": grown.total,
                             "n_chars_edited": len(body), "n_chars_encoded": encoded})
            columns = [*(batch.column(i) for i in kept), pa.array(made, kind)]
            yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])

    positional = docs.toDF(*(str(i) for i in range(len(docs.columns))))
    return positional.mapInArrow(run, schema).toDF(*(docs.columns[i] for i in kept), name), name


def sample_edits(text: str, key: str) -> Column:
    """Three edits per text whose places follow from the key: a replacement, an insertion of the
    text's own words, and a deletion. For queries that need a history."""
    body = text_or_empty(text)
    n = F.greatest(F.length(body), F.lit(1)).cast("bigint")
    place = lambda salt: F.pmod(F.xxhash64(F.col(key), F.lit(salt)), n).cast("int")
    made = lambda at, cut, put: F.struct(at.alias("at"), F.lit(cut).alias("cut"), put.alias("put"))
    return F.array(made(place(1), 7, F.lit(" edited text")), made(place(2), 0, F.substring(body, 1, 24)), made(place(3), 40, F.lit("")))
