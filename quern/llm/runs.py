"""Periodic runs: maximal stretches of words that repeat at a smallest period, found at several scales.

A run is a stretch of at least ``LEAST`` words and of at least two periods that no neighbouring word
extends. Words become numbers, other ones in each text, so texts of a batch lie in one array and no run
crosses from one to the next. Periods below ``FIRST`` are scanned directly, lag by lag. Beyond that a
scale ``s`` (``FIRST``, doubled each time) covers the periods from ``s`` to ``2s - 1``:

* Half the scale is the length of its grams, whose hashes are made of two of the scale before. Every
  window of ``s / 2`` grams picks those with the least hash, its minimizers. Inside a run of such a period
  two windows a period apart lie in the run and hold the same words, so their minimizers are a period
  apart and equal. Equal minimizers at a distance of the scale are seeds, which are compared word by word
  to both sides.
* Grams with a period of a quarter of their scale or less, which lie in runs that smaller scales have
  found, are no minimizers: they would pair in numbers. Other grams recur at distances above ``s / 4``
  only, so a minimizer has at most eight partners. A run whose windows hold no other grams lies over two
  runs of one smaller period that touch; its ends follow from theirs, and such pairs are seeds as well.

A stretch with the ends of a run of smaller period is that run. The result is exact; hashes only choose
what is compared.

Defined results: a null or empty text has no words and no runs; texts that repeat have equal results;
bytes that are not UTF-8 count as U+FFFD; a text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts

LEAST = 12
#: The first scale; shorter periods are scanned lag by lag. A power of two, above LEAST.
FIRST = 32
#: Words of texts looked at together.
TOGETHER = 1 << 19
RUN = "struct<start: bigint, length: bigint, period: bigint>"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.uint64((1 << 64) - 1)


class _Found:
    """Runs so far, by rising period. Of stretches with the same ends the first stays."""

    def __init__(self):
        self.ends: set[tuple[int, int]] = set()
        self.runs: list[tuple[int, int, int]] = []

    def add(self, start: int, length: int, period: int) -> None:
        if (start, length) not in self.ends:
            self.ends.add((start, length))
            self.runs.append((start, length, period))

    def up_to(self, period: int) -> np.ndarray:
        rows = np.array(self.runs, np.int64).reshape(-1, 3)
        return rows[rows[:, 2] <= period]


def _scan(ids: np.ndarray, period: int) -> Iterator[tuple[int, int]]:
    """Start and length of the stretches that repeat at a lag, long enough for a run."""
    least = max(LEAST - period, period)
    equal = np.flatnonzero(ids[:-period] == ids[period:])
    if len(equal) < least:
        return
    # Places from which `least` equal places follow one another; a stretch has them side by side.
    heads = equal[: len(equal) - least + 1][equal[least - 1:] - equal[: len(equal) - least + 1] == least - 1]
    if not len(heads):
        return
    cuts = np.flatnonzero(np.diff(heads) != 1) + 1
    for part in np.split(heads, cuts):
        yield int(part[0]), int(part[-1] - part[0]) + least + period


def _doubled(grams: np.ndarray, length: int) -> np.ndarray:
    """Hashes of grams of twice the length. Those over the end of the array mean nothing."""
    with np.errstate(over="ignore"):
        out = grams * _MIX
        out[:-length] += grams[length:] if length < len(grams) else 0
        out ^= out >> np.uint64(31)
        return out * np.uint64(0xBF58476D1CE4E5B9)


def _slid(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over all windows of a width that is a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least value of some window of ``width`` grams."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    least = _slid(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    most = _slid(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero((most == grams) & (grams != _NEVER))


def _pairs(places: np.ndarray, keys: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and distances of equal keys that are ``scale`` to ``2 * scale - 1`` apart."""
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    left = np.arange(len(places))
    step = 1
    while len(left):
        left = left[left + step < len(places)]
        apart = places[left + step] - places[left]
        near = (keys[left + step] == keys[left]) & (apart < 2 * scale)
        left, apart = left[near], apart[near]
        far = apart >= scale
        yield places[left[far]], apart[far]
        step += 1


def _extended(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words equal those a lag further on."""
    low, high, step, last = at, at, 64, len(ids) - lag
    while high < last:
        size = min(step, last - high)
        odd = np.flatnonzero(ids[high:high + size] != ids[high + lag:high + lag + size])
        if len(odd):
            high += int(odd[0])
            break
        high, step = high + size, step * 2
    step = 64
    while low:
        size = min(step, low)
        odd = np.flatnonzero(ids[low - size:low] != ids[low - size + lag:low + lag])
        if len(odd):
            low += int(odd[-1]) + 1 - size
            break
        low, step = low - size, step * 2
    return low, high


def _over_touching(ids: np.ndarray, runs: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """Stretches ``(from, to, lag)`` over two touching runs of the same period, for the lags of a scale.

    A lag shifts the first run into the second one, in step with its period."""
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    begin, period = runs[:, 0], runs[:, 2]
    end = begin + runs[:, 1]
    touching = np.flatnonzero((period[1:] == period[:-1]) & (begin[1:] <= end[:-1]))
    for k in touching.tolist():
        b, e, b2, e2, p = int(begin[k]), int(end[k]), int(begin[k + 1]), int(end[k + 1]), int(period[k])
        most = min(e - b, e2 - b2, (e2 - b) // 2, 2 * scale - 1)
        if most < scale:
            continue
        turn = _place(ids[b:b + 2 * p - 1], ids[b2:b2 + p])
        if turn < 0:
            continue
        lag = scale + (b2 - b - turn - scale) % p
        for q in range(lag, most + 1, p):
            low, high = max(b, b2 - q), min(e, e2 - q)
            if low < high:
                # Only where both runs begin or end together can neighbouring words go on being equal.
                low = _extended(ids, low, q)[0] if b == b2 - q else low
                high = _extended(ids, high - 1, q)[1] if e == e2 - q else high
                yield low, high, q


def _place(words: np.ndarray, part: np.ndarray) -> int:
    """Where ``part`` first stands in ``words``, or -1."""
    raw, size, at = words.tobytes(), words.itemsize, -1
    while True:
        at = raw.find(part.tobytes(), at + 1)
        if at < 0 or at % size == 0:
            return at // size if at >= 0 else -1


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs. ``ids`` holds texts of the given sizes one after the
    other, and no number of one text stands in another."""
    found, longest = _Found(), int(sizes.max(initial=0))
    for period in range(1, min(FIRST, longest // 2 + 1)):
        for start, length in _scan(ids, period):
            found.add(start, length, period)
    if longest < 2 * FIRST:
        return found.runs
    length_of = np.repeat(sizes, sizes)
    places = np.flatnonzero(length_of >= 2 * FIRST)
    grams, length = _doubled(ids[places].astype(np.uint64), len(places) + 1), 1
    scale = FIRST
    while 2 * scale <= longest:
        # Texts too short for the scale leave.
        stay = length_of[places] >= 2 * scale
        places, grams = places[stay], grams[stay]
        while 2 * length < scale:
            grams, length = _doubled(grams, length), length * 2
        half = scale // 2
        runs = found.up_to(half // 2)
        covering = runs[runs[:, 1] >= half]
        edges = np.zeros(len(ids) + 1, np.int32)
        np.add.at(edges, covering[:, 0], 1)
        np.add.at(edges, covering[:, 0] + covering[:, 1] - half + 1, -1)
        periodic = (edges.cumsum()[:-1] > 0)[places]
        values = np.where(periodic, _NEVER, grams >> np.uint64(1))[: len(grams) - half + 1]
        chosen = _minimizers(values, half)
        seeds = [np.stack(x, axis=1) for x in _pairs(chosen, values[chosen], scale)]
        seeds = np.concatenate([np.zeros((0, 2), np.int64), *seeds])
        stretches = list(_over_touching(ids, runs, scale))
        last, until = 0, 0
        for k in np.lexsort((seeds[:, 0], seeds[:, 1])).tolist():
            at, lag = int(places[seeds[k, 0]]), int(seeds[k, 1])
            # What a stretch of this lag reached needs no other comparison.
            if lag == last and at < until:
                continue
            low, high = _extended(ids, at, lag)
            last, until = lag, high
            stretches.append((low, high, lag))
        for low, high, lag in stretches:
            if high - low >= lag:
                found.add(low, high - low + lag, lag)
        scale *= 2
    return found.runs


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Words as numbers, each text with numbers of its own."""
    out, base = [], 0
    for words in texts:
        table = dict.fromkeys(words)
        table = dict(zip(table, range(base, base + len(table)), strict=True))
        base += len(table)
        out.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
    return np.concatenate([np.zeros(0, np.int64), *out])


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those behind a run's first period."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    keep = np.flatnonzero(edges.cumsum()[:-1] == 0).tolist()
    return b" ".join([words[i] for i in keep])


def runs_of(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words of each text, and its runs by start, then period."""
    at = 0
    while at < len(texts):
        group, count = [], 0
        while at < len(texts) and (not group or count < TOGETHER):
            group.append(texts[at].split())
            count += len(group[-1])
            at += 1
        sizes = np.array([len(w) for w in group], np.int64)
        starts = sizes.cumsum() - sizes
        found: list[list[tuple[int, int, int]]] = [[] for _ in group]
        for start, length, period in find_runs(_numbered(group), sizes):
            text = int(np.searchsorted(starts, start, "right")) - 1
            found[text].append((start - int(starts[text]), length, period))
        for words, runs in zip(group, found, strict=True):
            yield words, sorted(runs, key=lambda r: (r[0], r[2]))


def _work(texts: list[bytes]) -> list:
    counts, lists, collapsed = [], [], []
    for words, runs in runs_of(texts):
        counts.append(len(words))
        lists.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
        collapsed.append(_collapsed(words, runs).decode("utf-8", "replace"))
    return [counts, lists, collapsed]


def _build() -> Callable[[list[bytes]], list]:
    return _work


def with_runs(docs: DataFrame, text: str = "text", name: str = "_runs", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with ``n_words``, ``runs`` by start and period, and ``collapsed``: the
    words that no run repeats, joined by spaces."""
    return map_texts(docs, text, _build, f"n_words bigint, runs array<{RUN}>, collapsed string", name, keep)


def longest(runs: Column) -> Column:
    """The run of greatest length; of equal ones that with the smallest start, then period. Null without runs."""
    ranked = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(F.size(runs) > 0, F.struct((-ranked["s"]).alias("start"), ranked["length"].alias("length"), (-ranked["p"]).alias("period")))


def lines(runs: Column) -> Column:
    """``start,length,period`` and a line break for each run."""
    parts = lambda r: [r[c].cast("string") for c in ("start", "length", "period")]
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", *parts(r)), F.lit("\n"))), "")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def folded(text: str, doc_id: str) -> Column:
    """The text, or for a tenth of the ids its words with a tail that repeats: with ``h`` the crc32 of the
    id, ``g = h div 10`` and ``n`` words, each word ``i >= a`` becomes word ``a + (i - a) % p`` where
    ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``. A null id leaves the text as it is."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.get(words, place(i))), " "))

    repeated = F.transform(F.array(words_of(F.col(text))), tail)[0]
    return F.when(h % 10 == 0, repeated).otherwise(F.col(text))
