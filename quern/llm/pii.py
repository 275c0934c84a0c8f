"""Personal data: base patterns, and spans that a semi-Markov conditional random field adds.

The field reads a region (words with digits or ``@`` and what joins them) as a sequence of atoms:
runs of letters, runs of digits, single other characters. A segment is up to ``MAX_ATOMS`` atoms and
``MAX_CHARS`` characters, of digits enough for its type (see ``Atoms.segments``); its score is the sum of weights of features of the whole span (shape, digit
count, checksum, octets, length, characters around it, word before it) for its type. Dynamic
programming over all segmentations picks boundaries and types together. Weights are learned by
gradient ascent of the conditional likelihood on regions in which the base patterns are the truth: a
bounded number of regions from the corpus (``SAMPLE_DOCS``, long ones in pieces), and regions made from templates, which
also hold the variants that the base patterns miss (telephone numbers without a plus, separated by
dots or hyphens). A segment is added where it touches no base span; base spans always stay.

Regions of a batch are decoded together, in arrays, ``STEP`` atoms at a time; a region of any length is
one sequence. Dynamic programming runs over the segments that are worth more than their atoms outside.

Defined results: a null or empty text has no spans; equal texts have equal spans; bytes that are not
UTF-8 count as U+FFFD.
"""

from __future__ import annotations

import bisect
import itertools
import random
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_texts, utf8

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind: string, start: int, end: int>>"
SAMPLE_DOCS = 1000
SAMPLE_REGIONS = 300
MAX_ATOMS = 16
MAX_CHARS = 64
STEP = 16384
#: Digits of a segment without ``@`` and dots: fewer or more make no telephone or card number.
LEAST_DIGITS = 7
MOST_DIGITS = 19
TRAIN_CHARS = 400

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> list[tuple[int, int]]:
    """The local part is all of its characters left of the ``@`` that no earlier match holds."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        # Local characters never hold an @, so these walks do not overlap.
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
        last = match.end() if match else at + 1
        at = text.find("@", last)
    return found


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, by start, then kind; offsets are code points."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---------------------------------------------------------------- regions

#: Plain words with the space behind them, then a word with a digit or an ``@``.
_NEXT = re.compile(r"(?:[^\s@0-9]*+\s)*+([^\s@0-9]*+[@0-9]\S*+)")


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that can hold personal data: words with digits or ``@``, joined where one or two spaces
    part them. Every character is read once."""
    out: list[tuple[int, int]] = []
    match = _NEXT.match(text)
    while match:
        start, end = match.span(1)
        if out and start - out[-1][1] <= 2 and not text[out[-1][1]:start].strip(" "):
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        match = _NEXT.match(text, end)
    return out


def _hopeless(text: str, start: int, end: int) -> bool:
    """Whether no segment of the region can be typed."""
    digits = len(_DIGITS.sub("", text[start:end]))
    return digits < LEAST_DIGITS and text.find("@", start, end) < 0 and (digits < 4 or text.count(".", start, end) < 3)


def _train_pieces(text: str) -> list[tuple[int, int]]:
    """Regions to learn from, in pieces of about ``TRAIN_CHARS`` characters at most, cut at a space and
    through no base span. Spans are looked for in whole regions."""
    out, spans = [], None
    for start, end in regions(text):
        while end - start > TRAIN_CHARS:
            spans = base_spans(text) if spans is None else spans
            cut = text.rfind(" ", start + 1, start + TRAIN_CHARS)
            cut = cut if cut > 0 else start + TRAIN_CHARS
            cut = min((a for a, _, b in spans if start < a < cut < b), default=cut)
            out.append((start, cut))
            start = cut
        out.append((start, end))
    return out


# ---------------------------------------------------------------- atoms and features

_WORD_BEFORE = re.compile(r"([^\W\d_]+)\W*\Z")
_FEATURES = ("shape", "digits", "marks", "ends", "left", "right", "luhn", "octets", "at", "size", "word", "letters")
_WINDOW = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class Atoms:
    """The atoms of many regions, and the features of candidate segments, as integer codes in arrays.

    Each region brings ``_WINDOW`` characters before it and one behind it; a line break stands where the
    text has none. ``prefix`` sums over atoms give digits, marks and checksums of any segment.
    """

    def __init__(self, found: list[tuple[str, int, int]]):
        parts = [("\n" + t[max(0, a - _WINDOW):a], t[a:b], t[b:b + 1] or "\n") for t, a, b in found]
        self.text = "".join("".join(p) for p in parts)
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        body = np.array([[len(x) for x in p] for p in parts], np.int64).reshape(-1, 3)
        ends = body.sum(axis=1).cumsum()
        self.origin = ends - body.sum(axis=1)
        first, last = self.origin + body[:, 0], ends - body[:, 2]
        distinct, which = np.unique(codes, return_inverse=True)
        chars = [chr(c) for c in distinct.tolist()]
        look = lambda test: np.array([test(c) for c in chars], bool)[which]
        letter = ((codes | 32) >= 97) & ((codes | 32) <= 122) & (codes < 128)
        digit = (codes >= 48) & (codes <= 57)
        kind = np.where(letter, 1, np.where(digit, 2, 3))
        word, space, alpha = look(str.isalnum), look(str.isspace), look(str.isalpha)
        inside = np.zeros(len(codes) + 1, np.int64)
        np.add.at(inside, first, 1)
        np.add.at(inside, last, -1)
        inside = inside.cumsum()[:-1] > 0
        begins = inside & ((kind == 3) | (kind != np.roll(kind, 1)))
        begins[first[first < last]] = True
        self.at = np.flatnonzero(begins)
        self.region = np.searchsorted(first, self.at, "right") - 1
        self.end = np.minimum(np.append(self.at[1:], len(codes)), last[self.region])
        #: Where a position of ``text`` lies in the text of its region.
        self.shift = np.array([a for _, a, _ in found], np.int64)[self.region] - first[self.region]
        n, self.kind = self.end - self.at, kind[self.at]
        code = codes[self.at].astype(np.int64)
        outside = np.where(word, 1, np.where(space, 2, codes.astype(np.int64) + 3))
        self.space = space[self.at]
        self.first_class, self.last_class = outside[self.at], outside[self.end - 1]
        self.left, self.right = outside[self.at - 1], outside[self.end]
        self.digits = np.where(self.kind == 2, n, 0)
        self.dots, self.ats = (code == 46).astype(np.int64), (code == 64).astype(np.int64)
        self.alpha = (self.kind == 1) | alpha[self.at]
        self.shape = _mixed(np.where(self.kind == 3, code + 8, np.where(self.kind == 1, 1, 2 + np.minimum(n, 5))))
        self.mark = np.where(self.kind == 3, _mixed(code), np.uint64(0))
        order = np.lexsort((np.arange(len(code)), code))
        self.same = np.full(len(code), -1)
        again = (code[order][1:] == code[order][:-1]) & (self.kind[order][1:] == 3)
        self.same[order[1:][again]] = order[:-1][again]
        self._checksums(codes, digit)
        self._octets(codes)
        self._domains(code, n)
        self.word = self._words(word)

    def _checksums(self, codes: np.ndarray, digit: np.ndarray) -> None:
        """Sums over the digits before each place, plain and doubled, by the parity of the digit's rank."""
        value = np.where(digit, codes.astype(np.int64) - 48, 0)
        self.rank = np.concatenate([[0], digit.cumsum()])
        doubled = value * 2 - 9 * (value > 4)
        even = digit & (self.rank[:-1] % 2 == 0)
        sums = [np.concatenate([[0], np.where(side, v, 0).cumsum()]) for side in (even, digit & ~even) for v in (value, doubled)]
        self.sums = np.stack(sums).reshape(2, 2, -1)

    def _octets(self, codes: np.ndarray) -> None:
        """Whether an atom is a number of at most 255, with any zeros before it."""
        self.octet = np.zeros(len(self.at), bool)
        numbers = np.flatnonzero(self.kind == 2)
        value = np.zeros(len(numbers), np.int64)
        end = self.end[numbers]
        for back in (3, 2, 1):
            at = end - back
            value = value * 10 + np.where(at >= self.at[numbers], codes[np.maximum(at, 0)].astype(np.int64) - 48, 0)
        length = end - self.at[numbers]
        self.octet[numbers] = (value <= 255) & (length <= 3)
        for k in np.flatnonzero(length > 3).tolist():
            self.octet[numbers[k]] = _octet(self.text[self.at[numbers[k]]:end[k]])

    def _domains(self, code: np.ndarray, n: np.ndarray) -> None:
        """For each atom: whether what stands from behind the last ``@`` to its end is a domain."""
        self.domain = np.zeros(len(code), bool)
        label = (self.kind != 3) | (code == 45)
        for at in np.flatnonzero(self.ats).tolist():
            held, dots = False, 0
            for k in range(at + 1, min(at + MAX_ATOMS, len(code))):
                if self.region[k] != self.region[at] or not (label[k] or code[k] == 46 and held):
                    break
                held = bool(label[k])
                dots += not held
                self.domain[k] = held and dots > 0

    def _words(self, word: np.ndarray) -> np.ndarray:
        """Code of the word before each atom, 0 for none."""
        codes, out = {"": 0}, np.zeros(len(self.at), np.int64)
        before = np.maximum.accumulate(np.where(word, np.arange(len(word)), -1))
        nearest = before[self.at - 1]
        origin = self.origin[self.region]
        for k in np.flatnonzero((nearest >= np.maximum(origin, self.at - _WINDOW)) & (nearest >= 0)).tolist():
            if self.text[nearest[k]].isdecimal():
                continue
            match = _WORD_BEFORE.search(self.text[max(origin[k], self.at[k] - _WINDOW):self.at[k]])
            if match:
                out[k] = codes.setdefault(match[1].lower(), zlib.crc32(match[1].lower().encode("utf-8", "surrogatepass")) + 1)
        return out

    def segments(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(from, to)`` of the candidates that start at the atoms ``first`` to ``last - 1``, and a code
        per feature. Single atoms are all candidates. Longer segments have to be typed, so only those are
        that begin and end without a space and hold an ``@``, digits enough, or three dots and four digits."""
        i = np.arange(first, last)
        shape, marks = np.zeros(len(i), np.uint64), np.zeros(len(i), np.uint64)
        digits, dots, ats, alpha = (np.zeros(len(i), np.int64) for _ in range(4))
        out_i, out_j, rows = [], [], []
        for length in range(1, MAX_ATOMS + 1):
            a = i + length - 1
            alive = a < len(self.at)
            alive[alive] &= (self.region[a[alive]] == self.region[i[alive]]) & (
                (length == 1) | (self.end[a[alive]] - self.at[i[alive]] <= MAX_CHARS) & ~self.space[i[alive]])
            i, a = i[alive], a[alive]
            if not len(i):
                break
            with np.errstate(over="ignore"):
                shape = shape[alive] * _BASE + self.shape[a]
                marks = marks[alive] + np.where(self.same[a] < i, self.mark[a], np.uint64(0))
            digits, dots = digits[alive] + self.digits[a], dots[alive] + self.dots[a]
            ats, alpha = ats[alive] + self.ats[a], alpha[alive] + self.alpha[a]
            hope = (ats > 0) | (digits >= LEAST_DIGITS) & (digits <= MOST_DIGITS) | (dots == 3) & (digits >= 4)
            take = np.flatnonzero(hope & ~self.space[a] | (length == 1))
            if not len(take):
                continue
            ii, aa, d, n_at = i[take], a[take], digits[take], ats[take]
            start, end = self.at[ii], self.end[aa]
            octets = np.zeros(len(ii), bool)
            if length == 7:
                octets = (dots[take] == 3) & np.logical_and.reduce([self.octet[ii + k] for k in (0, 2, 4, 6)])
                octets &= np.logical_and.reduce([self.dots[ii + k] == 1 for k in (1, 3, 5)])
            rows.append(np.stack([
                shape[take].view(np.int64), np.minimum(d, 20), marks[take].view(np.int64),
                self.first_class[ii] * (1 << 22) + self.last_class[aa], self.left[ii], self.right[aa],
                self._luhn(start, end, d), octets, n_at * 2 + ((n_at == 1) & self.domain[aa]),
                np.minimum((end - start) // 4, 12), self.word[ii], alpha[take] > 0]).astype(np.int64))
            out_i.append(ii)
            out_j.append(aa + 1)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(_FEATURES)), np.int64)
        return np.concatenate(out_i), np.concatenate(out_j), np.concatenate(rows, axis=1).T

    def _luhn(self, start: np.ndarray, end: np.ndarray, digits: np.ndarray) -> np.ndarray:
        last = (self.rank[end] - 1) % 2
        plain = self.sums[last, 0, end] - self.sums[last, 0, start]
        doubled = self.sums[1 - last, 1, end] - self.sums[1 - last, 1, start]
        return (digits >= 14) & (digits <= 19) & ((plain + doubled) % 10 == 0)


class Field:
    """The trained field: weights per feature and type; type 0 is a single atom outside."""

    types = 1 + len(KINDS)

    def __init__(self):
        self.codes: list[np.ndarray] = [np.zeros(0, np.int64) for _ in _FEATURES]
        self.weights = np.zeros((1, self.types))

    def _numbers(self, rows: np.ndarray) -> np.ndarray:
        """Feature numbers of feature codes; 0 for those never seen."""
        out, before = np.zeros(rows.shape, np.int64), 1
        for f, known in enumerate(self.codes):
            if len(known):
                at = np.minimum(np.searchsorted(known, rows[:, f]), len(known) - 1)
                out[:, f] = np.where(known[at] == rows[:, f], at + before, 0)
            before += len(known)
        return out

    def lattice(self, text: str, start: int, end: int):
        """Atom bounds, segments ``(from, to)`` ordered by end, and their feature numbers."""
        atoms = Atoms([(text, start, end)])
        i, j, rows = atoms.segments(0, len(atoms.at))
        order = np.lexsort((-i, j))
        bounds = [start, *(atoms.end + atoms.shift).tolist()]
        return bounds, list(zip(i[order].tolist(), j[order].tolist())), self._numbers(rows[order])

    def scores(self, segments: list | np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.types))
        for f in range(rows.shape[1]):
            out += self.weights[rows[:, f]]
        spans = np.asarray(segments).reshape(-1, 2)
        out[spans[:, 1] - spans[:, 0] > 1, 0] = -np.inf  # outside is one atom at a time
        return out

    def decode_all(self, found: list[tuple[str, int, int]]) -> list[list[tuple[int, int, int]]]:
        """Best segmentation of each region: ``(start, kind, end)`` of its typed segments.

        All atoms can stay outside, so only a segment that is worth more than its atoms outside can be
        part of the best segmentation; dynamic programming runs over those."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in found]
        if not found:
            return out
        atoms = Atoms(found)
        alone = np.zeros(len(atoms.at) + 1)
        better: list[tuple[np.ndarray, ...]] = []
        held: list[tuple[np.ndarray, ...]] = []
        for first in range(0, len(atoms.at), STEP):
            i, j, rows = atoms.segments(first, min(first + STEP, len(atoms.at)))
            score = self.scores(np.stack([i, j], axis=1), self._numbers(rows))
            single = j - i == 1
            alone[i[single] + 1] = score[single, 0]
            kind = score[:, 1:].argmax(axis=1) + 1
            held.append((i, j, kind, score[np.arange(len(kind)), kind]))
        alone = alone.cumsum()
        for i, j, kind, value in held:
            gain = value - (alone[j] - alone[i])
            keep = gain > 1e-12
            better.append((j[keep], -i[keep], kind[keep], gain[keep]))
        j, i, kind, gain = (np.concatenate(x) for x in zip(*better))
        order = np.lexsort((i, j))
        ends, worth, back = [0], [0.0], [None]  # the best up to each atom at which something better ends
        for jj, ii, k, g in zip(j[order].tolist(), (-i[order]).tolist(), kind[order].tolist(), gain[order].tolist(), strict=True):
            at = bisect.bisect_right(ends, ii) - 1
            if worth[at] + g > worth[-1]:
                state = (worth[at] + g, (at, ii, jj, k))
                if ends[-1] == jj:
                    worth[-1], back[-1] = state
                else:
                    ends.append(jj)
                    worth.append(state[0])
                    back.append(state[1])
        at = len(ends) - 1
        while back[at]:
            at, ii, jj, k = back[at]
            shift = int(atoms.shift[ii])
            out[int(atoms.region[ii])].append((int(atoms.at[ii]) + shift, k - 1, int(atoms.end[jj - 1]) + shift))
        return [spans[::-1] for spans in out]

    def decode(self, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
        return self.decode_all([(text, start, end)])[0]

    def fit(self, examples: list[tuple[str, int, int, list[tuple[int, int, int]]]], rounds: int = 12,
            rate: float = 0.3, decay: float = 1e-3) -> Field:
        """Stochastic gradient ascent of the conditional likelihood of the given segmentations."""
        atoms = Atoms([e[:3] for e in examples])
        i, j, rows = atoms.segments(0, len(atoms.at))
        order = np.lexsort((-i, j))
        i, j, rows = i[order], j[order], rows[order]
        self.codes = [np.unique(rows[:, f]) for f in range(rows.shape[1])]
        rows = self._numbers(rows)
        work = []
        # Segments lie by end, so those of a region lie together.
        cuts = np.searchsorted(atoms.region[i], np.arange(len(examples) + 1))
        starts = np.searchsorted(atoms.region, np.arange(len(examples) + 1))
        for e, (_, _, _, spans) in enumerate(examples):
            low, high, base = cuts[e], cuts[e + 1], starts[e]
            begin = {int(p + s): k for k, (p, s) in enumerate(zip(atoms.at[base:starts[e + 1]], atoms.shift[base:starts[e + 1]]))}
            close = {int(p + s): k + 1 for k, (p, s) in enumerate(zip(atoms.end[base:starts[e + 1]], atoms.shift[base:starts[e + 1]]))}
            segments = list(zip((i[low:high] - base).tolist(), (j[low:high] - base).tolist()))
            wanted = {(begin[a], close[b]): k + 1 for a, k, b in spans if a in begin and b in close}
            covered = {k for a, b in wanted for k in range(a, b)}
            truth = [wanted.get((a, b), 0 if b - a == 1 and a not in covered else -1) for a, b in segments]
            if segments and all(s in set(segments) for s in wanted):
                work.append((int(starts[e + 1] - base) + 1, segments, rows[low:high], np.array(truth)))
        self.weights = np.zeros((sum(map(len, self.codes)) + 1, self.types))
        draw = random.Random(7)
        for _ in range(rounds):
            draw.shuffle(work)
            for n, segments, numbers, truth in work:
                score = self.scores(segments, numbers)
                chance = _marginals(n, segments, score)
                chance[truth >= 0, truth[truth >= 0]] -= 1
                np.add.at(self.weights, numbers, -rate / numbers.shape[1] * chance[:, None, :])
                self.weights[0] = 0
            self.weights *= 1 - decay
        return self


def _marginals(n: int, segments: list, score: np.ndarray) -> np.ndarray:
    """Probability of every segment and type under the field."""
    total = np.logaddexp.reduce(score, axis=1)
    ahead, behind = np.full(n, -np.inf), np.full(n, -np.inf)
    ahead[0] = behind[-1] = 0
    for s, (i, j) in enumerate(segments):
        ahead[j] = np.logaddexp(ahead[j], ahead[i] + total[s])
    for s in range(len(segments) - 1, -1, -1):
        i, j = segments[s]
        behind[i] = np.logaddexp(behind[i], behind[j] + total[s])
    i, j = np.array(segments).T
    return np.exp(score + (ahead[i] + behind[j] - ahead[-1])[:, None])


# ---------------------------------------------------------------- training regions

def _templates(seed: int = 11, count: int = 60) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Invented texts with their spans: all types, variants of telephone numbers, and other numbers."""
    r = random.Random(seed)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))

    def card() -> str:
        body = number(r.choice((13, 15, 15, 15)))
        full = next(body + c for c in "0123456789" if luhn(body + c))
        cut = r.choice(("", " ", "-"))
        return cut.join(full[i:i + 4] for i in range(0, len(full), 4))

    makers = [
        (0, lambda: f"{word()}{r.choice(('', '.', '.' + word(), number(2)))}@{word()}.{r.choice(('com', 'org', 'example.com', 'net'))}".replace(".@", "@")),
        (1, lambda: ".".join(str(r.randint(0, 255)) for _ in range(4))),
        (2, card),
        (3, lambda: f"+{r.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}"),
        (3, lambda: f"({number(3)}) {number(3)}-{number(4)}"),
        (3, lambda: r.choice("-.").join((number(3), number(3), number(4)))),
        (None, lambda: f"{number(1)}.{number(1)}"), (None, lambda: f"{number(2)}-{number(2)}-{number(4)}"),
        (None, lambda: number(r.randint(1, 12))), (None, lambda: f"v{number(1)}.{number(2)}.{number(1)}"),
        (None, lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))), (None, lambda: f"{word()}{number(2)}"),
        (None, lambda: f"{word()}@{word()} {number(2)}"), (None, lambda: f'token = "{number(14)}{word()}{number(5)}"'),
    ]
    out = []
    for _ in range(count):
        for kind, make in makers:
            before, span, after = " ".join(word() for _ in range(2)) + " ", make(), r.choice((".", "", ",")) + " " + word()
            out.append((before + span + after, [] if kind is None else [(len(before), kind, len(before) + len(span))]))
    return out


def _example(text: str, start: int, end: int, spans: list) -> tuple:
    return text, start, end, [s for s in spans if start <= s[0] and s[2] <= end]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> Field:
    """Learn the field. The first ``sample`` ids by their hash name the documents whose regions, at
    most two each and ``SAMPLE_REGIONS`` in all, come to the driver beside the templates."""
    chosen = docs.select(F.col(doc_id).alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for raw in utf8(batch.column(0)):
                chars = raw.decode("utf-8", "replace")
                out += [chars[max(0, a - 20):b + 2] for a, b in _train_pieces(chars)[:2]]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["region"])

    found = rows.select("text").mapInArrow(cut, "region string").distinct()
    texts = [r["region"] for r in found.orderBy(F.xxhash64("region"), "region").limit(SAMPLE_REGIONS).collect()]
    examples = [_example(t, a, b, base_spans(t)) for t in texts for a, b in _train_pieces(t)]
    examples += [_example(t, a, b, s) for t, s in _templates() for a, b in regions(t)]
    return Field().fit(examples)


_CANDIDATE = re.compile(rb"[0-9@]")
#: Characters of regions decoded together.
TOGETHER = 1 << 18


class _Cover:
    """Answers whether a base span overlaps or holds a stretch, from the furthest end of all earlier ones."""

    def __init__(self, base: list[tuple[int, int, int]]):
        self.starts = [a for a, _, _ in base]
        self.reach = list(itertools.accumulate((b for _, _, b in base), max))

    def holds(self, start: int, end: int) -> bool:
        at = bisect.bisect_right(self.starts, start)
        return at > 0 and self.reach[at - 1] >= end

    def meets(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.starts, end)
        return at > 0 and self.reach[at - 1] > start


def all_spans_of(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """Base spans of each text, and base spans with the added ones. Regions of many texts are decoded together."""
    bases = [base_spans(t) for t in texts]
    covers, both = [_Cover(b) for b in bases], [list(b) for b in bases]

    def settle(found: list[tuple[int, int, int]]) -> None:
        for (n, _, _), spans in zip(found, field.decode_all([(texts[n], a, b) for n, a, b in found]), strict=True):
            both[n] += [s for s in spans if not covers[n].meets(s[0], s[2])]

    waiting, chars = [], 0
    for n, text in enumerate(texts):
        for start, end in regions(text):
            # A region that a base span fills has nothing to add.
            if not covers[n].holds(start, end) and not _hopeless(text, start, end):
                waiting.append((n, start, end))
                chars += end - start
                if chars > TOGETHER:
                    settle(waiting)
                    waiting, chars = [], 0
    settle(waiting)
    return [(base, sorted(all_)) for base, all_ in zip(bases, both, strict=True)]


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and base spans with the added ones."""
    return all_spans_of([text], field)[0]


def _dicts(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]


def _spans_where(texts: list[bytes], field: Field) -> Iterator[tuple[str, list, list]]:
    """Each text with its spans; texts without a digit or ``@`` have none."""
    chars = [t.decode("utf-8", "replace") for t in texts]
    at = [n for n, t in enumerate(texts) if _CANDIDATE.search(t)]
    made = dict(zip(at, all_spans_of([chars[n] for n in at], field), strict=True))
    for n, text in enumerate(chars):
        yield text, *made.get(n, ([], []))


def find(field: Field) -> Callable[[], Callable[[list[bytes]], list]]:
    def work(texts: list[bytes]) -> list:
        found = list(_spans_where(texts, field))
        return [[_dicts(base) for _, base, _ in found], [_dicts(both) for _, _, both in found]]

    return lambda: work


def with_pii(docs: DataFrame, field: Field, text: str = "text", name: str = "_pii", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with ``base`` and ``spans``."""
    return map_texts(docs, text, find(field), f"base {SPAN}, spans {SPAN}", name, keep)


def with_masked(docs: DataFrame, field: Field, text: str = "text", name: str = "_masked", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with the text in which every span reads ``[KIND]``."""
    def work(texts: list[bytes]) -> list:
        return [[_masked(t, both) for t, _, both in _spans_where(texts, field)]]

    return map_texts(docs, text, lambda: work, "text string", name, keep)


def mask(text: str, field: Field) -> str:
    return _masked(text, all_spans(text, field)[1])


def _masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans are masked as one, under the kind of the first."""
    out, last = [], 0
    for a, kind, b in spans:
        if a >= last:
            out += [text[last:a], f"[{KINDS[kind].upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])
