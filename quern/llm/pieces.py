"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The symbols of a text are its characters. An agenda holds adjacent pairs that form a vocabulary
piece, best score first and leftmost among equals; a popped pair merges unless one of its sides has
changed since, and its new neighbours join the agenda. Characters outside the vocabulary become byte
pieces. A piece holds the space mark at its start or holds nothing else, so no merge can span a
character followed by a space mark: the text is cut there, and the result of a short part is kept for
its next occurrence, in a store of bounded size per task. Decoding works on the ids of the same parts:
byte pieces are only made of characters that are not in the vocabulary, and those never meet across
a cut. ``check`` compares whole Arrow batches with the library.

The vocabulary is read on the driver from a path and travels with the function. Vocabularies with a
normaliser table, user symbols, or marks inside pieces are refused.

Defined results: a null or empty text has the begin and end ids only and decodes to the empty text;
the space mark itself reads as a space; repeated rows have equal ids; bytes that are not UTF-8 are
encoded as U+FFFD.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from quern.llm.common import map_texts, worker_store

MARK = "▁"
CACHED_PARTS = 600_000
CACHED_CHARS = 48
SHORT = 32
NEVER = float("inf")
_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceVocabulary:
    """Pieces, scores and kinds of a merge-type vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        normal = [p.piece for p in model.pieces if p.type == 1]
        if (trainer.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or trainer.treat_whitespace_as_suffix or 4 in kinds or 5 in kinds or any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)):
            raise ValueError("only merge vocabularies without normaliser table, user symbols or inner space marks")
        self.prefix = norm.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.ranks = {p.piece: -p.score for p in model.pieces if p.type == 1}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.unknown = kinds.index(2)
        named = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 3}
        self.begin, self.end = named[trainer.bos_piece], named[trainer.eos_piece]
        self.values = {i: b for b, i in self.bytes.items()}
        special = {2: trainer.unk_surface.encode(), 3: b""}
        self.surfaces = [bytes([self.values[i]]) if p.type == 6 else special.get(p.type, p.piece.replace(MARK, " ").encode())
                         for i, p in enumerate(model.pieces)]
        self.name = hashlib.sha256(repr((self.ids, self.ranks)).encode()).hexdigest()


class Kept(dict):
    """Packed ids of parts; makes those that are missing."""

    def __init__(self, coder: Coder):
        self.coder = coder

    def __missing__(self, part: str) -> bytes:
        ids = self.coder.part_ids(part)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHED_PARTS:
                self.clear()
            self[part] = packed
        return packed


class Coder:
    """Encodes and decodes texts; ids of short parts stay in the worker process, across tasks."""

    def __init__(self, vocabulary: PieceVocabulary):
        self.v = vocabulary
        store = worker_store("pieces")
        if vocabulary.name not in store:
            store[vocabulary.name] = Kept(self)
        self.kept = store[vocabulary.name]

    def part_ids(self, part: str) -> list[int]:
        """Ids of one part by the agenda of adjacent pairs; a short agenda is a list, a long one a heap."""
        ids, ranks = self.v.ids, self.v.ranks
        if len(part) <= SHORT:
            found = ranks.get
            symbols = list(part)
            agenda = [found(a + b, NEVER) for a, b in zip(symbols, part[1:], strict=False)]
            while agenda and (best := min(agenda)) != NEVER:
                at = agenda.index(best)
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
                del agenda[at]
                if at < len(agenda):
                    agenda[at] = found(symbols[at] + symbols[at + 1], NEVER)
                if at:
                    agenda[at - 1] = found(symbols[at - 1] + symbols[at], NEVER)
            try:
                return [ids[s] for s in symbols]
            except KeyError:
                return self._numbered(symbols)
        push, pop = heapq.heappush, heapq.heappop
        symbols: list[str | None] = list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in ids:
                agenda.append((ranks[pair], i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, pair = pop(agenda)
            right = after[left]
            if symbols[left] is None or right >= n or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, None
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                joined = pair + symbols[right]
                if joined in ids:
                    push(agenda, (ranks[joined], left, joined))
            left = before[left]
            if left >= 0:
                joined = symbols[left] + pair
                if joined in ids:
                    push(agenda, (ranks[joined], left, joined))
        return self._numbered(symbols)

    def _numbered(self, symbols: list[str | None]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if s is None:
                continue
            if s in self.v.ids:
                out.append(self.v.ids[s])
            elif self.v.bytes:
                out += [self.v.bytes[b] for b in s.encode()]
            elif not out or out[-1] != self.v.unknown:
                out.append(self.v.unknown)
        return out

    def encode(self, text: str) -> bytes:
        """Packed ids, little-endian and with begin and end."""
        begin, end = struct.pack("<I", self.v.begin), struct.pack("<I", self.v.end)
        if not text:
            return begin + end
        text = text.replace(" ", MARK)
        parts = _PARTS.findall(MARK + text if self.v.prefix else text)
        return b"".join([begin, *map(self.kept.__getitem__, parts), end])

    def decode(self, packed: bytes) -> bytes:
        """The text of packed ids; bytes that are no UTF-8 become replacement marks, each run by itself."""
        ids = np.frombuffer(packed, "<u4").tolist()
        out = b"".join([self.v.surfaces[i] for i in ids])
        try:
            out.decode()
        except UnicodeDecodeError:
            runs, run = [], bytearray()
            for i in ids:
                if i in self.v.values:
                    run.append(self.v.values[i])
                else:
                    runs += [_replaced(run), self.v.surfaces[i]]
                    run = bytearray()
            out = b"".join([*runs, _replaced(run)])
        return out[1:] if self.v.prefix and out.startswith(b" ") else out


def _replaced(run: bytearray) -> bytes:
    """A run of byte pieces as UTF-8; each byte that belongs to no character becomes a mark."""
    codecs.register_error("bytewise-mark", lambda e: ("\ufffd", e.start + 1))
    return run.decode("utf-8", "bytewise-mark").encode()


RESULT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def summary(vocabulary: PieceVocabulary) -> Callable[[], Callable[[list[bytes]], list]]:
    def build():
        coder = Coder(vocabulary)

        def work(texts: list[bytes]) -> list:
            counts, ids, decoded = [], [], []
            for t in texts:
                packed = coder.encode(t.decode("utf-8", "replace"))
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(packed)).hexdigest())
            return [counts, ids, decoded]

        return work

    return build


def with_digests(docs: DataFrame, vocabulary: PieceVocabulary, text: str = "text", name: str = "_pieces", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with token count and digests of ids and decoded text."""
    return map_texts(docs, text, summary(vocabulary), RESULT, name, keep)


def with_ids(docs: DataFrame, vocabulary: PieceVocabulary, text: str = "text", name: str = "_pieces", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """All columns and a struct with the ids and the decoded text."""
    def build():
        coder = Coder(vocabulary)

        def work(texts: list[bytes]) -> list:
            made = [coder.encode(t.decode("utf-8", "replace")) for t in texts]
            return [[np.frombuffer(i, "<u4").astype(np.int32) for i in made], [coder.decode(i).decode() for i in made]]

        return work

    return map_texts(docs, text, build, "ids array<int>, decoded string", name, keep)


def check(docs: DataFrame, vocabulary: PieceVocabulary, path: str, text: str = "text") -> DataFrame:
    """Rows whose ids or decoded text differ from the library's; ``path`` must be readable in tasks."""
    def build():
        import sentencepiece

        coder, library = Coder(vocabulary), sentencepiece.SentencePieceProcessor(model_file=path)

        def work(texts: list[bytes]) -> list:
            plain = [t.decode("utf-8", "replace") for t in texts]
            want = library.encode(plain, add_bos=True, add_eos=True, num_threads=1)
            back = library.decode(want)
            made = [coder.encode(t) for t in plain]
            return [[np.array(w, "<u4").tobytes() == i and b.encode() == coder.decode(i)
                     for w, b, i in zip(want, back, made, strict=True)]]

        return work

    checked, name = map_texts(docs, text, build, "same boolean", "_checked")
    return checked.where(f"not {name}.same").drop(name)
