"""Tokenizers as Column functions, and fixed-length model inputs built from token ids.

A tokenizer is any object whose ``tokens``, ``ids`` and ``decode`` make Columns of Columns. Those here
are plain Spark expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import _col

IGNORED_LABEL = -100


class WhitespaceTokenizer:
    """Words between spaces; blank text has no words. Ids need a vocabulary table, so none here."""

    unk_token = "[UNK]"

    def tokens(self, text: Column | str) -> Column:
        return F.filter(F.split(F.trim(_col(text)), " +"), lambda w: w != "")

    def decode_tokens(self, tokens: Column) -> Column:
        return F.array_join(tokens, " ")


class CharTokenizer:
    """One token per character; the id is the Unicode code point."""

    unk_token = None

    def tokens(self, text: Column | str) -> Column:
        return F.filter(F.split(_col(text), ""), lambda ch: ch != "")

    def ids(self, text: Column | str) -> Column:
        return F.transform(self.tokens(text), lambda ch: F.ascii(ch))

    def decode(self, ids: Column | str) -> Column:
        # chr() stops at 255, so each code point is written as four big-endian bytes first.
        code_bytes = F.transform(_col(ids), lambda i: F.lpad(F.hex(i), 8, "0"))
        return F.decode(F.unhex(F.array_join(code_bytes, "")), "UTF-32")


def truncate(values: Column | str, n: int) -> Column:
    """The first ``n`` elements."""
    return F.slice(_col(values), 1, n)


def with_special(
    ids: Column | str, before: Sequence[int] = (), after: Sequence[int] = (), n: int | None = None
) -> Column:
    """Ids between the fixed ids that a tokenizer puts around a text. With ``n`` the result has at
    most ``n`` ids: the text's ids are cut for it, the fixed ones stay."""
    ids = _col(ids)
    if n is not None:
        ids = truncate(ids, max(0, n - len(before) - len(after)))
    fixed = [F.array(*(F.lit(i) for i in part)) if part else None for part in (before, after)]
    parts = [p for p in (fixed[0], ids, fixed[1]) if p is not None]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def pad(ids: Column | str, length: int, pad_id: int = 0) -> Column:
    """Cut or fill to exactly ``length`` ids."""
    kept = truncate(ids, length)
    return F.concat(kept, F.array_repeat(F.lit(pad_id), F.lit(length) - F.size(kept)))


def attention_mask(ids: Column | str, length: int) -> Column:
    """1 for each real position, 0 for each padded one."""
    used = F.least(F.size(_col(ids)), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(length) - used))


def mask_labels(ids: Column | str, mask: Column | str, prompt_len: Column) -> Column:
    """Ids as labels, with the first ``prompt_len`` and all padded positions ignored."""
    pairs = F.arrays_zip(_col(ids).alias("id"), _col(mask).alias("on"))
    return F.transform(
        pairs,
        lambda p, i: F.when((i < prompt_len) | (p["on"] == 0), F.lit(IGNORED_LABEL)).otherwise(p["id"]),
    )


def mlm_mask(ids: Column | str, key: Column | str, vocab_size: int, mask_id: int,
             special_ids: tuple[int, ...] = (), p: float = 0.15, seed: int = 0) -> Column:
    """Masked-language-model input: ``struct<input_ids, labels>``.

    A position is chosen with probability ``p``; of those 80 % become ``mask_id``, 10 % a random id
    and 10 % stay. All other labels are ignored. The three draws of a position are the first three
    32-bit parts of one md5 of seed, row key and position, so a retried task produces the same row and
    SQL can repeat them.
    """
    scale = 1_000_000
    key = _col(key)

    def bits(digest: Column, part: int) -> Column:
        return F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("bigint")

    def masked(x: Column, digest: Column) -> Column:
        chosen = F.pmod(bits(digest, 0), F.lit(scale)) < int(p * scale)
        if special_ids:
            chosen = chosen & ~x.isin(*special_ids)
        action = F.pmod(bits(digest, 1), F.lit(scale))
        random_id = F.pmod(bits(digest, 2), F.lit(vocab_size)).cast("int")
        replaced = (
            F.when(action < int(0.8 * scale), F.lit(mask_id))
            .when(action < int(0.9 * scale), random_id)
            .otherwise(x)
        )
        # Null where the position is not chosen, so the draw is looked at once.
        return F.when(chosen, F.struct(replaced.alias("id"), x.alias("label")))

    def position(x: Column, i: Column) -> Column:
        named = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), i.cast("string")))
        cell = F.transform(F.array(named), lambda digest: masked(x, digest))[0]
        return F.struct(x.alias("x"), cell.alias("cell"))

    def split(cells: Column) -> Column:
        return F.struct(
            F.transform(cells, lambda c: F.coalesce(c["cell"]["id"], c["x"])).alias("input_ids"),
            F.transform(cells, lambda c: F.coalesce(c["cell"]["label"], F.lit(IGNORED_LABEL))).alias("labels"),
        )

    return F.transform(F.array(F.transform(_col(ids), position)), split)[0]
