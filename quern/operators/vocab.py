"""Vocabulary mining: characters, words, subword pairs, candidate tokens."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import _col, strip_ws
from quern.operators.bpe import train_bpe
from quern.operators.order import row_index
from quern.session import materialize, materialize_counted

# Bytes of a part of a pack of texts, parts of a pack at most, and bits that number the parts of a task.
PACK_PART = 1 << 20
PACK_PARTS = 16
PACK_BITS = 32


def char_counts(df: DataFrame, text: str, freq: str | None = None) -> DataFrame:
    """Occurrences of each character, spaces left out. ``freq`` is how often a row counts: the words of a corpus with
    their counts hold each of its characters that is no space."""
    chars = df.select(F.explode(F.split(F.col(text), "")).alias("char"), (F.lit(1) if freq is None else F.col(freq)).alias("n"))
    counted = F.count("*") if freq is None else F.sum("n")
    return chars.where(~F.col("char").rlike(r"^(?:|\s|\p{Z})$")).groupBy("char").agg(counted.alias("freq"))


def char_vocab(df: DataFrame, text: str, coverage: float = 0.9995, freq: str | None = None) -> DataFrame:
    """The most frequent characters that together reach the coverage: ``char``, ``freq``, ``rank``.

    The windows run over the table of distinct characters, which Unicode bounds to about a million.
    """
    by_freq = Window.orderBy(F.desc("freq"), "char")
    before = by_freq.rowsBetween(Window.unboundedPreceding, -1)
    ranked = char_counts(df, text, freq).select(
        "char", "freq",
        F.row_number().over(by_freq).alias("rank"),
        F.coalesce(F.sum("freq").over(before), F.lit(0)).alias("before"),
        F.sum("freq").over(Window.partitionBy()).alias("total"),
    )
    return ranked.where(F.col("before") < F.col("total") * coverage).select("char", "freq", "rank")


def split_words(text: Column | str, split_digits: bool = True) -> Column:
    """Words between spaces; with ``split_digits`` each digit is a word of its own."""
    text = _col(text)
    if split_digits:
        text = F.regexp_replace(text, r"(\p{Nd})", " $1 ")
    return F.filter(F.split(text, r"[\s\p{Z}]+"), lambda w: w != "")


def word_counts(df: DataFrame, text: str, split_digits: bool = True) -> DataFrame:
    """Occurrences of each word: ``word``, ``freq``."""
    words = df.select(F.explode(split_words(text, split_digits)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("freq"))


#: Stands before a word that a space or the start of the text precedes.
BOUNDARY = "▁"
#: Scripts whose letters make words of their own; those of one group mix within a word.
SCRIPTS = (("Han", "Hiragana", "Katakana", "Bopomofo"), ("Latin",), ("Cyrillic",), ("Greek",), ("Arabic",), ("Hebrew",), ("Thai",), ("Lao",),
           ("Devanagari",), ("Hangul",), ("Armenian",), ("Georgian",), ("Khmer",), ("Myanmar",))


def script_words(re2: bool = False) -> str:
    """A pattern whose matches are the words of a marked text: letters of one script group with their combining marks,
    other letters, single digits, other characters. ``re2`` spells script names for SQL engines with that syntax."""
    name = (lambda s: rf"\p{{{s}}}") if re2 else (lambda s: rf"\p{{Is{s}}}")
    groups = ["".join(map(name, g)) for g in SCRIPTS]
    listed = "".join(groups)
    runs = [rf"[{g}][{g}\p{{M}}]*" for g in groups]
    other = rf"[^\s{BOUNDARY}\p{{N}}\p{{M}}{listed}]"
    marks = rf"(?:{other})[^\s{BOUNDARY}\p{{N}}{listed}]*"
    return rf"{BOUNDARY}?(?:{'|'.join(runs)}|\p{{N}}|{marks}|\p{{M}}+)"


def _marked(text: Column | str) -> Column:
    """The text with one space between stretches, and ``BOUNDARY`` before each."""
    return F.concat(F.lit(BOUNDARY), F.regexp_replace(F.regexp_replace(_col(text), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""), r"[\s\p{Z}]+", f" {BOUNDARY}"))


def _marked_words(marked: Column | str) -> Column:
    words = F.regexp_extract_all(_col(marked), F.lit(script_words()), F.lit(0))
    return F.filter(words, lambda w: w != BOUNDARY)


def split_by_script(text: Column | str) -> Column:
    """Words of a text by script, so that text without spaces has words: each run of letters of one script group, each
    digit and each run of other characters; a word after a space or at the start begins with ``BOUNDARY``."""
    return _marked_words(_marked(text))


def word_counts_by_script(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each word of ``split_by_script``: ``word``, ``freq``. No word goes over a space, so equal
    stretches between spaces are counted first and split once."""
    stretches = df.select(F.explode(F.split(_marked(text), " ")).alias("stretch")).groupBy("stretch").agg(F.count("*").alias("n"))
    words = stretches.select("n", F.explode(_marked_words("stretch")).alias("word"))
    return words.groupBy("word").agg(F.sum("n").alias("freq"))


def byte_tokens(char: Column | str) -> Column:
    """UTF-8 bytes of a character as ``<0xNN>`` tokens."""
    pairs = F.regexp_extract_all(F.hex(F.encode(_col(char), "UTF-8")), F.lit("(..)"), F.lit(1))
    return F.transform(pairs, lambda b: F.concat(F.lit("<0x"), b, F.lit(">")))


def byte_fallback(df: DataFrame, text: str, vocab: DataFrame) -> DataFrame:
    """Characters outside ``vocab`` (column ``char``) with their byte tokens and frequency."""
    rare = char_counts(df, text).join(vocab.select("char"), "char", "left_anti")
    return rare.select("char", "freq", byte_tokens("char").alias("tokens"))


def word_symbols(words: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """Words as symbol arrays: characters, or byte tokens for characters outside ``vocab``."""
    if vocab is None:
        return words.select("word", "freq", F.split("word", "").alias("symbols"))
    chars = words.select("word", "freq", F.posexplode(F.split("word", "")).alias("at", "char"))
    # Bounded by the number of Unicode characters.
    known = F.broadcast(vocab.select("char", F.lit(True).alias("known")))
    symbols = chars.join(known, "char", "left").select(
        "word", "freq", "at",
        F.when(F.col("known"), F.array("char")).otherwise(byte_tokens("char")).alias("part"),
    )
    # One group per distinct word, as long as that word.
    parts = symbols.groupBy("word", "freq").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
    return parts.select("word", "freq", F.flatten(F.col("parts.part")).alias("symbols"))


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent symbol pairs weighted by word frequency: ``left``, ``right``, ``freq``."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("symbols") - 1),
        lambda i: F.struct(
            F.get(F.col("symbols"), i - 1).alias("left"), F.get(F.col("symbols"), i).alias("right")
        ),
    )
    listed = words.where(F.size("symbols") > 1).select("freq", F.inline(pairs))
    return listed.groupBy("left", "right").agg(F.sum("freq").alias("freq"))


def learn_bpe(words: DataFrame, merges: int | None = None, **options) -> DataFrame:
    """The merges of ``bpe.train_bpe``, which also has the options: ``rank``, ``left``, ``right``, ``token``, ``freq``."""
    return train_bpe(words, merges, **options).merges


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the part of a pack that they belong to: the task, and how many bytes it has met before in `PACK_PART`."""
    task, before = TaskContext.get().partitionId() << PACK_BITS, 0
    for batch in batches:
        upto = before + np.cumsum(pc.fill_null(pc.binary_length(batch.column("_words")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        pack = np.concatenate(([before], upto[:-1])) // PACK_PART if len(upto) else upto
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(task + pack, pa.int64())], [*batch.schema.names, "_pack"])
        before = int(upto[-1]) if len(upto) else before


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each pack; the rows of a pack that a task reads follow each other."""
    held, pack = [], None

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            words = pc.unique(pa.chunked_array(held))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), pack), pa.int64()), words], ["_pack", "word"])
            held.clear()

    for batch in batches:
        at = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if pack != at[low]:
                yield from flush()
                pack = at[low]
            words = pc.split_pattern(batch.column(1).slice(low, high - low), " ").flatten()
            if len(words):
                held.append(pc.unique(words))
    yield from flush()


class PieceTable:
    """A tokenizer that is a table: each word's pieces, as ``bpe.train_bpe`` leaves them.

    It works on whole tables of texts: words are looked up by a join, so no vocabulary has to fit into an
    expression. The table is broadcast while it has fewer than ``broadcast_rows`` rows, else the join is dealt
    out by word and a salt, so that a frequent word spreads over ``salts`` tasks. Words outside the table
    are unknown; each counts as one piece.
    """

    def __init__(self, pieces: DataFrame, split_digits: bool = True, unk_token: str = "<unk>",
                 broadcast_rows: int = 200_000, salts: int = 16):
        self.pieces = pieces.select("word", "pieces")
        self.split_digits, self.unk_token = split_digits, unk_token
        self.salts = salts if self.pieces.limit(broadcast_rows).count() >= broadcast_rows else 0

    def words(self, text: Column | str) -> Column:
        return split_words(text, self.split_digits)

    def look_up(self, rows: DataFrame, place: Sequence[str]) -> DataFrame:
        """``rows`` (column ``word``) with ``pieces``, null for unknown words. ``place`` tells rows apart."""
        if not self.salts:
            return rows.join(F.broadcast(self.pieces), "word", "left")
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*place), F.lit(self.salts)).cast("int"))
        spread = self.pieces.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
        return salted.join(spread, ["word", "_salt"], "left").drop("_salt")

    def encode(self, df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
        """``order`` and ``tokens``: the pieces of each text, none for a blank or null one. Texts of one order are one text.

        Texts are written once, in packs of some MB. Of a pack only its distinct words meet the table; its texts
        then meet their words' pieces in one task, so no text moves word by word."""
        order = list(order)
        spark, schema = df.sparkSession, df.select(*order).schema
        # No word holds a space; a text without words is null.
        joined = df.select(*order, F.nullif(F.array_join(self.words(text), " "), F.lit("")).alias("_words"))
        packed = joined.mapInArrow(_packs, T.StructType([*schema, T.StructField("_words", T.StringType()), T.StructField("_pack", T.LongType())]))
        texts, seen = materialize_counted(packed, "piece-texts", bytes=F.sum(F.octet_length("_words")))
        # Whole packs while there are enough for all cores.
        share = max(1, min(PACK_PARTS, (seen["bytes"] or 0) // (4 * spark.sparkContext.defaultParallelism * PACK_PART)))
        low = F.col("_pack").bitwiseAND(F.lit((1 << PACK_BITS) - 1))
        texts = texts.withColumn("_pack", F.col("_pack") - low + F.floor(low / F.lit(share)))
        repeated = materialize(texts.groupBy(*order).agg(F.count("*").alias("_n")).where("_n > 1"), "piece-repeated")
        if repeated.isEmpty():
            return self._by_packs(texts, order, schema)
        other = repeated.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)))
        same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(order)))
        alone, rest = texts.join(other, same, "left_anti"), texts.join(other, same, "left_semi")
        return self._by_packs(alone, order, schema).unionByName(self._by_words(rest, order))

    def _by_packs(self, texts: DataFrame, order: Sequence[str], schema: T.StructType) -> DataFrame:
        spark, unk = texts.sparkSession, self.unk_token
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        wanted = texts.select("_pack", "_words").mapInArrow(_distinct_words, "_pack bigint, word string")
        # A word that the table has several times has all its pieces.
        known = self.pieces.where(F.col("word").isNotNull()).groupBy("word").agg(
            F.flatten(F.sort_array(F.collect_list(F.coalesce("pieces", F.array(F.lit(unk)))))).alias("pieces"))
        found = wanted.repartition(parts, "word").distinct().join(known, "word", "left").select(
            "_pack", "word", F.coalesce("pieces", F.array(F.lit(unk))).alias("pieces"))

        def put(words: pa.Table, lines: pa.Table) -> pa.Table:
            listed = pc.split_pattern(lines["_words"].combine_chunks(), " ")
            known, pieces = words["word"].combine_chunks(), words["pieces"].combine_chunks()
            at = pc.index_in(listed.flatten(), known)
            ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False))))
            tokens = np.concatenate(([0], np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False)[at.to_numpy(zero_copy_only=False)]))) if len(at) else np.zeros(1, np.int64)
            values = pieces.take(at).flatten()
            return pa.table([*(lines[c] for c in order), pa.ListArray.from_arrays(pa.array(tokens[ends], pa.int32()), values)], [*order, "tokens"])

        out = T.StructType([*schema, T.StructField("tokens", T.ArrayType(T.StringType()))])
        return found.groupBy("_pack").cogroup(texts.groupBy("_pack")).applyInArrow(put, out)

    def _by_words(self, texts: DataFrame, order: Sequence[str]) -> DataFrame:
        words = texts.select(*order, F.posexplode_outer(F.split("_words", " ")).alias("at", "word"))
        found = self.look_up(words, [*order, "at"])
        parts = F.when(F.col("word").isNull(), F.array().cast("array<string>")).otherwise(F.coalesce("pieces", F.array(F.lit(self.unk_token))))
        # One group per text, as long as that text.
        listed = found.groupBy(*order).agg(F.sort_array(F.collect_list(F.struct("at", parts.alias("parts")))).alias("all"))
        return listed.select(*order, F.flatten(F.col("all.parts")).alias("tokens"))

    def broken_up(self, lines: DataFrame, text: str, order: Sequence[str], most: int) -> DataFrame:
        """``order`` and ``text`` of the lines with more than ``most`` pieces or an unknown word.

        A word has a piece at least, so only lines of at most ``most`` words are looked up; they carry their text."""
        lines = lines.select(*order, text)
        count = F.size(self.words(text))
        words = lines.where(count <= most).select(*order, text, F.posexplode(self.words(text)).alias("_at", "word"))
        found = self.look_up(words, [*order, "_at"])
        judged = found.groupBy(*order).agg(
            F.any_value(text).alias(text), F.sum(F.coalesce(F.size("pieces"), F.lit(1))).alias("_n"), F.bool_or(F.col("pieces").isNull()).alias("_odd"))
        few = judged.where((F.col("_n") > most) | F.col("_odd")).select(*order, text)
        return lines.where(count > most).unionByName(few)

    def token_freq(self, lines: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
        """``token``, ``freq`` and ``first_seen`` (order, word, piece). Words are counted before they are looked up."""
        words = lines.select(*order, F.posexplode(self.words(text)).alias("at", "word"))
        counted = words.groupBy("word").agg(F.count("*").alias("n"), F.min(F.struct(*order, "at")).alias("seen"))
        found = counted.join(self.pieces, "word", "left")
        parts = F.coalesce("pieces", F.array(F.lit(self.unk_token)))
        spread = found.select("n", "seen", F.posexplode(parts).alias("piece", "token"))
        return spread.groupBy("token").agg(
            F.sum("n").alias("freq"), F.min(F.struct(*(F.col("seen")[c].alias(c) for c in (*order, "at")), "piece")).alias("first_seen"))


def fragmented_token_freq(
    df: DataFrame, text: str, order: Sequence[str], base, aux, max_base_pieces: int = 3,
    known: DataFrame | None = None,
) -> DataFrame:
    """Auxiliary tokens on lines the base tokenizer breaks up: ``token``, ``freq``, ``first_seen``.

    Either tokenizer makes Columns of Columns or is a ``PieceTable``. A line counts when the base tokenizer needs more than ``max_base_pieces`` tokens, or yields its
    unknown token. A tokenizer that works from a word list passes that list as ``known`` (column
    ``token``): base words outside it count as unknown.
    """
    lines = df.select(*order, strip_ws(text).alias("line")).where(F.col("line") != "")
    # Read for long and for short lines; what made the lines runs once.
    lines = materialize(lines, "fragmented-lines")
    if isinstance(base, PieceTable):
        hits = base.broken_up(lines, "line", order, max_base_pieces)
    else:
        hits = _broken_up(lines, order, base, max_base_pieces, known)
    if isinstance(aux, PieceTable):
        return aux.token_freq(hits, "line", order)
    seen = hits.select(*order, F.posexplode(aux.tokens("line")).alias("at", "token"))
    return seen.groupBy("token").agg(
        F.count("*").alias("freq"), F.min(F.struct(*order, "at")).alias("first_seen")
    )


def _broken_up(lines: DataFrame, order: Sequence[str], base, max_base_pieces: int, known: DataFrame | None) -> DataFrame:
    pieces = base.tokens("line")
    many = F.size(pieces) > max_base_pieces
    if known is not None:
        # Lines of few words carry their text to the verdict, so it is not looked up again.
        few = lines.where(~many).select(*order, "line", F.explode(pieces).alias("token"))
        found = few.join(known.select("token").distinct().withColumn("_known", F.lit(True)), "token", "left")
        odd = found.groupBy(*order).agg(F.any_value("line").alias("line"), F.bool_or(F.col("_known").isNull()).alias("_odd"))
        return lines.where(many).unionByName(odd.where("_odd").select(*order, "line"))
    if base.unk_token is not None:
        return lines.where(many | F.array_contains(pieces, base.unk_token))
    return lines.where(many)


def candidate_tokens(freq: DataFrame, vocab: DataFrame, min_freq: int = 5) -> DataFrame:
    """Frequent tokens the vocabulary lacks; sort by descending ``freq``, then ``first_seen``."""
    frequent = freq.where(F.col("freq") >= min_freq)
    return frequent.join(vocab.select("token"), "token", "left_anti")


def extend_vocab(vocab: DataFrame, tokens: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The vocabulary (``token``, ``id``) with new tokens appended under the next free ids.

    Repeated tokens count once, at their first place. ``added`` marks the new rows.
    """
    ranks = [F.col(c) if isinstance(c, str) else c for c in order]
    named = tokens.select("token", F.struct(*(c.alias(f"k{i}") for i, c in enumerate(ranks))).alias("place"))
    new = named.join(vocab.select("token"), "token", "left_anti")
    new = new.groupBy("token").agg(F.min("place").alias("place"))
    numbered = row_index(new, ["place"], name="at")
    last = vocab.agg(F.max("id").alias("last")).first()["last"]
    free = 0 if last is None else last + 1
    appended = numbered.select(
        "token", (F.col("at") + free).cast("bigint").alias("id"), F.lit(True).alias("added")
    )
    return vocab.select("token", F.col("id").cast("bigint").alias("id"), F.lit(False).alias("added")).unionByName(appended)


def compare_tokenizers(df: DataFrame, text: str, base, new) -> DataFrame:
    """Sample count, mean token count under both tokenizers, and the change."""
    lengths = df.select(F.size(base.tokens(text)).alias("base"), F.size(new.tokens(text)).alias("new"))
    return lengths.agg(
        F.count("*").alias("samples"),
        F.avg("base").alias("avg_len_base"),
        F.avg("new").alias("avg_len_new"),
        (F.avg("new") - F.avg("base")).alias("delta_len"),
    )
