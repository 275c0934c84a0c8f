"""Text normalisation and field extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The patterns that decide what cleaning removes.
HTML_TAG = r"<[^>]+>"
MARKDOWN_LINK = r"\[([^\]]+)\]\(([^)]+)\)"
# Categories a terminal cannot print, less the four characters that count as ordinary spacing.
# \p{C} is not used: it would also delete characters that are newer than the JVM's Unicode tables.
NON_PRINTABLE = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Z}&&[^\t\n\r ]]"
UNICODE_SPACE = r"[\x1c-\x1f\x{85}\s\p{Z}]+"
NOT_SPACE = r"[^\x1c-\x1f\x{85}\s\p{Z}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_html(c: Column | str) -> Column:
    """Each markup tag becomes one space; text between tags stays."""
    return F.regexp_replace(_col(c), HTML_TAG, " ")


def strip_md_links(c: Column | str) -> Column:
    """``[label](target)`` becomes ``label``."""
    return F.regexp_replace(_col(c), MARKDOWN_LINK, "$1")


def strip_nonprintable(c: Column | str) -> Column:
    """Delete control, format and non-ASCII space characters (tab, LF, CR and space stay)."""
    return F.regexp_replace(_col(c), NON_PRINTABLE, "")


def collapse_ws(c: Column | str) -> Column:
    """Runs of ASCII whitespace become one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def normalize_text(c: Column | str) -> Column:
    """Tags, then Markdown links, then non-printable characters, then whitespace."""
    return collapse_ws(strip_nonprintable(strip_md_links(strip_html(c))))


def normalize_ws(c: Column | str) -> Column:
    """Runs of any Unicode whitespace become one space; nothing else changes."""
    return F.trim(F.regexp_replace(_col(c), UNICODE_SPACE, " "))


def strip_ws(c: Column | str) -> Column:
    """Any Unicode whitespace off both ends."""
    return F.regexp_replace(_col(c), f"^{UNICODE_SPACE}|{UNICODE_SPACE}$", "")


def is_blank(c: Column | str) -> Column:
    """True for null and for text made of whitespace only."""
    return ~F.coalesce(_col(c).rlike(NOT_SPACE), F.lit(False))


def once(c: Column) -> Column:
    """The value through a generator, for use in a select as ``once(expr).alias(name)``.

    Spark copies an expression into every filter above it. It does not move filters below a
    generator, so a costly value that later filters look at is computed one time per row.
    """
    return F.explode(F.array(c))


def content_md5(*cols: Column | str) -> Column:
    """MD5 hex of the text, or of several texts joined by newlines."""
    parts = [_col(c) for c in cols]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("\n", *parts))


def _truthy_text(df: DataFrame, name: str) -> Column:
    """The field as text, or null when it is null, empty, zero or false."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.StringType):
        return F.nullif(value, F.lit(""))
    if isinstance(kind, T.BooleanType):
        return F.when(value, value.cast("string"))
    if isinstance(kind, T.NumericType):
        return F.when(value != 0, value.cast("string"))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.size(value) > 0, F.to_json(value))
    if isinstance(kind, (T.StructType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def coalesce_text(df: DataFrame, fields: Sequence[str], text: str = "text") -> Column:
    """``text`` when it is not null, else the non-empty ``fields`` joined by newlines.

    An empty string in ``text`` counts as present. Fields the frame lacks are skipped.
    """
    found = [_truthy_text(df, f) for f in fields if f in df.columns and f != text]
    joined = F.nullif(F.concat_ws("\n", *found), F.lit("")) if found else F.lit(None).cast("string")
    if text not in df.columns:
        return joined
    return F.coalesce(F.col(text).cast("string"), joined)


def _is_object(item: Column) -> Column:
    """Whether a VARIANT value is an object: only objects read as a map."""
    return F.try_variant_get(item, "$", "map<string,variant>").isNotNull()


def _content(item: Column) -> Column:
    """The text of a VARIANT item: ``content`` of an object, else the item itself; lists and objects as JSON."""
    return F.when(_is_object(item), F.try_variant_get(item, "$.content", "string")).otherwise(
        F.try_variant_get(item, "$", "string"))


def dialog_to_text(dialog: Column | str, kind: T.DataType) -> Column:
    """Join the turns of a dialog by newlines, leaving out blank turns.

    ``kind`` is the column type: an array of strings, an array of structs with ``content``, or a
    VARIANT holding a list whose items may be either.
    """
    dialog = _col(dialog)
    if isinstance(kind, T.VariantType):
        dialog, part = F.try_variant_get(dialog, "$", "array<variant>"), _content
    elif isinstance(kind.elementType, T.StructType):

        def part(item: Column) -> Column:
            return item["content"].cast("string")

    else:

        def part(item: Column) -> Column:
            return item.cast("string")

    parts = F.transform(dialog, lambda item: F.coalesce(part(item), F.lit("")))
    return F.array_join(F.filter(parts, lambda p: ~is_blank(p)), "\n")


def explode_dialog(df: DataFrame, dialog: str, keep: Sequence[str]) -> DataFrame:
    """One row per item of a VARIANT dialog: the ``keep`` columns, ``turn`` (from 0), ``role`` and ``text``.

    Every item has a row, so turns keep their numbers: ``role`` is null where the item is no object or has none,
    ``text`` where it is null or an object without content. A dialog that is no list has no rows.
    """
    items = F.try_variant_get(F.col(dialog), "$", "array<variant>")
    rows = df.select(*keep, F.posexplode(items).alias("turn", "_item"))
    return rows.select(*keep, "turn", F.try_variant_get("_item", "$.role", "string").alias("role"),
                       _content(F.col("_item")).alias("text"))


def dialog_size(dialog: Column | str, kind: T.DataType) -> Column:
    """Number of turns, or null when the value is not a list."""
    dialog = _col(dialog)
    if isinstance(kind, T.VariantType):
        dialog = F.try_variant_get(dialog, "$", "array<variant>")
    return F.when(dialog.isNotNull(), F.size(dialog))


def explode_lines(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """One row per non-blank line: the ``keep`` columns, ``line_no`` (from 0) and ``line``."""
    lines = df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return lines.where(~is_blank("line"))
