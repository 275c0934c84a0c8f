"""Training records: plain text and packed blocks for pre-training, masked ids for fine-tuning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.chat import (
    ChatTemplate, answer_parts, chatml_pair, chatml_prompt, instruction_answer, instruction_prompt,
    messages_to_text, prompt_text, render_template, sharegpt_to_messages, sharegpt_to_text,
)
from quern.functions.text import once, strip_ws
from quern.functions.tokens import IGNORED_LABEL, attention_mask, mask_labels, pad, truncate, with_special
from quern.operators.blocks import pack_blocks
from quern.operators.order import head


def collect_messages(
    df: DataFrame, conv: str, turn: str, role: str, content: str, max_turns: int = 0
) -> DataFrame:
    """Turn rows gathered into one ``messages`` array per conversation, in turn order.

    One conversation becomes one record. ``max_turns`` drops longer conversations before their turns
    are gathered; the counts behind it are summed ahead of the shuffle.
    """
    if max_turns > 0:
        short = df.groupBy(conv).agg(F.count("*").alias("_n")).where(F.col("_n") <= max_turns)
        df = df.join(short.select(conv), conv, "left_semi")
    turns = F.sort_array(F.collect_list(F.struct(turn, F.col(role).alias("role"), F.col(content).alias("content"))))
    gathered = df.groupBy(conv).agg(turns.alias("_turns"))
    return gathered.select(
        conv, F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages")
    )


def extract_text(df: DataFrame, fields: Sequence[str] = ("text",)) -> Column:
    """Text of a pre-training record: the first field that is not blank, else its conversation."""
    def field(name: str) -> Column:
        kind = df.schema[name].dataType
        value = F.col(name)
        if isinstance(kind, T.ArrayType):
            value = F.array_join(value.cast("array<string>"), " ")
        elif isinstance(kind, T.BooleanType):
            value = F.when(value, value.cast("string"))
        elif isinstance(kind, T.NumericType):
            value = F.when(value != 0, value.cast("string"))
        return F.nullif(strip_ws(value.cast("string")), F.lit(""))

    sources = [field(f) for f in fields if f in df.columns]
    if "messages" in df.columns:
        sources.append(F.nullif(messages_to_text("messages"), F.lit("")))
    if "conversations" in df.columns:
        sources.append(F.nullif(sharegpt_to_text("conversations"), F.lit("")))
    return F.coalesce(*sources, F.lit(""))


def pretraining_texts(df: DataFrame, order: Sequence[str], fields: Sequence[str] = ("text",)) -> DataFrame:
    """Order columns and non-empty ``text``."""
    return df.select(*order, once(extract_text(df, fields)).alias("text")).where(F.col("text") != "")


def pretraining_blocks(
    df: DataFrame, tokenizer, order: Sequence[str], block_size: int, fields: Sequence[str] = ("text",),
    batch_rows: int = 1000, before: Sequence[int] = (), after: Sequence[int] = (),
) -> DataFrame:
    """Records to fixed-size blocks with labels; ``before`` and ``after`` are ids around each text."""
    texts = pretraining_texts(df, order, fields)
    ids = texts.select(*order, with_special(tokenizer.ids("text"), before, after).alias("ids"))
    return pack_blocks(ids, "ids", block_size, order, batch_rows)


def sft_texts(df: DataFrame, template: ChatTemplate, keep: Sequence[str], named_only: bool = False,
              generation: bool = False) -> DataFrame:
    """The full text and the prompt text of a record of any supported shape; with ``generation`` a
    prompt of messages ends where the answer opens.

    ShareGPT turns and messages go through the template; single question-answer records are ChatML.
    """
    if "conversations" in df.columns or "messages" in df.columns:
        messages = sharegpt_to_messages("conversations") if "conversations" in df.columns else F.col("messages")
        rows = df.select(*keep, once(messages).alias("_m"))
        return rows.select(
            *keep, render_template("_m", template, named_only).alias("full_text"),
            prompt_text("_m", template, named_only, generation).alias("prompt_text"),
        )
    prompt, answer = instruction_prompt(df), instruction_answer(df)
    return df.select(*keep, chatml_pair(prompt, answer).alias("full_text"), chatml_prompt(prompt).alias("prompt_text"))


def sft_records(texts: DataFrame, tokenizer, max_length: int, keep: Sequence[str], pad_id: int = 0,
                before: Sequence[int] = (), after: Sequence[int] = ()) -> DataFrame:
    """``input_ids``, ``attention_mask`` and ``labels`` of exactly ``max_length`` positions.

    As many leading labels are ignored as the prompt text has tokens, and all padding is. ``before``
    and ``after`` are the ids a tokenizer puts around every text, prompts that are not empty included.
    """
    prompt = F.when(F.col("prompt_text") == "", F.array().cast("array<int>")).otherwise(
        with_special(tokenizer.ids("prompt_text"), before, after))
    full = with_special(tokenizer.ids("full_text"), before, after, max_length if before or after else None)
    ids = texts.select(*keep, full.alias("ids"), prompt.alias("prompt"))
    # Fixed per row before the per-position step, which would otherwise evaluate it at each position.
    sized = F.struct("ids", F.least(F.size("prompt"), F.lit(max_length)).alias("prompt_len"))
    ids = ids.select(*keep, once(sized).alias("s")).select(*keep, "s.*")
    padded = ids.select(
        *keep, "prompt_len", pad("ids", max_length, pad_id).alias("input_ids"),
        attention_mask("ids", max_length).alias("attention_mask"),
    )
    labels = mask_labels("input_ids", "attention_mask", F.col("prompt_len"))
    return padded.select(*keep, "input_ids", "attention_mask", labels.alias("labels"))


def sft_span_records(df: DataFrame, template: ChatTemplate, tokenizer, max_length: int, keep: Sequence[str],
                     pad_id: int = 0, before: Sequence[int] = (), after: Sequence[int] = (),
                     named_only: bool = False) -> DataFrame:
    """As `sft_records` for ``messages``, but every answer keeps its labels and all else is ignored.

    The parts of a message are tokenised by themselves, so no token spans what is learned and what is
    not. ``before`` is ignored too; ``after`` ends the record and is learned.
    """
    def cells(ids: Column, learned: Column) -> Column:
        return F.transform(ids, lambda x: F.struct(
            x.alias("id"), F.when(learned, x).otherwise(F.lit(IGNORED_LABEL)).alias("label")))

    def fixed(ids: Sequence[int], learned: bool) -> Column:
        return cells(F.array(*(F.lit(i) for i in ids)).cast("array<int>"), F.lit(learned))

    each = F.transform(
        answer_parts("messages", template, named_only),
        lambda p: F.concat(cells(tokenizer.ids(p["open"]), F.lit(False)), cells(tokenizer.ids(p["body"]), p["answer"])),
    )
    room = max(0, max_length - len(before) - len(after))
    whole = F.concat(fixed(before, False), truncate(F.flatten(each), room), fixed(after, True))
    rows = df.select(*keep, once(whole).alias("_c"))
    ids, labels = F.transform("_c", lambda c: c["id"]), F.transform("_c", lambda c: c["label"])
    return rows.select(
        *keep, pad(ids, max_length, pad_id).alias("input_ids"), attention_mask("_c", max_length).alias("attention_mask"),
        pad(labels, max_length, IGNORED_LABEL).alias("labels"),
    )


def training_columns(df: DataFrame) -> DataFrame:
    """Only what a trainer reads."""
    return df.select("input_ids", "attention_mask", "labels")


def calibration_sample(df: DataFrame, n: int, order: Sequence[str], text: str = "text", min_chars: int = 100,
                       strip: bool = False) -> DataFrame:
    """The first ``n`` texts longer than ``min_chars`` characters; ``strip`` takes white space off first."""
    if strip:
        df = df.withColumn(text, once(strip_ws(text)))
    return head(df.where(F.length(text) > min_chars), n, order)


def truncate_text(text: Column | str, tokenizer, n: int) -> Column:
    """The text of the first ``n`` tokens."""
    return tokenizer.decode(truncate(tokenizer.ids(text), n))
