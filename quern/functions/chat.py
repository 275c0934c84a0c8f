"""Conversation records: shapes, plain text, chat templates.

Messages are ``array<struct<role: string, content: string>>``; ShareGPT turns are
``array<struct<from: string, value: string>>``. Null roles and contents count as empty text.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import _col, strip_ws

# Speaker names per target format.
SHAREGPT_TO_MESSAGE_ROLE = {"human": "user", "gpt": "assistant", "system": "system"}
SHAREGPT_TO_PLAIN_ROLE = {"human": "User", "gpt": "Assistant"}


@dataclass(frozen=True)
class ChatTemplate:
    """Text around each role's content, and the text between messages."""

    roles: Mapping[str, str] = field(default_factory=dict)
    separator: str = ""
    # What opens an answer; a prompt that asks for one ends with it.
    generation: str = ""


# The chat formats of the model families a training set is rendered for.
TEMPLATES = {
    "baichuan2": ChatTemplate({
        "system": "<reserved_106>{system}",
        "user": "<reserved_106>{content}",
        "assistant": "<reserved_107>{content}",
    }),
    "chatglm3": ChatTemplate({
        "system": "[gMASK]sop<|system|>\n{system}",
        "user": "<|user|>\n{content}",
        "assistant": "<|assistant|>\n{content}",
    }),
    "deepseek": ChatTemplate({
        "system": "<｜begin▁of▁sentence｜>{system}\n\n",
        "user": "User: {content}\n\n",
        "assistant": "Assistant: {content}<｜end▁of▁sentence｜>",
    }),
    "llama3": ChatTemplate({
        "system": "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>",
        "user": "<|start_header_id|>user<|end_header_id|>\n\n{input}<|eot_id|>",
        "assistant": "<|start_header_id|>assistant<|end_header_id|>\n\n{output}<|eot_id|>",
    }),
    "chatml": ChatTemplate({
        "system": "<|im_start|>system\n{system}<|im_end|>",
        "user": "<|im_start|>user\n{input}<|im_end|>",
        "assistant": "<|im_start|>assistant\n{output}<|im_end|>",
    }, generation="<|im_start|>assistant\n"),
}
PLACEHOLDERS = ("{system}", "{content}", "{input}", "{output}")


def parse_template(text: str) -> ChatTemplate:
    """A template from its JSON form: ``messages`` (objects with ``role`` and ``template``) and an
    optional ``separator``. What stands before the placeholder of the assistant opens an answer."""
    found = json.loads(text)
    roles = {m["role"]: m["template"] for m in found.get("messages") or []}
    answer = roles.get("assistant", "")
    used = next((p for p in PLACEHOLDERS if p in answer), None)
    return ChatTemplate(roles, found.get("separator") or "", answer.split(used)[0] if used else "")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _rename(role: Column, names: Mapping[str, str]) -> Column:
    out = role
    for old, new in names.items():
        out = F.when(role == old, F.lit(new)).otherwise(out)
    return out


def _speaker_lines(turns: Column, role: str, content: str, names: Mapping[str, str]) -> Column:
    def line(t: Column) -> Column:
        return strip_ws(F.concat(_rename(_text(t[role]), names), F.lit(": "), _text(t[content])))

    return F.array_join(F.transform(turns, line), "\n")


def messages_to_text(messages: Column | str) -> Column:
    """``role: content`` lines in order."""
    return _speaker_lines(_col(messages), "role", "content", {})


def sharegpt_to_text(turns: Column | str) -> Column:
    """``User: …`` / ``Assistant: …`` lines; other speakers keep their name."""
    return _speaker_lines(_col(turns), "from", "value", SHAREGPT_TO_PLAIN_ROLE)


def sharegpt_to_messages(turns: Column | str) -> Column:
    """ShareGPT turns as messages; unknown speakers keep their name as role."""
    return F.transform(
        _col(turns),
        lambda t: F.struct(
            _rename(_text(t["from"]), SHAREGPT_TO_MESSAGE_ROLE).alias("role"),
            _text(t["value"]).alias("content"),
        ),
    )


def instruction_prompt(df: DataFrame) -> Column:
    """``instruction`` and ``input`` joined by a newline, or whichever of them is not empty."""
    parts = [F.nullif(F.col(c), F.lit("")) for c in ("instruction", "input") if c in df.columns]
    return F.concat_ws("\n", *parts)


def instruction_answer(df: DataFrame) -> Column:
    """``output``, or ``response`` where the record has no ``output``."""
    parts = [F.col(c) for c in ("output", "response") if c in df.columns]
    return F.coalesce(*parts, F.lit(""))


def instruction_to_messages(df: DataFrame) -> Column:
    """Instruction, Alpaca and question-answer records as a user and an assistant message."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(
        message("user", instruction_prompt(df)), message("assistant", instruction_answer(df))
    )


def _fill(template: str, placeholders: tuple[str, ...], content: Column) -> Column:
    used = next((p for p in placeholders if p in template), None)
    if used is None:
        return content
    pieces: list[Column] = []
    for i, fixed in enumerate(template.split(used)):
        if i:
            pieces.append(content)
        if fixed:
            pieces.append(F.lit(fixed))
    return F.concat(*pieces)


def render_message(m: Column, template: ChatTemplate, named_only: bool = False) -> Column:
    """One message as its role's template has it."""
    content = _text(m["content"])
    out = content
    for role, text in template.roles.items():
        fill = PLACEHOLDERS
        if named_only:
            fill = ("{system}",) if role == "system" else ("{content}",)
        out = F.when(m["role"] == role, _fill(text, fill, content)).otherwise(out)
    return out


def render_template(
    messages: Column | str, template: ChatTemplate, named_only: bool = False
) -> Column:
    """Messages as one text. A role without a template contributes its bare content.

    ``named_only`` fills just ``{system}`` for the system role and ``{content}`` for the others; a
    template that uses ``{input}`` or ``{output}`` then yields the bare content.
    """
    return F.array_join(
        F.transform(_col(messages), lambda m: render_message(m, template, named_only)), template.separator
    )


def prompt_text(
    messages: Column | str, template: ChatTemplate, named_only: bool = False, generation: bool = False
) -> Column:
    """The messages of every role but the assistant, rendered on their own.

    ``generation`` adds what opens an answer, unless there are no such messages.
    """
    rest = F.filter(_col(messages), lambda m: _text(m["role"]) != "assistant")
    text = render_template(rest, template, named_only)
    if not generation:
        return text
    return F.when(F.size(rest) > 0, F.concat(text, F.lit(template.generation))).otherwise(text)


def answer_parts(messages: Column | str, template: ChatTemplate, named_only: bool = False) -> Column:
    """Every message in two parts that read as `render_template` when joined:
    ``array<struct<open, body, answer>>``.

    ``open`` is the separator before the message and, for the assistant, what opens an answer;
    ``answer`` is true for the assistant's bodies.
    """
    def split(m: Column, i: Column) -> Column:
        text, answer = render_message(m, template, named_only), _text(m["role"]) == "assistant"
        opened = answer & text.startswith(template.generation)
        separator = F.when(i > 0, F.lit(template.separator)).otherwise("")
        return F.struct(
            F.when(opened, F.concat(separator, F.lit(template.generation))).otherwise(separator).alias("open"),
            F.when(opened, F.substr(text, F.lit(len(template.generation) + 1))).otherwise(text).alias("body"),
            answer.alias("answer"),
        )

    return F.transform(_col(messages), split)


def chatml_prompt(prompt: Column | str) -> Column:
    """A single user turn in ChatML, up to where the assistant starts to answer."""
    return F.concat(
        F.lit("<|im_start|>user\n"), _col(prompt), F.lit("<|im_end|>\n<|im_start|>assistant\n")
    )


def chatml_pair(prompt: Column | str, answer: Column | str) -> Column:
    """A single user turn and its answer in ChatML."""
    return F.concat(chatml_prompt(prompt), _col(answer), F.lit("<|im_end|>"))
