"""Prompts, targets and chat transcripts as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillset.functions.fixed_values import (
    ANSWER_PREFIX,
    CHOICE_PROMPT_END,
    CHOICE_PROMPT_OPTIONS,
    EXAM_PROMPT_END,
    EXAM_PROMPT_START,
    OPTION_COLUMNS,
)

# role -> (text before the content, text after it); "generation" is appended when an answer is to follow.
INSTRUCT_TEMPLATE = {
    "begin": "<s>",
    "system": ("[SYS] ", " [/SYS]"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", "</s>"),
    "generation": " ",
}


def options_array() -> Column:
    return F.array(*[F.col(name) for name in OPTION_COLUMNS])


def mcq_prompt() -> Column:
    """Question and four options numbered 0 to 3. Null as soon as one part is null."""
    return F.concat(
        F.col("question"),
        F.lit(CHOICE_PROMPT_OPTIONS),
        F.col("opa"),
        F.lit("\n1. "),
        F.col("opb"),
        F.lit("\n2. "),
        F.col("opc"),
        F.lit("\n3. "),
        F.col("opd"),
        F.lit(CHOICE_PROMPT_END),
    )


def shuffled_positions(row_id: Column, seed: int) -> Column:
    """Option positions 0..3 in an order that depends on seed and row id only."""
    keyed = [
        F.struct(F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string"), F.lit(f":{i}"))).alias("key"),
                 F.lit(i).alias("pos"))
        for i in range(len(OPTION_COLUMNS))
    ]
    return F.transform(F.array_sort(F.array(*keyed)), lambda s: s["pos"])


def exam_prompt(shuffle_options: bool = False, row_id: Column | None = None, seed: int = 0) -> Column:
    """Exam-style prompt with options numbered 1 to 4, optionally in a seeded order per row."""
    options = options_array()
    if shuffle_options:
        if row_id is None:
            raise ValueError("shuffle_options needs row_id")
        original = options
        options = F.transform(shuffled_positions(row_id, seed), lambda p: F.get(original, p))
    numbered = [F.concat(F.lit(f"{i + 1}. "), F.get(options, i)) for i in range(len(OPTION_COLUMNS))]
    lines = [
        F.lit(EXAM_PROMPT_START),
        F.concat(F.lit("Question: "), F.col("question")),
        F.lit("Options:"),
        *numbered,
        F.lit(EXAM_PROMPT_END),
    ]
    # concat, not concat_ws: a missing option makes the prompt null instead of silently shorter.
    joined = [part for line in lines for part in (F.lit("\n"), line)][1:]
    return F.concat(*joined)


def correct_option() -> Column:
    """Text of the option ``cop`` points at."""
    return F.get(options_array(), F.col("cop"))


def target_number() -> Column:
    """Training target with the option number, such as ``2.``"""
    return F.concat(F.col("cop").cast("string"), F.lit("."))


def target_answer() -> Column:
    """Training target with the option text."""
    return F.concat(F.lit(ANSWER_PREFIX), correct_option())


def chat_messages(user: Column, assistant: Column | None = None) -> Column:
    """One user turn, followed by the assistant turn when given."""
    turns = [("user", user)] if assistant is None else [("user", user), ("assistant", assistant)]
    return F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in turns])


def render_chat(
    messages: Column, template: Mapping = INSTRUCT_TEMPLATE, add_generation_prompt: bool = False
) -> Column:
    """Transcript of the messages under a template of text before and after each role's content.

    Null content makes the transcript null; an unknown role is an error.
    """
    roles = [role for role in template if role not in ("begin", "generation")]

    def turn(message: Column) -> Column:
        rendered = F.raise_error(F.concat(F.lit("no template for role "), F.coalesce(message["role"], F.lit("null"))))
        for role in roles:
            before, after = template[role]
            rendered = F.when(
                message["role"] == role, F.concat(F.lit(before), message["content"], F.lit(after))
            ).otherwise(rendered)
        return rendered

    turns = F.transform(messages, turn)
    text = F.concat(F.lit(template.get("begin", "")), F.array_join(turns, ""))
    if add_generation_prompt:
        text = F.concat(text, F.lit(template.get("generation", "")))
    return F.when(F.exists(messages, lambda m: m["content"].isNull()), F.lit(None)).otherwise(text)
