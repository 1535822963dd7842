"""Fine-tuning and review datasets from their raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.functions.prompts import INSTRUCT_TEMPLATE, chat_messages, exam_prompt, mcq_prompt, render_chat, target_answer, target_number
from quillset.operators.projections import drop_nulls, recode, single_choice, to_instruction_output, to_text_label
from quillset.operators.ranks import sample_n, split_exact, train_test_split


def sft_dataset(
    questions: DataFrame,
    sample: int | None = None,
    test: float = 0.3,
    seed: int = 42,
    template: Mapping = INSTRUCT_TEMPLATE,
    allow_fewer: bool = False,
) -> DataFrame:
    """Transcripts for fine-tuning: (id, split, text)."""
    chosen = single_choice(questions)
    if sample is not None:
        chosen = sample_n(chosen, sample, "id", seed, allow_fewer)
    pairs = chosen.select("id", mcq_prompt().alias("prompt"), target_number().alias("target"))
    records = train_test_split(to_instruction_output(pairs, "prompt", "target", "id"), "id", test, seed)
    text = render_chat(chat_messages(F.col("instruction"), F.col("output")), template)
    return records.select("id", "split", text.alias("text"))


def exam_sft_dataset(questions: DataFrame, template: Mapping = INSTRUCT_TEMPLATE) -> DataFrame:
    """Transcripts of exam prompts with the option text as the answer: (id, text)."""
    return questions.select("id", render_chat(chat_messages(exam_prompt(), target_answer()), template).alias("text"))


def write_sft_dataset(dataset: DataFrame, path: str) -> str:
    """One folder per split, ready for a trainer."""
    dataset.write.partitionBy("split").parquet(path)
    return path


def review_dataset(reviews: DataFrame, seed: int = 42) -> DataFrame:
    """Labelled reviews in three splits: (id, text, label, split)."""
    known = recode(drop_nulls(reviews, ["category", "clean_text"]), "category", "category_1")
    labelled = to_text_label(known, "clean_text", "category_1", "id")
    return split_exact(labelled, "id", test=0.2, validation=0.1, seed=seed)
