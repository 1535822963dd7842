"""Multiple-choice evaluation from questions to scores."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.functions.answers import closest_option, parse_choice, strip_prefix
from quillset.functions.prompts import INSTRUCT_TEMPLATE, chat_messages, exam_prompt, mcq_prompt, options_array, render_chat
from quillset.operators.metrics import choice_scores, match_scores
from quillset.operators.projections import single_choice
from quillset.operators.ranks import sample_n
from quillset.operators.scoring import score_batches


def answer_questions(
    questions: DataFrame,
    make_predict_fn: Callable,
    sample: int | None = None,
    seed: int = 42,
    template: Mapping | None = INSTRUCT_TEMPLATE,
    batch_size: int = 8,
) -> DataFrame:
    """Prompt, model answer and parsed prediction for single-choice questions.

    The sample is drawn before prompts are built. Without a template the model gets the bare prompt.
    """
    chosen = single_choice(questions)
    if sample is not None:
        chosen = sample_n(chosen, sample, "id", seed)
    prompted = chosen.withColumn("prompt", mcq_prompt())
    text = F.col("prompt")
    if template is not None:
        text = render_chat(chat_messages(text), template, add_generation_prompt=True)
    answered = score_batches(prompted.withColumn("text", text), "text", make_predict_fn, batch_size)
    return answered.withColumn("prediction", parse_choice(F.col("answer")))


def evaluate_choices(answered: DataFrame) -> DataFrame:
    """Accuracy, error rate and invalid rate of parsed answers."""
    return choice_scores(answered.withColumn("prediction", parse_choice(F.col("answer"))))


def matched_answers(answered: DataFrame) -> DataFrame:
    """Answers without their prefix, the closest option and whether it is the right one."""
    stripped = answered.withColumn("stripped", strip_prefix(F.col("answer")))
    options = options_array()
    closest = closest_option(F.col("stripped"), [F.get(options, i) for i in range(4)])
    return stripped.withColumn("closest", closest).withColumn(
        "is_correct", F.coalesce(F.col("closest") == F.col("cop"), F.lit(False))
    )


def evaluate_matches(answered: DataFrame) -> DataFrame:
    """Correct, total and percent by closest option."""
    return match_scores(matched_answers(answered))


def exam_evaluation(
    questions: DataFrame, make_predict_fn: Callable, template: Mapping = INSTRUCT_TEMPLATE, batch_size: int = 64
) -> DataFrame:
    """Exam prompts for all questions, model answers, scores by closest option."""
    text = render_chat(chat_messages(exam_prompt()), template)
    return evaluate_matches(score_batches(questions.withColumn("text", text), "text", make_predict_fn, batch_size))
