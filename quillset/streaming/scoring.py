"""Stateless operators over a stream of questions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.functions.prompts import INSTRUCT_TEMPLATE
from quillset.plans.evaluation import answer_questions


def answer_stream(
    questions: DataFrame, make_predict_fn: Callable, template: Mapping | None = INSTRUCT_TEMPLATE, batch_size: int = 8
) -> DataFrame:
    """Answers and predictions for a streaming table of questions.

    No operator on this path keeps state or needs a global order, so it runs in append mode with any trigger.
    """
    answered = answer_questions(questions, make_predict_fn, template=template, batch_size=batch_size)
    return answered.select("id", "answer", "prediction", (F.col("prediction") == F.col("cop")).alias("is_correct"))
