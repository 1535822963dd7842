"""Reading choices out of model output, and small array helpers for predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillset.functions.fixed_values import ANSWER_PREFIX, INVALID_CHOICE, MASKED_LABEL
from quillset.functions.text import fold_accents


def parse_choice(answer: Column) -> Column:
    """Lowest option number whose digit occurs anywhere in the answer; -1 if none does or the answer is null."""
    choice = F.lit(INVALID_CHOICE)
    for number in (3, 2, 1, 0):
        choice = F.when(F.contains(answer, F.lit(str(number))), F.lit(number)).otherwise(choice)
    return choice


def strip_prefix(text: Column, prefix: str = ANSWER_PREFIX) -> Column:
    """Text without the prefix, when it starts with it."""
    return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, len(prefix) + 1, 2**31 - 1)).otherwise(text)


def closest_option(answer: Column, options: Sequence[Column]) -> Column:
    """0-based index of the option with the smallest edit distance; the first of equals. Accents do not count."""
    folded = fold_accents(answer)
    distances = F.array(*[F.levenshtein(folded, fold_accents(option)) for option in options])
    return first_position(distances, F.array_min(distances))


def first_position(values: Column, wanted: Column) -> Column:
    return (F.array_position(values, wanted) - 1).cast("int")


def argmax(logits: Column) -> Column:
    """0-based index of the first maximum; NaN is rejected."""
    checked = F.when(F.exists(logits, F.isnan), F.raise_error(F.lit("NaN in logits")).cast("int"))
    return F.coalesce(checked, first_position(logits, F.array_max(logits)))


def ids_to_labels(ids: Column, names: Sequence[str]) -> Column:
    """Label names for an array of ids; null where the id has no name."""
    table = F.array(*[F.lit(name) for name in names])
    return F.transform(ids, lambda i: F.get(table, i))


def labels_to_ids(labels: Column, names: Sequence[str]) -> Column:
    """Ids for an array of label names; null where the name is unknown."""
    table = F.array(*[F.lit(name) for name in names])
    return F.transform(labels, lambda n: F.nullif((F.array_position(table, n) - 1).cast("int"), F.lit(-1)))


def mask_filter(pred: Column, label: Column) -> Column:
    """Array of (pred, label) pairs without the masked positions."""
    return F.filter(
        F.arrays_zip(pred.alias("pred"), label.alias("label")), lambda pair: pair["label"] != MASKED_LABEL
    )
