"""Row filters, recoding, renaming and label dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillset.contracts import require_columns
from quillset.functions.fixed_values import CATEGORY_CLASSES, MULTI_CHOICE


def single_choice(df: DataFrame, column: str = "choice_type") -> DataFrame:
    """Rows that are not multi-choice questions; rows of unknown type stay."""
    return require_columns(df, column).filter(~F.col(column).eqNullSafe(MULTI_CHOICE))


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return require_columns(df, *subset).dropna(subset=list(subset))


def recode(df: DataFrame, column: str, out: str | None = None, mapping: Mapping[int, int] = CATEGORY_CLASSES) -> DataFrame:
    """Replace values by the mapping, all at once, and cast to int; values without an entry pass through."""
    value = F.col(column)
    replaced = value
    for old, new in mapping.items():
        replaced = F.when(value == F.lit(old), F.lit(new)).otherwise(replaced)
    return df.withColumn(out or column, replaced.cast("int"))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return require_columns(df, *names).drop(*names)


def to_text_label(df: DataFrame, text: str = "clean_text", label: str = "category_1", *keep: str) -> DataFrame:
    """Text and label under their training names."""
    return df.select(*keep, F.col(text).alias("text"), F.col(label).alias("label"))


def to_instruction_output(df: DataFrame, instruction: str = "prompt", output: str = "target", *keep: str) -> DataFrame:
    """Prompt and target under their fine-tuning names."""
    return df.select(*keep, F.col(instruction).alias("instruction"), F.col(output).alias("output"))


def format_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named model inputs."""
    return df.select(*(names or ("input_ids", "attention_mask", "label")))


def label_dictionary(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``label_id``, ``label`` and ``num_labels`` of a list of label names, as a table of the session of ``df``."""
    rows = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(n) for n in names])).alias("label_id", "label"))
    return rows.withColumn("num_labels", F.lit(len(names)))


def class_dimension(df: DataFrame, column: str) -> DataFrame:
    """Distinct class names with their 0-based position in alphabetical order."""
    names = df.select(F.col(column).alias("target_name")).filter(F.col("target_name").isNotNull()).distinct()
    position = F.row_number().over(Window.orderBy("target_name")) - 1  # one row per class
    return names.select(position.alias("target"), "target_name")


def shape_key_absent_as_null(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` in its types; a column the input lacks becomes null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
