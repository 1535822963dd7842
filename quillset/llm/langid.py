"""Language identification in two steps: the family of languages, then the language within it.

Families are found from the labelled texts: languages with the most similar mean features are joined until about the
square root of their number is left. Linear support vector machines decide between every two families, and within a family
between every two of its languages; the most votes win, then the larger sum of margins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import in_pieces
from quillset.llm.features import ROWS, letter_features
from quillset.session import materialise

UNDETERMINED = "und"
#: Labelled texts of each language, about, that the machines are fitted on; they are drawn by a hash of the id.
PER_LANGUAGE = 600


@dataclass(frozen=True)
class Machine:
    """Decides between two groups, named by their index: the first one where the margin is positive."""

    first: int
    second: int
    weights: np.ndarray
    intercept: float


@dataclass(frozen=True)
class Model:
    """Languages of each family, the machines between families, and those within each family."""

    families: tuple[tuple[str, ...], ...]
    between: tuple[Machine, ...]
    within: tuple[tuple[Machine, ...], ...]


def held_out(key: str = "doc_id") -> Column:
    """Whether the document is kept from learning: CRC-32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_features(docs: DataFrame, key: str, text: str, lang: str, per_language: int) -> DataFrame:
    """Rows (lang, features) of the sample that is learned from."""
    learnable = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key))
    counts = {r[0]: r[1] for r in learnable.groupBy(lang).count().collect()}  # as many rows as languages
    if not counts:
        return docs.sparkSession.createDataFrame([], "lang string, features array<float>")
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, per_language / n))])
    drawn = learnable.filter(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(17)), F.lit(1 << 30)) < share[F.col(lang)] * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text", 1 << 20, ROWS):
            rows, letters = letter_features(batch.column("text").to_pylist())
            has = letters > 0
            flat = pa.ListArray.from_arrays(pa.array(np.arange(int(has.sum()) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows[has].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("lang").filter(pa.array(has)), flat], names=["lang", "features"])

    drawn = drawn.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return materialise(drawn.mapInArrow(run, "lang string, features array<float>"), "language-sample")


def families_of(means: dict[str, np.ndarray]) -> tuple[tuple[str, ...], ...]:
    """Languages joined by the cosine of their mean features less what all share, until about the root of their number."""
    names = sorted(means)
    rows = np.stack([means[n] for n in names])
    rows = rows - rows.mean(axis=0)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    near, groups = rows @ rows.T, [[i] for i in range(len(names))]
    while len(groups) > max(1, round(len(names) ** 0.5)):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: near[np.ix_(groups[p[0]], groups[p[1]])].mean())
        groups[a] += groups.pop(b)
    return tuple(tuple(names[i] for i in sorted(g)) for g in groups)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the documents that are not held out."""
    sample = labelled_features(docs, key, text, lang, per_language).withColumn("x", array_to_vector("features"))
    means = {r[0]: r[1].toArray() for r in sample.groupBy("lang").agg(Summarizer.mean(F.col("x"))).collect()}
    if not means:
        return Model((), (), ())
    families = families_of(means)

    def machine(first: int, second: int, one: tuple[str, ...], other: tuple[str, ...]) -> Machine:
        rows = sample.filter(F.col("lang").isin([*one, *other])).select("x", F.col("lang").isin([*one]).cast("double").alias("y"))
        fitted = LinearSVC(featuresCol="x", labelCol="y", maxIter=30, regParam=1e-4, standardization=False).fit(rows)
        return Machine(first, second, fitted.coefficients.toArray().astype(np.float32), float(fitted.intercept))

    between = tuple(machine(a, b, families[a], families[b]) for a, b in combinations(range(len(families)), 2))
    within = tuple(tuple(machine(a, b, (f[a],), (f[b],)) for a, b in combinations(range(len(f)), 2)) for f in families)
    return Model(families, between, within)


def decided(rows: np.ndarray, groups: int, machines: tuple[Machine, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The group with the most votes for each row, and how sure its weakest won or lost vote is (0 to 1)."""
    votes, sums = np.zeros((len(rows), groups)), np.zeros((len(rows), groups))
    least = np.full((len(rows), groups), np.inf)
    for m in machines:
        margin = rows @ m.weights + m.intercept
        for group, side in ((m.first, margin), (m.second, -margin)):
            votes[:, group] += side > 0 if group == m.first else side >= 0
            sums[:, group] += side
            least[:, group] = np.minimum(least[:, group], side)
    best = np.lexsort((sums, votes), axis=1)[:, -1] if len(rows) else np.zeros(0, dtype=np.int64)
    return best, 1 / (1 + np.exp(-2 * np.clip(least[np.arange(len(rows)), best], -300, 300)))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; ``text`` alone is looked at. Null texts, texts without letters, and all texts of
    a model that has seen no label get ``und`` and score 0. Columns of the two names are replaced. Nothing is shuffled."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    kinds = [f"`{f.name}`: {f.dataType.simpleString()}" for f in kept.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, text, rows=ROWS):
            rows, letters = letter_features(batch.column(text).to_pylist())
            names, scores = np.full(len(rows), UNDETERMINED, dtype=object), np.zeros(len(rows))
            if model.families:
                family, sure = decided(rows, len(model.families), model.between)
                for f, languages in enumerate(model.families):
                    at = np.flatnonzero((family == f) & (letters > 0))
                    language, surer = decided(rows[at], len(languages), model.within[f])
                    names[at] = np.array(languages, dtype=object)[language]
                    scores[at] = sure[at] * surer
            added = [pa.array(names.tolist(), pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(run, ", ".join([*kinds, "lang_pred: string", "score: double"]))


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: key, held_out, lang_pred, score, by a model learned from the same table's other documents."""
    model = fit(docs, key, text, lang)
    rows = docs.select(key, held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    return predict(rows, model).drop("text")


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language; a null ``lang`` becomes the predicted one.

    Rows are chosen one by one, so repeated keys need no care. The columns keep their names and their other values, those
    named as the predictor's own columns too.
    """
    model = fit(docs, key, text, lang)
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c != text}
    judged = predict(docs.select(*[F.col(f"`{c}`").alias(own.get(c, c)) for c in docs.columns]), model, text)
    known = F.coalesce(F.col(own[lang]), F.col("lang_pred")) if lang in own else None
    back = [known.alias(c) if c == lang and known is not None else F.col(own.get(c, c)).alias(c) for c in docs.columns]
    return judged.filter(F.col("lang_pred") != UNDETERMINED).select(*back)
