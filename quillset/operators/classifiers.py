"""Text and token classifiers on Spark ML, their evaluation and their tuning."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, FeatureHasher, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.functions.answers import argmax, ids_to_labels
from quillset.functions.fixed_values import ENTITY_LABELS, MASKED_LABEL
from quillset.functions.text import STOPWORDS, words
from quillset.operators.decoding import Transitions, count_transitions, decode, transition_weights
from quillset.operators.metrics import choice_scores, token_accuracy
from quillset.operators.rows import explode_rows, posexplode_rows
from quillset.operators.spans import entity_scores, span_array
from quillset.operators.token_regression import fit_token_regression, token_chances
from quillset.session import materialise


def text_classifier(dim: int = 1 << 14, reg_param: float = 0.01, max_iter: int = 20) -> Pipeline:
    """Unfitted pipeline over the columns ``text`` and ``label``."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="kept", stopWords=list(STOPWORDS)),
            HashingTF(inputCol="kept", outputCol="tf", numFeatures=dim),
            IDF(inputCol="tf", outputCol="features"),
            LogisticRegression(family="multinomial", regParam=reg_param, maxIter=max_iter),
        ]
    )


def train_text_classifier(train: DataFrame, validation: DataFrame, **parameters) -> tuple[PipelineModel, DataFrame]:
    """Fitted model and its scores on the validation split."""
    model = text_classifier(**parameters).fit(train)
    return model, evaluate(model, validation)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with ``predicted``, the class of the highest probability."""
    scored = model.transform(df).withColumn("predicted", argmax(vector_to_array("probability")))
    return scored.select(*df.columns, "predicted")


def evaluate(model: PipelineModel, df: DataFrame, label: str = "label") -> DataFrame:
    """One row: accuracy and error rate of the model on labelled rows."""
    return choice_scores(predict(model, df), truth=label, prediction="predicted").select("accuracy", "error_rate")


# ---------------------------------------------------------------- tokens

_TOKEN_FEATURES = ["word", "previous", "next", "prefix", "suffix", "shape"]


def token_features(df: DataFrame, tokens: str, labels: str | None = None) -> DataFrame:
    """One row per token with its features: the word, its neighbours, affixes, and a shape flag.

    The neighbours are taken inside the row, so no window is needed. Other columns of ``df`` are kept.
    """
    lowered = F.transform(tokens, F.lower)
    edge = F.array(F.lit(""))
    prepared = df.withColumn("_lower", lowered)
    size = F.size("_lower")
    columns = [
        F.col(tokens).alias("token"),
        F.col("_lower").alias("word"),
        F.concat(edge, F.slice("_lower", 1, F.greatest(size - 1, F.lit(0)))).alias("previous"),
        F.concat(F.slice("_lower", 2, F.greatest(size, F.lit(1))), edge).alias("next"),
    ]
    if labels:
        columns.append(F.col(labels).alias("label"))
    others = [c for c in df.columns if c not in (tokens, labels)]
    exploded = posexplode_rows(prepared, F.arrays_zip(*columns), "pos", "c", *others).select(*others, "pos", "c.*")
    word = F.col("word")
    return (
        exploded.withColumn("prefix", F.substring(word, 1, 3))
        .withColumn("suffix", F.substring(word, -3, 3))
        .withColumn("shape", _shape(F.col("token")))
    )


def _shape(token: Column) -> Column:
    capital = F.when(token.rlike(r"^\p{Lu}"), F.lit("C")).otherwise(F.lit("c"))
    digit = F.when(token.rlike(r"\d"), F.lit("D")).otherwise(F.lit("d"))
    hyphen = F.when(F.contains(token, F.lit("-")), F.lit("H")).otherwise(F.lit("h"))
    return F.concat(capital, digit, hyphen)


def train_token_classifier(
    sentences: DataFrame, tokens: str, labels: str, dim: int = 1 << 14, reg_param: float = 0.001, max_iter: int = 20
) -> PipelineModel:
    """Multinomial regression over hashed token features; masked positions are left out."""
    hasher = FeatureHasher(inputCols=_TOKEN_FEATURES, outputCol="features", numFeatures=dim)
    return PipelineModel(stages=[hasher, fit_token_regression(sentences, tokens, labels, dim, reg_param, max_iter)])


def tag_tokens(
    model: PipelineModel, texts: DataFrame, key: str, text: str, names: Sequence[str] = ENTITY_LABELS
) -> DataFrame:
    """Every word of a text with its tag: (key, pos, token, label, score)."""
    split = texts.select(key, words(F.col(text)).alias("tokens"))
    scored = model.transform(token_features(split, "tokens")).withColumn("_p", vector_to_array("probability"))
    table = F.array(*[F.lit(n) for n in names])
    return scored.select(
        key, "pos", "token", F.get(table, argmax(F.col("_p"))).alias("label"), F.array_max("_p").alias("score")
    )


def sequence_weights(
    model: PipelineModel, sentences: DataFrame, labels: str, names: Sequence[str] = ENTITY_LABELS
) -> Transitions:
    """Step weights of the training tags for the labels that the model knows."""
    return transition_weights(count_transitions(sentences, labels), names[: model.stages[-1].numClasses])


def tag_sentences(
    model: PipelineModel, weights: Transitions, sentences: DataFrame, key: str, tokens: str, labels: str | None = None
) -> DataFrame:
    """Sentences decoded as wholes: (key, tokens, [labels,] pred, scores), label ids and the model's chance of each.

    One shuffle brings the rows of a key together: theirs are the cells of one sentence, by position, token and label.
    """
    whole = token_chances(model.stages[-1], sentences, key, tokens, labels, "_chances")
    return decode(whole, "_chances", weights, "pred", "scores").drop("_chances")


def evaluate_tags(tagged: DataFrame, labels: str, names: Sequence[str] = ENTITY_LABELS) -> DataFrame:
    """One row for decoded sentences: accuracy and error rate of tokens; precision, recall and F1 of whole entities."""
    tagged = materialise(tagged.select("pred", labels), "tagged")
    tokens = token_accuracy(tagged, "pred", labels).select("accuracy", (1 - F.col("accuracy")).alias("error_rate"))
    entities = entity_scores(tagged, "pred", labels, names).filter("type = 'micro'").select("precision", "recall", "f1")
    return tokens.join(F.broadcast(entities))  # one row each


def tag_entities(
    model: PipelineModel,
    texts: DataFrame,
    key: str,
    text: str,
    names: Sequence[str] = ENTITY_LABELS,
    weights: Transitions | None = None,
) -> DataFrame:
    """Words tagged as part of an entity: (key, pos, token, label, score). With step weights, the tags of a text are its
    best path, in which an entity only goes on where one of its type began; without, each word has its own best tag."""
    if weights is None:
        return tag_tokens(model, texts, key, text, names).filter(F.col("label") != names[0])
    tagged = tag_sentences(model, weights, texts.select(key, words(F.col(text)).alias("tokens")), key, "tokens")
    cells = F.arrays_zip(
        F.col("tokens").alias("token"), ids_to_labels(F.col("pred"), names).alias("label"), F.col("scores").alias("score")
    )
    return posexplode_rows(tagged, cells, "pos", "c", key).select(key, "pos", "c.*").filter(F.col("label") != names[0])


def entity_spans(tagged: DataFrame, tokens: str, tags: str, key: str) -> DataFrame:
    """Entities of tag arrays as text: (key, start, end, type, words)."""
    spans = explode_rows(tagged.withColumnRenamed(tokens, "_t"), span_array(F.col(tags)), "s", key, "_t")
    return spans.select(
        key, "s.*", F.array_join(F.slice("_t", F.col("s.start") + 1, F.col("s.end") - F.col("s.start") + 1), " ").alias("words")
    )


# ---------------------------------------------------------------- tuning


def draw_trials(space: dict[str, tuple], n_trials: int, seed: int) -> list[dict]:
    """Seeded draws from a search space: ``("log", low, high)`` or ``("choice", values)`` per parameter."""
    draw = random.Random(seed)
    trials = []
    for _ in range(n_trials):
        trial = {}
        for name, spec in space.items():
            if spec[0] == "log":
                trial[name] = math.exp(draw.uniform(math.log(spec[1]), math.log(spec[2])))
            else:
                trial[name] = draw.choice(list(spec[1]))
        trials.append(trial)
    return trials


def guided_trial(
    space: dict[str, tuple], known: Sequence[tuple[dict, float]], seed: int, good_share: float = 0.25, draws: int = 24
) -> dict:
    """The next trial: per parameter, of ``draws`` values from the density of the good trials the one whose density among
    them is largest against that among the others. ``known`` holds trials and losses; losses that are no numbers are bad.

    A range has a normal kernel per trial on the log scale, as wide as its neighbours are away, and one over the whole
    range; choices have their counts plus one.
    """
    if not known:
        return draw_trials(space, 1, seed)[0]
    draw = random.Random(seed)
    ranked = sorted(known, key=lambda pair: pair[1] if math.isfinite(pair[1]) else math.inf)
    cut = max(1, math.ceil(good_share * len(ranked)))
    good, bad = [t for t, _ in ranked[:cut]], [t for t, _ in ranked[cut:]]
    trial = {}
    for name, spec in space.items():
        if spec[0] == "log":
            low, high = math.log(spec[1]), math.log(spec[2])
            if high <= low:
                trial[name] = spec[1]
                continue
            fine = _kernels([math.log(t[name]) for t in good], low, high)
            coarse = _kernels([math.log(t[name]) for t in bad], low, high)
            values = []
            for _ in range(draws):
                centre, width = draw.choice(fine)
                values.append(min(max(draw.gauss(centre, width), low), high))
            best = max(values, key=lambda v: math.log(_density(v, fine)) - math.log(_density(v, coarse)))
            trial[name] = min(max(math.exp(best), spec[1]), spec[2])
        else:
            choices = list(spec[1])
            fine = [1 + sum(t[name] == c for t in good) for c in choices]
            coarse = [1 + sum(t[name] == c for t in bad) for c in choices]
            at = max(draw.choices(range(len(choices)), fine, k=draws), key=lambda i: fine[i] / coarse[i])
            trial[name] = choices[at]
    return trial


def _kernels(points: Sequence[float], low: float, high: float) -> list[tuple[float, float]]:
    ordered = sorted(points)
    edges = [low, *ordered, high]
    least = (high - low) / min(100, 1 + len(edges))
    found = [((low + high) / 2, high - low)]
    for i, point in enumerate(ordered, 1):
        found.append((point, min(max(point - edges[i - 1], edges[i + 1] - point, least), high - low)))
    return found


def _density(value: float, kernels: Sequence[tuple[float, float]]) -> float:
    return sum(math.exp(-0.5 * ((value - c) / w) ** 2) / w for c, w in kernels) / len(kernels) + 1e-300


def hyperparameter_search(
    make_estimator: Callable[[], Estimator],
    to_param_map: Callable[[Estimator, dict], dict],
    train: DataFrame,
    validation: DataFrame,
    space: dict[str, tuple],
    n_trials: int = 5,
    seed: int = 42,
    startup: int = 3,
    parallel: int = 2,
) -> DataFrame:
    """Fit one model per trial and measure its log loss on the validation split: (trial, params, choices, loss, is_best).

    The first ``startup`` trials are drawn at random, each later one by ``guided_trial`` from the losses of the rounds
    before; ``parallel`` trials make a round and are fitted at once. The stages before the last of a pipeline are fitted
    once per setting of theirs, and what they yield is written once. ``params`` holds numbers, ``choices`` all else as text.
    """
    estimator = make_estimator()
    last = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    evaluator = MulticlassClassificationEvaluator(metricName="logLoss", labelCol=last.getLabelCol())
    prepared: dict[frozenset, tuple[DataFrame, DataFrame]] = {}

    def inputs(settings: dict) -> tuple[DataFrame, DataFrame]:
        """Both splits as the last stage reads them, under the settings of the stages before it."""
        if not isinstance(estimator, Pipeline) or len(estimator.getStages()) == 1:
            return train, validation
        name = frozenset((p.parent, p.name, repr(v)) for p, v in settings.items())
        if name not in prepared:
            model = Pipeline(stages=estimator.getStages()[:-1]).copy(settings).fit(train)
            columns = [last.getLabelCol(), last.getFeaturesCol()]
            prepared[name] = tuple(
                materialise(model.transform(split).select(*columns), "prepared") for split in (train, validation)
            )
        return prepared[name]

    def loss_of(settings: dict, splits: tuple[DataFrame, DataFrame]) -> float:
        return float(evaluator.evaluate(last.fit(splits[0], settings).transform(splits[1])))

    trials, losses = draw_trials(space, min(startup, n_trials), seed), []
    with ThreadPoolExecutor(parallel) as pool:  # the threads only hand jobs to Spark
        while len(losses) < n_trials:
            if len(losses) == len(trials):
                known = list(zip(trials, losses))
                room = min(parallel, n_trials - len(trials))
                trials += [guided_trial(space, known, seed + len(trials) + i) for i in range(room)]
            jobs = []
            for trial in trials[len(losses) :]:
                settings = to_param_map(estimator, trial)
                own = {p: v for p, v in settings.items() if p.parent == last.uid}
                splits = inputs({p: v for p, v in settings.items() if p.parent != last.uid})
                jobs.append(pool.submit(inheritable_thread_target(train.sparkSession)(loss_of), own, splits))
            losses += [job.result() for job in jobs]
    finite = [loss if math.isfinite(loss) else math.inf for loss in losses]
    best = finite.index(min(finite)) if finite else -1
    rows = [
        (i, {n: float(v) for n, v in t.items() if _is_number(v)}, {n: str(v) for n, v in t.items() if not _is_number(v)}, losses[i], i == best)
        for i, t in enumerate(trials)
    ]
    schema = "trial int, params map<string,double>, choices map<string,string>, loss double, is_best boolean"
    return train.sparkSession.createDataFrame(rows, schema)


def _is_number(value: object) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)
