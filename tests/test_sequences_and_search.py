"""Decoding of whole tag sequences and the guided search, against brute force and hand-made cases."""

import itertools
import math
import random

import numpy as np

from quillset.functions.fixed_values import ENTITY_LABELS, MASKED_LABEL
from quillset.operators import classifiers, decoding
from quillset.plans import fixtures

NAMES = ["O", "B-PER", "I-PER", "B-LOC", "I-LOC"]


def weights_of(spark, rows, names=NAMES):
    counts = decoding.count_transitions(spark.createDataFrame(rows, "id long, tags array<int>"), "tags")
    return counts, decoding.transition_weights(counts, names)


TAGS = [(1, [0, 1, 2, MASKED_LABEL, 2, 0]), (2, [1, 3, 4]), (3, []), (4, None), (5, [0, 2]), (6, [0, None, 0])]


def test_transition_counts_skip_masked_positions(spark):
    counts, weights = weights_of(spark, TAGS)
    got = {(r["before"], r["after"]): r["n"] for r in counts.collect()}
    assert got == {(None, 0): 3, (None, 1): 1, (0, 1): 1, (1, 2): 1, (2, 2): 1, (2, 0): 1, (1, 3): 1, (3, 4): 1, (0, 2): 1, (0, 0): 1}
    assert weights.after[0][2] == decoding.NEVER == weights.first[2]  # taken in training, but against the rules
    assert math.isclose(sum(math.exp(w) for w in weights.after[1] if w > decoding.NEVER), 1.0)


def test_best_path_equals_brute_force(spark):
    _, weights = weights_of(spark, TAGS)
    draw = np.random.default_rng(3)
    sentences = [draw.dirichlet(np.full(5, 0.3), size=n) for n in (0, 1, 2, 3, 4, 5, 5, 1, 3)]
    sentences.append(np.array([[0.0, 0, 1, 0, 0]] * 3))  # the model is sure of tags that may not stand alone

    def value(grid, path):
        total = weights.first[path[0]]
        for t, tag in enumerate(path):
            total += math.log(max(grid[t, tag], math.exp(-700))) - weights.prior[tag]
            total += weights.after[path[t - 1]][tag] if t else 0.0
        return total

    for grid, path in zip(sentences, decoding.best_paths(sentences, weights)):
        if len(grid):
            best = max(value(grid, p) for p in itertools.product(range(5), repeat=len(grid)))
            assert math.isclose(value(grid, path), best, rel_tol=1e-12)
        assert len(path) == len(grid)
        names = [NAMES[i] for i in path]
        assert all(decoding.may_follow(b, a) for b, a in zip([None, *names], names))


def test_blocks_give_the_paths_of_single_sentences(spark, monkeypatch):
    _, weights = weights_of(spark, TAGS)
    draw = np.random.default_rng(5)
    sentences = [draw.dirichlet(np.full(5, 0.5), size=int(n)) for n in draw.integers(0, 40, 50)]
    whole = [p.tolist() for p in decoding.best_paths(sentences, weights)]
    monkeypatch.setattr(decoding, "CELLS", 300)
    assert [p.tolist() for p in decoding.best_paths(sentences, weights)] == whole
    assert [decoding.best_paths([s], weights)[0].tolist() for s in sentences] == whole


def test_decode_keeps_columns_and_nulls(spark):
    _, weights = weights_of(spark, TAGS)
    sure = [0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0]
    df = spark.createDataFrame([(1, sure, "x"), (2, [], "y"), (3, None, None)], "id long, c array<double>, other string")
    got = {r["id"]: r for r in decoding.decode(df, "c", weights).collect()}
    assert got[1]["path"] == [1, 2] and got[1]["scores"] == [1.0, 1.0] and got[1]["other"] == "x"
    assert got[2]["path"] == [] and got[3]["path"] is None and got[3]["scores"] is None
    assert decoding.decode(df.limit(0), "c", weights).count() == 0


def test_entities_of_texts_are_valid_and_scored(spark, sf_dir):
    sentences = fixtures.named_words(spark, sf_dir)
    model = classifiers.train_token_classifier(sentences, "tokens", "tags", dim=1 << 10, max_iter=10)
    weights = classifiers.sequence_weights(model, sentences, "tags")
    tagged = classifiers.tag_sentences(model, weights, sentences, "sent_id", "tokens", "tags")
    assert tagged.count() == sentences.filter("size(tokens) > 0").count()
    for row in tagged.limit(200).collect():
        names = [ENTITY_LABELS[i] for i in row["pred"]]
        assert all(decoding.may_follow(b, a) for b, a in zip([None, *names], names))
        assert len(row["pred"]) == len(row["tokens"]) == len(row["tags"]) == len(row["scores"])
    scores = classifiers.evaluate_tags(tagged, "tags").first()
    assert scores["f1"] > 0.8 and scores["accuracy"] > 0.9
    texts = spark.createDataFrame([(1, "and Then some"), (2, ""), (3, None), (4, "Anna Maria left")], "id long, text string")
    found = classifiers.tag_entities(model, texts, "id", "text", weights=weights).orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"], r["token"], r["label"]) for r in found] == [
        (1, 1, "Then", "B-PER"), (4, 0, "Anna", "B-PER"), (4, 1, "Maria", "I-PER")
    ]


SPACE = {"rate": ("log", 1e-6, 1.0), "kind": ("choice", ["a", "b", "c"]), "flag": ("choice", [True, False])}


def loss(trial):
    return abs(math.log10(trial["rate"]) + 3) + {"a": 2.0, "b": 0.0, "c": 1.0}[trial["kind"]]


def test_guided_trials_beat_random_ones():
    better = 0
    for seed in range(30):
        known = [(t, loss(t)) for t in classifiers.draw_trials(SPACE, 6, seed)]
        for i in range(24):
            trial = classifiers.guided_trial(SPACE, known, 1000 * seed + i)
            assert 1e-6 <= trial["rate"] <= 1.0 and trial["kind"] in "abc"
            known.append((trial, loss(trial)))
        random_losses = [loss(t) for t in classifiers.draw_trials(SPACE, 30, seed)]
        better += np.mean([v for _, v in known[6:]]) < np.mean(random_losses) - 0.5
    assert better >= 27


def test_guided_trial_without_history_ties_and_failed_fits():
    assert classifiers.guided_trial(SPACE, [], 3) == classifiers.draw_trials(SPACE, 1, 3)[0]
    trials = classifiers.draw_trials(SPACE, 4, 1)
    assert classifiers.guided_trial(SPACE, [(t, math.nan) for t in trials], 5)["kind"] in "abc"
    assert classifiers.guided_trial({"x": ("log", 2.0, 2.0)}, [({"x": 2.0}, 1.0)], 0) == {"x": 2.0}


def test_search_keeps_choices_that_are_no_numbers(spark):
    draw = random.Random(2)
    mood = ["awful broken", "plain usual", "great lovely"]
    rows = [(i, " ".join(draw.choices(mood[i % 3].split() + ["thing"], k=6)), i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, text string, label int")

    def to_map(pipeline, trial):
        stages = pipeline.getStages()
        return {stages[4].regParam: trial["reg"], stages[4].standardization: trial["scaled"] == "yes", stages[2].numFeatures: trial["dim"]}

    space = {"reg": ("log", 1e-3, 1.0), "scaled": ("choice", ["yes", "no"]), "dim": ("choice", [64, 256])}
    arguments = (lambda: classifiers.text_classifier(max_iter=5), to_map, df.filter("id < 100"), df.filter("id >= 100"), space)
    table = classifiers.hyperparameter_search(*arguments, n_trials=4, startup=2).collect()
    assert [r["trial"] for r in table] == [0, 1, 2, 3] and sum(r["is_best"] for r in table) == 1
    assert all(r["choices"]["scaled"] in ("yes", "no") and set(r["params"]) == {"reg", "dim"} for r in table)
    best = next(r for r in table if r["is_best"])
    assert best["loss"] == min(r["loss"] for r in table)
    # the loss of a trial is that of a whole pipeline fitted with its settings
    pipeline = classifiers.text_classifier(max_iter=5)
    settings = to_map(pipeline, {**best["params"], **best["choices"], "dim": int(best["params"]["dim"])})
    model = pipeline.fit(arguments[2], settings)
    whole = classifiers.MulticlassClassificationEvaluator(metricName="logLoss").evaluate(model.transform(arguments[3]))
    assert math.isclose(whole, best["loss"], rel_tol=1e-6)
