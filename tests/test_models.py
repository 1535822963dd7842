"""Trained operators on data with a clear signal, and the streaming path."""

import random

import numpy as np
from pyspark.sql import functions as F

from quillset.operators import classifiers
from quillset.plans import fixtures, training_sets
from quillset.sources import sinks
from quillset.streaming.scoring import answer_stream


def reviews(spark, n=300):
    draw = random.Random(2)
    mood = {0: "awful broken sad", 1: "plain usual table", 2: "great lovely bright"}
    rows = [(i, " ".join(draw.choices(mood[i % 3].split() + ["thing", "day"], k=8)), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string, label int")


def test_text_classifier_beats_the_majority_and_reloads(spark, tmp_path):
    df = reviews(spark)
    train, test = df.filter("id < 240"), df.filter("id >= 240")
    model, scores = classifiers.train_text_classifier(train, test, dim=1 << 10)
    assert scores.first()["accuracy"] > 0.9
    before = sorted(tuple(r) for r in classifiers.predict(model, test).collect())
    loaded = sinks.load_model(sinks.save_model(model, str(tmp_path / "model")))
    assert sorted(tuple(r) for r in classifiers.predict(loaded, test).collect()) == before


def test_token_classifier_beats_the_majority_and_tags(spark, sf_dir):
    sentences = fixtures.named_words(spark, sf_dir)
    model = classifiers.train_token_classifier(sentences, "tokens", "tags", dim=1 << 10, max_iter=10)
    rows = classifiers.token_features(sentences, "tokens", "tags").withColumnRenamed("tags", "label")
    majority = rows.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert classifiers.evaluate(model, rows).first()["accuracy"] > majority
    texts = spark.createDataFrame([(1, "and Then some")], "id long, text string")
    tagged = classifiers.tag_tokens(model, texts, "id", "text").orderBy("pos").collect()
    assert [r["token"] for r in tagged] == ["and", "Then", "some"]
    entities = classifiers.tag_entities(model, texts, "id", "text").collect()
    assert [(r["pos"], r["label"][2:]) for r in entities] == [(1, "PER")]


def test_token_features_of_one_word(spark):
    row = classifiers.token_features(spark.createDataFrame([(["A-1"],)], "t array<string>"), "t").first()
    assert (row["word"], row["previous"], row["next"], row["prefix"], row["suffix"], row["shape"]) == ("a-1", "", "", "a-1", "a-1", "CDH")


def test_entity_spans_as_text(spark):
    df = spark.createDataFrame([(1, ["New", "York", "is", "big"], ["B-LOC", "I-LOC", "O", "O"])], "id long, t array<string>, g array<string>")
    assert tuple(classifiers.entity_spans(df, "t", "g", "id").first()) == (1, 0, 1, "LOC", "New York")


def test_search_draws_and_best_trial(spark):
    space = {"reg_param": ("log", 1e-4, 10.0), "features": ("choice", [64, 256])}
    assert classifiers.draw_trials(space, 3, 1) == classifiers.draw_trials(space, 3, 1)
    df = reviews(spark, 150)

    def to_map(pipeline, trial):
        stages = pipeline.getStages()
        return {stages[4].regParam: trial["reg_param"], stages[2].numFeatures: int(trial["features"])}

    table = classifiers.hyperparameter_search(
        lambda: classifiers.text_classifier(max_iter=5), to_map, df.filter("id < 100"), df.filter("id >= 100"), space, 3
    ).collect()
    best = [r for r in table if r["is_best"]]
    assert len(table) == 3 and len(best) == 1 and best[0]["loss"] == min(r["loss"] for r in table)
    assert all(1e-4 <= r["params"]["reg_param"] <= 10.0 for r in table)


def make_two():
    return lambda prompts: np.array(["2."] * len(prompts), dtype=object)


def test_stream_gives_the_answers_of_the_batch(spark, sf_dir, tmp_path):
    source = str(tmp_path / "in")
    fixtures.mcq(spark, sf_dir).filter("question is not null").repartition(3).write.parquet(source)
    stored = spark.read.parquet(source)
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        answer_stream(stream, make_two).writeStream.format("memory").queryName("answers")
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.processAllAvailable()
    query.stop()
    got = sorted(tuple(r) for r in spark.table("answers").collect())
    assert got == sorted(tuple(r) for r in answer_stream(stored, make_two).collect()) and got
    assert {r[2] for r in got} == {2}


def test_review_splits_are_disjoint_and_whole(spark, sf_dir):
    raw = fixtures.reviews(spark, sf_dir)
    splits = training_sets.review_dataset(raw)
    known = raw.filter("category is not null and clean_text is not null").count()
    assert splits.count() == known == splits.select("id").distinct().count()
