"""The token regression in steps over blocks against Spark ML's own hashing, regression and row-wise scoring."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillset.operators import classifiers, token_regression
from quillset.functions.fixed_values import MASKED_LABEL

SCHEMA = "id long, tokens array<string>, tags array<int>"
ODD = [
    (1, ["", "A-1", "Élan", "ΣΑΣ", "x" * 37, None, "Ab9"], [0, 1, 1, 1, 0, 0, 5]),
    (2, [], [1]),
    (3, ["a"], [1, 2, None]),
    (4, ["a", "B"], [1]),
    (5, None, [1]),
    (6, ["q"], None),
    (7, ["q", "r"], [MASKED_LABEL, 3]),
    (8, ["New", "York", "is", "big"], [1, 2, 0, 0]),
    (8, ["New", "is", "Old"], [1, 0, 1]),
    (None, ["b1", "New"], [5, 1]),
    (9, [], []),
]


def sentences(spark):
    return spark.createDataFrame([*ODD, *[(i, ["the", f"Ann{i % 7}", "b-2"], [0, 1, 5]) for i in range(20, 60)]], SCHEMA).repartition(3)


def hashed_rows(df, dim):
    rows = classifiers.token_features(df.select("tokens", "tags"), "tokens", "tags").filter(F.col("label") != MASKED_LABEL)
    hasher = FeatureHasher(inputCols=classifiers._TOKEN_FEATURES, outputCol="features", numFeatures=dim)
    return hasher, hasher.transform(rows).select("label", "features")


@pytest.mark.parametrize("dim", [8, 1 << 10, 1 << 17])
def test_regression_is_that_of_spark_ml(spark, dim, monkeypatch):
    monkeypatch.setattr(token_regression, "BLOCK", 16)
    df = sentences(spark)
    hasher, rows = hashed_rows(df, dim)
    expected = LogisticRegression(family="multinomial", regParam=0.001, maxIter=8).fit(rows)
    model = classifiers.train_token_classifier(df, "tokens", "tags", dim=dim, max_iter=8).stages[-1]
    assert np.allclose(model.coefficientMatrix.toArray(), expected.coefficientMatrix.toArray(), atol=1e-7)
    assert np.allclose(model.interceptVector.toArray(), expected.interceptVector.toArray(), atol=1e-7)


def test_one_label_only(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [2, 2])], SCHEMA)
    model = classifiers.train_token_classifier(df, "tokens", "tags", dim=16)
    assert {r["predicted"] for r in classifiers.predict(model, classifiers.token_features(df, "tokens")).collect()} == {2}
    with pytest.raises(ValueError):
        classifiers.train_token_classifier(df.filter("id = 0"), "tokens", "tags", dim=16)


@pytest.mark.parametrize("labels", ["tags", None])
def test_sentences_are_scored_as_token_rows(spark, labels):
    df = sentences(spark)
    hasher, rows = hashed_rows(df, 1 << 10)
    model = PipelineModel([hasher, LogisticRegression(family="multinomial", regParam=0.01, maxIter=5).fit(rows)])
    cell = F.struct("pos", "token", *(["label"] if labels else []), vector_to_array("probability").alias("p"))
    scored = model.transform(classifiers.token_features(df.select("id", "tokens", *([labels] if labels else [])), "tokens", labels))
    cells = scored.groupBy("id").agg(F.array_sort(F.collect_list(cell)).alias("c")).collect()
    expected = {r["id"]: ([c["token"] for c in r["c"]], [c["label"] for c in r["c"]] if labels else None, [p for c in r["c"] for p in c["p"]]) for r in cells}
    found = token_regression.token_chances(model.stages[-1], df, "id", "tokens", labels, "p").collect()
    got = {r["id"]: (r["tokens"], r["tags"] if labels else None, r["p"]) for r in found}
    assert len(found) == len(got) and got.keys() == expected.keys()
    for key, (tokens, tags, chances) in got.items():
        assert (tokens, tags) == expected[key][:2]
        assert np.allclose(chances, expected[key][2], atol=1e-9)


def test_training_keeps_no_row_per_token(spark, tmp_path, monkeypatch):
    written = []
    keep = token_regression.materialise
    monkeypatch.setattr(token_regression, "materialise", lambda df, name: written.append(keep(df, name)) or written[-1])
    df = spark.createDataFrame([(i, ["the", "Ann", "b2"] * 50, [0, 1, 5] * 50) for i in range(40)], SCHEMA).coalesce(1)
    classifiers.train_token_classifier(df, "tokens", "tags", dim=64, max_iter=2)
    assert [stored.count() for stored in written] == [1]
