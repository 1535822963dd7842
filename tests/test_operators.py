"""Filters, joins, metrics, spans, sources and sinks on hand-written rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.contracts import QUESTIONS, REVIEWS, require_columns
from quillset.operators import joins, logs, metrics, projections, scoring, spans
from quillset.sources import sinks, tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_single_choice_keeps_unknown_types(spark):
    df = spark.createDataFrame([(1, "multi"), (2, "single"), (3, None)], "id long, choice_type string")
    assert rows(projections.single_choice(df), "id") == [(2,), (3,)]


def test_single_choice_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "q")
    spark.createDataFrame([(1, "multi"), (2, None)], "id long, choice_type string").write.parquet(path)
    plan = projections.single_choice(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualNullSafe(choice_type,multi))" in plan


def test_recode_is_simultaneous_and_passes_unknown_values(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (5.0,)], "c double")
    assert [r["n"] for r in projections.recode(df, "c", "n").collect()] == [0, 1, 2, 5]


def test_require_columns(spark):
    with pytest.raises(ValueError):
        require_columns(spark.range(1), "id", "text")


def test_label_dictionary(spark):
    got = rows(projections.label_dictionary(spark.range(1), ["O", "B-X"]), "label_id", "label", "num_labels")
    assert got == [(0, "O", 2), (1, "B-X", 2)]


def test_log_merge_split_rules(spark):
    log = spark.createDataFrame(
        [
            (1.0, 10, 0.5, None), (1.0, 10, 0.4, 0.9), (1.0, 10, None, 0.7), (1.0, 10, None, 0.6),
            (2.0, 20, 0.3, None), (1.0, 20, None, 0.2), (2.0, 30, None, None),
        ],
        "epoch double, step long, loss double, eval_loss double",
    )
    # a row with both losses is a training row; equal keys combine; the step counts beside the epoch
    assert rows(joins.merge_logs(log), "epoch", "step", "loss", "eval_loss") == [
        (1.0, 10, 0.4, 0.6), (1.0, 10, 0.4, 0.7), (1.0, 10, 0.5, 0.6), (1.0, 10, 0.5, 0.7),
    ]


def test_best_epoch_takes_the_lowest_step_of_equals(spark):
    log = spark.createDataFrame([(3.0, 30, 0.2), (1.0, 10, 0.2), (2.0, 20, 0.5), (4.0, 40, None)], "epoch double, step long, eval_loss double")
    assert rows(logs.best_epoch(log), "epoch", "step", "eval_loss") == [(1.0, 10, 0.2)]


def test_write_back_keeps_unanswered_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    answers = spark.createDataFrame([(1, "a")], "id long, answer string")
    assert rows(joins.write_back(df, answers), "id", "answer") == [(1, "a"), (2, None)]


def test_choice_scores(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, -1), (3, 3)], "cop int, prediction int")
    assert rows(metrics.choice_scores(df), "accuracy", "error_rate", "invalid_rate") == [(0.5, 0.5, 0.25)]


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "y int, p int")
    report = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert (report["2"]["precision"], report["2"]["recall"], report["2"]["f1"], report["2"]["support"]) == (0, 0, 0, 1)
    assert report["0"]["precision"] == pytest.approx(0.5) and report["0"]["recall"] == pytest.approx(0.5)
    assert report["1"]["precision"] == pytest.approx(0.5) and report["1"]["recall"] == pytest.approx(1.0)
    assert report["accuracy"]["precision"] == pytest.approx(0.5)
    assert report["macro avg"]["recall"] == pytest.approx(0.5)
    assert report["weighted avg"]["recall"] == pytest.approx((2 * 0.5 + 1.0) / 4)
    assert report["weighted avg"]["support"] == 4


def test_merged_logs_keep_all_metric_columns(spark):
    log = spark.createDataFrame(
        [(1.0, 1, 0.5, None, 1e-3, None, 10.0), (1.0, 1, None, 0.4, None, 0.9, 3.0), (2.0, 2, 0.3, None, 1e-4, None, 11.0)],
        "epoch double, step long, loss double, eval_loss double, lr double, eval_f1 double, runtime double",
    )
    merged = joins.merge_logs(log)
    assert rows(merged, "epoch", "step", "loss", "lr", "runtime_train", "eval_loss", "eval_f1", "runtime_valid") == [(1.0, 1, 0.5, 1e-3, 10.0, 0.4, 0.9, 3.0)]
    assert "runtime" not in merged.columns


def test_neighbours_without_document_or_class_stay(spark):
    near = spark.createDataFrame([(1, 10, 0.1), (1, 11, 0.2), (1, 12, 0.3)], "query_id long, item_id long, distance double")
    documents = spark.createDataFrame([(10, "a", 0), (11, "b", 7)], "doc_id long, text string, target int")
    classes = spark.createDataFrame([(0, "news")], "target int, target_name string")
    found = joins.lookup_neighbours(near, documents, classes)
    assert rows(found, "item_id", "text", "target", "target_name") == [(10, "a", 0, "news"), (11, "b", 7, None), (12, None, None, None)]


def test_unknown_predictions_are_counted(spark):
    df = spark.createDataFrame([(0, 1), (0, 9), (0, None), (1, 0)], "y int, p int")
    assert rows(metrics.confusion_matrix(df, "y", "p", [0, 1]), "label", "pred_0", "pred_1", "pred_other") == [(0, 0, 1, 2), (1, 1, 0, 0)]


def test_entity_scores_without_spans_and_with_colons(spark):
    names = ["O", "B-a:b", "I-a:b", "B-a:c"]
    none = spark.createDataFrame([([0, 0], [0, 0])], "pred array<int>, label array<int>")
    for df in (none, none.limit(0)):
        assert [tuple(r)[:4] for r in spans.entity_scores(df, names=names).collect()] == [("micro", 0, 0, 0)]
    df = spark.createDataFrame([([1, 2, 0, 3], [1, 2, 0, 1])], "pred array<int>, label array<int>")
    assert rows(spans.entity_scores(df, names=names), "type", "true_spans", "predicted_spans", "matched_spans") == [("a:b", 2, 1, 1), ("a:c", 0, 1, 0), ("micro", 2, 2, 1)]


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, -1)], "y int, p int")
    assert rows(metrics.confusion_matrix(df, "y", "p", [-1, 0, 1]), "label", "pred_minus_1", "pred_0", "pred_1") == [(0, 0, 1, 1), (1, 1, 0, 0)]


def test_token_accuracy_all_masked(spark):
    df = spark.createDataFrame([([1], [-100])], "pred array<int>, label array<int>")
    assert rows(metrics.token_accuracy(df), "tokens", "hits", "accuracy") == [(0, 0, 0.0)]


SENTENCES = [
    ("lone I after O", ["O", "I-PER", "I-PER", "O"], [(1, 2, "PER")]),
    ("I of another type", ["B-PER", "I-LOC", "I-LOC"], [(0, 0, "PER"), (1, 2, "LOC")]),
    ("B after B", ["B-ORG", "B-ORG", "I-ORG"], [(0, 0, "ORG"), (1, 2, "ORG")]),
    ("to the end", ["O", "B-MISC", "I-MISC"], [(1, 2, "MISC")]),
    ("nothing", ["O", "O"], []),
]


@pytest.mark.parametrize("chunk", [2, 3, 65_536])
def test_spans_of_arrays_and_rows_agree(spark, chunk):
    df = spark.createDataFrame([(n, t) for n, t, _ in SENTENCES] + [("empty", [])], "s string, t array<string>")
    wanted = sorted((n, *span) for n, _, found in SENTENCES for span in found)
    assert rows(spans.bio_spans(df, "s", "t"), "sent", "start", "end", "type") == wanted
    flat = df.select("s", F.posexplode("t").alias("pos", "tag"))
    assert rows(spans.bio_spans_rows(flat, "s", "pos", "tag", chunk), "sent", "start", "end", "type") == wanted


def test_long_span_over_many_chunks(spark):
    flat = spark.range(50).select(F.lit(1).alias("s"), F.col("id").alias("pos"), F.when(F.col("id") == 3, "B-X").when(F.col("id").between(4, 40), "I-X").otherwise("O").alias("tag"))
    assert rows(spans.bio_spans_rows(flat, "s", "pos", "tag", 7), "start", "end", "type") == [(3, 40, "X")]


def test_entity_scores_mask_joins_what_it_separates(spark):
    # the masked token between two I- tags is taken out before spans are read
    df = spark.createDataFrame([([1, 0, 2, 0], [1, -100, 2, 0]), ([5], [-100])], "pred array<int>, label array<int>")
    got = {r["type"]: r for r in spans.entity_scores(df).collect()}
    assert set(got) == {"PER", "micro"}
    assert (got["micro"]["true_spans"], got["micro"]["predicted_spans"], got["micro"]["matched_spans"]) == (1, 1, 1)
    assert got["PER"]["f1"] == 1.0


def test_entity_scores_without_predictions(spark):
    df = spark.createDataFrame([([0, 0], [1, 0])], "pred array<int>, label array<int>")
    micro = spans.entity_scores(df).filter("type = 'micro'").first()
    assert (micro["precision"], micro["recall"], micro["f1"]) == (0.0, 0.0, 0.0)


def test_csv_round_trip_and_null_tokens(spark, tmp_path):
    text = ['say "hi", now', "two\nlines", " padded ", "NA", None, "null", "fine"]
    df = spark.createDataFrame([(i, t, 1.0 if i else None) for i, t in enumerate(text)], REVIEWS)
    path = sinks.write_results_csv(df, str(tmp_path / "r"))
    plain = rows(sinks.read_results_csv(spark, path, REVIEWS), "id", "clean_text")
    assert plain == sorted(enumerate(text), key=repr)
    cleaned = dict(rows(tables.read_reviews_csv(spark, path), "id", "clean_text"))
    assert [cleaned[i] for i in range(len(text))] == ['say "hi", now', "two\nlines", " padded ", None, None, None, "fine"]
    assert tables.read_reviews_csv(spark, path).filter("category is null").count() == 1


def test_split_folder_is_pruned(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([(1, "train"), (2, "test")], "id long, split string").write.partitionBy("split").parquet(path)
    test = tables.read_split(spark, path, "test")
    assert rows(test, "id") == [(2,)]
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_metrics_round_trip_keeps_nulls(spark, tmp_path):
    one = spark.createDataFrame([(1.5, None)], "loss double, f1 double")
    path = sinks.write_metrics(one, str(tmp_path / "m"))
    assert rows(sinks.read_metrics(spark, path, one.schema), "loss", "f1") == [(1.5, None)]


def make_fussy_scorer():
    def score(inputs):
        if any("bad" in x for x in inputs):
            raise ValueError("bad input")
        return [x.upper() for x in inputs]

    return score


def test_scoring_survives_bad_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, "d")], "id long, t string").coalesce(1)
    got = rows(scoring.score_batches_with_errors(df, "t", make_fussy_scorer, 4), "id", "answer", "error")
    assert got == [(1, "A", None), (2, None, "ValueError: bad input"), (3, None, None), (4, "D", None)]


def make_length_model():
    import numpy as np

    return lambda inputs: np.array([len(x) for x in inputs])


def test_scoring_numbers_with_nulls(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "id long, t string")
    got = rows(scoring.score_batches(df, "t", make_length_model, 8, T.LongType()), "id", "answer")
    assert got == [(1, 3), (2, None)]


def test_questions_contract(spark, sf_dir):
    from quillset.plans import fixtures

    made = fixtures.mcq(spark, sf_dir)
    assert [(f.name, f.dataType) for f in made.schema.fields] == [(f.name, f.dataType) for f in QUESTIONS.fields]
