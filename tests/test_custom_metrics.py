"""A user's own metrics in two phases, and the log of a scoring run."""

import random

import numpy as np

from quillset.operators import custom_metrics, metrics, scoring, spans
from quillset.functions.fixed_values import ENTITY_LABELS, MASKED_LABEL


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Entities:
    """Counts of exact spans per type, read off the tags one by one."""

    columns = ["pred", "label"]
    schema = "type string, true_spans long, predicted_spans long, matched_spans long"

    def start(self):
        return {}

    def update(self, state, rows):
        for pred, label in zip(rows["pred"], rows["label"]):
            kept = [i for i, tag in enumerate(label) if tag != MASKED_LABEL]
            truth, guess = ({*self.spans([ENTITY_LABELS[tags[i]] for i in kept])} for tags in (label, pred))
            for at, group in enumerate((truth, guess, truth & guess)):
                for span in group:
                    state.setdefault(span[2], [0, 0, 0])[at] += 1
        return state

    def spans(self, tags):
        start = None
        for i, tag in enumerate([*tags, "O"]):
            if start is not None and (tag == "O" or tag[0] == "B" or tag[2:] != tags[start][2:]):
                yield start, i, tags[start][2:]
                start = None
            if tag != "O" and start is None:
                start = i

    def merge(self, state, other):
        for kind, counts in other.items():
            state[kind] = [a + b for a, b in zip(state.get(kind, [0, 0, 0]), counts)]
        return state

    def finish(self, state):
        return [(kind, *counts) for kind, counts in sorted(state.items())]


class Count:
    columns = ["x"]
    schema = "n long, top double"

    def start(self):
        return (0, None)

    def update(self, state, rows):
        known = rows["x"].dropna()
        return self.merge(state, (len(rows), float(known.max()) if len(known) else None))

    def merge(self, state, other):
        tops = [t for t in (state[1], other[1]) if t is not None]
        return (state[0] + other[0], max(tops, default=None))

    def finish(self, state):
        return [state]


def test_entity_scores_through_a_custom_metric(spark):
    draw = random.Random(4)
    rows = []
    for i in range(300):
        n = draw.randint(0, 12)
        label = [draw.choice([*range(9), MASKED_LABEL, 0, 0]) for _ in range(n)]
        rows.append((i, [draw.choice([max(t, 0), 0, draw.randrange(9)]) for t in label], label))
    df = spark.createDataFrame(rows, "id long, pred array<int>, label array<int>").repartition(7)
    built = spans.entity_scores(df).filter("type != 'micro'").select("type", "true_spans", "predicted_spans", "matched_spans")
    assert found(custom_metrics.custom_metric(df, Entities(), fan_in=3)) == found(built)


def test_choice_scores_through_a_custom_metric(spark):
    draw = random.Random(5)
    rows = [(draw.choice([0, 1, 2, 3, None]), draw.choice([-1, 0, 1, 2, 3, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "cop int, prediction int").repartition(5)
    (own,), (built,) = found(custom_metrics.custom_metric(df, custom_metrics.ChoiceTally())), found(metrics.choice_scores(df))
    assert np.allclose(own, built)
    assert found(custom_metrics.custom_metric(df.limit(0), custom_metrics.ChoiceTally())) == [(None, None, None)]


def test_groups_null_keys_and_handed_on_states(spark, monkeypatch):
    rows = [(i % 5 if i % 7 else None, None if i % 3 else float(i)) for i in range(700)]
    df = spark.createDataFrame(rows, "x long, y double").selectExpr("x as k", "y as x").repartition(6)
    expected = {}
    for key, value in rows:
        n, top = expected.get(key, (0, None))
        expected[key] = (n + 1, top if value is None else value if top is None else max(top, value))
    for most in (10_000, 2):
        monkeypatch.setattr(custom_metrics, "MOST_GROUPS", most)
        got = custom_metrics.custom_metric(df, Count(), ["k"])
        assert got.columns == ["k", "n", "top"]
        assert {r["k"]: (r["n"], r["top"]) for r in got.collect()} == expected
    assert custom_metrics.custom_metric(df.limit(0), Count(), ["k"]).count() == 0


def test_keys_of_any_type_come_back_whole(spark):
    big = 2**60
    rows = [(big, "a", 0.5), (big + 1, None, float("nan")), (None, "a", None), (0, "", 0.0), (None, "a", None), (big, "a", 0.5)]
    df = spark.createDataFrame(rows, "k long, s string, d double").selectExpr("*", "1.0D as x", "k > 0 as flag", "date'2020-01-01' as day")
    got = custom_metrics.custom_metric(df, Count(), ["k", "s", "d", "flag", "day"])
    plain = df.groupBy("k", "s", "d", "flag", "day").agg({"*": "count"}).selectExpr("*", "1.0D as top")
    assert str(found(got)) == str(found(plain)) and got.columns[:5] == ["k", "s", "d", "flag", "day"]


def make_upper():
    return lambda texts: np.array([t.upper() for t in texts], dtype=object)


def test_run_log_counts_what_was_scored(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else f"t{i}") for i in range(200)], "id long, text string").repartition(4)
    written, log = scoring.score_to_table(df, "text", make_upper, str(tmp_path / "a"), batch_size=16)
    assert {r["id"]: r["answer"] for r in written.collect()} == {i: None if i % 10 == 0 else f"T{i}" for i in range(200)}
    row = log.first()
    assert row["samples"] == 200 and row["seconds"] > 0 and row["per_second"] > 0
    assert np.isclose(row["per_second"], 200 / row["seconds"]) and 0 < row["batch_seconds"]
    none = scoring.score_to_table(df.limit(0), "text", make_upper, str(tmp_path / "b"))[1].first()
    assert none["samples"] == 0 and none["per_second"] is None
