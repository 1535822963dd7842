"""CSV files read in splits against Spark's reader, which takes a file in one task."""

import random

import pytest
from pyspark.sql import functions as F

from quillset.contracts import REVIEWS
from quillset.sources import csv_splits, sinks, tables


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def cell(draw):
    parts = ["word", "Ünï", ",", '""', "\n", "\n\n", " ", "NA", "\\", "7"]
    kind = draw.random()
    if kind < 0.1:
        return ""
    if kind < 0.4:
        return f"plain{draw.randint(0, 9)} text"
    size = 900 if kind > 0.97 else draw.randint(1, 8)  # some cells are longer than a split
    return '"' + "".join(draw.choice(parts) for _ in range(size)) + '"'


def contents(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_splits_give_the_rows_of_whole_files(spark, tmp_path, small_splits, seed):
    draw, key = random.Random(seed), 0
    for name in ("a.csv", "b.csv", "only_header.csv", "empty.csv"):
        rows = []
        for _ in range(200 if name in ("a.csv", "b.csv") else 0):
            key += 1
            rows.append(f"{key},{cell(draw)},{draw.choice(['1.0', '-1', 'NaN', '', '0'])}")
            if draw.random() < 0.05:
                rows.append("")
        end = draw.choice(["\n", ""])
        text = "" if name == "empty.csv" else "\n".join(["id,clean_text,category", *rows]) + end
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    path = str(tmp_path)
    whole = tables.read_reviews_csv(spark, path)
    cut = tables.read_reviews_csv(spark, path, cut_files=True)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert contents(cut) == contents(whole) and cut.count() == 400
    assert cut.schema == whole.schema


def test_splits_without_a_broadcast(spark, tmp_path, small_splits, monkeypatch):
    draw = random.Random(9)
    rows = [f"{i},{cell(draw)},1.0" for i in range(300)]
    (tmp_path / "a.csv").write_text("\n".join(["id,clean_text,category", *rows]), encoding="utf-8", newline="")
    whole = contents(tables.read_reviews_csv(spark, str(tmp_path)))
    monkeypatch.setattr(csv_splits, "fits_broadcast", lambda df: False)
    assert contents(tables.read_reviews_csv(spark, str(tmp_path), cut_files=True)) == whole


def test_windows_line_ends_and_an_open_quote(spark, tmp_path, small_splits):
    text = "id,clean_text,category\r\n" + "".join(f'{i},"x{i}",1\r\n' for i in range(100)) + '100,"never closed'
    (tmp_path / "a.csv").write_text(text, newline="")
    got = {r["id"]: r["clean_text"] for r in tables.read_reviews_csv(spark, str(tmp_path), cut_files=True).collect()}
    assert len(got) == 101 and all(got[i] == f"x{i}" for i in range(100)) and "never closed" in got[100]


def test_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,other,category\n1,x,2\n")
    with pytest.raises(Exception, match="unexpected CSV header"):
        tables.read_reviews_csv(spark, str(tmp_path), cut_files=True).collect()


def test_written_results_come_back(spark, tmp_path, small_splits):
    df = spark.range(500).select(
        "id", F.concat(F.lit('say "hi"\n, '), F.repeat(F.lit("line\n"), (F.col("id") % 7).cast("int"))).alias("clean_text"),
        (F.col("id") % 3 - 1).cast("double").alias("category"),
    )
    path = sinks.write_results_csv(df.repartition(2), str(tmp_path / "w"))
    assert contents(csv_splits.read_split_csv(spark, path, REVIEWS)) == contents(df)
