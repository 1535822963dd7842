"""Exact order, samples, splits, padding and packing."""

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillset.operators import ranks, sequences


def seeded(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("partitions", [1, 4, 13])
@pytest.mark.parametrize("n", [1, 40, 300, 999])
def test_sample_is_the_head_of_the_seeded_order(spark, partitions, n):
    df = spark.range(1000).repartition(partitions)
    got = {r["id"] for r in ranks.sample_n(df, n, "id", 7).collect()}
    assert got == set(seeded(range(1000), 7)[:n])


@pytest.mark.parametrize("n", [20, 400])
def test_sample_larger_than_the_table(spark, n):
    with pytest.raises(Exception, match="larger than the table"):
        ranks.sample_n(spark.range(10), n, "id", 1).collect()
    assert ranks.sample_n(spark.range(10), n, "id", 1, allow_fewer=True).count() == 10


@pytest.mark.parametrize("partitions", [1, 4, 13])
@pytest.mark.parametrize("n", [1, 2, 7, 1003])
def test_split_sizes_and_members(spark, partitions, n):
    split = ranks.split_exact(spark.range(n).repartition(partitions), "id", 0.2, 0.1, 5)
    got = {r["id"]: r["split"] for r in split.collect()}
    n_test = math.ceil(0.2 * n)
    n_val = math.ceil(0.1 * (n - n_test))
    order = seeded(range(n), 5)
    assert {i for i in got if got[i] == "test"} == set(order[:n_test])
    assert {i for i in got if got[i] == "validation"} == set(order[n_test : n_test + n_val])
    assert len(got) == n


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_rank_offsets_and_batches_of_gappy_clustered_keys(spark, partitions):
    keys = [*range(300), *range(10**9, 10**9 + 50), -5, 2**60, 2**60 + 1]
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k long, n int").repartition(partitions)
    rank = {r["k"]: r["rank"] for r in ranks.global_rank(df, "k").collect()}
    assert rank == {k: i + 1 for i, k in enumerate(sorted(keys))}
    offsets = {r["k"]: r["offset"] for r in ranks.prefix_offsets(df, "k", "n").collect()}
    total = 0
    for k in sorted(keys):
        assert offsets[k] == total
        total += k % 7
    batch = {r["k"]: r["batch"] for r in ranks.batch_index(df, "k", 64).collect()}
    assert batch == {k: i // 64 for i, k in enumerate(sorted(keys))}
    item = {r["k"]: r["item"] for r in ranks.item_ids(df, "k").collect()}
    assert item == {k: i for i, k in enumerate(sorted(keys))}


def test_rank_of_nothing(spark):
    assert ranks.global_rank(spark.range(0), "id").count() == 0
    assert ranks.split_exact(spark.range(0), "id", 0.2, 0.1).count() == 0


def test_top_k_breaks_ties_by_item(spark):
    df = spark.createDataFrame([(1, 9, 0.5), (1, 3, 0.5), (1, 5, 0.1), (2, 1, 0.2)], "query_id long, item_id long, distance double")
    got = [tuple(r) for r in ranks.top_k_per_query(df, 2).orderBy("query_id", "rank").collect()]
    assert got == [(1, 5, 0.1, 1), (1, 3, 0.5, 2), (2, 1, 0.2, 1)]
    plan = ranks.top_k_per_query(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle


def vocabulary(spark, tokens):
    return spark.createDataFrame([(i + 4, t, 1) for i, t in enumerate(tokens)], "id int, token string, n long")


def test_vocabulary_ties_and_specials(spark):
    df = spark.createDataFrame([(["b", "a", "c", "a", "[PAD]"],), (["b", "d"],)], "t array<string>")
    got = [tuple(r) for r in sequences.build_vocab(df, "t", 3).orderBy("id").collect()]
    assert got[:4] == [(0, "[PAD]", 0), (1, "[UNK]", 0), (2, "[CLS]", 0), (3, "[SEP]", 0)]
    assert got[4:] == [(4, "a", 2), (5, "b", 2), (6, "c", 1)]


def test_both_encoders_agree(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["a", "z", "b", "a"]), (2, []), (3, None), (4, ["q", None])], "id long, t array<string>")
    vocab = vocabulary(spark, ["a", "b"])
    wanted = {1: [4, 1, 5, 4], 2: [], 3: None, 4: [1, 1]}
    in_row = {r["id"]: r["ids"] for r in sequences.encode_tokens(df, "t", vocab, "id", "ids").collect()}
    monkeypatch.setattr(sequences, "BROADCAST_ROW_LIMIT", 1)
    joined = {r["id"]: r["ids"] for r in sequences.encode_tokens(df, "t", vocab, "id", "ids").collect()}
    assert in_row == wanted and joined == wanted


def test_assemble_in_stretches(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    got = {r["k"]: r["vs"] for r in sequences.assemble_sequence(df.repartition(5), ["k"], "pos", "v", "vs", chunk=7).collect()}
    assert got == {k: [2 * i for i in range(k, 100, 3)] for k in range(3)}


def test_tokenize_truncates(spark):
    df = spark.createDataFrame([(1, "B a É a"), (2, "")], "id long, text string")
    got = {r["id"]: (r["input_ids"], r["attention_mask"]) for r in sequences.tokenize(df, "text", vocabulary(spark, ["a", "b", "e"]), "id", 3).collect()}
    assert got == {1: ([5, 4, 6], [1, 1, 1]), 2: ([], [])}


def test_presplit_truncation_keeps_the_closing_token(spark):
    df = spark.createDataFrame([(["abcdef", "xyz"], [1, 2])], "tokens array<string>, tags array<int>")
    row = sequences.tokenize_presplit(df, "tokens", "tags", width=2, max_len=4).first()
    assert row["pieces"] == ["[CLS]", "ab", "cd", "[SEP]"]
    assert row["word_ids"] == [None, 0, 0, None] and row["labels"] == [-100, 1, -100, -100]


@pytest.mark.parametrize("side", ["left", "right"])
def test_padding(spark, side):
    df = spark.createDataFrame([(0, [5], [1]), (0, [6, 7, 8], [1, 2, 3]), (1, [9], [4])], "batch int, input_ids array<int>, labels array<int>")
    got = sorted((r["batch"], r["input_ids"], r["labels"], r["attention_mask"]) for r in sequences.pad_batch(df, labels="labels", side=side).collect())
    short = (0, [5, 0, 0], [1, -100, -100], [1, 0, 0]) if side == "right" else (0, [0, 0, 5], [-100, -100, 1], [0, 0, 1])
    assert got == sorted([short, (0, [6, 7, 8], [1, 2, 3], [1, 1, 1]), (1, [9], [4], [1])])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(10, 99), max_size=12), min_size=1, max_size=12), st.integers(1, 6))
def test_packing_is_the_stream_cut_into_blocks(spark, rows, block):
    df = spark.createDataFrame(list(enumerate(rows)), "id long, input_ids array<int>").repartition(3)
    stream = [t for row in rows for t in [*row, 3]]
    whole = {r["block"]: r["input_ids"] for r in sequences.pack_sequences(df, "id", block=block, drop_last=False).collect()}
    assert [t for b in sorted(whole) for t in whole[b]] == stream
    full = sequences.pack_sequences(df, "id", block=block).collect()
    assert len(full) == len(stream) // block and all(len(r["input_ids"]) == block for r in full)


@pytest.mark.parametrize("partitions", [1, 7])
def test_ranks_of_keys_that_are_no_numbers(spark, partitions):
    texts = [f"{w}-{i}" for i, w in enumerate(["é", "z", "A", "", "日", "a\u0000b"] * 40)] + [None]
    df = spark.createDataFrame([(t, len(t or "")) for t in texts], "k string, n int").repartition(partitions)
    ordered = sorted(texts, key=lambda t: (t is not None, (t or "").encode()))
    assert {r["k"]: r["rank"] for r in ranks.global_rank(df, "k").collect()} == {t: i for i, t in enumerate(ordered, 1)}
    sums, total = {}, 0
    for t in ordered:
        sums[t], total = total, total + len(t or "")
    assert {r["k"]: r["offset"] for r in ranks.prefix_offsets(df, "k", "n").collect()} == sums
    days = spark.sql("select date_add(date'2020-01-01', cast(id * 37 % 500 as int)) as d from range(500)")
    assert {r["d"].toordinal(): r["batch"] for r in ranks.batch_index(days, "d", 64).collect()} == {737425 + i: i // 64 for i in range(500)}


def test_packing_by_a_text_key(spark):
    df = spark.createDataFrame([(f"k{9 - i}", [i] * (i + 1)) for i in range(9)], "id string, input_ids array<int>")
    blocks = sequences.pack_sequences(df, "id", block=7, drop_last=False).orderBy("block").collect()
    whole = [x for i in reversed(range(9)) for x in [*[i] * (i + 1), 3]]
    assert [x for r in blocks for x in r["input_ids"]] == whole


def test_assembled_rows_travel_once_and_as_stretches(spark):
    rows = [(k, p, f"{k}.{p}") for k in (3, None, 5) for p in range(40)] + [(5, p, f"again {p}") for p in range(10, 12)]
    rows += [(7, None, "y"), (7, None, "x"), (7, 2, None), (7, 0, "z"), (3, 2**31 - 1, "last")]
    df = spark.createDataFrame(rows, "k int, pos int, v string").coalesce(1)
    whole = sequences.assemble_sequence(df, ["k"], "pos", "v", "vs", chunk=16)
    got = {r["k"]: r["vs"] for r in whole.collect()}
    own = lambda k: [f"{k}.{p}" for p in range(40)]
    assert got == {3: [*own(3), "last"], None: own(None), 5: own(5)[:10] + ["5.10", "again 10", "5.11", "again 11"] + own(5)[12:], 7: ["x", "y", "z", None]}
    spread = sequences.assemble_sequence(df.repartition(3), ["k"], "pos", "v", "vs")
    assert spread._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sequences._stretches(df.selectExpr("k", "pos as _pos", "v as _value"), ["k"], 1000).filter("k = 3").count() == 2
