"""Scalar functions on hand-written rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillset.functions import answers, prompts, text, tokens, vectors


def values(df, column="x"):
    return [r[column] for r in df.select(F.col(column)).collect()]


def test_parse_choice_goes_by_digit_not_by_position(spark):
    df = spark.createDataFrame([("10",), ("Option 2 or 1",), ("3",), ("",), ("none",), (None,)], "a string")
    assert values(df.select(answers.parse_choice(F.col("a")).alias("x"))) == [0, 1, 3, -1, -1, -1]


def test_strip_prefix_only_at_the_start(spark):
    df = spark.createDataFrame([("Answer: yes",), ("the Answer: yes",), ("Answer:yes",), (None,)], "a string")
    assert values(df.select(answers.strip_prefix(F.col("a")).alias("x"))) == ["yes", "the Answer: yes", "Answer:yes", None]


def test_closest_option_first_of_equals_and_blind_to_accents(spark):
    df = spark.createDataFrame(
        [("ab", "ax", "ay", "b", "c"), ("éa", "zz", "ea", "eb", "q"), ("x", None, None, None, None)],
        "a string, o0 string, o1 string, o2 string, o3 string",
    )
    options = [F.col(f"o{i}") for i in range(4)]
    assert values(df.select(answers.closest_option(F.col("a"), options).alias("x"))) == [0, 1, None]


def test_argmax_first_maximum_and_no_nan(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([2.0],)], "a array<double>")
    assert values(df.select(answers.argmax(F.col("a")).alias("x"))) == [1, 0]
    bad = spark.createDataFrame([([1.0, float("nan")],)], "a array<double>")
    with pytest.raises(PySparkException):
        bad.select(answers.argmax(F.col("a"))).collect()


def test_label_names_and_back(spark):
    df = spark.createDataFrame([([0, 2, 7],)], "a array<int>")
    named = df.select(answers.ids_to_labels(F.col("a"), ["O", "B-X", "I-X"]).alias("x"))
    assert values(named) == [["O", "I-X", None]]
    back = spark.createDataFrame([(["I-X", "?"],)], "a array<string>")
    assert values(back.select(answers.labels_to_ids(F.col("a"), ["O", "B-X", "I-X"]).alias("x"))) == [[2, None]]


def test_mask_filter(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, -100, 4]), ([5], [-100])], "p array<int>, l array<int>")
    pairs = values(df.select(answers.mask_filter(F.col("p"), F.col("l")).alias("x")))
    assert [[tuple(c) for c in row] for row in pairs] == [[(1, 1), (3, 4)], []]


def test_preprocess_folds_before_lowering_and_keeps_repeats(spark):
    df = spark.createDataFrame([("  The ÉTÉ été\tMaß  the Ünal “x” ",), ("plain Text",), (None,)], "a string")
    got = values(df.select(text.preprocess_text(F.col("a"), ["the"]).alias("x")))
    assert got == ['ete ete mass unal "x"', "plain text", None]


QUESTION = "id long, question string, opa string, opb string, opc string, opd string, cop int"


def test_mcq_prompt_text_and_null(spark):
    df = spark.createDataFrame([(1, "Q?", "a", "b", "c", "d", 2), (2, "Q?", None, "b", "c", "d", 0)], QUESTION)
    assert values(df.select(prompts.mcq_prompt().alias("x"))) == [
        "Q?\nchoose only one of the following options: \n0. a\n1. b\n2. c\n3. d\nRespond only with the number of the chosen option.",
        None,
    ]


def test_exam_prompt_has_no_margin(spark):
    df = spark.createDataFrame([(1, "Line one\n   line two", "a", "b", "c", "d", 2)], QUESTION)
    lines = values(df.select(prompts.exam_prompt().alias("x")))[0].split("\n")
    assert lines[1:8] == ["Question: Line one", "   line two", "Options:", "1. a", "2. b", "3. c", "4. d"]
    assert lines[0].startswith("You are a medical student") and lines[8].startswith("Solve this")


def test_shuffled_options_depend_on_seed_and_row_only(spark):
    df = spark.createDataFrame([(i, "Q", "a", "b", "c", "d", 0) for i in range(40)], QUESTION)
    shuffled = prompts.exam_prompt(True, F.col("id"), 1).alias("x")
    first, second = values(df.select(shuffled)), values(df.repartition(7).orderBy("id").select(shuffled))
    assert first == second
    orders = {tuple(line[3:] for line in p.split("\n")[3:7]) for p in first}
    assert len(orders) > 5 and all(sorted(o) == ["a", "b", "c", "d"] for o in orders)


def test_targets(spark):
    df = spark.createDataFrame([(1, "Q", "a", "b", "c", "d", 2)], QUESTION)
    row = df.select(prompts.correct_option(), prompts.target_number(), prompts.target_answer()).first()
    assert tuple(row) == ("c", "2.", "Answer: c")


def test_render_chat(spark):
    template = {"begin": "^", "user": ("<u>", "</u>"), "assistant": ("<a>", "</a>"), "generation": "<a>"}
    df = spark.createDataFrame([("hi", "yo"), ("hi", None)], "u string, a string")
    full = df.select(prompts.render_chat(prompts.chat_messages(F.col("u"), F.col("a")), template).alias("x"))
    assert values(full) == ["^<u>hi</u><a>yo</a>", None]
    ask = df.select(prompts.render_chat(prompts.chat_messages(F.col("u")), template, True).alias("x"))
    assert values(ask) == ["^<u>hi</u><a>"] * 2
    with pytest.raises(PySparkException):
        ask = df.select(prompts.render_chat(prompts.chat_messages(F.col("u")), {"assistant": ("", "")})).collect()


def test_align_labels(spark):
    df = spark.createDataFrame([([None, 0, 0, 1, 2, 2, None], [5, 6, 7])], "w array<int>, l array<int>")
    one = df.select(tokens.align_labels(F.col("w"), F.col("l")).alias("x"))
    every = df.select(tokens.align_labels(F.col("w"), F.col("l"), True).alias("x"))
    assert values(one) == [[-100, 5, -100, 6, 7, -100, -100]]
    assert values(every) == [[-100, 5, 5, 6, 7, 7, -100]]


def test_word_pieces(spark):
    df = spark.createDataFrame([(["abcdefghi", "xy", "abcd"],)], "t array<string>")
    assert values(df.select(tokens.piece_tokens(F.col("t"), 4, "<", ">").alias("x"))) == [
        ["<", "abcd", "efgh", "i", "xy", "abcd", ">"]
    ]
    assert values(df.select(tokens.piece_word_ids(F.col("t"), 4).alias("x"))) == [[None, 0, 0, 0, 1, 2, None]]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])], "u array<double>, v array<double>")
    rows = df.select(vectors.unit_vector(F.col("u")).alias("x"), vectors.angular_distance(F.col("u"), F.col("v")).alias("d"))
    first, second = rows.collect()
    assert first["x"] == pytest.approx([0.6, 0.8]) and first["d"] == pytest.approx((2 * (1 - 0.8)) ** 0.5)
    assert second["x"] == [0.0, 0.0] and second["d"] == pytest.approx(2**0.5)
