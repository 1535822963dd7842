"""Hard negatives, quality rules and periodic runs against brute force and hand-made cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillset.llm import negatives, quality, runs
from quillset.llm.queries import op13_periodic_runs

# ---------------------------------------------------------------- hard negatives


def mined(rows, n_positives=5, n_negatives=10, low=30, high=90, every=100):
    """Rows are (id, vector, label); brute force in Python integers."""
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in ok]
    anchors = {}
    for i, v, label in sorted(whole, key=lambda r: (r[2], r[1])):
        if i % every == 0:
            anchors.setdefault(i, (v, label))
    out = Counter()
    for a, (v, label) in anchors.items():
        scores = [(-sum(x * y for x, y in zip(v, w)), i, own == label) for i, w, own in whole if i != a and len(w) == len(v)]
        for score, positive, _ in sorted(s for s in scores if s[2])[:n_positives]:
            fits = sorted(s for s in scores if not s[2] and low * -score <= 100 * -s[0] <= high * -score)[:n_negatives]
            out.update((a, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(fits, 1))
    return out


def found_negatives(spark, rows, every=100, kind="float", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumn("rank", F.lit("mine")).withColumn("dim", F.lit(1))
    got = negatives.hard_negatives(df.repartition(3), F.col("vec_id") % every == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize("scale", [0.3, 900.0, 1e6])
def test_packed_scores_are_exact(scale):
    draw = np.random.default_rng(1)
    for dim in (1, 3, 64):
        a, r = (np.floor(draw.standard_normal((n, dim)) * scale).astype(np.int64) for n in (5, 23))
        assert (negatives.packed_scores(a, r) == a @ r.T).all()
    assert negatives.packed_scores(a[:0], r).shape == (0, 23)
    same = np.full((2, 4), -7, dtype=np.int64)
    assert (negatives.packed_scores(same, same) == 196).all()


def test_packed_scores_of_wide_numbers():
    a, r = np.array([[3 << 40, -5]], dtype=np.int64), np.array([[1 << 19, 7], [-(1 << 19), 0]], dtype=np.int64)
    assert negatives.packed_scores(a, r).tolist() == [[(3 << 59) - 35, -(3 << 59)]]
    with pytest.raises(OverflowError):
        negatives.packed_scores(a, a)


def test_hard_negatives_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_BLOCK", 97)  # many blocks on both sides
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 7)
    draw = np.random.default_rng(0)
    vectors = draw.standard_normal((600, 8)).astype(np.float32)
    vectors[100:300] = vectors[20]  # many copies
    labels = draw.integers(0, 3, size=600)
    labels[:250] = 1
    rows = [(i, [float(x) for x in v], int(label)) for i, (v, label) in enumerate(zip(vectors, labels))]
    odd = [(700, None, 1), (701, [float("nan")] * 8, 1), (710, [None] * 8, 2), (720, [float("inf")] * 8, 2), (730, [0.0] * 8, None), (740, [0.0] * 8, 0), (750, [], 1), (760, [], 2)]
    odd += [(None, [1.0] * 8, 1), (770, [1.0, 2.0], 1), (780, [1.0, 1.0], 1), (790, [0.5, 1.0], 2)]
    rows += odd + [rows[50], rows[50], rows[20]]  # repeated rows
    wanted = mined(rows, every=10)
    assert len(wanted) > 1500 and found_negatives(spark, rows, 10) == wanted


def test_hard_negatives_of_few_rows(spark):
    assert found_negatives(spark, []) == Counter()
    assert found_negatives(spark, [(0, [1.0], 1)]) == Counter()  # neither positives nor negatives
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2), (4, [0.9], 2), (5, [0.3], 2)]
    assert found_negatives(spark, rows) == mined(rows) and {r[3] for r in mined(rows)} == {2, 4}
    big = [(0, [4e6, 1.0], 1), (1, [3e6, -2.0], 1), (2, [2e6, 0.5], 2)]
    assert found_negatives(spark, big, kind="double") == mined(big) != Counter()


# ---------------------------------------------------------------- quality rules


def base_values(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, seen, duplicates = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(inside)


TEXTS = [
    None, "", " \n\t\x0b", "a b c", "a b c a b c", "x\nx\n\n\nx \nx", "é ☃ 😀 z <b> 5% & | #*$", "a a a a a a", "one two three four one two three",
    "long " * 40_000, "\n".join(["same line here"] * 30), " ".join(f"w{i}" for i in range(60)), "a\rb\rc a b c", "x" * 200_000,
]


def test_base_counts_agree_with_brute_force(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no key")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string")).withColumn("n_words", F.lit("mine"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.quality_report(df, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        n, chars, symbols, duplicates, repeated = base_values("no key" if r.doc_id is None else TEXTS[r.doc_id] if r.doc_id != 9 else "long")
        if r.doc_id == 9:
            n, chars, repeated = 40_000, 160_000, 40_000
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, duplicates, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and r.kept == (not r.base_failed) and r.failed == ""
    assert quality.quality_report(df.limit(0), labels).count() == 0


def test_binomial_bound_is_exact():
    for n, share in ((1, 0.3), (12, 0.05), (40, 0.5)):
        for k in range(n + 1):
            wanted = sum(math.comb(n, j) * share**j * (1 - share) ** (n - j) for j in range(k + 1))
            assert quality.binomial_at_most(k, n, share) == pytest.approx(wanted, abs=1e-12)


def test_cutoffs_stop_at_the_first_that_fails():
    import pandas as pd

    grid = range(1000, -1, -100)
    cells = lambda good, poor: pd.DataFrame({"cell": range(12), "good": good, "poor": poor})
    # cell c: the signal lies above the c last values of the grid
    good = [4000, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    assert quality.chosen_cutoff(cells(good, [10, 0, 0, 0, 0, 0, 0, 0, 20, 0, 0, 0]), grid, 0.01, 0.01) == 700
    good = [3900, 0, 0, 0, 0, 0, 0, 100, 0, 0, 0, 0]  # lost from 600 on
    assert quality.chosen_cutoff(cells(good, [10, 0, 0, 0, 0, 0, 20, 0, 20, 0, 0, 0]), grid, 0.01, 0.01) == 700
    assert quality.chosen_cutoff(cells([3] + [0] * 11, [0] * 11 + [50]), grid, 0.01, 0.01) is None  # too few good texts to tell
    assert quality.chosen_cutoff(cells([4000] + [0] * 11, [1000] + [0] * 10 + [1]), grid, 0.01, 0.01) is None  # not worth it
    assert quality.chosen_cutoff(cells([4000] + [0] * 11, [0] * 12), grid, 0.01, 0.01) is None


def test_rules_catch_poor_texts_and_keep_good_ones(spark):
    draw = random.Random(3)
    words = [f"word{i}" for i in range(500)]
    good = lambda: " ".join(draw.choices(words, k=80))
    poor = lambda: " ".join(w + draw.choice(["", "###", "$$$", "%%%"]) for w in draw.choices(words, k=80))
    rows = [(i, poor() if i % 5 == 0 else good(), "en" if i % 3 else None, 0 if i % 5 == 0 else 1) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int").repartition(6)
    labels = df.filter("doc_id % 2 = 0").select("doc_id", "quality")
    labels = labels.union(spark.createDataFrame([(1, None), (99999, 0)], "doc_id long, quality int")).union(labels.limit(5))
    found = quality.quality_report(df, labels).join(df.select("doc_id", "quality"), "doc_id").filter("NOT base_failed")
    kept = {r.quality: r.k for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    assert kept[1] >= 1 - quality.RISK and kept[0] < 0.1
    assert {r.failed for r in found.filter("NOT kept").collect()} <= {"symbols", "symbols,long_words", "long_words"}


# ---------------------------------------------------------------- runs


def runs_by_hand(words, min_length=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(min_length, exponent * q):
                found.setdefault((at, end - at + q), q)
            at = max(end, at + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(draw):
    k = draw.choice([1, 2, 3, 30])
    words = [draw.randrange(k) for _ in range(draw.randrange(50))]
    for _ in range(draw.randrange(4)):
        unit = [draw.randrange(k) for _ in range(draw.randrange(1, 9))]
        at = draw.randrange(len(words) + 1)
        words[at:at] = (unit * 60)[: draw.randrange(60)]
    return words


@pytest.mark.parametrize("least,exponent", [(6, 4), (4, 3), (20, 5)])
def test_runs_agree_with_brute_force(least, exponent):
    draw = random.Random(least)
    total = 0
    for _ in range(40):
        docs = [random_words(draw) for _ in range(25)]
        begins = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        found = runs.runs_of(np.array([w for d in docs for w in d], dtype=np.int64), begins, least, exponent)
        for i, words in enumerate(docs):
            wanted = runs_by_hand(words, least, exponent)
            total += len(wanted)
            assert found.get(i, []) == wanted
    assert total > 100


def test_long_runs_take_little_time():
    n = 200_000
    begins = np.array([0, n])
    assert runs.runs_of(np.zeros(n, dtype=np.int64), begins) == {0: [(0, n, 1)]}
    assert runs.runs_of(np.arange(n) % 50_000, begins) == {0: [(0, n, 50_000)]}
    assert runs.runs_of(np.arange(n), begins) == {}
    assert len(runs.runs_of(np.array([0, 0, 0, 0, 0, 0, 1, 2] * (n // 8), dtype=np.int64), begins)[0]) == n // 8 + 1
    with pytest.raises(ValueError):
        runs.find_runs(None, min_exponent=2)


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_run_report_agrees_with_brute_force(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    draw = random.Random(9)
    texts = dict(enumerate([None, "", " \n", "a", "b " * 9, "a b\x0bc d " * 7, "é ☃ " * 5 + "x", "a " * 50_000]))
    texts |= {i: " ".join(f"w{w}" for w in random_words(draw)) for i in range(10, 300)}
    rows = [*texts.items(), (6, texts[6])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("mine")).repartition(4)
    found = runs.run_report(runs.find_runs(runs.with_planted_tails(df))).collect()
    assert len(found) == len(rows) and sum(r.n_runs for r in found) > 100
    for r in found:
        words = planted(r.doc_id, texts[r.doc_id])
        listed = [(0, len(words), 1)] if r.doc_id == 7 else runs_by_hand(words)
        best = min(listed, key=lambda x: (-x[1], x[0], x[2])) if listed else (None, None, None)
        milli = 1000 * best[1] // best[2] if listed else None
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(listed), *best, milli)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in listed))
        dropped = {i for s, n, q in listed for i in range(s + q, s + n)}
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in dropped))
    assert runs.find_runs(df.limit(0)).count() == 0
    unkeyed = runs.find_runs(spark.createDataFrame([(None, "b " * 9)], "doc_id long, text string")).first()
    assert unkeyed.doc_id is None and unkeyed.collapsed == "b" and [tuple(x) for x in unkeyed.runs] == [(0, 9, 1)]


def test_runs_of_the_given_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r.doc_id: r.n_runs for r in op13_periodic_runs(spark, sf_dir).collect()}
    short = {i: t for i, t in texts.items() if len(t or "") < 20_000}
    assert found.keys() == texts.keys() and len(short) > 150
    assert {i: found[i] for i in short} == {i: len(runs_by_hand(planted(i, t))) for i, t in short.items()}
