"""Quality rules whose cutoffs keep the share of good documents that they reject below a stated risk.

Each rule rejects documents whose signal lies above a cutoff. A holdout of labelled documents says, for every stratum
(language) and every cutoff of a fixed grid, how many distinct good texts would go. Cutoffs are tested from the most lenient
on: the exact binomial test asks whether so few of the good texts would have been rejected if the true share were above the
limit. The first cutoff that cannot be told from the limit ends the sequence, which needs no correction along the grid; the
level is divided by the number of rules and strata (Bonferroni), and the limit by the number of rules. So with the stated
confidence no stratum loses more than RISK of its good documents, whatever the signals are worth. Of the cutoffs that pass,
the one that rejects most of the labelled poor texts is taken, and none if it does not gain enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import in_pieces, text_of
from quillset.session import broadcast_if_small, materialise

#: Share of good documents that the cutoffs may reject in a stratum, and the chance that some stratum loses more.
RISK, CHANCE = 0.05, 0.05
#: A cutoff is taken if it rejects at least so many times the limit of its rule among the poor texts.
GAIN = 5.0
#: Words a document has at least, and the percentage of words in repeated windows it has at most.
MIN_WORDS, MAX_REPEATED = 50, 50

#: Signals in thousandths and the values they are compared with, most lenient first.
SIGNALS: dict[str, range] = {
    "symbols": range(1000, -1, -5),  # symbols by characters of words
    "duplicate_lines": range(1000, -1, -10),  # duplicates by lines that have words
    "repeated_words": range(1000, -1, -10),  # words in repeated windows by words
    "capitals": range(1000, -1, -10),  # A-Z by characters of words
    "exclamations": range(1000, -1, -5),  # exclamation marks by characters of words
    "long_words": range(50_000, 2_000, -250),  # characters by words
    "short_words": range(0, -10_000, -250),  # the same, negative
}

_SYMBOLS, _WHITE = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLLOWING = bytes(range(0x80, 0xC0))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclamations"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that occur twice or more in the text, the first occurrence included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    size = len(numbers)
    pairs = ids[:-1] * size + ids[1:]
    if size >= 1 << 21:  # three numbers would not fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, name, times = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = times[name] > 1
    inside = np.zeros(len(ids), dtype=bool)
    for at in range(3):
        inside[at : at + len(twice)] |= twice
    return int(inside.sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS for one text in UTF-8."""
    words = text.split()
    dark = text.translate(None, _WHITE)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(dark.translate(None, _FOLLOWING)),
        len(dark) - len(dark.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(dark) - len(dark.translate(None, _CAPITALS)),
        dark.count(b"!"),
    )


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: Column | None = None) -> DataFrame:
    """id, stratum (null as ''), digest of the text and COUNTS per document; whole texts, nothing is shuffled."""
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce((F.col("lang") if stratum is None else stratum).cast("string"), F.lit("")).alias("stratum"),
        F.xxhash64(text_of(text)).alias("digest"),
        text_of(text).alias("text"),
    )
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("id", "stratum", "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            counted = np.array([counts_of(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()], dtype=np.int64)
            columns = [pa.array(c) for c in counted.T]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("id", "stratum", "digest")), *columns], names=["id", "stratum", "digest", *COUNTS])

    return rows.mapInArrow(run, f"{kinds}, {', '.join(f'{c} bigint' for c in COUNTS)}")


def signal(name: str) -> Column:
    """Thousandths of a signal; texts without words have none of it."""
    share = lambda part, of: F.coalesce(F.expr(f"{part} * 1000 div nullif({of}, 0)"), F.lit(0))
    return {
        "symbols": share("n_symbols", "word_chars"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "exclamations": share("n_exclamations", "word_chars"),
        "long_words": share("word_chars", "n_words"),
        "short_words": -share("word_chars", "n_words"),
    }[name].cast("long")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def binomial_at_most(rejected: int, n: int, share: float) -> float:
    """Chance of ``rejected`` or fewer of ``n`` when each goes with chance ``share``; exact up to rounding."""
    if rejected >= n:
        return 1.0
    if share <= 0:
        return 1.0
    if share >= 1:
        return 0.0
    terms = [lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(share) + (n - k) * log1p(-share) for k in range(rejected + 1)]
    most = max(terms)
    return min(1.0, exp(most) * sum(exp(t - most) for t in terms))


def chosen_cutoff(cells: pd.DataFrame, grid: range, limit: float, level: float, gain: float = GAIN) -> int | None:
    """The cutoff for one rule and stratum. ``cells`` has good and poor texts by ``cell``, the number of values of the grid
    that the signal lies above, counted from the strict end. None if no cutoff passes, or none is worth it.
    """
    good, poor = np.zeros(len(grid) + 1, dtype=np.int64), np.zeros(len(grid) + 1, dtype=np.int64)
    at = cells["cell"].to_numpy()
    np.add.at(good, at, cells["good"].to_numpy())
    np.add.at(poor, at, cells["poor"].to_numpy())
    n_good, n_poor = int(good.sum()), int(poor.sum())
    lost, caught = np.cumsum(good[::-1])[:-1], np.cumsum(poor[::-1])[:-1]  # above the first, second, ... value of the grid
    best, best_caught = None, 0
    for value, rejected, hits in zip(grid, lost, caught):
        if n_good == 0 or rejected > limit * n_good or binomial_at_most(int(rejected), n_good, limit) > level:
            break
        if hits > best_caught:
            best, best_caught = value, int(hits)
    return best if n_poor and best_caught >= gain * limit * n_poor else None


def calibrate(counted: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality", risk: float = RISK, chance: float = CHANCE, gain: float = GAIN) -> DataFrame:
    """(stratum, rule, cutoff) of the rules that take part in a stratum.

    ``labels`` has ``key`` and ``quality`` (1 good, 0 poor, others ignored); a document labelled twice counts as good if
    any label says so. Documents that the base rules reject are left out, and equal texts count once.
    """
    marks = labels.filter(F.col(quality).isin(0, 1)).groupBy(F.col(key).alias("id")).agg(F.max(quality).alias("good"))
    held = counted.filter(~base_failed()).join(marks, "id")
    texts = held.groupBy("stratum", "digest").agg(F.max("good").alias("good"), *[F.max(c).alias(c) for c in COUNTS])
    above = [
        F.struct(
            F.lit(name).alias("rule"),
            # values of the grid below the signal: they fall by a fixed step
            F.greatest(F.lit(0), F.least(F.lit(len(grid)), F.ceil((signal(name) - F.lit(grid[-1])) / F.lit(-grid.step)))).cast("int").alias("cell"),
        )
        for name, grid in SIGNALS.items()
    ]
    cells = texts.select("stratum", "good", F.explode(F.array(*above)).alias("s")).groupBy("stratum", "s.rule", "s.cell")
    cells = materialise(cells.agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum(1 - F.col("good").cast("long")).alias("poor")), "holdout-cells")
    strata = cells.select("stratum").distinct().count()
    limit, level = risk / len(SIGNALS), chance / (len(SIGNALS) * max(1, strata))

    def choose(group: pd.DataFrame) -> pd.DataFrame:  # as many rows as the grid has values, at most
        rule = group["rule"].iloc[0]
        cutoff = chosen_cutoff(group, SIGNALS[rule], limit, level, gain)
        found = [] if cutoff is None else [(group["stratum"].iloc[0], rule, cutoff)]
        return pd.DataFrame(found, columns=["stratum", "rule", "cutoff"])

    chosen = cells.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff bigint")
    return materialise(chosen, "cutoffs")


def judged(counted: DataFrame, cutoffs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: key, COUNTS without the last three, base_failed, kept, failed (names of the rules that reject it)."""
    limits = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))  # a row per rule
    rows = counted.join(broadcast_if_small(limits), "stratum", "left")
    failing = [F.when(signal(name) > F.try_element_at("limits", F.lit(name)), F.lit(name)) for name in SIGNALS]
    failed = F.filter(F.array(*failing), lambda name: name.isNotNull())
    return rows.select(
        F.col("id").alias(key),
        *COUNTS[:5],
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(failed) == 0)).alias("kept"),
        F.array_join(failed, ",").alias("failed"),
    )


def quality_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: Column | None = None, **options) -> DataFrame:
    """Per document: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed.

    Null texts have no words, as have empty and white ones; all of them fail the base rules. Repeated rows give repeated
    results. A null stratum is one of its own; without labels, or with too few to vouch for a cutoff, only the base rules
    reject. Texts are read once; other columns are not read.
    """
    counted = materialise(measured(docs, key, text, stratum), "quality-counts")
    return judged(counted, calibrate(counted, labels, key, **options), key)
