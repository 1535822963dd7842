"""Runs: maximal periodic stretches of a text's words, found as maximal pairs in the LCP-interval tree.

Two places of one document whose words agree for exactly l words to the right, and whose left words differ, form a maximal
pair. With a distance of q words it is a stretch of l + q words with period q that cannot be extended, so the pairs whose
distance is small against l are the runs, and no extension is needed. Pairs of one stretch whose distance is a multiple of
the smallest period fall together; the smallest distance stays.

The suffixes of many documents are sorted at once by doubling; documents never compare equal, as their number is part of
every word. The intervals of equal prefixes are then gone through bottom-up with a stack. A node holds its places by
position, each with its left word (its class). Two occurrences of l words less than half of l apart are a period of those
words, and every occurrence but the first of such a row of occurrences has the same word on its left: so of the classes near
a place only those at the two ends of its window have to be looked at, and each pair that is formed is a stretch.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import in_pieces, text_of

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text whose suffixes are sorted together, one document at least.
PIECE = 2 << 20
MIN_LENGTH, MIN_EXPONENT = 6, 4


class _Ids(dict):
    """word -> its number, by first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def least_overlap(min_length: int, min_exponent: int) -> int:
    """The fewest words that the two places of a pair of a run have in common."""
    return min(max(min_length - q, (min_exponent - 1) * q, 1) for q in range(1, min_length + 1))


def with_repeats(ids: np.ndarray, begins: np.ndarray, width: int) -> np.ndarray:
    """Which documents may hold a run: those with some ``width`` words twice. Hashes only ever let more through."""
    n = len(ids) - width + 1
    if n < 2:
        return np.zeros(0, dtype=np.int64)
    doc = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    with np.errstate(over="ignore"):
        joined = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for at in range(width):
            joined = (joined ^ (joined >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[at : at + n].astype(np.uint64)
        joined = (joined ^ (joined >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    whole = doc[:n] == doc[width - 1 :]
    joined, doc = joined[whole], doc[:n][whole]
    ordered = np.sort(joined)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(twice, joined), len(twice) - 1)
    return np.unique(doc[twice[at] == joined])


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of the places by their first 1, 2, 4, ... words, until all differ. Equal rank: those words are equal.

    ``symbols`` are numbers of words that tell documents apart, ``ends`` is where the document of each place ends.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    key = symbols[order]
    rank = np.empty(n, dtype=np.int64)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, sizes)
    active = order[np.repeat(sizes > 1, sizes)]
    levels, step = [rank.astype(np.int32)], 1
    while len(active):
        following = active + step
        second = np.where(following < ends[active], rank[np.minimum(following, n - 1)], -1)
        key = rank[active] * np.int64(n + 1) + second + 1
        sort = np.argsort(key, kind="stable")
        active, key = active[sort], key[sort]
        old = rank[active]
        index = np.arange(len(active))
        group = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
        within = index - np.repeat(group, np.diff(np.append(group, len(active))))
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(first, len(active)))
        rank[active] = np.repeat((old + within)[first], sizes)
        active = active[np.repeat(sizes > 1, sizes)]
        levels.append(rank.astype(np.int32))
        step *= 2
    return levels


def common_words(levels: list[np.ndarray], ends: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``one`` and ``other`` have in common."""
    total = np.zeros(len(one), dtype=np.int64)
    last = len(ends) - 1
    for level in range(len(levels) - 1, -1, -1):
        a, b = one + total, other + total
        inside = (a < ends[one]) & (b < ends[other])
        same = inside & (levels[level][np.minimum(a, last)] == levels[level][np.minimum(b, last)])
        total += np.where(same, 1 << level, 0)
    return total


def maximal_pairs(places: list[int], overlaps: list[int], left: list[int], least: int, share: int, min_length: int) -> Iterator[tuple[int, int, int]]:
    """(place, distance, overlap) of the maximal pairs with overlap >= share * distance and overlap + distance >= min_length.

    ``places`` are in suffix order, ``overlaps[r]`` is what place r has in common with the one before it. Overlaps under
    ``least`` end a tree.
    """
    stack: list[tuple[int, list[int]]] = []

    def absorb(overlap: int, one: list[int], other: list[int]) -> tuple[list[int], list[tuple[int, int, int]]]:
        small, large = (one, other) if len(one) < len(other) else (other, one)
        reach, found = overlap // share, []
        for place in small:
            near = bisect_left(large, place - reach)
            if near < len(large) and large[near] < place and left[large[near]] != left[place]:
                found.append((large[near], place - large[near], overlap))
            near = bisect_right(large, place)
            if near < len(large) and large[near] <= place + reach and left[large[near]] != left[place]:
                for at in range(near, bisect_right(large, place + reach)):
                    if left[large[at]] != left[place]:
                        found.append((place, large[at] - place, overlap))
        if len(small) < 16:
            for place in small:
                insort(large, place)
        else:
            large = sorted(large + small)
        return large, [f for f in found if f[1] + overlap >= min_length]

    for place, overlap in zip([*places, -1], [*overlaps, 0]):
        if overlap < least:
            overlap = 0
        while stack and stack[-1][0] > overlap:
            _, child = stack.pop()
            if stack and stack[-1][0] >= overlap:
                above, held = stack.pop()
                held, found = absorb(above, held, child)
                stack.append((above, held))
                yield from found
            elif overlap:
                stack.append((overlap, child))
        if place >= 0:
            stack.append((1 << 62, [place]))


def runs_of(ids: np.ndarray, begins: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> dict[int, list[tuple[int, int, int]]]:
    """Document -> its runs (start, length, period) by start, then period; ``ids`` are the words of all documents."""
    least, share = least_overlap(min_length, min_exponent), min_exponent - 1
    chosen = with_repeats(ids, begins, least)
    if not len(chosen):
        return {}
    sizes = np.diff(begins)[chosen]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    doc = np.repeat(np.arange(len(chosen)), sizes)
    words = ids[np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(begins[chosen], sizes)]
    symbols = doc * np.int64(int(words.max()) + 1) + words
    ends = np.repeat(offsets[1:], sizes)
    levels = suffix_ranks(symbols, ends)
    level = least.bit_length() - 1  # its ranks tell apart the first 2 ** level <= least words
    if level >= len(levels):
        return {}
    order = np.empty(len(words), dtype=np.int64)
    order[levels[-1]] = np.arange(len(words))
    overlaps = np.zeros(len(words), dtype=np.int64)
    near = np.flatnonzero(levels[level][order[1:]] == levels[level][order[:-1]]) + 1
    overlaps[near] = common_words(levels, ends, order[near - 1], order[near])
    overlaps[overlaps < least] = 0
    # a place that never shares more than ``most`` words cannot pair with one further away than most / share
    most = np.maximum(overlaps, np.append(overlaps[1:], 0))
    some = np.flatnonzero(most)
    if not len(some):
        return {}
    by_place = some[np.lexsort((order[some], levels[level][order[some]]))]
    gaps = np.diff(order[by_place])
    equal = levels[level][order[by_place[1:]]] == levels[level][order[by_place[:-1]]]
    gaps = np.where(equal, gaps, 1 << 40)
    nearest = np.minimum(np.append(gaps, 1 << 40), np.concatenate(([1 << 40], gaps)))
    kept = np.sort(by_place[nearest * share <= most[by_place]])
    if not len(kept):
        return {}
    between = np.minimum.reduceat(overlaps[: kept[-1] + 1], np.concatenate(([0], kept[:-1] + 1)))  # from after one kept place to the next
    between[0] = 0
    starts_doc = np.zeros(len(words), dtype=bool)
    starts_doc[offsets[:-1][sizes > 0]] = True
    left = np.where(starts_doc, -1, np.concatenate(([-1], symbols[:-1])))
    stretches: dict[tuple[int, int], int] = {}
    lengths = between.tolist()
    for place, distance, overlap in maximal_pairs(order[kept].tolist(), lengths, left.tolist(), least, share, min_length):
        stretch = (place, overlap + distance)
        stretches[stretch] = min(distance, stretches.get(stretch, distance))
    found: dict[int, list[tuple[int, int, int]]] = {}
    for (place, length), period in stretches.items():
        number = int(doc[place])
        found.setdefault(int(chosen[number]), []).append((place - int(offsets[number]), length, period))
    return {number: sorted(rows, key=lambda r: (r[0], r[2])) for number, rows in found.items()}


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    kept, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at:begin]
        at = max(at, end)
    return b" ".join(kept + words[at:])


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per document: key, runs (array of start, length, period; words from 0, by start, then period), collapsed.

    Words are runs of characters outside ASCII white space of the whole text. A run has its smallest period q, at least
    ``min_length`` words and ``min_exponent`` periods (3 or more), and no neighbouring word extends it. ``collapsed`` joins
    by one space the words that no run covers after its first q. Null, empty and white texts have no runs and an empty
    ``collapsed``. Repeated rows give repeated results, null keys stay, other columns are not read. A document is handled
    whole in one task, in memory of some 8 bytes a word for each doubling of its longest repeat; nothing is shuffled.
    """
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods are not told by the neighbours of a place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text", PIECE):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            words, numbers = [t.split() for t in texts], _Ids()
            begins = np.concatenate(([0], np.cumsum([len(w) for w in words])))
            ids = np.fromiter((numbers[w] for row in words for w in row), dtype=np.int64, count=int(begins[-1]))
            found = runs_of(ids, begins, min_length, min_exponent)
            runs = [found.get(row, []) for row in range(len(words))]
            flat = [r for row in runs for r in row]
            fields = [pa.array([r[f] for r in flat], pa.int64()) for f in range(3)]
            listed = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum([len(r) for r in runs]))), pa.int32()),
                pa.StructArray.from_arrays(fields, names=["start", "length", "period"]),
            )
            rest = pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), listed, rest], names=["id", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("id"), text_of(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)


def run_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document of ``find_runs``: number of runs, the longest (ties: smallest start, then period), digests."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.select(key, "runs", "collapsed", longest.alias("best"), listed.alias("listed"))
    length, period = -F.col("best.minus"), F.col("best.period")
    return rows.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(-best.minus * 1000) div best.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text, where about a tenth of the documents, told by a hash of the key, repeat some of their words to the end.

    With h the CRC-32 of the key as text, g = h div 10 and n > 0 words, documents with h mod 10 = 0 repeat from word
    a = g mod n on the 1 + (n - a) div (3 + g mod 8) words that follow. Others, and those with a null key, stay.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))

    def repeated(ws: Column) -> Column:
        n = F.size(ws)
        g = F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        times = (F.floor((n - a) / p) + 1).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(ws, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(ws, F.lit(1), a), tail), " ")).otherwise(F.lit(""))

    planted = F.element_at(F.transform(F.array(words), repeated), 1)
    return docs.select(key, F.when(F.coalesce(h % 10 == 0, F.lit(False)), planted).otherwise(text_of(text)).alias(text))
