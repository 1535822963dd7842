"""Token counts by byte-pair merging with the vocabulary of a sentencepiece model; no ids are made.

Spaces become the model's space mark and one mark goes in front. The characters of a chunk form a linked list; a heap
holds the adjacent pairs that are pieces. The best scored pair merges first, the leftmost of equal ones. The count is the
number of initial symbols less the number of merges, where a character outside the vocabulary counts as its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import Cache, in_pieces, text_of, without, worker_state

MARK = "▁"


class Pieces:
    """Ranks of the ordinary pieces of a model with byte fallback, and where its texts can be cut."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            (model.get_score(i), model.id_to_piece(i))
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        # equal scores share a rank, so that the leftmost pair goes first
        rank_of = {score: rank for rank, score in enumerate(sorted({s for s, _ in plain}, reverse=True))}
        self.rank = {piece: rank_of[score] for score, piece in plain}
        self.single = {p for p in self.rank if len(p) == 1}
        joined = {(a, b) for p in self.rank for a, b in zip(p, p[1:])}
        # Merges never cross two characters that no piece has side by side, so a text falls into chunks that
        # merge by themselves: at least before a mark that follows another character, and around characters
        # that occur in no longer piece.
        within = {c for pair in joined for c in pair}
        marks_end_nothing = not any(b == MARK and a != MARK for a, b in joined)
        is_letter = re.compile(r"[^\W\d_]").match
        mixed = {(a, b) for a, b in joined if MARK not in (a, b) and bool(is_letter(a)) != bool(is_letter(b))}
        # A few pieces may join a letter and another character after all ("²."). If each has a character beyond ASCII,
        # texts with one of these are cut at marks only; else all are.
        odd = {next((c for c in pair if not c.isascii()), "") for pair in mixed}
        letters_apart = "" not in odd
        self.odd = re.compile("[" + "".join(map(re.escape, sorted(odd))) + "]") if odd and letters_apart else None
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in within and chr(c) != " ")
        alone_class = f"[{alone}]|" if alone else ""
        alone_not = alone.replace("\\\n", "\\n")
        at_marks = re.compile(rf"{alone_class}{MARK}*[^{MARK}{alone_not}]+|{MARK}+") if marks_end_nothing else re.compile(r"[\s\S]+")
        self.chunk = self.long_chunk = at_marks
        if marks_end_nothing and letters_apart:
            self.chunk = re.compile(rf"{alone_class}{MARK}*[^\W\d_]+|{MARK}*(?:(?![^\W\d_])[^{MARK}{alone_not}])+|{MARK}+")
        self.counts = Cache(self.merge, 80 << 20)

    def merge(self, chunk: str) -> int:
        """Tokens of one chunk."""
        n = len(chunk)
        rank, single = self.rank, self.single
        symbols = list(chunk)
        count = sum(1 if c in single else len(c.encode("utf-8", "surrogatepass")) for c in symbols)
        if n == 1:
            return count
        following, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [found << 32 | at for at in range(n - 1) if (found := rank.get(chunk[at : at + 2])) is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            at = entry & 0xFFFFFFFF
            after = following[at]
            if after < 0 or rank.get(piece := symbols[at] + symbols[after]) != entry >> 32:
                continue  # stale: one of the two has merged since
            following[at] = beyond = following[after]
            symbols[at], symbols[after], following[after] = piece, "", -1
            count -= 1
            if beyond >= 0:
                before[beyond] = at
                if (found := rank.get(piece + symbols[beyond])) is not None:
                    heappush(queue, found << 32 | at)
            if (ahead := before[at]) >= 0:
                if (found := rank.get(symbols[ahead] + piece)) is not None:
                    heappush(queue, found << 32 | ahead)
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        chunk = self.long_chunk if self.odd and self.odd.search(text) else self.chunk
        return sum(map(self.counts.__getitem__, chunk.findall(MARK + text.replace(" ", MARK))))


def pieces(path: str) -> Pieces:
    return worker_state(("pieces", path), lambda: Pieces(path))


def count_tokens(df: DataFrame, path: str, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of each whole ``text``; null and empty texts have none.

    A column of the name ``count`` is replaced, other columns stay as they are. Nothing is shuffled. ``path`` has to
    exist on the executors.
    """
    kept = without(df, count)
    schema = ", ".join([*(f"`{f.name}`: {f.dataType.simpleString()}" for f in kept.schema.fields), f"`{count}`: bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pieces(path)
        for batch in in_pieces(batches, text):
            counts = [tables.count(t or "") for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.asarray(counts, dtype=np.int64))], names=[*batch.schema.names, count])

    return kept.mapInArrow(run, schema)


def sized(df: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, bytes of the text, its tokens, and whether these are more than ``limit``."""
    rows = count_tokens(df.select(key, text_of(text).alias("text"), F.octet_length(text_of(text)).cast("long").alias("n_bytes")), path)
    return rows.select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
