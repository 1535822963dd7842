"""Byte-pair encoding and decoding with the vocabulary of a tokenizers file.

A text is cut at special tokens, normalised (NFC, lower case) and split into words. The symbols of a word form a doubly
linked list; a priority queue holds the ranks of adjacent pairs. The pair of lowest rank merges first, the leftmost of
equal ones; an entry whose pair is gone when it is popped is skipped. Decoding joins the vocabulary's strings by a space,
which is what the library does for a file without a decoder.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import Cache, in_pieces, text_of, without, worker_state

# The white space of the split pattern, as that library's regular expressions define it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
ANY_WORD = regex.compile(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
# The same for texts of Latin-1 characters, in plain classes.
LATIN_L, LATIN_N = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff", "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
LATIN_WORD = re.compile(rf"[{LATIN_L}]+|{CONTRACTIONS}|[{LATIN_N}]|[^{SPACE}{LATIN_L}{LATIN_N}]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next free one from 256."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in prints else next(free)) for b in range(256)]


class Vocabulary:
    """The tables of one tokenizers file of kind BPE over bytes with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {content: np.int32(i).tobytes() for content, i in special.items()}
        self.at_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        size = max([*self.ids.values(), *special.values()]) + 1
        self.strings = np.full(size, "", dtype=object)
        for string, i in [*self.ids.items(), *special.items()]:
            self.strings[i] = string
        # pair of ids -> rank and id of what it becomes, in one number
        self.merges: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[self.ids[left] << 20 | self.ids[right]] = rank << 20 | self.ids[left + right]
        symbols = byte_symbols()
        self.inner = [self.ids[s] for s in symbols]
        self.last = [self.ids[s + self.suffix] for s in symbols]
        self.words = Cache(self.merge)

    def merge(self, word: str) -> bytes:
        """The ids of one word."""
        data = word.encode()
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        n = len(ids)
        if n == 1:
            return array("i", ids).tobytes()
        merges, following, before = self.merges, [*range(1, n), -1], [*range(-1, n - 1)]
        queue = []
        for at in range(n - 1):
            found = merges.get(ids[at] << 20 | ids[at + 1])
            if found is not None:
                queue.append(found << 32 | at)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            found, at = entry >> 32, entry & 0xFFFFFFFF
            after = following[at]
            if ids[at] < 0 or after < 0 or merges.get(ids[at] << 20 | ids[after]) != found:
                continue  # stale: one of the two has merged since
            ids[at], ids[after] = found & 0xFFFFF, -1
            following[at] = beyond = following[after]
            if beyond >= 0:
                before[beyond] = at
                again = merges.get(ids[at] << 20 | ids[beyond])
                if again is not None:
                    heappush(queue, again << 32 | at)
            if (ahead := before[at]) >= 0:
                again = merges.get(ids[ahead] << 20 | ids[at])
                if again is not None:
                    heappush(queue, again << 32 | ahead)
        return array("i", [i for i in ids if i >= 0]).tobytes()

    def words_of(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return ANY_WORD.findall(text)
        return LATIN_WORD.findall(text)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as bytes of int32."""
        if self.at_special and "<|" in text:
            parts = self.at_special.split(text)
            return b"".join(
                self.special[part] if odd % 2 else b"".join(map(self.words.__getitem__, self.words_of(part)))
                for odd, part in enumerate(parts)
            )
        return b"".join(map(self.words.__getitem__, self.words_of(text)))

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.strings[ids])


def vocabulary(path: str) -> Vocabulary:
    """The tables of a file, read once in a worker process."""
    return worker_state(("bpe", path), lambda: Vocabulary(path))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with a column ``ids`` (array of int): the ids of each whole ``text``; null and empty texts give no ids.

    Specials that occur in a text get their own id, none is added. A column of the name ``ids`` is replaced; other columns
    stay as they are. Rows stay where they are read: nothing is shuffled, so repeated or hot rows need no care. ``path``
    has to exist on the executors.
    """
    return _coded(df, path, text, ids, None)


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and the text that its ids decode to, specials kept, in one pass."""
    return _coded(df, path, text, ids, decoded)


def decode(df: DataFrame, path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` decode to; null and empty arrays give the empty text."""
    kept = without(df, decoded)
    schema = f"{kept.schema.simpleString()[7:-1]}, `{decoded}`: string" if kept.columns else f"`{decoded}`: string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = vocabulary(path)
        for batch in batches:
            texts = [tables.decode(np.asarray(i or [], dtype=np.int64)) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, decoded])

    return kept.mapInArrow(run, schema)


def _coded(df: DataFrame, path: str, text: str, ids: str, decoded: str | None) -> DataFrame:
    added = [ids] + [decoded] * (decoded is not None)
    kept = without(df, *added)
    kinds = [f"`{f.name}`: {f.dataType.simpleString()}" for f in kept.schema.fields]
    schema = ", ".join([*kinds, f"`{ids}`: array<int>"] + [f"`{decoded}`: string"] * (decoded is not None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = vocabulary(path)
        for batch in in_pieces(batches, text):
            coded = [tables.encode(t or "") for t in batch.column(text).to_pylist()]
            offsets = np.zeros(len(coded) + 1, dtype=np.int32)
            np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
            values = np.frombuffer(b"".join(coded), dtype=np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
            if decoded is not None:
                texts = [tables.decode(values[offsets[i] : offsets[i + 1]]) for i in range(len(coded))]
                columns.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])

    return kept.mapInArrow(run, schema)


def round_trip_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, SHA-256 of the decimal ids joined by a space, SHA-256 of the decoded text."""
    coded = encode_decode(df.select(key, text_of(text).alias("text")), path)
    return coded.select(
        key,
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
