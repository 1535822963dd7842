"""Hashed count features of whole texts as dense rows, computed batch by batch in the workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quillset.llm.common import release_worker_state, worker_state
from quillset.llm.shingles import word_hashes

SIZE = 4096
#: Texts whose dense rows are held at once: 8 MB of them, and a copy or two.
ROWS = 512


def _letters() -> np.ndarray:
    return worker_state(("letters",), lambda: np.array([chr(c).isalpha() for c in range(0x110000)]))


def unit_roots(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts at length one; rows of zeros stay."""
    roots = np.sqrt(counts, dtype=np.float32)
    norms = np.sqrt((roots * roots).sum(axis=1, keepdims=True))
    return roots / np.where(norms == 0, 1, norms)


def letter_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Rows for the runs of one to three characters of lower-cased texts, all but letters as spaces; and the number of
    letters of each text."""
    letters = _letters()
    counts, sizes = np.zeros((len(texts), SIZE), dtype=np.float32), np.zeros(len(texts), dtype=np.int64)
    for row, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letters[codes]
        sizes[row] = int(is_letter.sum())
        if sizes[row]:
            codes = np.concatenate(([32], np.where(is_letter, codes, 32), [32])).astype(np.uint32)
            one = codes * np.uint32(0x9E3779B1)
            two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + one[1:]
            three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + one[2:]
            runs = np.concatenate((one, two, three))
            runs = (runs ^ (runs >> np.uint32(16))) * np.uint32(0x27D4EB2F)
            counts[row] = np.bincount(runs >> np.uint32(20), minlength=SIZE)
    return unit_roots(counts), sizes


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows for the words of each text and its number of words."""
    release_worker_state()
    hashes, begins = word_hashes(column)
    cells = (hashes >> np.uint64(52)).astype(np.int64)
    sizes = np.diff(begins)
    counts = np.zeros((len(sizes), SIZE), dtype=np.float32)
    for row in np.flatnonzero(sizes):
        counts[row] = np.bincount(cells[begins[row] : begins[row + 1]], minlength=SIZE)
    return unit_roots(counts), sizes
