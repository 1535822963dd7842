"""Sub-tokens and label alignment inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillset.functions.fixed_values import MASKED_LABEL


def word_pieces(word: Column, width: int) -> Column:
    """Pieces of at most ``width`` characters; the empty word is one empty piece, as it keeps its place and label."""
    last = F.greatest(F.floor((F.length(word) - 1) / F.lit(width)).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(word, i * width + 1, F.lit(width)))


def piece_tokens(tokens: Column, width: int, opening: str, closing: str) -> Column:
    """Pieces of all words between an opening and a closing special token."""
    pieces = F.flatten(F.transform(tokens, lambda w: word_pieces(w, width)))
    return F.concat(F.array(F.lit(opening)), pieces, F.array(F.lit(closing)))


def piece_word_ids(tokens: Column, width: int) -> Column:
    """Index of the word each piece came from; null for the special tokens at both ends."""
    special = F.array(F.lit(None).cast("int"))
    ids = F.flatten(
        F.transform(tokens, lambda w, i: F.array_repeat(i, F.greatest(F.ceil(F.length(w) / F.lit(width)).cast("int"), F.lit(1))))
    )
    return F.concat(special, ids, special)


def align_labels(word_ids: Column, labels: Column, label_all_word_parts: bool = False) -> Column:
    """Label per sub-token: the word's label on its first piece, the mask on specials and (by default) later pieces."""
    masked = F.lit(MASKED_LABEL)
    shifted = F.concat(F.array(F.lit(None).cast("int")), F.slice(word_ids, 1, F.greatest(F.size(word_ids) - 1, F.lit(0))))
    cells = F.arrays_zip(word_ids.alias("word"), shifted.alias("previous"))

    def label(cell: Column) -> Column:
        own = F.get(labels, cell["word"])
        kept = own if label_all_word_parts else F.when(cell["word"].eqNullSafe(cell["previous"]), masked).otherwise(own)
        return F.when(cell["word"].isNull(), masked).otherwise(kept)

    return F.transform(cells, label)
