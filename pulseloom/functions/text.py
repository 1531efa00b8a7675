"""Word-level text expressions with the same word notion throughout.

A word character is a letter, a number or the underscore, in any script.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"

# Letters that equal another letter when case is ignored but that lower() keeps apart.
_FOLD_FROM, _FOLD_TO = "ſıςµ", "siσμ"


def fold(text: Column) -> Column:
    """Lower case, with the special letters above brought to their plain form.

    The letter-by-letter step runs only on texts that need it.
    """
    special = F.translate(F.lower(F.translate(text, "İ", "i")), _FOLD_FROM, _FOLD_TO)
    needed = reduce(lambda a, b: a | b, [text.contains(letter) for letter in "İΣ" + _FOLD_FROM])
    return F.when(needed, special).otherwise(F.lower(text))


def fold_literal(text: str) -> str:
    """``fold`` for a literal."""
    return text.replace("İ", "i").lower().translate(str.maketrans(_FOLD_FROM, _FOLD_TO))


def words(folded: Column) -> Column:
    return F.split(folded, f"[^{WORD}]+")


def is_single_word(term: str) -> bool:
    return re.fullmatch(r"\w+", term) is not None


def _boundary(outer_side: str, edge: str) -> str:
    """A word boundary next to a literal edge character."""
    inside = re.match(r"\w", edge) is not None
    if outer_side == "before":
        return f"(?<![{WORD}])" if inside else f"(?<=[{WORD}])"
    return f"(?![{WORD}])" if inside else f"(?=[{WORD}])"


def _escape(term: str) -> str:
    return "".join(c if c.isalnum() or c in "_ " else f"\\x{{{ord(c):x}}}" for c in term)


def contains_term(folded: Column, term: str) -> Column:
    """Whole-word search of one folded literal; the plain search runs first as it is cheap."""
    pattern = _boundary("before", term[0]) + _escape(term) + _boundary("after", term[-1])
    return folded.contains(term) & folded.rlike(pattern)


def tokens(text: Column) -> Column:
    """Lower-case words of at least two characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def unigrams_and_bigrams(found: Column) -> Column:
    """The tokens followed by each pair of neighbours joined by a space."""
    pairs = F.zip_with(
        F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))),
        F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(found, pairs)
