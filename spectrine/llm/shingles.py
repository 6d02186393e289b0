"""Word shingles as DataFrame expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often lambdas in ``body`` use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; an empty array for null or empty text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(text: Column, n: int = WORDS) -> Column:
    """64-bit hashes of the text's ``n``-word shingles, in order, repeats included.

    Texts with 1 to ``n - 1`` words have one shingle, the whole sequence, which no
    longer text has; texts without words have none.
    """

    def hashes(w: Column) -> Column:
        at_each = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, n)]))
        return F.slice(at_each, 1, F.greatest(F.size(w) - (n - 1), F.lit(1)))

    return let(words(text), hashes)
