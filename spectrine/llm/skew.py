"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot beyond ``LEAST`` left rows and beyond 1 / ``MOST`` of all of them, so at most ``MOST`` keys are hot.
LEAST, MOST = 1000, 2000


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until it is none of ``taken`` (letter case aside)."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def weighted_lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], weight: str, *, how: str = "inner", spread: Column | None = None, least: int = LEAST
) -> DataFrame:
    """``left`` joined to ``right``, which has one row per key and in ``weight`` the key's count of left rows.

    A hot key's left rows are dealt to parts by a hash (``spread``, or all their
    columns), its right row is repeated for each part, so no task gets more than
    about a hot key's threshold of them. The keys of hot rows alone are broadcast,
    ``MOST`` at most. ``right`` should be a saved table, for it is read three times;
    its weight is not in the result.
    """
    on = list(on)
    total = right.agg(F.sum(weight)).first()[0] or 0
    bound = max(least, int(total) // MOST)
    taken = [*left.columns, *right.columns]
    part, parts = fresh("part", taken), fresh("parts", taken)
    dealt = F.ceil(F.col(weight) / bound).cast("int")
    hot = right.where(F.col(weight) > bound).select(*on, dealt.alias(parts))
    spread = F.xxhash64(*left.columns) if spread is None else spread
    placed = left.join(F.broadcast(hot), on, "left").withColumn(part, F.when(F.col(parts).isNull(), 0).otherwise(F.pmod(spread, F.col(parts)).cast("int")))
    copies = F.when(F.col(weight) > bound, dealt).otherwise(1)
    repeated = right.withColumn(part, F.explode(F.sequence(F.lit(0), copies - 1))).drop(weight)
    return placed.drop(parts).join(repeated, [*on, part], how).drop(part)
