"""Fill-in-the-middle: a text cut into prefix, middle and suffix, and put together again in another order.

Cuts are counted in units of the text. A grammar of units names the ASCII characters
at which the class of a text changes (none for code points, white space for words, the
line feed for lines). One Aho-Corasick automaton finds those characters and the
sentinels in a single scan. Between two events every character is of one class, so the
units of a gap follow by arithmetic: as many as characters, or one. Only the events are
kept; the offset of the unit of a given rank is a bisection over them and a
difference. A text of a million code points without a sentinel is one gap.

The scan also tells whether a text holds a sentinel, which makes it ``plain``, and on the way
back where an output is to be cut. No sentinel overlaps another or itself, so joining
parts makes no new one.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bound_batches
from .skew import fresh

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
SEED = 1
PLAIN_FROM, SPM_BELOW = 90, 20


@dataclass(frozen=True)
class Units:
    """How a text falls into units.

    A character of ``changes`` is a unit of its own, or ends the unit before it if
    ``closes``. A gap between such characters has one unit, or one a character if
    ``each``.
    """

    changes: str = ""
    each: bool = True
    closes: bool = False


UNITS = {
    "points": Units(),
    "words": Units(" \t\n\x0b\x0c\r", each=False),
    "lines": Units("\n", each=False, closes=True),
}


@functools.lru_cache(maxsize=16)
def _automaton(changes: str, sentinels: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for char in changes:
        found.add_word(char, (1, None))
    for word in sentinels:
        found.add_word(word, (len(word), word))
    found.make_automaton()
    return found


class Scan:
    """The events of a text: stretches of units, and where sentinels stand."""

    def __init__(self, text: str, units: Units = UNITS["points"], sentinels: Sequence[str] = SENTINELS):
        self.text, self.units, self.sentinels = text, units, []
        #: first unit and offset of every stretch
        self.ranks, self.starts, self.count = [], [], 0
        gap = 0
        for last, (size, word) in _automaton(units.changes, tuple(sentinels)).iter(text):
            at = last + 1 - size
            if word is not None:  # of the class of the gap around it
                self.sentinels.append((at, word))
                continue
            if units.closes:
                self._stretch(gap, at + 1)
            else:
                self._stretch(gap, at)
                self._stretch(at, at + 1)
            gap = at + 1
        self._stretch(gap, len(text))

    def _stretch(self, start: int, end: int) -> None:
        if start < end:
            self.ranks.append(self.count)
            self.starts.append(start)
            self.count += end - start if self.units.each else 1

    def offset(self, rank: int) -> int:
        """Where the unit of this rank (from 0) begins; the text's length for the rank after the last."""
        if rank >= self.count:
            return len(self.text)
        k = bisect_right(self.ranks, rank) - 1
        return self.starts[k] + rank - self.ranks[k]


def rearrange(scan: Scan, first: int, second: int, form: str) -> str:
    """The text with its cuts after ``first`` and ``second`` units, in the order of ``form``."""
    if form == "plain":
        return scan.text
    a, b = scan.offset(first), scan.offset(second)
    prefix, middle, suffix = scan.text[:a], scan.text[a:b], scan.text[b:]
    if form == "spm":
        return "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restored(output: str, form: str) -> str:
    """The text that :func:`rearrange` was given; an error if the output has not the sentinels of its form."""
    if form == "plain":
        return output
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    found = Scan(output).sentinels
    if tuple(word for _, word in found) != order or found[0][0] != 0:
        raise ValueError(f"sentinels {[word for _, word in found]} in an output of form {form}")
    ends = [at for at, _ in found[1:]] + [len(output)]
    part = {word: output[at + len(word) : end] for (at, word), end in zip(found, ends, strict=True)}
    return part[PREFIX] + part[MIDDLE] + part[SUFFIX]


def _draws(ident: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a row, from its id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    units: str = "points",
    seed: int = SEED,
    plain_from: int = PLAIN_FROM,
    spm_below: int = SPM_BELOW,
) -> DataFrame:
    """Every row and column of ``docs`` plus ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``n`` counts the text's units. Draws h1 to h4 depend on ``seed`` and the id alone:
    the prefix ends after the smaller of h1 and h2 modulo n + 1 units, the middle after
    the larger. ``form`` is ``plain`` for texts without units or with a sentinel, or if
    h3 % 100 >= ``plain_from``; else ``spm`` if h4 % 100 < ``spm_below``, else ``psm``.
    Lengths are in code points, null in plain rows. Null text: empty. Null id: the
    draws of an empty id. Repeated ids: the same draws. Columns of the added names are
    replaced, others of whatever name pass through; an empty table gives an empty table.
    """
    grammar = UNITS[units]
    added = ("n", "form", "prefix_chars", "middle_chars", "output")

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def cut(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for series in batches:
            rows = []
            for value, h1, h2, h3, h4 in zip(*series, strict=True):
                scan = Scan(value, grammar)
                if not scan.count or scan.sentinels or h3 % 100 >= plain_from:
                    rows.append((scan.count, "plain", None, None, value))
                    continue
                form = "spm" if h4 % 100 < spm_below else "psm"
                first, second = sorted((h1 % (scan.count + 1), h2 % (scan.count + 1)))
                a, b = scan.offset(first), scan.offset(second)
                rows.append((scan.count, form, a, b - a, rearrange(scan, first, second, form)))
            out = pd.DataFrame(rows, columns=added)
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in added]
    name = fresh("_cut", [*docs.columns, *added])
    rows = docs.withColumn(name, cut.asNondeterministic()(F.coalesce(F.col(text), F.lit("")), *_draws(F.col(ident), seed)))
    return rows.select(*kept, *[F.col(name)[c].alias(c) for c in added])


def restore(output: Column, form: Column) -> Column:
    """The text of an output column, by its form column."""

    @F.pandas_udf("string")
    def run(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restored(x, f) for x, f in zip(outputs, forms, strict=True)], dtype=object)

    return run.asNondeterministic()(output, form)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = fill_in_middle(docs).withColumn("restored", restore(F.col("output"), F.col("form")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


_SENTINEL = " OR ".join(f"contains(t, '{x}')" for x in SENTINELS)
_DRAWS = ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))

SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || doc_id) AS h FROM documents
), e AS (
  SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n, {_DRAWS} FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR {_SENTINEL} OR h3 % 100 >= {PLAIN_FROM} THEN 'plain' WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM e
), g AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m
                        ELSE '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM g
"""
