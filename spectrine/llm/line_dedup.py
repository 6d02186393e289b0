"""Cross-site boilerplate lines.

A line is boilerplate when it stands on at least ``min_sites`` distinct sites. It is cut
from every page, whatever its share of it, but for one case: where boilerplate is most of
a page and other rows have the very same lines, the page is a copy, its own lines are
boilerplate only because its copies stand on many sites, and it is left for near-duplicate
removal to judge.

Texts are split once, into keys of 128 bits a line. One aggregation counts lines; those
seen too rarely go. For the others one HyperLogLog sketch of sites a line hash merges in the
map-side and final aggregation, so a line that a third of all documents share costs one
sketch per task. Lines whose estimate lies within ``near`` of the threshold are then counted
exactly.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .shingles import let
from .skew import fresh, weighted_lookup

MIN_SITES = 10
NEAR = 0.25
LG_K = 12
MAX_REMOVED_SHARE = 0.5


def bare_line(line: Column) -> Column:
    """A line without its outer blanks; tabs and carriage returns are blanks."""
    return F.trim(F.regexp_replace(line, r"[\t\r]", " "))


def _bare_key(bare: Column) -> Column:
    return F.when(F.length(bare) > 0, F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(bare, F.lit(1)).alias("b")))


def line_key(line: Column) -> Column:
    """128 bits of a line without its outer blanks; null for a blank line."""
    return _bare_key(bare_line(line))


def lines_of(docs: DataFrame, text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _keyed(docs: DataFrame, site: str, text: str) -> DataFrame:
    """(site, t, page, keys, sizes): a row's site, its text's and its lines' hash, and key and bare length of every line."""
    lines = F.transform(lines_of(docs, text), bare_line)
    rows = docs.select(F.col(site).cast("string").alias("site"), _text_key(text).alias("t"), lines.alias("lines"))
    page = F.filter("keys", lambda k: k.isNotNull())
    return (
        rows.withColumn("keys", F.transform("lines", _bare_key))
        .withColumn("page", F.struct(F.xxhash64(page, F.lit(2)).alias("a"), F.xxhash64(page, F.lit(3)).alias("b")))
        .select("site", "t", "page", "keys", F.transform("lines", F.length).alias("sizes"))
    )


def _text_key(text: str) -> Column:
    """128 bits of a text, null for a null text."""
    return F.when(F.col(text).isNotNull(), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b")))


def _marks(keyed: DataFrame, scratch: Scratch, min_sites: int, near: float, lg_k: int) -> DataFrame:
    """(k, weight) of the boilerplate lines: their keys, and how often they are seen in all."""
    low, high = (1 - near) * min_sites, (1 + near) * min_sites
    lines = keyed.select("site", F.explode("keys").alias("k")).where("k is not null")
    often = lines.groupBy("k").agg(F.count(F.lit(1)).alias("weight"), F.count("site").alias("sited"))
    often = scratch.save(often.where(F.col("sited") >= int(low)).drop("sited"), "often")
    seen = scratch.save(weighted_lookup(lines, often, ["k"], "weight").where("site is not null"), "seen")
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k)))
    spread = scratch.save(seen.groupBy("k").agg(sketch.alias("sites")).where(F.col("sites") >= low), "spread")
    sure = spread.where(F.col("sites") >= high).select("k")
    close = spread.where(F.col("sites") < high).select("k")
    close = scratch.save(close.join(often, "k"), "close")
    exact = weighted_lookup(seen, close, ["k"], "weight").groupBy("k").agg(F.count_distinct("site").alias("sites"))
    return scratch.save(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("k")).join(often, "k"), "marks")


def boilerplate_lines(
    docs: DataFrame,
    *,
    site: str = "source",
    text: str = "text",
    min_sites: int = MIN_SITES,
    near: float = NEAR,
    lg_k: int = LG_K,
) -> DataFrame:
    """Keys ``k`` of the lines that stand on ``min_sites`` sites or more.

    Null sites count as no site, blank lines as no line. An estimate at or beyond
    ``(1 + near) * min_sites`` is accepted, one below ``(1 - near) * min_sites``
    refused (at ``lg_k`` = 12 the standard error is 1.6 %, so ``near`` = 0.25 is
    15 of them), and everything between is counted exactly.
    """
    scratch = Scratch(docs.sparkSession, "line_spread")
    return _marks(scratch.save(_keyed(docs, site, text), "keyed"), scratch, min_sites, near, lg_k).select("k")


def remove_boilerplate(
    docs: DataFrame,
    *,
    site: str = "source",
    text: str = "text",
    min_sites: int = MIN_SITES,
    near: float = NEAR,
    lg_k: int = LG_K,
    max_removed_share: float = MAX_REMOVED_SHARE,
) -> DataFrame:
    """Every row and column of ``docs``, with boilerplate lines cut out of ``text``.

    Adds ``n_lines`` (lines of the text, blank ones too), ``n_boilerplate`` (lines
    that are boilerplate) and ``n_removed`` (lines cut). A document is a copy of
    another page when its boilerplate holds more than ``max_removed_share`` of its
    non-blank characters and another row has the same non-blank lines in the same
    order, outer blanks aside: it stays as it is, for near-duplicate removal to
    judge, and ``n_removed`` is 0. All other pages are cut, whatever the
    boilerplate's share; so are copies with edited lines. Lines that stay keep
    their order and bytes; a page of nothing but boilerplate becomes empty.

    Null text: null, with ``n_lines`` 0. Empty text: empty, one blank line. Null
    site: the row's lines do not count towards a spread but are cut like others.
    Repeated rows and repeated or null ids are treated row by row. Columns of the
    three added names are replaced; others, of whatever name, pass through. An empty table
    gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "line_dedup")
    keyed = scratch.save(_keyed(docs, site, text), "keyed")
    marks = _marks(keyed, scratch, min_sites, near, lg_k)
    added = ("n_lines", "n_boilerplate", "n_removed")
    kept = [c for c in docs.columns if c not in added]
    # Equal texts have the same lines to cut, so one row a text is joined to all rows that have it.
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + x)
    lines = F.arrays_zip(F.sequence(F.lit(0), F.size("keys") - 1).alias("at"), F.col("keys").alias("k"), F.col("sizes").alias("size"))
    places = keyed.where("t is not null").select("t", "page", total.alias("total"), F.inline(lines)).where("k is not null")
    found = weighted_lookup(places, marks, ["k"], "weight", spread=F.xxhash64("t", "at"))
    found = found.groupBy("t").agg(
        F.first("page").alias("page"), F.first("total").alias("total"), F.collect_set(F.struct("at", "size")).alias("cut"), F.count(F.lit(1)).alias("seen")
    )
    share = F.aggregate("cut", F.lit(0).cast("long"), lambda n, c: n + c["size"]) / F.col("total")
    found = found.select(
        "t", "page", F.col("cut.at").alias("cuts"), (share > max_removed_share).alias("heavy"), F.expr("cast(seen / size(cut) as long)").alias("weight")
    )
    found = scratch.save(found, "found")
    # rows with equal lines are all in ``found`` or none is, so every other row counts
    pages = found.where("heavy").groupBy("page").agg(F.sum("weight").alias("rows"), F.count(F.lit(1)).alias("texts"))
    pages = scratch.save(pages.where("rows > 1").select("page", "texts", F.lit(True).alias("copied")), "pages")
    found = weighted_lookup(found, pages, ["page"], "texts", how="left")
    whole = F.col("heavy") & F.coalesce("copied", F.lit(False))
    nothing = F.array().cast("array<int>")
    found = found.select("t", F.when(whole, nothing).otherwise(F.col("cuts")).alias("cuts"), F.size("cuts").alias("marked"), "weight")
    found = scratch.save(found, "judged")

    names = {c: fresh(c, docs.columns) for c in ("t", "cuts", "marked")}
    rows = docs.select(*kept).withColumn(names["t"], _text_key(text))
    spread = F.xxhash64(*[F.col(c) for c in kept])
    joined = weighted_lookup(rows, found.withColumnsRenamed(names), [names["t"]], "weight", how="left", spread=spread)
    cuts, whole = F.col(names["cuts"]), F.col(text)
    n_lines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1

    def cut(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cuts)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    removed = F.when(cuts.isNull(), 0).otherwise(F.size(cuts))
    return joined.select(
        *[F.col(c) if c != text else F.when(removed > 0, let(F.split(whole, "\n", -1), cut)).otherwise(whole).alias(text) for c in kept],
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.col(names["marked"]), F.lit(0)).cast("long").alias("n_boilerplate"),
        removed.cast("long").alias("n_removed"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with boilerplate lines removed and ``n_chars`` renewed."""
    out = remove_boilerplate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_boilerplate(docs).select("doc_id", "n_lines", "n_boilerplate", "n_removed", "text")


SQL = f"""
WITH lines AS (
  SELECT d.doc_id, d.source, u.i AS pos, string_split(coalesce(d.text, ''), chr(10))[u.i] AS line
  FROM documents d, unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) AS u(i)
), bare AS (
  SELECT *, trim(replace(replace(line, chr(9), ' '), chr(13), ' '), ' ') AS b FROM lines
), marks AS (
  SELECT b FROM bare WHERE b <> '' AND source IS NOT NULL GROUP BY b HAVING count(DISTINCT source) >= {MIN_SITES}
), judged AS (
  SELECT x.*, (m.b IS NOT NULL) AS bad FROM bare x LEFT JOIN marks m ON x.b = m.b
), per AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE bad) AS n_boilerplate,
         coalesce(sum(length(b)) FILTER (WHERE bad), 0) > {MAX_REMOVED_SHARE} * sum(length(b)) AS heavy,
         md5(string_agg(b, chr(10) ORDER BY pos) FILTER (WHERE b <> '')) AS page,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT bad), '') AS cleaned
  FROM judged GROUP BY doc_id
), p AS (
  SELECT *, heavy AND count(*) OVER (PARTITION BY page) > 1 AS copied FROM per
)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE p.n_lines END AS BIGINT) AS n_lines,
       CAST(p.n_boilerplate AS BIGINT) AS n_boilerplate,
       CAST(CASE WHEN p.copied THEN 0 ELSE p.n_boilerplate END AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL OR p.copied OR p.n_boilerplate = 0 THEN d.text ELSE p.cleaned END AS text
FROM documents d JOIN p ON d.doc_id = p.doc_id
"""
