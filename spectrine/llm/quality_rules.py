"""Quality rules: fixed counts of a text, and how far it lies from its language.

Base rules are counts within the row: words, symbols, repeated lines, words in
repeated windows. Texts that pass them are compared with two references of their
language, taken from the corpus itself: a histogram of character classes and one of
common words (the words that make up at least ``share`` of a language's words, and one
bin for all others). The measure is the Jensen-Shannon distance, base 2.

A histogram of few words lies away from any reference by chance alone, by about
1 / sqrt(words). So the bound is ``floor + noise / sqrt(words)``, and texts below
``min_words`` words are not judged at all; neither are texts of a language with fewer
than ``min_texts`` texts to refer to.

* Common words are heavy hitters: one frequent-items sketch a language gives
  candidates. It never counts too little, and too much by 3.5 / ``TRACKED`` of the words at
  most, so none is missed and few are there in vain; the exact count decides.
* A reference counts every distinct text once, as parts per million, so neither long
  texts nor a text with a million copies bend it. Sums are of whole numbers and do not
  depend on the order of rows.
* Only these tables, a row a language, meet the texts again. Texts are never shuffled.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .shingles import let
from .skew import fresh, weighted_lookup

MIN_BASE_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8
SHARE_PER_MILLE = 3
MIN_WORDS = 50
MIN_TEXTS = 20
CHAR_BOUND = (0.10, 1.2)
WORD_BOUND = (0.10, 2.2)
#: Counters of a sketch, how many of them are asked for (fewer than 1,000 / 2.5 words can seem to reach the share),
#: and the tasks whose sketches merge at a time.
TRACKED, ASKED, FAN = 8192, 1000, 512
#: Sizes and seeds of a language's word table; the first pair under which no two of its words share a place is taken.
SLOTS, SEEDS = (2**10, 2**13, 2**16, 2**20), 16
#: So many languages are broadcast, of about 20 KB each; more are joined by their key.
BROADCAST_LANGUAGES = 2000
PPM = 1_000_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

BLANKS = r"[\x20\x09-\x0D]+"
#: Character classes, cut out of a text one after another; what none of them takes is the last bin.
CLASSES = (r"\p{Ll}+", r"[\x20\x09-\x0D]+", r"\p{Lu}+", r"\p{L}+", r"\p{Nd}+", r"""[.,;:!?'"()-]+""")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def _plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda n, x: n + x)


def _windows(words: Column, width: int = WINDOW) -> Column:
    """A 64-bit hash of each window of ``width`` (a power of two) words, by doubling: of 2 words, of 4, of 8."""

    def through(h: Column, step: int) -> Column:
        if step == width:
            return F.slice(h, 1, F.greatest(F.size(h) - (width - 1), F.lit(0)))
        return let(F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step))), lambda longer: through(longer, 2 * step))

    return let(F.transform(words, lambda x: F.xxhash64(x)), lambda h: through(h, 1))


def repeated_words(windows: Column, width: int = WINDOW) -> Column:
    """How many words stand in a window that the array of windows holds twice or more; equal windows are neighbours once sorted."""

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - p, F.lit(width))))
        return _total(gaps)

    def twice(s: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        found = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return let(F.sort_array(F.transform(found, lambda x: x["at"])), covered)

    keyed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(keyed, twice)).otherwise(F.lit(0).cast("long"))


def base_counts(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the five counts of a text that is not null; columns of these names must not be there."""
    words, windows = (fresh(c, [*rows.columns, *MEASURES]) for c in ("_words", "_windows"))
    rows = rows.withColumn(words, _words(F.col(text)))
    rows = rows.withColumn(windows, _windows(F.col(words)))
    lines = F.filter(F.split(F.col(text), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = (
        F.size(words),
        F.length(F.array_join(words, "")),
        F.length(F.regexp_replace(F.col(text), r"[^#*$%&|<>]+", "")),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        repeated_words(F.col(windows)),
    )
    return rows.withColumns({m: c.cast("long") for m, c in zip(MEASURES, counts, strict=True)}).drop(words, windows)


def _failed() -> Column:
    return (F.col("n_words") < MIN_BASE_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


def _class_counts(text: Column) -> Column:
    """Code points by character class: small letters, blanks, capital and other letters, digits, marks, the rest."""

    def cut(rest: Column, classes: tuple, lengths: list) -> Column:
        if not classes:
            return F.array(*[(x - y).cast("long") for x, y in zip(lengths, [*lengths[1:], F.lit(0)], strict=True)])
        return let(F.regexp_replace(rest, classes[0], ""), lambda left: cut(left, classes[1:], [*lengths, F.length(left)]))

    return cut(text, CLASSES, [F.length(text)])


def _place(word: Column, size: Column, seed: Column) -> Column:
    return F.hash(word, seed).bitwiseAND(size - 1)


def _bins(words: Column, table: Column) -> Column:
    """The place of every word that the table knows, in the order of the words."""

    def places(slots: Column, last: Column, seed: Column) -> Column:
        at = lambda w: F.hash(w, seed).bitwiseAND(last)
        return F.transform(F.filter(words, lambda w: F.get(slots, at(w)) == w), at)

    # the table's fields are read once a row, not once a word
    return let(table["slots"], lambda slots: let(table["size"] - 1, lambda last: let(table["seed"], lambda seed: places(slots, last, seed))))


def _word_counts(text: Column, table: Column) -> Column:
    """Counts of the table's words and, last, of all others; null without a table."""

    def counts(w: Column) -> Column:
        def per_bin(bins: Column) -> Column:
            each = F.transform(table["words"]["place"], lambda k: (F.size(bins) - F.size(F.array_remove(bins, k))).cast("long"))
            return F.concat(each, F.array((F.size(w) - F.size(bins)).cast("long")))

        return let(_bins(w, table), per_bin)

    return F.when(table.isNotNull(), let(_plain_words(text), counts))


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, base 2, of counts to shares; null if there is nothing to compare."""

    def half(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def spread(c: Column, n: Column) -> Column:
        pairs = F.zip_with(c, reference, lambda x, q: F.struct((x / n).alias("p"), q.alias("q")))
        parts = F.transform(pairs, lambda x: half(x["p"], (x["p"] + x["q"]) / 2) + half(x["q"], (x["p"] + x["q"]) / 2))
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2))

    return let(counts, lambda c: let(_total(c), lambda n: F.when(n > 0, spread(c, n))))


def _tables(words: DataFrame) -> DataFrame:
    """(lang, table) from (lang, word): a language's words by place, and the word at every place, null where there is none."""
    pairs = F.array(*[F.struct(F.lit(size).alias("size"), F.lit(seed).alias("seed")) for size in SLOTS for seed in range(SEEDS)])
    apart = lambda o: F.size(F.array_distinct(F.transform("common", lambda w: _place(w, o["size"], o["seed"])))) == F.size("common")
    nothing = F.lit(None).cast("string")

    def table(words: Column, o: Column) -> Column:
        gap = lambda x, i: x["place"] - F.coalesce(F.get(words, i - 1)["place"], F.lit(-1)) - 1
        before = F.transform(words, lambda x, i: F.concat(F.array_repeat(nothing, gap(x, i)), F.array(x["word"])))
        after = F.array_repeat(nothing, o["size"] - 1 - F.element_at(words, -1)["place"])
        return F.struct(o["size"].alias("size"), o["seed"].alias("seed"), words.alias("words"), F.concat(F.flatten(before), after).alias("slots"))

    def placed(o: Column) -> Column:
        known = F.sort_array(F.transform("common", lambda w: F.struct(_place(w, o["size"], o["seed"]).alias("place"), w.alias("word"))))
        return let(known, lambda words: table(words, o))

    lists = words.groupBy("lang").agg(F.collect_list("word").alias("common"))  # at most 1,000 / share words a language
    chosen = F.get(F.filter(pairs, apart), F.lit(0))
    return lists.select("lang", let(chosen, placed).alias("table"))


def _beside(rows: DataFrame, table: DataFrame, lang: str, counts: DataFrame) -> DataFrame:
    """``rows`` with their language's row of ``table``, nulls if it has none."""
    table = table.withColumnRenamed("lang", lang)
    if table.count() <= BROADCAST_LANGUAGES:
        return rows.join(F.broadcast(table), lang, "left")
    weight = fresh("weight", [*rows.columns, *table.columns])
    weighed = table.join(counts.select(F.col("lang").alias(lang), F.col("rows").alias(weight)), lang)
    return weighted_lookup(rows, weighed, [lang], weight, how="left")


def _prepare(
    docs: DataFrame, text: str, lang: str, share_per_mille: int, min_words: int, min_texts: int, keep: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References by language, row counts of languages, and the figures of every row, all of them saved.

    References are (lang, table, bins, char_reference, word_reference) for languages
    (null: ``und``) with ``min_texts`` distinct texts that pass the base rules and have
    ``min_words`` words; ``bins`` are the places of the table's words among the counts
    in the figures. Histograms of words are null for a language without common words. Figures are
    the columns ``keep`` as ``row``, the base counts, whether the text is judged, and raw counts.
    """
    scratch = Scratch(docs.sparkSession, "quality_rules")
    row = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"), *row)
    words = rows.select("lang", F.explode(_plain_words(F.col("text"))).alias("word"))
    merged = words.groupBy("lang", F.expr(f"spark_partition_id() div {FAN}").alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(word, {TRACKED})").alias("s"), F.count(F.lit(1)).alias("n")
    )
    found = merged.groupBy("lang").agg(F.expr("approx_top_k_combine(s)").alias("s"), F.sum("n").alias("total"))
    found = scratch.save(found.select("lang", "total", F.expr(f"approx_top_k_estimate(s, {ASKED})").alias("top")), "found")
    likely = found.select("lang", "total", F.inline("top")).where(F.col("count") * 1000 >= F.col("total") * share_per_mille)
    counts = scratch.save(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "counts")

    candidates = scratch.save(_tables(likely.select("lang", F.col("item").alias("word"))), "candidates")

    usable = base_counts(rows, "text").withColumn("usable", ~_failed() & (F.col("n_words") >= min_words))
    key = (F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"))
    small = lambda c: c.cast("array<int>")
    chars, counted = small(_class_counts(F.col("text"))), small(_word_counts(F.col("text"), F.col("table")))
    figures = _beside(usable, candidates, "lang", counts).select(
        *(["row"] if keep else []), "lang", *key, *MEASURES, "usable", chars.alias("char"), counted.alias("word")
    )
    figures = scratch.save(figures, "figures")

    # what the candidates count over all texts decides, exactly, which of them are common
    seen = figures.select("lang", F.posexplode("word").alias("bin", "x")).groupBy("lang", "bin").agg(F.sum("x").alias("x"))
    named = candidates.select("lang", F.posexplode("table.words.word").alias("bin", "word"))
    exact = seen.join(named, ["lang", "bin"]).join(found.select("lang", "total"), "lang").where(F.col("x") * 1000 >= F.col("total") * share_per_mille)
    common = scratch.save(_tables(exact.select("lang", "word")), "common")
    known = candidates.select("lang", F.col("table.words.word").alias("known")).join(common, "lang")
    bins = known.select("lang", F.transform("table.words", lambda w: F.array_position("known", w["word"]).cast("int") - 1).alias("bins"))

    # copies of a text meet in the tasks already
    texts = figures.where("usable").dropDuplicates(["lang", "a", "b"]).select("lang", "char", "word")
    texts = _beside(texts, bins, "lang", counts)

    def ppm(c: Column) -> Column:
        shares = lambda x, n: F.transform(x, lambda v: F.floor(v.cast("long") * PPM / F.greatest(n, F.lit(1))).cast("int"))
        return let(c, lambda x: let(_total(x), lambda n: shares(x, n)))

    word = F.when(F.col("bins").isNotNull(), ppm(_chosen(F.col("word"))))
    texts = scratch.save(texts.select("lang", ppm(F.col("char")).alias("char"), word.alias("word")), "texts")
    enough = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts).select("lang")
    out = enough.join(common, "lang", "left").join(bins, "lang", "left")
    for kind in ("char", "word"):
        sums = texts.select("lang", F.posexplode(kind).alias("bin", "x")).groupBy("lang", "bin").agg(F.sum("x").alias("x"))
        shares = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bin", "x"))).alias("s"))
        share = F.when(_total(F.col("s.x")) > 0, let(_total(F.col("s.x")), lambda n: F.transform("s.x", lambda x: x / n)))
        out = out.join(shares.select("lang", share.alias(f"{kind}_reference")), "lang", "left")
    return scratch.save(out, "references"), counts, figures


def _chosen(word: Column) -> Column:
    """Counts by the places in ``bins`` and, last, of all other words."""
    held = F.transform("bins", lambda i: F.get(word, i))
    return let(held, lambda h: F.concat(h, F.array((_total(word) - _total(h)).cast("int"))))


def _verdict(char_bound: tuple[float, float], word_bound: tuple[float, float]) -> Column:
    def near(distance: str, bound: tuple[float, float]) -> Column:
        return F.coalesce(F.col(distance) <= F.lit(bound[0]) + F.lit(bound[1]) / F.sqrt(F.col("n_words").cast("double")), F.lit(True))

    return ~F.col("base_failed") & near("char_distance", char_bound) & near("word_distance", word_bound)


ADDED = (*MEASURES, "base_failed", "char_distance", "word_distance", "kept")


def judge(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    share_per_mille: int = SHARE_PER_MILLE,
    min_words: int = MIN_WORDS,
    min_texts: int = MIN_TEXTS,
    char_bound: tuple[float, float] = CHAR_BOUND,
    word_bound: tuple[float, float] = WORD_BOUND,
) -> DataFrame:
    """As :func:`quality_rules`, without the text column: the figures that made the references give the verdicts too.

    Texts are read twice in all, once for common words and once for figures.
    """
    keep = [c for c in docs.columns if c not in ADDED and c != text]
    table, counts, figures = _prepare(docs, text, lang, share_per_mille, min_words, min_texts, keep)
    rows = _beside(figures, table.select("lang", "bins", "char_reference", "word_reference"), "lang", counts)
    char, word = F.col("char_reference"), F.col("word_reference")
    rows = rows.withColumn("base_failed", _failed())
    rows = rows.withColumn("char_distance", F.when(F.col("usable") & char.isNotNull(), _distance(F.col("char"), char)))
    rows = rows.withColumn("word_distance", F.when(F.col("usable") & word.isNotNull(), _distance(_chosen(F.col("word")), word)))
    return rows.select(*(["row.*"] if keep else []), *ADDED[:-1], _verdict(char_bound, word_bound).alias("kept"))


def quality_rules(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    share_per_mille: int = SHARE_PER_MILLE,
    min_words: int = MIN_WORDS,
    min_texts: int = MIN_TEXTS,
    char_bound: tuple[float, float] = CHAR_BOUND,
    word_bound: tuple[float, float] = WORD_BOUND,
) -> DataFrame:
    """Every row and column of ``docs`` plus its counts, its two distances and the verdict.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``char_distance``, ``word_distance`` and
    ``kept``. A distance is null where it is not judged: base rules failed, fewer than
    ``min_words`` words, or no reference of its language. ``kept`` is false where the
    base rules failed or a distance passes its bound ``floor + noise / sqrt(n_words)``.

    Null text: as empty, all counts 0, base rules failed; the text stays null. Null
    language: language ``und``. Rows are judged one by one, so repeated rows and null
    ids need no rule; copies count once in the references. Columns of the added names
    are replaced, others of whatever name pass through. An empty table gives an empty
    table.
    """
    table, counts, _ = _prepare(docs, text, lang, share_per_mille, min_words, min_texts, [])
    table = table.drop("bins")
    kept = [c for c in docs.columns if c not in ADDED]
    names = {c: fresh(f"_{c}", [*docs.columns, *ADDED]) for c in ("lang", "text", *table.columns[1:])}
    rows = docs.select(*kept, F.coalesce(F.col(lang), F.lit("und")).alias(names["lang"]), F.coalesce(F.col(text), F.lit("")).alias(names["text"]))
    rows = _beside(rows, table.withColumnsRenamed({c: names[c] for c in table.columns[1:]}), names["lang"], counts)
    col = {k: F.col(v) for k, v in names.items()}
    rows = base_counts(rows, names["text"]).withColumn("base_failed", _failed())
    judged = ~F.col("base_failed") & (F.col("n_words") >= min_words)
    rows = rows.withColumn("char_distance", F.when(judged & col["char_reference"].isNotNull(), _distance(_class_counts(col["text"]), col["char_reference"])))
    counted = _word_counts(col["text"], col["table"])
    rows = rows.withColumn("word_distance", F.when(judged & col["word_reference"].isNotNull(), _distance(counted, col["word_reference"])))

    return rows.select(*kept, *MEASURES, "base_failed", "char_distance", "word_distance", _verdict(char_bound, word_bound).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_SQL_CLASSES = ", ".join(f"len(regexp_replace(t, '{x}', '', 'g'))" for x in (
    r"[^\p{Ll}]+", r"[^\x20\x09-\x0D]+", r"[^\p{Lu}]+", r"[\p{Ll}\p{Lu}]+|[^\p{L}]+", r"[^\p{Nd}]+", r"""[^.,;:!?''"()-]+"""
))

SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS p,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, [{_SQL_CLASSES}] AS c6, len(t) AS n
  FROM docs
), starts AS (
  SELECT rid, i, array_to_string(w[i:i + 7], chr(1)) AS x FROM split, unnest(range(1, len(w) - 6)) AS u(i)
), twice AS (
  SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, x) AS k FROM starts) WHERE k > 1
), gaps AS (
  SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS g FROM twice
), repeats AS (
  SELECT rid, sum(g) AS n_repeat_words FROM gaps GROUP BY rid
), base AS (
  SELECT d.rid, d.doc_id, d.lang, d.t, s.p, list_append(c6, n - list_sum(c6)) AS cc, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(w) < {MIN_BASE_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEATED} * len(w) AS base_failed
  FROM docs d JOIN split s USING (rid) LEFT JOIN repeats USING (rid)
), plain AS (
  SELECT rid, lang, unnest(p) AS word FROM base
), common AS (
  SELECT lang, word FROM (SELECT lang, word, count(*) AS k FROM plain GROUP BY lang, word) JOIN
    (SELECT lang, count(*) AS total FROM plain GROUP BY lang) USING (lang) WHERE 1000 * k >= {SHARE_PER_MILLE} * total
), judged AS (
  SELECT * FROM base WHERE NOT base_failed AND n_words >= {MIN_WORDS}
), hits AS (
  SELECT rid, p.lang, word, count(*) AS c FROM plain p JOIN common USING (lang, word) WHERE rid IN (SELECT rid FROM judged) GROUP BY rid, p.lang, word
), cells AS (
  SELECT 'char' AS kind, rid, lang, i AS bin, CAST(i AS VARCHAR) AS name, cc[i] AS c FROM judged, unnest(range(1, 8)) AS u(i)
  UNION ALL
  SELECT 'word', rid, j.lang, 0, word, coalesce(h.c, 0) FROM judged j JOIN common USING (lang) LEFT JOIN hits h USING (rid, word)
  UNION ALL
  SELECT 'word', rid, j.lang, 1, '', len(p) - coalesce(k, 0) FROM judged j LEFT JOIN (SELECT rid, sum(c) AS k FROM hits GROUP BY rid) USING (rid)
  WHERE lang IN (SELECT lang FROM common)
), shares AS (
  SELECT *, sum(c) OVER (PARTITION BY kind, rid) AS total FROM cells
), texts AS (
  SELECT lang, t, min(rid) AS rid FROM judged GROUP BY lang, t
), enough AS (
  SELECT lang FROM texts GROUP BY lang HAVING count(*) >= {MIN_TEXTS}
), sums AS (
  SELECT kind, s.lang, bin, name, sum(c * {PPM} // greatest(total, 1)) AS x
  FROM shares s JOIN texts USING (rid) WHERE s.lang IN (SELECT lang FROM enough) GROUP BY kind, s.lang, bin, name
), refs AS (
  SELECT kind, lang, bin, name, x / sum(x) OVER (PARTITION BY kind, lang) AS q FROM sums
), parts AS (
  SELECT kind, rid, s.lang, bin, name, c / total AS p, q, (c / total + q) / 2 AS m FROM shares s JOIN refs USING (kind, lang, bin, name) WHERE total > 0
), far AS (
  SELECT kind, rid, sqrt(greatest(0, sum((CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END) + (CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END)) / 2)) AS d
  FROM parts GROUP BY kind, rid
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(c.d <= {CHAR_BOUND[0]} + {CHAR_BOUND[1]} / sqrt(n_words), true)
         AND coalesce(w.d <= {WORD_BOUND[0]} + {WORD_BOUND[1]} / sqrt(n_words), true) AS kept
FROM base b LEFT JOIN far c ON c.kind = 'char' AND c.rid = b.rid LEFT JOIN far w ON w.kind = 'word' AND w.rid = b.rid
"""
