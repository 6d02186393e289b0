"""Phrase collocations: phrases of two or three words that stand together far more often than their parts do.

1. Words are counted per language: a counter in each task, one aggregation. Those seen
   ``min_count`` times make the dictionary and get ids from 1 without gaps; no other
   word can be in a phrase seen that often.
2. Texts become sequences of ids. A piece breaks at every other word (id 0).
3. Each place ends a phrase of two ids and one of three. A phrase is a fixed-width
   key: ids of ``BITS`` bits, first word highest, 0 for no third word. Every task sorts
   and counts its keys in runs of ``FLUSH``, so a frequent phrase leaves it a few times
   only, whatever its count.
4. Keys are dealt by range and sorted; a key is one LONG, which Spark sorts by radix.
   Equal keys are neighbours, and a streaming pass adds up the runs.

What is left are phrases of ``min_count`` or more. Their parts are looked up by id with
joins that deal frequent words to several tasks.

The dictionary travels to the tasks while its size, which is counted, allows
(``DICTIONARY_WORDS`` words of ``DICTIONARY_BYTES`` bytes). A larger one is joined to
the words instead, and keys are three LONGs; the result is the same.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import bound_batches
from .scratch import Scratch
from .skew import weighted_lookup

MIN_COUNT = 10
KEEP = 2000
ABSORBED = 50
SCALE = 1_000_000
BITS = 21
DICTIONARY_WORDS = 2**20
DICTIONARY_BYTES = 64 * 2**20
FLUSH = 4_000_000
BLOCK = 1 << 20
CHUNK = 1 << 16

_UPPER, _SEPARATORS = bytes(range(65, 91)), b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_UPPER + _SEPARATORS + b"\t", _UPPER.lower() + b"." * len(_SEPARATORS) + b" ")


def tokens(text: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """Words in lower case (A-Z), and ``.`` where a piece ends, in blocks that a blank ends."""
    plain, at = text.translate(_PLAIN).replace(b".", b" . "), 0
    while at < len(plain):
        end = plain.find(b" ", at + block)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _texts(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    """The UTF-8 texts of a batch of (lang, text) by language."""
    found = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
        found[lang].append(text)
    return found


def _count_words(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, seen in counts.items():
            seen.pop(b".", None)
            arrays = [pa.array([lang] * len(seen), pa.string()), pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
            yield from pa.Table.from_arrays(arrays, ["lang", "word", "n"]).to_batches(max_chunksize=50_000)
        counts.clear()

    for batch in batches:
        for lang, texts in _texts(batch).items():
            for text in texts:
                for block in tokens(text):
                    counts[lang].update(block)
        if sum(map(len, counts.values())) > most:
            yield from flush()
    yield from flush()


def _runs(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of sorted ``keys`` and the sums of their counts."""
    first = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
    at = np.flatnonzero(first)
    return keys[at], np.add.reduceat(counts, at)


def _table(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(keys[:, i]) for i in range(keys.shape[1])]
    return pa.RecordBatch.from_arrays([*columns, pa.array(counts)], [*_names(keys.shape[1]), "a"])


def _names(width: int) -> list[str]:
    return [f"k{i}" for i in range(width)]


def _schema(width: int) -> str:
    return ", ".join(f"{k} long" for k in _names(width)) + ", a long"


class _Packer:
    """Keys of phrases, counted in runs of about ``FLUSH``."""

    def __init__(self, width: int, flush: int = FLUSH):
        self.width, self.most = width, flush
        self.held, self.size = [], 0

    def add(self, ids: np.ndarray, mine: np.ndarray | None = None) -> None:
        """Phrases that end at the third place of ``ids`` or later, and where ``mine`` holds."""
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        two = (b > 0) & (c > 0)
        if mine is not None:
            two &= mine[2:]
        three = two & (a > 0)
        none = np.zeros(1, ids.dtype)
        for x, y, z in ((b[two], c[two], none), (a[three], b[three], c[three])):
            if self.width == 1:
                keys = ((x << 2 * BITS) | (y << BITS) | z)[:, None]
            else:
                keys = np.column_stack(np.broadcast_arrays(x, y, z))
            self.held.append(keys)
            self.size += len(keys)

    def full(self) -> bool:
        return self.size >= self.most

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys = np.concatenate(self.held)
            self.held, self.size = [], 0
            if self.width == 1:
                keys.sort(axis=0)
            else:
                keys = keys[np.lexsort(keys.T[::-1])]
            keys, counts = _runs(keys, np.ones(len(keys), np.int64))
            for k in range(0, len(keys), 100_000):
                yield _table(keys[k : k + 100_000], counts[k : k + 100_000])


_LOADED: dict[str, dict] = {}


def _dictionary(name: str, shared) -> dict[str, dict[bytes, int]]:
    """Ids by language and word; built once a worker."""
    if name not in _LOADED:
        _LOADED.clear()
        found: dict[str, dict[bytes, int]] = defaultdict(dict)
        for batch in pa.ipc.open_stream(shared.value):
            for lang, word, ident in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                found[lang][word] = ident
        _LOADED[name] = found
    return _LOADED[name]


def _keys_by_dictionary(rows: DataFrame, words: DataFrame, flush: int) -> DataFrame:
    """Counted keys; the dictionary, whose size the caller has checked, goes to the tasks."""
    table = words.select("lang", "word", "id").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    shared, name = rows.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes()), uuid.uuid4().hex

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer = _dictionary(name, shared), _Packer(1, flush)
        for batch in batches:
            for lang, texts in _texts(batch).items():
                get, tail = known.get(lang, {}).get, np.zeros(2, np.int64)
                for block in tokens(b".".join(texts)):
                    ids = np.fromiter((get(x, 0) for x in block), np.int64, len(block))
                    ids = np.concatenate([tail, ids])
                    packer.add(ids)
                    tail = ids[-2:]
                    if packer.full():
                        yield from packer.flush()
        yield from packer.flush()

    return rows.mapInArrow(pack, _schema(1))


def _keys_by_join(rows: DataFrame, words: DataFrame, flush: int, chunk: int) -> DataFrame:
    """Counted keys for a dictionary of any size: words meet it in a join and then their neighbours again, chunk by chunk."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at = 0
                for block in tokens(text.encode()):
                    n = len(block)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, row)), pa.array(np.arange(at, at + n)), pa.array([lang] * n, pa.string()), pa.array(block, pa.binary())],
                        ["row", "at", "lang", "word"],
                    )
                    at += n

    placed = rows.select(F.monotonically_increasing_id().alias("row"), "lang", "text").mapInArrow(spread, "row long, at long, lang string, word binary")
    found = weighted_lookup(placed, words.select("lang", "word", "id", "f"), ["lang", "word"], "f", spread=F.xxhash64("row", "at"))
    part = F.expr(f"at div {chunk}")
    parts = F.when(F.col("at") % chunk >= chunk - 2, F.array(part, part + 1)).otherwise(F.array(part))
    cells = found.select("row", "at", "id", F.explode(parts).alias("part")).groupBy("row", "part")
    cells = cells.agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("c")).select("part", "c.at", "c.id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(3, flush)
        for batch in batches:
            for part, at, ids in zip(*(batch.column(i) for i in range(3)), strict=True):
                at, ids, first = at.values.to_numpy(), ids.values.to_numpy(), max(0, part.as_py() * chunk - 2)
                line = np.zeros(at[-1] - first + 3, np.int64)  # words outside the dictionary are 0
                line[at - first + 2] = ids
                mine = np.arange(first - 2, at[-1] + 1) // chunk == part.as_py()
                packer.add(line, mine)
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    return cells.mapInArrow(pack, _schema(3))


def _add_runs(width: int, least: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty((0, width), np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = [x.to_numpy() for x in batch.columns]
            keys = np.concatenate([keys, np.column_stack(cells[:width])])
            keys, counts = _runs(keys, np.concatenate([counts, cells[width]]))
            often = np.flatnonzero(counts[:-1] >= least)
            yield _table(keys[often], counts[often])
            keys, counts = keys[-1:], counts[-1:]  # the next batch may go on with this key
        if len(counts) and counts[0] >= least:
            yield _table(keys, counts)

    return add


def _dense(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``words`` with an ``id`` from 1 without gaps: places within partitions plus the partitions' offsets."""
    placed = scratch.save(words.withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftrightunsigned("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row a partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    low = F.col("_place").bitwiseAND(F.lit(2**33 - 1))
    out = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return scratch.save(out.withColumn("id", low + F.col("_before") + 1).drop("_part", "_before", "_place"), "dictionary")


def phrases(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    dictionary_words: int = DICTIONARY_WORDS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    flush: int = FLUSH,
    chunk: int = CHUNK,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dictionary (lang, word, f, id), phrases (id1, id2, id3 or 0, a) of ``min_count`` or more, and word counts (lang, n)."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "collocations")
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = rows.mapInArrow(_count_words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    frequent = F.when(F.col("f") >= min_count, F.col("word"))  # all others are one row a language
    counted = scratch.save(counted.groupBy("lang", frequent.alias("word")).agg(F.sum("f").alias("f")), "words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words = _dense(counted.where("word is not null"), scratch)
    size = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    if size[0] <= min(dictionary_words, 2**BITS - 1) and size[1] <= dictionary_bytes:
        keys, width = _keys_by_dictionary(rows, words, flush), 1
    else:
        keys, width = _keys_by_join(rows, words, flush, chunk), 3
    names = _names(width)
    runs = keys.repartitionByRange(*names).sortWithinPartitions(*names)
    if width == 1:
        mask = F.lit(2**BITS - 1)
        ids = [F.shiftright("k0", 2 * BITS), F.shiftright("k0", BITS).bitwiseAND(mask), F.col("k0").bitwiseAND(mask)]
    else:
        ids = [F.col(k) for k in names]
    found = runs.mapInArrow(_add_runs(width, min_count), _schema(width))
    return words, scratch.save(found.select(*[x.alias(f"id{i + 1}") for i, x in enumerate(ids)], "a"), "phrases"), totals


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    keep: int = KEEP,
    absorbed: int = ABSORBED,
    dictionary_words: int = DICTIONARY_WORDS,
    flush: int = FLUSH,
    chunk: int = CHUNK,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``keep`` best phrases of every language (null: ``und``).

    A phrase of a words is scored by the cut of least floor(10^6 a^2 / (l r)), where l
    and r are the counts of its two parts; of equal cuts the first counts. A pair
    inside a triple with at least ``absorbed`` percent of its count is left out. Ties
    in score go to the larger a, then to the phrase first in byte order. Arithmetic is
    exact: decimals of 38 digits.

    Null and empty texts have no words; repeated rows count as often as they stand;
    other columns are not read. Tables without such phrases give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    words, found, totals = phrases(docs, text=text, lang=lang, min_count=min_count, dictionary_words=dictionary_words, flush=flush, chunk=chunk)
    pairs, triples = found.where("id3 = 0").drop("id3"), found.where("id3 > 0")

    def looked_up(rows: DataFrame, table: DataFrame, on: list[str], name: str) -> DataFrame:
        weight = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("weight"))
        return weighted_lookup(rows, scratch.save(table.join(weight, on), name), on, "weight")

    def word(rows: DataFrame, k: int, name: str) -> DataFrame:
        columns = [F.col("id").alias(f"id{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}")]
        return looked_up(rows, words.select(*columns, *(["lang"] if k == 1 else [])), [f"id{k}"], f"{name}{k}")

    for i, j, name in ((1, 2, "left"), (2, 3, "right")):
        parts = pairs.select(F.col("id1").alias(f"id{i}"), F.col("id2").alias(f"id{j}"), F.col("a").alias(name))
        triples = looked_up(triples, parts, [f"id{i}", f"id{j}"], name)
    triples = scratch.save(triples, "triples")
    inside = [
        triples.where(F.col("a") * 100 >= F.col(name) * absorbed).select(F.col(f"id{i}").alias("id1"), F.col(f"id{j}").alias("id2"))
        for i, j, name in ((1, 2, "left"), (2, 3, "right"))
    ]
    pairs = pairs.join(inside[0].union(inside[1]).distinct(), ["id1", "id2"], "left_anti")
    for k in (1, 2):
        pairs, triples = word(pairs, k, "pair"), word(triples, k, "triple")
    triples = word(triples, 3, "triple")

    def scored(left: str, right: str) -> Column:
        square = "cast(a as decimal(15,0)) * cast(a as decimal(15,0))"
        score = F.expr(f"({square} * {SCALE}) div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))")
        return F.struct(score.alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))

    first, second = scored("f1", "right"), scored("left", "f3")
    pairs = pairs.select("lang", F.concat_ws(" ", F.col("w1").cast("string"), F.col("w2").cast("string")).alias("phrase"), "a", scored("f1", "f2").alias("cut"))
    triples = triples.select(
        "lang", F.concat_ws(" ", *[F.col(f"w{k}").cast("string") for k in (1, 2, 3)]).alias("phrase"), "a", F.when(second["score"] < first["score"], second).otherwise(first).alias("cut")
    )
    scores = scratch.save(pairs.unionByName(triples).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scores")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = math.isqrt(scores.count() // keep) + 1  # so that neither step gives a task much more than the square root
    best = scores.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= keep)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= keep)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


SQL = rf"""
WITH pieces AS (
  SELECT rid, lang, i, list_filter(regexp_split_to_array(p[i], '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
        FROM documents) d, unnest(range(1, len(p) + 1)) AS u(i)
), spots AS (
  SELECT lang, w, k FROM pieces, unnest(range(1, len(w) + 1)) AS u(k)
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM (
    SELECT lang, s AS size, array_to_string(w[k:k + s - 1], ' ') AS phrase FROM spots, unnest([1, 2, 3]) AS v(s) WHERE k + s - 1 <= len(w)
  ) GROUP BY lang, size, phrase
), total AS (
  SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= {MIN_COUNT}
), cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM c, unnest([1, 2]) AS u(k) WHERE k < size
), scored AS (
  SELECT cuts.*, l.a AS l, r.a AS r, ({SCALE}::HUGEINT * cuts.a * cuts.a) // (l.a::HUGEINT * r.a) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y
), chosen AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE size = 3 UNION ALL
  SELECT lang, array_to_string(w[2:3], ' ') AS phrase, a FROM c WHERE size = 3
), dropped AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN inside i USING (lang, phrase) WHERE c.size = 2 AND 100 * i.a >= {ABSORBED} * c.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, CAST(encode(phrase) AS BLOB)) AS rank, phrase, a, l, r, score
  FROM chosen ANTI JOIN dropped USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= {KEEP}
"""
