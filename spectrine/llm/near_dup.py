"""Near-duplicate documents: MinHash signatures and a multi-index Hamming join.

A document's signature is ``VALUES`` MinHash values of 16 bits each; the distance of
two signatures is the number of values that differ. Sets of Jaccard similarity J
differ in each value with chance 1 - J, so with 64 values and J = 0.8 more than
``DISTANCE`` = 26 values differ with a chance of about 4 in 100,000; from 0.85 on it is
below 2 in ten million.

Every pair within that distance is found for certain: the signature is split into
``CHUNKS`` = 14 chunks, so some chunk differs in at most floor(26 / 14) = 1 value, and
each chunk is indexed once for each value that may be wrong, by the others. Pairs of
one index key become candidates and links are confirmed on the full shingle sets.

Equal word sequences are one node from the start. Candidates are screened inside the
join by two bounds that no link can fail: the sizes of the sets (J >= 0.8 needs a ratio
of 0.8 or more) and parity sketches. A parity sketch throws a set's shingles into
``BITS`` bits, each shingle flipping one; two sketches never differ in more bits than
their sets in shingles, and 9 differing shingles in (|A| + |B|) are the most that J = 0.8
allows. Up to some thousand shingles this leaves hardly a pair that is no link; the sketch
says less about longer texts, for which the signature distance remains.

Links inside a component need not be known, so work does not grow with the square of
a group of copies. In ``STAR_ROUNDS`` rounds each node is compared with one random
member (a hub) of each of a few of its keys and joined to the most similar of them, and
what is joined is merged. Only pairs of different components are then compared under
all keys, the component that is most frequent under a key being nowhere paired with itself,
and each pair is emitted at the first key that it shares.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bound_batches
from .components import components
from .scratch import Scratch
from .shingles import let
from .skew import fresh, weighted_lookup

VALUES, DISTANCE, CHUNKS = 64, 26, 14
WORDS, PERCENT = 5, 80
#: Bits of a parity sketch.
BITS = 2048
#: Rounds in which each node meets the hubs of its keys; an economy, which the last join makes good.
STAR_ROUNDS = 2
#: Members of one key that one task compares with the others.
BLOCK = 500
#: Pairs under one key that one task compares, about; and the most tasks.
TASK_PAIRS, TASKS = 2_000_000, 20_000
#: Bytes of ids (24 a row, of text keys and ids) broadcast to select texts; beyond that the texts are shuffled.
BROADCAST_BYTES = 24_000_000
#: Words handled together.
BATCH_WORDS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


@functools.cache
def _factors(seed: int, count: int) -> list[np.uint64]:
    return list(np.random.default_rng(seed).integers(0, 2**64, count, dtype=np.uint64) | _ONE)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words: A-Z in lower case, runs of anything but ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n-word shingles in order; fewer words give one, of the whole; none give none."""
    if not len(words):
        return words
    width = min(n, len(words))
    last = len(words) - width + 1
    h = np.full(last, np.uint64(width))
    for j in range(width):
        h = _finish((h + _MIX) * _MIX ^ words[j : j + last])
    return h


def _signatures(parts: list[np.ndarray], seed: int, count: int) -> np.ndarray:
    """One row of ``count`` 16-bit MinHash values for each non-empty array of shingle hashes."""
    out = np.empty((len(parts), count), dtype=np.int16)
    k = 0
    while k < len(parts):
        end, size = k, 0
        while end < len(parts) and (end == k or size + len(parts[end]) <= BATCH_WORDS):
            size += len(parts[end])
            end += 1
        flat = np.concatenate(parts[k:end])
        starts = np.cumsum([0, *map(len, parts[k : end - 1])])
        for i, factor in enumerate(_factors(seed, count)):
            least = np.minimum.reduceat(flat * factor, starts)
            out[k:end, i] = ((least * _MIX) >> np.uint64(48)).astype(np.uint16).view(np.int16)
        k = end
    return out


def sketch(text: Column, words: int) -> Column:
    """struct(digest, n, sig): of the word sequence, the shingle set's size and the signature."""

    @F.pandas_udf("digest binary, n long, sig array<smallint>")
    def run(texts: pd.Series) -> pd.DataFrame:
        digests, sizes, parts = [], [], []
        for text in texts:
            w = word_hashes(text)
            s = np.unique(shingles(w, words))
            digests.append(xxhash.xxh3_128_digest(w.tobytes()) if len(w) else None)
            sizes.append(len(s))
            if len(w):
                parts.append(s)
        rows = iter(_signatures(parts, 64, VALUES))
        return pd.DataFrame({"digest": digests, "n": sizes, "sig": [next(rows) if n else None for n in sizes]})

    return run.asNondeterministic()(text)


def full_set(text: Column, words: int) -> Column:
    """struct(digest, odd, have): of the word sequence, the parity sketch and the distinct shingle hashes."""

    @F.pandas_udf("digest binary, odd array<bigint>, have array<bigint>")
    def run(texts: pd.Series) -> pd.DataFrame:
        ws = [word_hashes(t) for t in texts]
        have = [np.unique(shingles(w, words)) for w in ws]
        return pd.DataFrame(
            {
                "digest": [xxhash.xxh3_128_digest(w.tobytes()) if len(w) else None for w in ws],
                "odd": [parity(h) for h in have],
                "have": [h.view(np.int64) for h in have],
            }
        )

    return run.asNondeterministic()(text)


def parity(hashes: np.ndarray) -> np.ndarray:
    """The parity sketch of distinct shingle hashes, as 64-bit words."""
    spots = ((hashes * _MIX) >> np.uint64(40)) % np.uint64(BITS)
    return np.packbits(np.bincount(spots.astype(np.int64), minlength=BITS).astype(np.uint8) & 1).view(np.int64)


_PARTS = [(int(c[0]), len(c)) for c in np.array_split(np.arange(VALUES), CHUNKS)]


def _keys() -> Column:
    """The index keys of a signature. Key i leaves out value i and holds the others of its chunk."""
    out = []
    for first, size in _PARTS:
        for skip in range(first, first + size):
            rest = [F.get("sig", F.lit(i)) for i in range(first, first + size) if i != skip]
            out.append(F.xxhash64(F.lit(skip), *rest))
    return F.array(*out)


def _star_keys(turn: int) -> list[int]:
    """Places of the keys whose hubs are met in a round: another one of each chunk."""
    return [first + turn % size for first, size in _PARTS]


def _differ(a: str, b: str) -> Column:
    return F.zip_with(a, b, lambda x, y: F.when(x == y, 0).otherwise(1))


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda n, v: n + v)


def _first_shared(differ: Column) -> Column:
    """The first key that two signatures share, from the array that marks where they differ."""
    chunks = F.array(*[F.struct(F.lit(first).alias("at"), F.lit(size).alias("size")) for first, size in _PARTS])
    fit = F.get(F.filter(chunks, lambda c: _sum(F.slice(differ, c["at"] + 1, c["size"])) <= 1), F.lit(0))
    wrong = F.array_position(F.slice(differ, fit["at"] + 1, fit["size"]), 1)
    return fit["at"] + F.greatest(wrong - 1, F.lit(0)).cast("int")


def _unlike_bits(a: str, b: str, first: int, end: int) -> Column:
    """Bits in which words ``first`` to ``end`` - 1 of two parity sketches differ."""
    words = [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(first, end)]
    return functools.reduce(lambda x, y: x + y, words)


def _all_unlike_bits(a: str, b: str) -> Column:
    """Bits in which two parity sketches differ: never more than shingles in which the sets do."""
    return _sum(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))))


def _may_link(percent: int) -> Column:
    """False only for pairs that cannot have 100 * |A & B| >= percent * |A | B|, by the sizes and sketches of a and b.

    Some words, whose test is compiled, turn most pairs away before the others are looked at.
    """
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    most = (100 - percent) * (F.col("n_a") + F.col("n_b"))
    some = (100 + percent) * _unlike_bits("odd_a", "odd_b", 0, 20) <= most
    return sizes & some & ((100 + percent) * _all_unlike_bits("odd_a", "odd_b") <= most)


def _named(df: DataFrame, end: str, *columns: str) -> DataFrame:
    return df.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])


class _Search:
    """The links between the nodes of one table, up to components."""

    def __init__(self, scratch: Scratch, texts: DataFrame, nodes: DataFrame, words: int, percent: int):
        self.scratch, self.percent = scratch, percent
        keyed = nodes.select("digest", "node", F.posexplode(_keys()).alias("at", "key"))
        shared = keyed.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.count(F.lit(1)).alias("weight"))
        shared = scratch.save(shared.where("x <> y").select("key", "weight"), "shared")
        self.members = scratch.save(weighted_lookup(keyed, shared, ["key"], "weight", spread=F.xxhash64("node")), "members")
        met = nodes.join(self.members.select("digest").distinct(), "digest", "left_semi")
        met = self.met = scratch.save(met.select("digest", "node", "id", "sig", "n"), "met")
        total, distinct = met.select(F.count(F.lit(1)), F.count_distinct("node")).first()
        self.unique = total == distinct
        asked = met.select(F.col("id").alias("doc_id")).distinct()
        if 24 * total <= BROADCAST_BYTES:
            asked = F.broadcast(asked)
        sets = (
            texts.join(asked, "doc_id", "left_semi")
            .select(full_set(F.col("text"), words).alias("s"))
            .select("s.digest", "s.odd", "s.have")
            .join(met.select("digest", "node", "n", "sig"), "digest")
            .dropDuplicates(["digest"])
        )
        self.sets = scratch.save(sets.select("node", "n", "sig", "odd", "have"), "sets")
        self.links, self.roots, self.turn = None, None, 0

    def _placed(self) -> DataFrame:
        """(key, at, node, root) of the members of keys that hold several components."""
        placed = self.members.select("key", "at", "node").withColumn("root", F.col("node"))
        if self.roots is not None:
            placed = self.members.select("key", "at", "node").join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        return placed

    def _confirm(self, pairs: DataFrame, name: str) -> None:
        """Adds the pairs whose full sets are similar enough, and merges components."""
        pairs = self.scratch.save(pairs, f"{name}-pairs")
        both = F.size(F.array_intersect("have_a", "have_b")).cast("long")
        firsts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("weight")).join(_named(self.sets, "a", "n", "have"), "a")
        firsts = self.scratch.save(firsts, f"{name}-firsts")
        exact = weighted_lookup(pairs, firsts, ["a"], "weight").join(_named(self.sets, "b", "n", "have"), "b")
        exact = exact.select("a", "b", "n_a", "n_b", both.alias("both"))
        links = exact.where(100 * F.col("both") >= self.percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")
        if self.roots is not None:
            links = links.unionByName(self.roots.select(F.col("root").alias("a"), F.col("node").alias("b")))
        self.roots = components(links, self.scratch, f"{name}-roots")
        self.scratch.drop(f"{name}-pairs", f"{name}-firsts")

    def star(self) -> None:
        """Compares every node with a random member of some of its keys and joins it to the likest."""
        name = f"star{self.turn}"
        placed = self._placed().where(F.col("at").isin(_star_keys(self.turn)))
        hub = F.max_by(F.struct("node", "root"), F.xxhash64("node", "key"))
        hubs = placed.groupBy("key").agg(
            hub.alias("hub"), F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("weight")
        )
        hubs = self.scratch.save(hubs.where("x <> y").select("key", "hub", "weight"), f"{name}-keys")
        met = weighted_lookup(placed, hubs, ["key"], "weight").where(F.col("root") != F.col("hub.root"))
        met = self.scratch.save(met.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), name)
        hubs = met.groupBy("a").agg(F.count(F.lit(1)).alias("weight"))
        hubs = self.scratch.save(hubs.join(_named(self.sets, "a", "n", "odd"), "a"), f"{name}-hubs")
        wide = weighted_lookup(met, hubs, ["a"], "weight").join(_named(self.sets, "b", "n", "odd"), "b").where(_may_link(self.percent))
        share = _all_unlike_bits("odd_a", "odd_b") / (F.col("n_a") + F.col("n_b"))
        best = wide.select("a", "b", share.alias("share")).groupBy("b").agg(F.min_by("a", F.struct("share", "a")).alias("a"))
        self._confirm(best.select("a", "b"), name)
        self.scratch.drop(name, f"{name}-hubs", f"{name}-keys")
        self.turn += 1

    def cross(self) -> None:
        """Compares all pairs of different components that share a key."""
        counts = self._placed().groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
        keys = (
            counts.groupBy("key")
            .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all"))
            .where("most < all")
            .select("key", "main", F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("parts"), F.col("all").alias("weight"))
        )
        keys = self.scratch.save(keys, "open-keys")
        open_ = weighted_lookup(self._placed(), keys, ["key"], "weight")
        open_ = self.scratch.save(open_.join(self.sets.select("node", "n", "odd", "sig"), "node"), "open")
        # the rows are few for the pairs that they make, so the number of tasks follows the pairs
        pairs = keys.agg(F.sum(F.col("parts").cast("double") * BLOCK * F.col("weight"))).first()[0] or 0
        tasks = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(TASKS, int(pairs / TASK_PAIRS)))
        part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
        a = open_.where("root <> main").select(
            "key", part.alias("part"), "main", "at", F.col("node").alias("a"), F.col("root").alias("root_a"),
            F.col("n").alias("n_a"), F.col("odd").alias("odd_a"), F.col("sig").alias("sig_a"),
        )
        b = open_.select(
            "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("node").alias("b"), F.col("root").alias("root_b"),
            F.col("n").alias("n_b"), F.col("odd").alias("odd_b"), F.col("sig").alias("sig_b"),
        )
        apart = (F.col("root_b") == F.col("main")) | (F.col("root_a") < F.col("root_b"))
        once = let(_differ("sig_a", "sig_b"), lambda d: (_sum(d) <= DISTANCE) & (_first_shared(d) == F.col("at")))
        a, b = (side.repartition(tasks, "key", "part") for side in (a, b))
        same = (a["key"] == b["key"]) & (a["part"] == b["part"])
        self._confirm(a.join(b, same & apart & _may_link(self.percent) & once).select("a", "b"), "cross")
        self.scratch.drop("open", "open-keys")


def _text_key(text: str) -> Column:
    """128 bits of a text, null for a null text."""
    return F.when(F.col(text).isNotNull(), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b")))


def judge(docs: DataFrame, *, ident: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """As :func:`near_duplicates`, with ``text_key`` (128 bits of each row's text) and
    ``component`` (names the component, also where two share a smallest id)."""
    if not 80 <= percent <= 100:
        raise ValueError("the signature settings need a percentage of 80 to 100")
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "near_dup")
    texts = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    rows = texts.select("doc_id", _text_key("text").alias("text_key"), sketch(F.col("text"), words).alias("s"))
    rows = scratch.save(rows.select("doc_id", "text_key", "s.*"), "rows")
    groups = (
        rows.where("n > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.max("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("weight"))
    )
    groups = scratch.save(groups, "groups")
    seed = 0
    while True:
        # nodes have 64-bit names; should two that are compared with anything share one, all get others
        search = _Search(scratch, texts, groups.withColumn("node", F.xxhash64("digest", F.lit(seed))), words, percent)
        if search.unique:
            break
        seed += 1
    for _ in range(STAR_ROUNDS):
        search.star()
    search.cross()

    # only nodes that were compared with anything can be in a component of several
    linked = search.met.select("digest", "node").join(search.roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    placed = scratch.save(groups.select("digest", "id", "weight").join(linked, "digest", "left"), "placed")
    least = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    least = scratch.save(least, "least")
    named = weighted_lookup(placed.drop("id"), least, ["root"], "size").unionByName(
        placed.where("root is null").select("root", "digest", "weight", F.col("id").alias("component_id"))
    )
    named = scratch.save(named, "named")
    lonely = F.col("n").eqNullSafe(0) | F.col("doc_id").isNull()
    joined = weighted_lookup(rows.where(~lonely).select("doc_id", "text_key", "n", "digest"), named, ["digest"], "weight")
    component = F.struct("root", F.when(F.col("root").isNull(), F.col("digest")).alias("digest"))
    joined = joined.select("doc_id", "text_key", "n", "component_id", component.alias("component"))
    alone = rows.where(lonely).select("doc_id", "text_key", "n", F.col("doc_id").alias("component_id"))
    alone = alone.withColumn("component", F.lit(None).cast(joined.schema["component"].dataType))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    scratch.drop("shared", "members", "met", "sets", "groups", "placed", "least")
    return joined.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"), "text_key", "component")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; options as of :func:`judge`.

    Documents are linked when 100 * |A & B| >= ``percent`` * |A | B| for their sets
    of distinct ``words``-word shingles; a component is what links connect, named
    by its smallest id, and ``kept`` marks the rows with that id. Null, empty and
    wordless texts have no shingles, are linked with nothing and are kept. Texts
    with fewer words than a shingle have one, the whole sequence. Repeated rows
    are copies of each other. Rows that repeat an id with another text are judged
    by their own text. Rows with a null id are kept, have a null component and link
    nothing. An empty table gives an empty table. Percentages below 80 are refused,
    for the signature settings do not cover them.
    """
    return judge(docs, **options).drop("text_key", "component")


def drop_near_duplicates(docs: DataFrame, *, ident: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component, all columns; rows that are linked with nothing all stay.

    Of a component stays a row with its smallest id; if several rows have that id (repeated
    rows, or near copies under one id), one of them. Rows that repeat an id with an unlinked text
    are judged by that text. Null, empty and wordless texts and rows with a null id stay, each repeat
    too. Columns of any name pass through.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "drop_near_dup")
    judged = scratch.save(judge(docs, ident=ident, text=text, **options).where("n_shingles > 0 and doc_id is not null"), "judged")
    kept = judged.where("kept")
    gone = judged.where(~F.col("kept")).select("doc_id", "text_key").distinct()
    twice = kept.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
    twice = scratch.save(kept.join(twice, "component").select("doc_id", "text_key", "component").distinct(), "twice")
    row = [fresh("row_id", docs.columns), fresh("row_text", docs.columns)]
    keyed = docs.withColumn(row[0], F.col(ident)).withColumn(row[1], _text_key(text))

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("doc_id").alias(row[0]), F.col("text_key").alias(row[1]), *[c for c in df.columns if c == "component"])

    if twice.isEmpty():
        return keyed.join(named(gone), row, "left_anti").select(*docs.columns)
    group = fresh("component", docs.columns)
    rest = keyed.join(named(gone.unionByName(twice.drop("component"))), row, "left_anti").select(*docs.columns)
    one = keyed.join(named(twice).withColumnRenamed("component", group), row).dropDuplicates([group]).select(*docs.columns)
    return rest.unionByName(one)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4)


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s
  FROM w WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(nx.n) + any_value(ny.n) - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id
"""
