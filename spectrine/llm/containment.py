"""Containment search: which documents hold which short items.

An item is contained in a document when at least ``threshold`` of the item's
distinct word shingles occur in the document. Candidates come from MinHash; each
is then verified on the exact shingle sets.

*Sizes.* Items are partitioned by their number of shingles q: up to ``TINY``, then
(8, 32], (32, 128], (128, 512], ... Each class cuts documents, whatever their
length, into blocks whose size S is a quarter of the largest item: 1, 8, 32, 128,
... shingles. So a short item inside a very long document is compared with pieces
of its own size, never with the document as a whole, where its Jaccard similarity
would vanish.

*Bands.* One row per band. A block that lies wholly within the passage that holds
the item has its minimum among the item's shingles; hash i collides when the
item's own minimum lies in the block and is the block's minimum. For q > S and
containment 0.8 the chance is over 0.5 for each hash (worst at q = S + 1, straddling
two blocks; over 0.7 from q = 2 S), so ``HASHES`` = 16 bands miss a contained item
with less than 2**-16. Windows of two overlapping blocks never do worse, for they
hold all of a block's shingles. In the class of tiny items a block is a single
shingle, its own minimum under every hash, and an item enters with each of its
(at most 8) shingles, so nothing is missed.

Everything here is DataFrame expressions. The item bands are broadcast only when
their counted bytes are at most ``BROADCAST_BYTES``; beyond that Spark shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .shingles import WORDS, shingle_hashes

THRESHOLD = 0.8
HASHES = 16
TINY = 8
#: Bytes of shingles and bands that are broadcast.
BROADCAST_BYTES = 32_000_000


def row_key(ident: str, text: str) -> Column:
    """Names a row by 128 bits of id and text, so null and repeated ids do not mix."""
    return F.struct(*[F.xxhash64(F.col(ident), F.col(text), F.lit(seed)).alias(part) for part, seed in (("a", 7), ("b", 8))])


def _class_of(q: Column) -> Column:
    """0 for tiny items, k for q in (8 * 4**(k-1), 8 * 4**k]."""
    k = F.lit(0)
    for c in range(12):
        k = F.when(q > TINY * 4**c, F.lit(c + 1)).otherwise(k)
    return k


def _block(k: int) -> int:
    return 1 if k == 0 else 2 * 4**k


def prepare_items(items: DataFrame, *, ident: str, text: str, words: int = WORDS) -> DataFrame:
    """(item, q, k, shingles) for each item row that has words."""
    return (
        items.select(F.col(ident).alias("item"), F.array_distinct(shingle_hashes(F.col(text), words)).alias("shingles"))
        .withColumn("q", F.size("shingles"))
        .where("q > 0 and item is not null")
        .withColumn("k", _class_of(F.col("q")))
    )


def _item_bands(items: DataFrame) -> DataFrame:
    tiny = items.where("k = 0").select("item", "k", F.lit(0).alias("i"), F.explode("shingles").alias("v"))

    def minimum(i: int) -> Column:
        return F.array_min(F.transform("shingles", lambda h: F.xxhash64(h, F.lit(i))))

    minima = F.array(*[F.struct(F.lit(i).alias("i"), minimum(i).alias("v")) for i in range(HASHES)])
    large = items.where("k > 0").select("item", "k", F.inline(minima))
    return tiny.unionByName(large).distinct()


def _minima(docs: DataFrame, ks: list[int], *, ident: str, text: str, words: int, overlap: bool) -> DataFrame:
    """(doc, k, i, v): the MinHash bands of every block or window of every class in ``ks``.

    Rows are dealt by document once; both aggregations and the final distinct reuse
    that partitioning, so signatures are never shuffled.
    """
    base = _block(min(ks))
    least = [F.min(F.xxhash64("h", F.lit(i))).alias(f"m{i}") for i in range(HASHES)]
    blocks = (
        docs.select(row_key(ident, text).alias("doc"), F.col(text).alias("text"))
        .repartition("doc")
        .select("doc", F.posexplode(shingle_hashes(F.col("text"), words)).alias("pos", "h"))
        .groupBy("doc", F.floor(F.col("pos") / base).cast("int").alias("b"))
        .agg(*least)
    )
    spans = []
    for k in ks:
        c = F.floor(F.col("b") / (_block(k) // base)).cast("int")
        spans += [F.struct(F.lit(k).alias("k"), (c - o).alias("w")) for o in range(2 if overlap else 1)]
    if len(spans) > 1:
        blocks = (
            blocks.select("doc", F.explode(F.array(*spans)).alias("s"), *[f"m{i}" for i in range(HASHES)])
            .groupBy("doc", "s")
            .agg(*[F.min(f"m{i}").alias(f"m{i}") for i in range(HASHES)])
            .select("doc", "s.k", *[f"m{i}" for i in range(HASHES)])
        )
    else:
        blocks = blocks.withColumn("k", F.lit(ks[0]))
    bands = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"m{i}").alias("v")) for i in range(HASHES)])
    return blocks.select("doc", "k", F.inline(bands))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    overlap: bool = False,
) -> DataFrame:
    """(doc, item, shared, item_shingles) of every document row and item it contains.

    ``doc`` is :func:`row_key` of the document row. Items without words or id and
    documents without words match nothing. Repeated item rows with one id are one
    item each; their results are merged by the larger ``shared / item_shingles``.
    """
    scratch = Scratch(docs.sparkSession, "containment")
    items = scratch.save(prepare_items(items, ident=item_id, text=item_text, words=words), "items")
    counted = items.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("shingles")).collect()  # at most 13 rows
    sizes = {r.k: r.n for r in counted}
    if not sizes:
        nothing = F.lit(None).cast("int")
        return items.select(F.lit(None).cast("struct<a:bigint,b:bigint>").alias("doc"), "item", nothing.alias("shared"), nothing.alias("item_shingles")).where("false")
    bands = _item_bands(items)
    # a shingle has 8 bytes, a band about 40
    small = sum(8 * r.shingles + 40 * r.n * max(HASHES, TINY) for r in counted) <= BROADCAST_BYTES
    bounded = F.broadcast if small else lambda df: df
    found = []
    if 0 in sizes:
        found.append(
            docs.select(
                row_key(doc_id, doc_text).alias("doc"), F.explode(shingle_hashes(F.col(doc_text), words)).alias("v")
            )
            .join(bounded(bands.where("k = 0").select("item", "v")), "v")
            .select("doc", "item")
        )
    if large := sorted(k for k in sizes if k):
        found.append(
            _minima(docs, large, ident=doc_id, text=doc_text, words=words, overlap=overlap)
            .join(bounded(bands.where("k > 0")), ["k", "i", "v"])
            .select("doc", "item")
        )
    pairs = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    pairs = scratch.save(pairs.distinct(), "pairs")

    sets = items.select("item", "q", "shingles").distinct()
    whole = (
        docs.select(row_key(doc_id, doc_text).alias("doc"), F.col(doc_text).alias("text"))
        .join(pairs.select("doc").distinct(), "doc", "left_semi")
        .dropDuplicates(["doc"])
        .select("doc", F.array_distinct(shingle_hashes(F.col("text"), words)).alias("have"))
    )
    if small:
        sets = F.broadcast(sets)
    return (
        pairs.join(whole, "doc")
        .join(sets, "item")
        .select("doc", "item", F.size(F.array_intersect("have", "shingles")).alias("shared"), F.col("q").alias("item_shingles"))
        .where(F.col("shared") >= F.lit(threshold) * F.col("item_shingles"))
        .groupBy("doc", "item")
        .agg(F.max(F.struct(F.col("shared") / F.col("item_shingles"), "shared", "item_shingles")).alias("best"))
        .select("doc", "item", "best.shared", "best.item_shingles")
    )
