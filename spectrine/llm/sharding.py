"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``SLOTS`` places. Every shard owns ``vnodes`` virtual nodes, placed by
a hash of shard and node number; the arc that ends at a node belongs to its shard.
A row's key falls on a place by its hash and goes to the arc's shard. Shards are
bounded: n rows over s shards give the first ``n mod s`` shards in ring order a
capacity of ceil(n / s) and the others floor(n / s). Keys that overflow a full
shard continue clockwise, node by node, to the first shard with room. Capacities
add up to n, so every shard ends full and counts differ by one at most, while only
overflowing keys leave the shard that the plain ring gives them.

Keys are texts: equal texts fall on one place and stay together unless a shard's
bound cuts through them, as it must for a group larger than a shard.

Rows are never gathered by arc. Counts per (place, part) are aggregated, where a
place with more rows than a bound is dealt by row hash to as many parts as keep a part
near it. The bound is 1 / ``PARTS`` of all rows, and ``LEAST`` rows at least, so there are no more than
``PARTS`` further parts whatever the rows; the table of counts is bounded by them and the
ring's size, and the walk over arcs runs on it. A row then needs only its number
within its (place, part).
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 24
VNODES = 64
SLOTS = 16_384
PARTS, LEAST = 8192, 256


def _table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table as one literal of the plan."""
    names = [x.split()[0] for x in schema.split(", ", schema.count(", ") if "<" not in schema else 1)]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    kind = "array<struct<" + re.sub(r"(\w+) (?=\w)", r"\1: ", schema) + ">>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def ring_nodes(spark, shards: int, vnodes: int, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node in ring order; a place taken twice goes to the smaller shard."""
    place = F.pmod(F.xxhash64(F.concat_ws("/", "shard", "node")), F.lit(slots))
    grid = (
        spark.range(shards).select(F.col("id").cast("int").alias("shard"))
        .select("shard", F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))).alias("node"))
    )
    rows = grid.groupBy(place.alias("place")).agg(F.min("shard").alias("shard")).collect()  # shards * vnodes rows at most
    return sorted((r.place, r.shard) for r in rows)


def walk(counts: list[int], owners: list[int], capacity: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Deal rows of arcs to shards: (arc, first, end, shard) with ranges of row numbers within an arc.

    In round r every arc offers what is left of it to the shard r nodes clockwise,
    in ring order, and the shard takes as much as it has room for. What is taken
    first are the rows first in the arc.
    """
    room, out = dict(capacity), []
    left = deque((arc, 0) for arc, n in enumerate(counts) if n)
    hop = 0
    while left:
        later = deque()
        for arc, first in left:
            shard = owners[(arc + hop) % len(owners)]
            take = min(room.get(shard, 0), counts[arc] - first)
            if take:
                out.append((arc, first, first + take, shard))
                room[shard] -= take
            if first + take < counts[arc]:
                later.append((arc, first + take))
        left, hop = later, hop + 1
        if hop > len(owners):
            raise ValueError("capacities are smaller than the rows")
    return out


def shard(
    docs: DataFrame,
    *,
    shards: int = SHARDS,
    vnodes: int = VNODES,
    ident: str = "doc_id",
    text: str = "text",
    slots: int = SLOTS,
    least: int = LEAST,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    The law is ``rows``: shard counts differ by one at most. ``size`` is the text's
    UTF-8 bytes (null: 0) plus 8, ``text_crc32`` the CRC of those bytes (null text:
    of none), ``slot`` numbers a shard's rows from 0 without gaps, ``grown_shard``
    is null. Null texts are one group, empty texts another. Null and repeated ids
    are rows like others; equal rows are interchangeable. With fewer rows than
    shards some shards stay empty; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    bytes_ = F.coalesce(F.col(text), F.lit("")).cast("binary")
    spot = F.xxhash64(F.col(text), F.when(F.col(text).isNull(), 1).otherwise(0))
    rows = docs.select(
        F.col(ident).alias("doc_id"),
        (F.octet_length(bytes_).cast("long") + 8).alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        spot.alias("spot"),
    ).withColumn("place", F.pmod("spot", F.lit(slots)))
    by_place = rows.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    places = {r.place: r.n for r in by_place.collect()}  # at most `slots` rows
    total = sum(places.values())
    bound = max(least, total // PARTS)
    dealt = {p: -(-n // bound) for p, n in places.items() if n > bound}  # PARTS places at most, as many parts beyond them
    sub = {}
    if dealt:
        hot = _table(spark, sorted(dealt.items()), "place long, parts int")
        rows = rows.join(F.broadcast(hot), "place", "left")
        part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id", "spot", F.lit(5)), F.col("parts")))
        rows = rows.withColumn("part", part.cast("int")).drop("parts")
        for r in rows.join(F.broadcast(hot), "place", "left_semi").groupBy("place", "part").agg(F.count(F.lit(1)).alias("n")).collect():
            sub.setdefault(r.place, []).append((r.part, r.n))  # at most 2 * PARTS rows
    else:
        rows = rows.withColumn("part", F.lit(0))

    nodes = ring_nodes(spark, shards, vnodes, slots)
    ends, owners = [p for p, _ in nodes], [s for _, s in nodes]
    counts, offsets = [0] * len(nodes), []
    for start in [*range(ends[-1] + 1, slots), *range(ends[-1] + 1)]:  # clockwise, from the first arc's start
        n = places.get(start, 0)
        if n:
            arc = bisect_left(ends, start) % len(ends)
            for p, k in sorted(sub.get(start, [(0, n)])):
                offsets.append((start, p, arc, counts[arc]))
                counts[arc] += k
    order = list(dict.fromkeys(owners)) + [s for s in range(shards) if s not in set(owners)]
    capacity = {s: total // shards + (k < total % shards) for k, s in enumerate(order)}
    taken, spans = dict.fromkeys(order, 0), []
    for arc, first, end, s in walk(counts, owners, capacity):
        spans.append((arc, first, end, s, taken[s] - first))
        taken[s] += end - first

    # both tables are bounded by the ring's size, whatever the number of rows
    offset = _table(spark, offsets, "place long, part int, arc int, at long")
    per_arc = {}
    for arc, first, end, s, shift in spans:
        per_arc.setdefault(arc, []).append((first, end, s, shift))
    span = _table(
        spark,
        [(arc, [dict(zip(("first", "end", "shard", "shift"), x, strict=True)) for x in spans]) for arc, spans in per_arc.items()],
        "arc int, spans array<struct<first: long, end: long, shard: int, shift: long>>",
    )
    table = offset.join(F.broadcast(span), "arc").select("place", "part", "at", "spans")
    within = Window.partitionBy("place", "part").orderBy("spot", "text_crc32", "size", "doc_id")
    number = F.col("at") + F.row_number().over(within) - 1
    mine = F.get(F.filter("spans", lambda x: (x["first"] <= F.col("number")) & (F.col("number") < x["end"])), F.lit(0))
    return (
        rows.join(F.broadcast(table), ["place", "part"])
        .withColumn("number", number)
        .withColumn("mine", mine)
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("mine.shard").alias("shard"),
            (F.col("number") + F.col("mine.shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
