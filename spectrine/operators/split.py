"""Train/test splits as tables (sample_id, partition, ord).

A maximin (Kennard-Stone) split takes the two rows farthest apart, then always the row
whose nearest chosen row is farthest. It is sequential, but most of it need not go over
the data row by row:

* The farthest pair lies among rows far from the centre: two rows are never farther
  apart than their radii add up to. Rows go by falling radius in blocks, each block
  meets all rows in one pass, and the search ends when two radii cannot reach the best pair.
* A row's distance to the chosen ones only falls. So of the farthest rows, twice ``block`` of them, the
  best after any number of choices is the best of all as long as it lies before the
  first row that was left out, where that row stood at first. One pass hands these rows to
  the driver, which chooses many of them; the next pass lowers all distances by all
  of those choices at once.
* Rows are kept in packs of some thousand, each matrix as one binary value, so a pass costs
  its products and hardly anything else. Products in single precision tell which distances
  may count; those are taken by differences of the spectra as given. Rows go by their place in
  the order of ids, so ties go to the smaller id.

Tables of up to ``block`` rows, which the driver would hold anyway, are split by one task,
and so are groups. Larger groups take the way above, one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataError
from ..functions.columns import doubles
from ..functions.kernels import choose, farthest, kennard_stone, nearest_squares, test_rows
from ..shared import Tables
from .matrix import with_position

BLOCK = 4096
#: Rows of a group that one task splits.
GROUP_ROWS = 20_000


def _in_tasks(keyed: DataFrame, test_size: float) -> DataFrame:
    """(_g, sample_id, partition, ord) with each group computed by one task."""

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sample_id", kind="stable")
        ids = pdf["sample_id"].to_numpy()
        n_test = test_rows(len(ids), test_size)
        order = kennard_stone(np.stack(pdf["x"].to_numpy()), len(ids) - n_test)
        rest = np.setdiff1d(np.arange(len(ids)), order)
        return pd.DataFrame(
            {
                "_g": pdf["_g"].iloc[0],
                "sample_id": np.r_[ids[order], ids[rest]],
                "partition": ["train"] * len(order) + ["test"] * len(rest),
                "ord": np.r_[np.arange(len(order)), np.arange(len(rest))].astype(np.int32),
            }
        )

    kind = keyed.schema["_g"].dataType.simpleString()
    ident = keyed.schema["sample_id"].dataType.simpleString()
    return keyed.groupBy("_g").applyInPandas(split, f"_g {kind}, sample_id {ident}, partition string, ord int")


def _matrix(x: pa.Array, width: int) -> np.ndarray:
    values = x.flatten().to_numpy(zero_copy_only=False)
    if x.null_count or len(values) != len(x) * width:
        raise ValueError(f"spectra must all have {width} values")
    return values.reshape(-1, width)


def _centre(rows: DataFrame, width: int) -> np.ndarray:
    """The mean spectrum, which only conditions the products: any point near it would do."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width), 0
        for batch in batches:
            total, n = total + _matrix(batch.column(0), width).sum(0), n + batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([[*total, float(n)]], pa.list_(pa.float64()))], ["m"])

    sums = rows.select("x").mapInArrow(partial, "m array<double>").select(F.posexplode("m").alias("j", "v"))
    found = {r.j: r.v for r in sums.groupBy("j").agg(F.sum("v").alias("v")).collect()}  # a row a column
    return np.array([found[j] for j in range(width)]) / found[width]


#: Rows of the farthest-pair search that meet all others in one pass: so many blocks.
_HELD = 8
#: Values of a pack's matrix, and of the matrices that the driver holds, at most.
_PACK, _DRIVER = 1 << 18, 1 << 22
_PACKS = "key long, outer double, place binary, x binary"
_LEFT = "place binary, x binary, d array<double>"


def _packed(x: np.ndarray) -> bytes:
    """In single precision where that loses nothing."""
    single = x.astype(np.float32)
    return (single if np.array_equal(single, x) else np.ascontiguousarray(x, float)).tobytes()


def _unpacked(place: pa.Scalar, x: pa.Scalar, width: int) -> tuple[np.ndarray, np.ndarray]:
    places, raw = np.frombuffer(place.as_buffer(), np.int64), x.as_buffer()
    kind = np.float32 if raw.size == len(places) * width * 4 else np.float64
    return places, np.frombuffer(raw, kind).reshape(-1, width).astype(float)


def _held(packs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and spectra of a bounded number of packs."""
    got = packs.select("place", "x").toArrow()
    parts = [_unpacked(p, x, width) for p, x in zip(got["place"], got["x"], strict=True)]
    return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])


def _pack(numbered: DataFrame, width: int, centre: np.ndarray, size: int) -> DataFrame:
    """Packs of up to ``size`` rows by falling distance from the centre, of (place, x, inward)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, rows = np.zeros(0, np.int64), np.zeros((0, width))

        def out(places: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            outer = float(np.sqrt(((x - centre) ** 2).sum(1).max()))
            return pa.RecordBatch.from_pydict({"key": [int(places[0])], "outer": [outer], "place": [places.tobytes()], "x": [_packed(x)]})

        for batch in batches:
            places = np.r_[places, batch.column(0).to_numpy()]
            rows = np.vstack([rows, _matrix(batch.column(1), width)])
            while len(places) >= size:
                yield out(places[:size], rows[:size])
                places, rows = places[size:], rows[size:]
        if len(places):
            yield out(places, rows)

    spark = numbered.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = numbered.repartitionByRange(parts, "inward", "place").sortWithinPartitions("inward", "place")
    return dealt.select("place", "x").mapInArrow(pack, _PACKS).repartition(parts)  # a pass that needs the inner ones only is no shorter by a few tasks


def _farthest_pair(packs: DataFrame, width: int, centre: np.ndarray, held_packs: int) -> list[int]:
    """Places of the two rows farthest apart, ascending; of equal pairs the one with the smallest places."""
    order = [(r.key, r.outer) for r in packs.select("key", "outer").orderBy(F.col("outer").desc(), "key").collect()]  # a row a pack
    best: tuple[float, int, int] | None = None
    for k in range(0, len(order), held_packs):
        reach, least = order[k][1], -1.0 if best is None else best[0]
        if (reach * 2 * (1 + 1e-9)) ** 2 < least:
            break
        keys = [key for key, _ in order[k : k + held_packs]]
        others, held = _held(packs.where(F.col("key").isin(keys)), width)

        def pair(batches: Iterator[pa.RecordBatch], others=others, held=held, least=least) -> Iterator[pa.RecordBatch]:
            top: tuple[float, int, int] | None = None
            for batch in batches:
                for place, x in zip(batch.column(0), batch.column(1), strict=True):
                    names, mine = _unpacked(place, x, width)
                    found = farthest(mine, names, held, others, centre, least if top is None else top[0])
                    if found and (top is None or (-found[0], *found[1:]) < (-top[0], *top[1:])):
                        top = found
            if top:
                yield pa.RecordBatch.from_pydict({"d": [top[0]], "a": [top[1]], "b": [top[2]]})

        # packs before these have met them already, packs too far in cannot reach the best pair
        later = (F.col("outer") < reach) | ((F.col("outer") == reach) & (F.col("key") >= order[k][0]))
        some = packs.where(later & (F.col("outer") >= max(least, 0.0) ** 0.5 - reach * (1 + 2e-9)))
        top = some.select("place", "x").mapInArrow(pair, "d double, a long, b long").orderBy(F.col("d").desc(), "a", "b").first()
        if top and (best is None or (-top.d, top.a, top.b) < (-best[0], *best[1:])):
            best = (top.d, top.a, top.b)
    return [best[1], best[2]]


def _lowered(given: DataFrame, width: int, centre: np.ndarray, gone: np.ndarray, chosen: np.ndarray) -> DataFrame:
    """The packs without the rows that are ``gone``, distances lowered by the spectra ``chosen``."""
    gone = np.sort(gone)

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                places, x = _unpacked(batch.column(0)[k], batch.column(1)[k], width)
                d = batch.column(2)[k].values.to_numpy(zero_copy_only=False)
                stay = gone[np.minimum(np.searchsorted(gone, places), len(gone) - 1)] != places
                if stay.any():
                    x = x[stay]
                    d = nearest_squares(x, chosen, d[stay], centre)
                    cells = [pa.array([places[stay].tobytes()], pa.binary()), pa.array([_packed(x)], pa.binary()), pa.array([d], pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(cells, ["place", "x", "d"])

    return given.mapInArrow(lower, _LEFT)


def _farthest_rows(left: DataFrame, width: int, floor: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, spectra and distances of the ``most`` farthest rows that are not nearer than ``floor``, the farthest first."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                d = batch.column(2)[k].values.to_numpy(zero_copy_only=False)
                if not (d >= floor).any():
                    continue
                places, x = _unpacked(batch.column(0)[k], batch.column(1)[k], width)
                at = np.lexsort((places, -d))[:most]
                at = at[d[at] >= floor]
                cells = [pa.array(places[at]), pa.array([_packed(r) for r in x[at]], pa.binary()), pa.array(d[at])]
                yield pa.RecordBatch.from_arrays(cells, ["place", "x", "d"])

    found = left.mapInArrow(top, "place long, x binary, d double").orderBy(F.col("d").desc(), "place").limit(most).toArrow()
    places, d = found["place"].to_numpy(), found["d"].to_numpy()
    if not len(places):
        return places, np.zeros((0, width)), d
    one = np.zeros(1, np.int64)
    spectra = [_unpacked(pa.scalar(one.tobytes(), pa.binary()), x, width)[1] for x in found["x"]]
    return places, np.concatenate(spectra), d


def _distributed(rows: DataFrame, n: int, test_size: float, block: int) -> DataFrame:
    """(sample_id, partition, ord) of one table (sample_id, x) of ``n`` rows."""
    spark, tables = rows.sparkSession, Tables(rows.sparkSession, "maximin")
    width = rows.select(F.size("x").alias("w")).first().w
    n_train = n - test_rows(n, test_size)
    centre = _centre(rows, width)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inward = -np.sqrt(((_matrix(batch.column(1), width) - centre) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inward)], ["sample_id", "x", "inward"])

    ident = rows.schema["sample_id"].dataType.simpleString()
    placed = with_position(rows.select("sample_id", "x").mapInArrow(measured, f"sample_id {ident}, x array<double>, inward double"), name="place")
    numbered = tables.save(placed, "numbered")
    size = max(1, min(block, _PACK // max(1, width)))
    packs = tables.save(_pack(numbered, width, centre, size), "packs")
    names = numbered.select("place", "sample_id")
    places = np.array(_farthest_pair(packs, width, centre, _HELD), np.int64)
    ends = {r.place: r.x for r in numbered.where(F.col("place").isin(places.tolist())).select("place", "x").collect()}
    x = np.array([ends[int(p)] for p in places])[:n_train]
    places = places[:n_train]

    most = max(1, min(2 * block, _DRIVER // max(1, width)))
    chosen, done, passes = [], 0, 0
    path = f"{tables.root}/chosen"

    def keep() -> None:
        ords = np.concatenate(chosen)
        first = done - len(ords)
        cells = pa.table({"place": ords, "ord": np.arange(first, done, dtype=np.int32)})
        spark.createDataFrame(cells).write.mode("append").parquet(path)
        chosen.clear()

    left = packs.select("place", "x", F.array_repeat(F.lit(float("inf")), (F.octet_length("place") / 8).cast("int")).alias("d"))
    while True:
        chosen.append(places)
        done, passes = done + len(places), passes + 1
        if done >= n_train:
            break
        if sum(map(len, chosen)) >= 16 * most:
            keep()
        left = tables.save(_lowered(left, width, centre, places, x), f"left{passes % 2}")
        rest = n - done
        floor = 0.0
        if rest > 2 * most:
            share = 1 - 1.25 * most / rest
            floor = left.select(F.explode("d").alias("d")).agg(F.percentile_approx("d", share, 10_000)).first()[0]
        found, x, d = _farthest_rows(left, width, floor, most + 1)
        if len(found) <= most < rest:  # the estimate was too high
            found, x, d = _farthest_rows(left, width, 0.0, most + 1)
        beaten = None
        if len(found) > most:
            last = (-d[most], found[most])
            found, x, d = found[:most], x[:most], d[:most]
            order = np.argsort(found)
            beaten = lambda near, at, last=last, own=found[order]: (-near, own[at]) > last
        order = np.argsort(found)
        found, x, d = found[order], x[order], d[order]
        picked = choose(x, d, n_train - done, beaten, tabled=most)
        places, x = found[picked], x[picked]
    keep()
    last = np.sort(places)

    def rest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0):
                own = np.frombuffer(place.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.setdiff1d(own, last))], ["place"])

    tests = tables.save(left.select("place").mapInArrow(rest_of, "place long"), "tests")
    tests = with_position(tests, order="place", name="ord").select("place", F.lit("test").alias("partition"), F.col("ord").cast("int"))
    trains = spark.read.schema("place long, ord int").parquet(path).select("place", F.lit("train").alias("partition"), "ord")
    return names.join(trains.unionByName(tests), "place").select("sample_id", "partition", "ord")


def kennard_stone_split(
    df: DataFrame,
    test_size: float = 0.25,
    *,
    group: str | None = None,
    key: str = "sample_id",
    spectrum: str = "spectrum",
    max_group: int | None = None,
    block: int = BLOCK,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """([group,] sample_id, partition, ord) of a Kennard-Stone split on the raw spectra.

    Euclidean distance, ties to the smaller id; ``ord`` is the order of selection for
    train and of ids for test. Ids must be unique and not null. Each group is split by
    itself: groups of up to ``group_rows`` rows side by side, larger ones pass by pass.
    Where ``max_group`` is given, a group with more rows is refused before any is computed.
    """
    keyed = df.select(
        (F.col(group) if group else F.lit(0)).alias("_g"), F.col(key).alias("sample_id"), doubles(F.col(spectrum)).alias("x")
    )
    limit = group_rows if group else block
    if max_group is not None:
        largest = keyed.groupBy("_g").count().agg(F.max("count")).first()[0] or 0
        if largest > max_group:
            raise DataError(f"a group of {largest} rows; this split takes at most {max_group}")
    # groups beyond the limit: fewer than rows / limit
    large = {r._g: r.n for r in keyed.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).collect()}
    small = keyed
    for g in large:
        small = small.where(~F.col("_g").eqNullSafe(F.lit(g)))
    out = None if large and not group else _in_tasks(small, test_size)
    for g, n in large.items():
        one = keyed.where(F.col("_g").eqNullSafe(F.lit(g))).select("sample_id", "x")
        part = _distributed(one, n, test_size, block).select(F.lit(g).cast(keyed.schema["_g"].dataType).alias("_g"), "sample_id", "partition", "ord")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("_g", group) if group else out.drop("_g")


def identity_split(df: DataFrame, *, key: str = "sample_id") -> DataFrame:
    """Every row is both train and test."""
    return df.select(F.col(key).alias("sample_id"), F.explode(F.array(F.lit("train"), F.lit("test"))).alias("partition"))


def mask_split(df: DataFrame, is_test: Column, *, key: str = "sample_id") -> DataFrame:
    """A split from a boolean test mask; null counts as train."""
    return df.select(F.col(key).alias("sample_id"), F.when(F.coalesce(is_test, F.lit(False)), "test").otherwise("train").alias("partition"))
