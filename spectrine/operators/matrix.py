"""Dataset assembly: the canonical table is (sample_id BIGINT, spectrum ARRAY<DOUBLE>, target DOUBLE)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import DataError
from ..functions.columns import all_finite, doubles, even_places, finite
from ..shared import Tables

SCHEMA = "sample_id long, spectrum array<double>, target double"


def from_rows(spark: SparkSession, x: Sequence[Sequence[float]], y: Sequence[float]) -> DataFrame:
    """In-memory source: nested rows and one target each."""
    if len(x) != len(y):
        raise DataError(f"{len(x)} rows and {len(y)} targets")
    data = [(i, [float(v) for v in row], float(t)) for i, (row, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, SCHEMA)


def reshape_flat(df: DataFrame, cols: int, *, flat: str = "flat", rows: int | None = None) -> DataFrame:
    """(…, row, spectrum) from row-major arrays of rows * cols values; other lengths fail."""
    n = F.size(flat)
    fits = (n > 0) & (F.pmod(n, F.lit(cols)) == 0) if rows is None else n == rows * cols
    checked = F.when(fits, F.col(flat)).otherwise(
        F.raise_error(F.format_string("a flat matrix of %d values does not fit %d columns", n, F.lit(cols)))
    )
    return (
        df.withColumn("_flat", doubles(checked))
        .select(
            *[c for c in df.columns if c != flat],
            "_flat",
            F.explode(F.sequence(F.lit(0), (F.size("_flat") / cols).cast("int") - 1)).alias("row"),
        )
        .withColumn("spectrum", F.slice("_flat", F.col("row") * cols + 1, cols))
        .drop("_flat")
    )


def assemble_wide(df: DataFrame, columns: Sequence[str], *, name: str = "spectrum") -> DataFrame:
    """One array from numeric columns, in the given order; the columns go."""
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in columns])).drop(*columns)


def assemble_long(
    df: DataFrame, key: str | Sequence[str], position: str, value: str, headers: Sequence, *, fill: float | None = 0.0, agg=F.sum
) -> DataFrame:
    """One array per key from (key, position, value) rows, one value per header; absent cells get ``fill``.

    A partial aggregation per (key, header) comes before the shuffle, so no cell list is collected.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cells = [
        F.coalesce(agg(F.when(F.col(position) == F.lit(h), F.col(value))).cast("double"), F.lit(fill).cast("double")).alias(f"_{i}")
        for i, h in enumerate(headers)
    ]
    wide = df.groupBy(*keys).agg(*cells)
    return wide.select(*keys, F.array(*[f"_{i}" for i in range(len(headers))]).alias("spectrum"))


def header_places(df: DataFrame, header: str) -> DataFrame:
    """(header, j): every header that occurs, numbered from 0 in order; nulls are no header. One pass over the rows."""
    tables = Tables(df.sparkSession, "headers")
    found = tables.save(df.where(F.col(header).isNotNull()).select(F.col(header).alias("header")).distinct(), "found")
    return tables.save(with_position(found, order="header", name="j").select("header", F.col("j").cast("int").alias("j")), "places")


def assemble_sparse(
    df: DataFrame, key: str | Sequence[str], header: str, value: str, *, places: DataFrame | None = None, fill: float = 0.0, agg=F.sum, dense: bool = True
) -> DataFrame:
    """(key…, spectrum) from (key, header, value) rows, for any number of headers.

    Where not ``dense``, (key…, size, indices, values) instead: the places and values of the cells that are there, by
    place, of ``size`` in all, the others being ``fill``. Rows then take memory and time by their cells, not by
    keys times headers.

    Headers are a table, by default those that occur, and never leave the executors. Cells are
    aggregated by (key, header) in the tasks and once more, meet their header's place,
    and only the cells that are there travel to their key: a key's list has at most one
    entry a header. A last step lays each list out as one array, a batch at a time, absent
    cells as ``fill``. Rows with a null header, or one that ``places`` does not name, give their key no
    cell; a key without cells is all ``fill``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    places = header_places(df, header) if places is None else places
    width = places.agg(F.coalesce(F.max("j") + 1, F.lit(0)).alias("n")).first().n
    names = [f"key{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(header).alias("header"), F.col(value).alias("value"))
    cells = rows.groupBy(*names, "header").agg(agg("value").cast("double").alias("v"))
    cells = cells.join(places.select("header", "j"), "header", "left")
    there = F.when(F.col("j").isNotNull() & F.col("v").isNotNull(), F.struct("j", "v"))
    lists = cells.groupBy(*names).agg(F.collect_list(there).alias("c"))
    if not dense:
        lists = lists.withColumn("c", F.array_sort("c")).toDF(*keys, "c")
        return lists.select(*keys, F.lit(width).cast("int").alias("size"), F.col("c.j").alias("indices"), F.col("c.v").alias("values"))

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, 4_000_000 // max(1, width))
        for batch in batches:
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                cells = part.column(len(names))
                flat, counts = cells.flatten(), np.diff(cells.offsets.to_numpy())
                out = np.full((part.num_rows, width), float(fill))
                out[np.repeat(np.arange(part.num_rows), counts), flat.field("j").to_numpy()] = flat.field("v").to_numpy()
                ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * width)
                arrays = [*part.columns[: len(names)], pa.ListArray.from_arrays(ends, pa.array(out.ravel()))]
                yield pa.RecordBatch.from_arrays(arrays, [*names, "spectrum"])

    kinds = ", ".join(f"{n} {lists.schema[n].dataType.simpleString()}" for n in names)
    return lists.mapInArrow(lay_out, f"{kinds}, spectrum array<double>").toDF(*keys, "spectrum")


def _shape(spectrum: str) -> list[Column]:
    size = F.when(F.col(spectrum).isNotNull(), F.size(spectrum))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.max(size).cast("long").alias("n_cols"),
        F.count_if(F.col(spectrum).isNull()).alias("n_null"),
        (F.coalesce(F.min(size) == F.max(size), F.lit(False)) & (F.coalesce(F.min(size), F.lit(0)) > 0) & (F.count_if(F.col(spectrum).isNull()) == 0)).alias("is_rectangular"),
    ]


def rectangular(df: DataFrame, *, spectrum: str = "spectrum") -> DataFrame:
    """One row: n_rows, n_cols, n_null, is_rectangular (positive, of equal length, no null array)."""
    return df.agg(*_shape(spectrum))


def require_rectangular(df: DataFrame, *, spectrum: str = "spectrum", target: str | None = None) -> tuple[int, int]:
    """(rows, columns), or :class:`DataError`; with ``target``, all values must be finite too. One pass."""
    shape = rectangular(df, spectrum=spectrum)
    if target:
        odd = F.count_if(~(all_finite(F.col(spectrum)) & finite(F.col(target)))).alias("n_odd")
        shape = df.select(spectrum, target).agg(*_shape(spectrum), odd)
    got = shape.first()
    if not got.is_rectangular:
        raise DataError(f"spectra are not rectangular: {got.n_rows} rows, {got.n_null} null, up to {got.n_cols} values")
    if target and got.n_odd:
        raise DataError(f"{got.n_odd} rows hold a null or a value that is not finite")
    return got.n_rows, got.n_cols


def finite_rows(df: DataFrame, *, spectrum: str = "spectrum", target: str | None = "target") -> DataFrame:
    """Rows whose spectrum and target are finite throughout."""
    keep = all_finite(F.col(spectrum))
    return df.where(keep & finite(F.col(target)) if target else keep)


def require_rows(df: DataFrame, at_least: int = 20) -> int:
    """The number of rows, or :class:`DataError` below ``at_least``. Reads no more than that many rows."""
    n = df.limit(at_least).count()
    if n < at_least:
        raise DataError(f"{n} rows; at least {at_least} are needed")
    return n


#: Values looked at for each bucket of positions.
_SAMPLED = 20


def bounds_of(df: DataFrame, order: str, parts: int) -> list:
    """At most ``parts`` - 1 different values that cut the values of ``order`` into parts of about one size, ascending.

    They are read off a bounded sample, chosen by hash, so the same rows give the same bounds.
    """
    sample = df.where(F.col(order).isNotNull()).select(F.col(order).alias("v")).orderBy(F.xxhash64("v")).limit(_SAMPLED * parts)
    values = [r.v for r in sample.distinct().orderBy("v").collect()]  # at most _SAMPLED * parts
    return sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else []


def bucket_of(value: Column, bounds: list) -> Column:
    """The number of ``bounds`` (ascending) below ``value``, by halving; nulls are in the first bucket."""

    def search(first: int, end: int) -> Column:
        if first == end:
            return F.lit(first)
        mid = (first + end) // 2
        return F.when(value <= F.lit(bounds[mid]), search(first, mid)).otherwise(search(mid + 1, end))

    return F.when(value.isNull(), 0).otherwise(search(0, len(bounds)))


def with_position(df: DataFrame, *, order: str = "sample_id", name: str = "position", parts: int | None = None) -> DataFrame:
    """0-based place of each row in the order of ``order``, nulls first; equal values in any order.

    Rows are dealt to buckets between fixed bounds, read off a bounded sample of the
    values; each bucket numbers its own rows and adds the counts of those before, so
    no single task sees all rows. The bounds are constants of the plan, so both
    readings of ``df`` agree on them.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = bucket_of(F.col(order), bounds_of(df, order, parts))
    taken = {c.lower() for c in (*df.columns, name)}
    b, n, start, at = (next(x for x in (f"{'_' * k}{c}" for k in range(1, 99)) if x not in taken) for c in ("bucket", "n", "start", "at"))
    counts = df.groupBy(bucket.alias(b)).agg(F.count(F.lit(1)).alias(n))  # one row per bucket
    before = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(b, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    within = Window.partitionBy(b).orderBy(order)
    return (
        df.withColumn(b, bucket)
        .withColumn(at, F.row_number().over(within) - 1)
        .join(F.broadcast(starts), b)
        .withColumn(name, (F.col(start) + F.col(at)).cast("long"))
        .drop(b, at, start)
    )


def even_sample(df: DataFrame, limit: int, *, order: str = "sample_id") -> DataFrame:
    """``limit`` evenly spaced rows in the order of ``order``; all rows if there are no more."""
    n = df.count()
    if limit >= n:
        return df
    places = even_places(n, limit)
    spark = df.sparkSession
    chosen = spark.range(1).select(F.explode(F.lit(places)).alias("position"))
    return with_position(df, order=order).join(F.broadcast(chosen), "position", "left_semi").drop("position")


def gather(df: DataFrame, chosen: DataFrame, *, key: str = "sample_id", strict: bool = True) -> DataFrame:
    """Rows named by ``chosen``; with ``strict``, a name without a row is an error."""
    if strict and (lost := chosen.join(df, key, "left_anti").limit(1).collect()):
        raise DataError(f"no row with {key} {lost[0][key]}")
    return df.join(chosen, key)


def label_partition(position: Column, *, every: int = 5) -> Column:
    """``test`` for each ``every``-th position, ``train`` for the rest."""
    return F.when(F.pmod(position, F.lit(every)) == 0, "test").otherwise("train")


def label_batch(position: Column, *, batches: int = 3) -> Column:
    return F.concat(F.lit("batch_"), F.pmod(position, F.lit(batches)).cast("string"))


def lossless(selected: DataFrame, source: DataFrame, *, key: str = "sample_id", spectrum: str = "spectrum") -> DataFrame:
    """One row: n_selected, n_missing, n_different values of ``selected`` against ``source``."""
    a = selected.select(F.col(key), F.col(spectrum).alias("_a"), F.lit(True).alias("_sel"))
    b = source.select(F.col(key), F.col(spectrum).alias("_b"), F.lit(True).alias("_src"))
    bad = F.size(F.filter(F.zip_with("_a", "_b", lambda x, y: ~x.eqNullSafe(y)), lambda d: d))
    return a.join(b, key, "left").agg(
        F.count(F.lit(1)).alias("n_selected"),
        F.count_if(F.col("_src").isNull()).alias("n_missing"),
        F.coalesce(F.sum(F.when(F.col("_src").isNotNull(), bad)), F.lit(0)).cast("long").alias("n_different"),
    )


def long_form(df: DataFrame, *, key: str = "sample_id", spectrum: str = "spectrum", places: int | None = 6) -> DataFrame:
    """(key, j, value): one row per cell, j from 1."""
    v = F.col("value") if places is None else F.round("value", places) + F.lit(0.0)
    return df.select(key, F.posexplode(spectrum).alias("j", "value")).select(key, (F.col("j") + 1).cast("long").alias("j"), v.alias("value"))
