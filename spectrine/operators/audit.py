"""Comparing runs, predictions and schedules by sample identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from ..errors import DataError
from .matrix import bounds_of, bucket_of, with_position


def lookup(df: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """Left lookup of ``value`` by ``key``; ``gap`` says what is missing, else null."""
    return df.join(table.select(key, value).withColumn("_known", F.lit(True)), key, "left").withColumn(
        "gap", F.when(F.col("_known").isNull(), F.concat(F.lit(f"no {value} for "), F.col(key).cast("string")))
    ).drop("_known")


def compare_by_id(a: DataFrame, b: DataFrame, *, key: str = "sample_id", values: Sequence[str] = ("target", "prediction")) -> DataFrame:
    """One row: n_common, n_only_a, n_only_b, same_ids and, per value, max_abs_<value> over common ids (0 if none)."""
    left = a.select(F.col(key), *[F.col(v).alias(f"_a_{v}") for v in values], F.lit(True).alias("_a"))
    right = b.select(F.col(key), *[F.col(v).alias(f"_b_{v}") for v in values], F.lit(True).alias("_b"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return left.join(right, key, "full_outer").agg(
        F.count_if(both).alias("n_common"),
        F.count_if(F.col("_b").isNull()).alias("n_only_a"),
        F.count_if(F.col("_a").isNull()).alias("n_only_b"),
        (F.count_if(~both) == 0).alias("same_ids"),
        *[F.coalesce(F.max(F.abs(F.col(f"_a_{v}") - F.col(f"_b_{v}"))), F.lit(0.0)).alias(f"max_abs_{v}") for v in values],
    )


def id_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side) with side ``common``, ``only_a`` or ``only_b``, for each distinct id."""
    left, right = (d.select(key).distinct().withColumn(m, F.lit(True)) for d, m in ((a, "_a"), (b, "_b")))
    side = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").otherwise("common")
    return left.join(right, key, "full_outer").select(key, side.alias("side"))


def explode_vectors(df: DataFrame, arrays: dict[str, str], *, keep: Sequence[str] = (), position: str = "pos") -> DataFrame:
    """One row per element of parallel arrays {column: new name}; unequal lengths fail."""
    names = list(arrays)
    same = F.lit(True)
    for n in names[1:]:
        same = same & (F.size(n) == F.size(names[0]))
    zipped = F.arrays_zip(*[F.col(n).alias(arrays[n]) for n in names])
    checked = F.when(same, zipped).otherwise(F.raise_error(F.lit("parallel arrays differ in length")))
    return df.select(*keep, F.posexplode(checked).alias(position, "_z")).select(*keep, position, *[F.col("_z")[arrays[n]].alias(arrays[n]) for n in names])


def last_write_wins(df: DataFrame, key: str | Sequence[str], order: Column | str) -> DataFrame:
    """The row of greatest ``order`` for each key."""
    keys = [key] if isinstance(key, str) else list(key)
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def unique_match(df: DataFrame, condition: Column) -> DataFrame:
    """The only row that satisfies ``condition``; none or several is an error."""
    found = df.where(condition).limit(2)
    n = found.count()
    if n != 1:
        raise DataError(f"{'no' if n == 0 else 'more than one'} row matches")
    return found


def unique_per_group(df: DataFrame, keys: Sequence[str], condition: Column, value: str) -> DataFrame:
    """(keys, n_matches, value): the value where exactly one row of a group matches, else null."""
    return df.groupBy(*keys).agg(
        F.count_if(condition).alias("n_matches"), F.min(F.when(condition, F.col(value))).alias("_v")
    ).select(*keys, "n_matches", F.when(F.col("n_matches") == 1, F.col("_v")).alias(value))


def distinct_sorted(df: DataFrame, *columns: str) -> DataFrame:
    """One row with the sorted distinct values of each column. Meant for columns of few values."""
    return df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in columns])


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def uniform(df: DataFrame | GroupedData, *columns: str) -> DataFrame:
    """One row, or one a group: for each column, whether all rows hold one and the same value."""
    return df.agg(*[(F.min(c).eqNullSafe(F.max(c)) & (F.count(c) == F.count(F.lit(1)))).alias(f"one_{c}") for c in columns])


def fold_lookup(df: DataFrame, folds: DataFrame, *, fold: str = "fold_id", ids: str = "sample_ids") -> DataFrame:
    """Left lookup of a fold's ids by a textual fold id; text that is no whole number gets an empty list."""
    table = folds.select(F.col(fold).cast("long").alias("_fold"), F.col(ids).alias("expected_ids"))
    return df.join(table, F.expr(f"try_cast({fold} AS BIGINT)") == F.col("_fold"), "left").drop("_fold").withColumn(
        "expected_ids", F.coalesce("expected_ids", F.array().cast("array<bigint>"))
    )


def alignment(df: DataFrame, *, observed: str = "sample_indices", expected: str = "expected_ids") -> DataFrame:
    """Adds same_order, same_set, n_missing, n_extra and ids_sha256 to each row of two id lists."""
    return df.select(
        "*",
        (F.col(observed) == F.col(expected)).alias("same_order"),
        (F.array_sort(observed) == F.array_sort(expected)).alias("same_set"),
        F.size(F.array_except(expected, observed)).cast("long").alias("n_missing"),
        F.size(F.array_except(observed, expected)).cast("long").alias("n_extra"),
        F.sha2(F.concat_ws(",", F.col(observed).cast("array<string>")), 256).alias("ids_sha256"),
    )


def best_task(df: DataFrame, *, metric: str, ident: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, best_id, best_metric): the least metric, first in ``order`` on ties; nulls and NaN never win."""
    valid = df.where(F.col(metric).isNotNull() & ~F.isnan(metric))
    return valid.groupBy(*keys).agg(
        F.min_by(ident, F.struct(metric, order)).alias("best_id"), F.min(metric).alias("best_metric")
    )


def recompute_aggregate(tasks: DataFrame, declared: DataFrame, *, tolerance: float = 1e-12) -> DataFrame:
    """Declared scheduler totals against those of ``tasks`` (id, pos, status, metric)."""
    done = F.col("status") == "succeeded"
    own = tasks.agg(
        F.count(F.lit(1)).alias("num_tasks"),
        F.count_if(done).alias("num_succeeded"),
        F.min_by("id", F.when(done, F.struct("metric", "pos"))).alias("best_task_id"),
        F.min(F.when(done, F.col("metric"))).alias("best_metric"),
    )
    said = declared.select(*[F.col(c).alias(f"declared_{c}") for c in own.columns])
    both = own.join(said, how="cross")  # one row on either side
    gap = F.abs(F.col("best_metric") - F.col("declared_best_metric"))
    return both.select(
        *own.columns,
        (F.col("num_tasks") == F.col("declared_num_tasks")).alias("tasks_agree"),
        (F.col("num_succeeded") == F.col("declared_num_succeeded")).alias("succeeded_agree"),
        F.col("best_task_id").eqNullSafe(F.col("declared_best_task_id")).alias("best_agrees"),
        F.coalesce(gap <= tolerance, F.col("best_metric").isNull() & F.col("declared_best_metric").isNull()).alias("metric_agrees"),
    )


def first_of(items: str, condition) -> Column:
    """The first element of an array of structs that satisfies ``condition``."""
    return F.get(F.filter(items, condition), F.lit(0))


def consistent(a: Column, b: Column, stated: Column, *, tolerance: float, slack: float = 1e-12) -> Column:
    """The stated difference is |a - b| and within tolerance."""
    return (F.abs(F.abs(a - b) - stated) <= slack) & (stated <= tolerance)


def compare_runs(a: DataFrame, b: DataFrame, *, tolerance: float = 1e-10) -> DataFrame:
    """Per variant: counts and greatest differences of two prediction tables, and whether they agree."""
    keys = ["variant_idx", "sample_id"]
    left, right = (d.select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in ("target", "prediction")], F.lit(True).alias(f"in_{s}")) for d, s in ((a, "a"), (b, "b")))
    gap = lambda c: F.coalesce(F.max(F.abs(F.col(f"{c}_a") - F.col(f"{c}_b"))), F.lit(0.0))
    return (
        left.join(right, keys, "full_outer")
        .groupBy("variant_idx")
        .agg(
            F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("n_common"),
            F.count_if(F.col("in_a").isNull() | F.col("in_b").isNull()).alias("n_unmatched"),
            gap("target").alias("max_abs_target"),
            gap("prediction").alias("max_abs_prediction"),
        )
        .withColumn("agrees", (F.col("n_unmatched") == 0) & (F.col("max_abs_target") <= tolerance) & (F.col("max_abs_prediction") <= tolerance))
    )


def pairwise(df: DataFrame, run: str, key: str, value: str) -> DataFrame:
    """(run_a, run_b, n_common, max_abs) for each pair of runs: rows meet on ``key``, so work is linear in keys."""
    a = df.select(F.col(run).alias("run_a"), F.col(key), F.col(value).alias("_x"))
    b = df.select(F.col(run).alias("run_b"), F.col(key), F.col(value).alias("_y"))
    return a.join(b, key).where("run_a < run_b").groupBy("run_a", "run_b").agg(
        F.count(F.lit(1)).alias("n_common"), F.max(F.abs(F.col("_x") - F.col("_y"))).alias("max_abs")
    )


def pairwise_slots(df: DataFrame, run: str, key: str, value: str) -> DataFrame:
    """As :func:`pairwise`, for one row a (run, key), with a single shuffle of the data.

    A key's values of all runs meet in one aggregate row with a slot a run, which tasks
    fill before the shuffle; pairs of slots then compare within the row, and only the
    results of pairs, of which there are as many as pairs of runs, are shuffled again.
    """
    runs = sorted(r[0] for r in df.where(F.col(run).isNotNull()).select(run).distinct().collect())  # a row a run
    if len(runs) < 2:
        return df.select(F.col(run).alias("run_a"), F.col(run).alias("run_b"), F.lit(0).cast("long").alias("n_common"), F.lit(0.0).alias("max_abs")).limit(0)
    there = lambda r: F.col(run) == F.lit(r)
    slots = [F.max(F.when(there(r), F.struct(F.lit(1).alias("in"), F.col(value).alias("v")))).alias(f"s{i}") for i, r in enumerate(runs)]
    rows = df.where(F.col(key).isNotNull()).groupBy(key).agg(*slots)
    pairs = [
        F.when(F.col(f"s{i}").isNotNull() & F.col(f"s{j}").isNotNull(), F.struct(
            F.lit(runs[i]).alias("run_a"), F.lit(runs[j]).alias("run_b"), F.abs(F.col(f"s{i}.v") - F.col(f"s{j}.v")).alias("gap")
        ))
        for i in range(len(runs)) for j in range(i + 1, len(runs))
    ]
    met = rows.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.*")
    return met.groupBy("run_a", "run_b").agg(F.count(F.lit(1)).alias("n_common"), F.max("gap").alias("max_abs"))


def _digests(df: DataFrame, key: str, values: Sequence[str], buckets: int, side: str) -> DataFrame:
    """(bucket, d): per bucket of keys, rows and two sums of row hashes that do not depend on order."""
    row = [F.col(key), *[F.col(v) for v in values]]
    sums = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(*row, F.lit(1))).alias("x"))
    return df.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")).agg(*sums).select("bucket", F.struct("n", "s", "x").alias(side))


def run_differences(
    a: DataFrame, b: DataFrame, *, key: str = "sample_id", values: Sequence[str] = ("target", "prediction"), buckets: int = 4096
) -> DataFrame:
    """(key, kind, max_abs) of the rows in which two tables with unique keys differ.

    ``kind`` is ``only_a``, ``only_b`` or ``changed``; ``max_abs`` is the largest difference of a
    changed row's values (null if one of them is null). Both tables are first reduced to a
    digest of 128 bits a bucket of keys. Only digests are shuffled; buckets whose
    digests agree are not looked at again, so nearly equal runs of any size cost two
    scans and a join of the rows of a few buckets.
    """
    spark = a.sparkSession
    both = _digests(a, key, values, buckets, "a").join(_digests(b, key, values, buckets, "b"), "bucket", "full_outer")
    differ = [r.bucket for r in both.where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket").collect()]  # at most ``buckets``
    kind = a.schema[key].dataType.simpleString()
    if not differ:
        return spark.createDataFrame([], f"`{key}` {kind}, kind string, max_abs double")
    mine = F.pmod(F.xxhash64(key), F.lit(buckets)).isin(differ)
    left, right = (
        d.where(mine).select(F.col(key).alias("k"), F.struct(*[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)]).alias(side))
        for d, side in ((a, "a"), (b, "b"))
    )
    met = left.join(right, "k", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    gaps = [F.abs(F.col(f"a.v{i}") - F.col(f"b.v{i}")) for i in range(len(values))]
    odd = [F.col(f"a.v{i}").isNull() != F.col(f"b.v{i}").isNull() for i in range(len(values))]
    any_odd = odd[0]
    for o in odd[1:]:
        any_odd = any_odd | o
    side = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").otherwise("changed")
    largest = F.array_max(F.array(*gaps))
    return met.select(F.col("k").alias(key), side.alias("kind"), F.when((side == "changed") & ~any_odd, largest).alias("max_abs"))


def difference_report(a: DataFrame, b: DataFrame, *, key: str = "sample_id", values: Sequence[str] = ("target", "prediction"), tolerance: float = 1e-10, listed: int = 20) -> DataFrame:
    """One row: n_only_a, n_only_b, n_changed, n_beyond the tolerance, max_abs, agrees, and the first ``listed`` ids of each kind."""
    found = run_differences(a, b, key=key, values=values)
    beyond = (F.col("kind") == "changed") & F.coalesce(F.col("max_abs") > tolerance, F.lit(True))
    order = F.row_number().over(Window.partitionBy("kind", F.pmod(F.xxhash64(key), F.lit(64))).orderBy(key))
    short = found.withColumn("beyond", beyond).withColumn("at", order)  # a kind's first ids are among the first of each part
    lists = [
        F.slice(F.sort_array(F.collect_list(F.when((F.col("kind") == k) & (F.col("at") <= listed), F.col(key)))), 1, listed).alias(f"ids_{k}")
        for k in ("only_a", "only_b", "changed")
    ]
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("only_a", "only_b", "changed")]
    out = short.agg(*counts, F.count_if("beyond").alias("n_beyond"), F.coalesce(F.max("max_abs"), F.lit(0.0)).alias("max_abs"), *lists)
    return out.withColumn("agrees", (F.col("n_only_a") == 0) & (F.col("n_only_b") == 0) & (F.col("n_beyond") == 0))


def case_maxima(df: DataFrame, *values: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_cases"), *[F.max(v).alias(f"max_{v}") for v in values])


def slice_coverage(df: DataFrame, *, keys: Sequence[str], start: str, stop: str, width: str) -> DataFrame:
    """Per key: whether the half-open slices begin at 0, end at ``width`` and neither overlap nor leave gaps.

    Expects few slices a key, as a dataset has few sources.
    """
    order = Window.partitionBy(*keys).orderBy(start, stop)
    following = df.withColumn("_next", F.lead(start).over(order))
    return following.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_slices"),
        (F.min(start) == 0).alias("starts_at_zero"),
        (F.max(stop) == F.max(width)).alias("ends_at_width"),
        (F.count_if(F.col("_next") < F.col(stop)) == 0).alias("no_overlap"),
        (F.count_if(F.col("_next") > F.col(stop)) == 0).alias("no_gap"),
    )


def interval_coverage(
    df: DataFrame, *, keys: Sequence[str], start: str, stop: str, width: str, parts: int | None = None
) -> DataFrame:
    """Per key: n_slices, starts_at_zero, ends_at_width, n_overlaps, n_gaps and the length covered, for any number of slices.

    A slice overlaps if it begins before an earlier one has ended, and leaves a gap if it
    begins after all earlier ones have; earlier means in order of start, then stop, so a
    slice nested in a long one hides nothing. Empty slices count like others.

    The end reached so far is a prefix maximum in two levels: slices are dealt to ranges
    of ``start``, the maximum of each (key, range) is handed on to the ranges after it, and each
    range scans its own slices from there. A key of millions of slices is scanned by
    as many tasks as there are ranges.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"key{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(start).alias("a"), F.col(stop).alias("b"), F.col(width).alias("w"))
    rows = rows.withColumn("range", bucket_of(F.col("a"), bounds_of(rows, "a", parts)))
    tops = rows.groupBy(*names, "range").agg(F.max("b").alias("top"))  # at most ``parts`` rows a key
    so_far = Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*[F.col(n).alias(f"t_{n}") for n in names], F.col("range").alias("t_range"), F.max("top").over(so_far).alias("reached"))
    meet = F.col("range") == F.col("t_range")
    for n in names:
        meet = meet & F.col(n).eqNullSafe(F.col(f"t_{n}"))
    within = Window.partitionBy(*names, "range").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    scanned = rows.join(tops, meet).withColumn("before", F.greatest(F.max("b").over(within), F.col("reached")))
    fresh = F.greatest(F.col("b") - F.greatest(F.col("a"), F.coalesce("before", "a")), F.lit(0))
    out = scanned.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n_slices"),
        (F.min("a") == 0).alias("starts_at_zero"),
        (F.max("b") == F.max("w")).alias("ends_at_width"),
        F.count_if(F.col("a") < F.col("before")).alias("n_overlaps"),
        F.count_if(F.col("a") > F.col("before")).alias("n_gaps"),
        F.sum(fresh).cast("long").alias("covered"),
    )
    return out.withColumnsRenamed(dict(zip(names, keys, strict=True)))


def source_id(position: Column, *names: str) -> Column:
    """The first non-empty of several names, else ``source_<position>``."""
    return F.coalesce(*[F.when(F.col(n) != "", F.col(n)) for n in names], F.concat(F.lit("source_"), position.cast("string")))


def slice_headers(headers: Column, start: Column, stop: Column) -> Column:
    """headers[start:stop]; null when the slice leaves the headers."""
    inside = (start >= 0) & (stop >= start) & (stop <= F.size(headers))
    return F.when(inside, F.slice(headers, start + 1, stop - start))


def fold_status(df: DataFrame, status: str, *, keys: Sequence[str] = ()) -> DataFrame:
    """The worst status: failed over blocked over passed."""
    rank = F.when(F.col(status) == "failed", 2).when(F.col(status) == "blocked", 1).otherwise(0)
    worst = F.max(rank)
    return df.groupBy(*keys).agg(F.when(worst == 2, "failed").when(worst == 1, "blocked").otherwise("passed").alias("status"))


def declared_gaps(**pairs: tuple[Column, Column]) -> Column:
    """Messages for each declared value that differs from what is observed."""
    return F.array_compact(
        F.array(
            *[
                F.when(~a.eqNullSafe(b), F.concat(F.lit(f"{name}: declared "), F.coalesce(a.cast("string"), F.lit("none")), F.lit(", observed "), F.coalesce(b.cast("string"), F.lit("none"))))
                for name, (a, b) in pairs.items()
            ]
        )
    )


def rights(df: DataFrame, *, denials: str = "denials", grants: str = "grants", expected: Sequence[str] = ("execute", "read")) -> DataFrame:
    """Adds has_denials and grants_exact to each row."""
    want = F.lit(list(expected))
    return df.select("*", (F.size(denials) > 0).alias("has_denials"), (F.sort_array(grants) == F.sort_array(want)).alias("grants_exact"))


def delta_maxima(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: greatest |rmse difference| over variants and greatest |prediction difference| over rows of two runs."""
    def with_rmse(d: DataFrame, s: str) -> DataFrame:
        own = d.groupBy("variant_idx").agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("target"), F.lit(2)))).alias(f"rmse_{s}"))
        return own

    per = compare_runs(a, b).join(with_rmse(a, "a"), "variant_idx").join(with_rmse(b, "b"), "variant_idx")
    return per.agg(
        F.count(F.lit(1)).alias("n_variants"),
        F.max(F.abs(F.col("rmse_a") - F.col("rmse_b"))).alias("max_abs_rmse"),
        F.max("max_abs_prediction").alias("max_abs_prediction"),
    )


def runtime_alignment(result: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: how many test positions a result has, how many resolve to a sample id, and whether counts of
    ids, predictions and targets are equal. ``result`` is (position, target, prediction), ``samples`` (position, sample_id)."""
    known = result.join(samples, "position", "left")
    return known.agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.count("sample_id").alias("n_ids"),
        F.count("prediction").alias("n_predictions"),
        F.count("target").alias("n_targets"),
    ).withColumn("aligned", (F.col("n_ids") == F.col("n_predictions")) & (F.col("n_ids") == F.col("n_targets")) & (F.col("n_ids") == F.col("n_positions")))


def case_threshold(df: DataFrame, case: str, *, at_least: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """Per ``keys``, or in one row: the number of distinct cases (nulls are none) and whether there are enough."""
    counted = df.groupBy(*keys).agg(F.count_distinct(case).alias("n_cases"))
    return counted.withColumn("enough", F.col("n_cases") >= at_least)


def hash_chain(df: DataFrame, hashes: Sequence[str]) -> DataFrame:
    """Adds ``chain_equal`` (all hashes are there and equal) and ``first_break`` (the first that is null or differs from the first)."""
    first = F.col(hashes[0])
    broken = [F.when(first.isNull(), hashes[0]), *[F.when(~F.col(h).eqNullSafe(first), h) for h in hashes[1:]]]
    return df.withColumn("first_break", F.coalesce(*broken)).withColumn("chain_equal", F.col("first_break").isNull())


def blocked_workers(df: DataFrame, status: str, *, expected: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """Per ``keys``, or in one row: how many workers are blocked and whether that is exactly ``expected``."""
    counted = df.groupBy(*keys).agg(F.count_if(F.col(status) == "blocked").alias("n_blocked"))
    return counted.withColumn("as_expected", F.col("n_blocked") == expected)


def order_match(a: DataFrame, b: DataFrame, *, order_a: str, order_b: str, key: str = "sample_id") -> DataFrame:
    """One row: n_common, n_out_of_place (common ids at another position) and same_order (equal ids at equal positions)."""
    left = with_position(a.select(key, F.col(order_a).alias("_o")), order="_o", name="_pa").select(key, "_pa")
    right = with_position(b.select(key, F.col(order_b).alias("_o")), order="_o", name="_pb").select(key, "_pb")
    common = F.col("_pa").isNotNull() & F.col("_pb").isNotNull()
    return left.join(right, key, "full_outer").agg(
        F.count_if(common).alias("n_common"),
        F.count_if(common & (F.col("_pa") != F.col("_pb"))).alias("n_out_of_place"),
        (F.count_if(~F.col("_pa").eqNullSafe(F.col("_pb"))) == 0).alias("same_order"),
    )
