"""Ordered scans (running sum, previous row, carried value) for keys of any size.

A plain window puts every row of a key into one task, so a key that holds a
third of a log stops the job. Here the rows of keys above ``slice_rows`` are cut into
slices of about that many rows, along the key and the scan order, by Spark's range
partitioning: the number of slices grows with the rows, equal positions are split as well, and no
table of cut points is made. Each slice is scanned on its own and completed with what earlier
slices of the key carry over. That is one row per slice, folded in two levels: groups of
``GROUP`` slices first, then the groups. Nothing is broadcast by hand. Without large keys the
scan is an ordinary window: one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.session import materialized

SLICE_ROWS = 1_000_000
GROUP = 1024
# Hash buckets that are counted before keys are.
BUCKETS = 8192


def large_keys(df: DataFrame, keys: Sequence[str], slice_rows: int) -> DataFrame | None:
    """Keys with more than ``slice_rows`` rows and those ``_rows``; None where there are none.

    No key has more rows than its hash bucket, so only keys of buckets above the limit are
    counted one by one. The counts of the buckets do not grow with the number of keys.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    counts = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    full = [r[0] for r in counts.where(F.col("_rows") > slice_rows).select("_bucket").collect()]
    if not full:
        return None
    loads = df.where(bucket.isin(full)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return loads.where(F.col("_rows") > slice_rows)


def sliced_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_rows: int = SLICE_ROWS,
    loads: DataFrame | None = None,
) -> DataFrame:
    """Add ``_slice`` (0 for keys of up to ``slice_rows`` rows) and ``_large``.

    Slices of a key are numbered along ``order``; the result of a scan does not depend on
    where they are cut. ``loads`` (keys, ``_rows``) may give row counts per key, or
    estimates of them, where they are cheaper to get than by counting ``df``. Counting is a job of its own, and
    sliced rows are written to the shared folder, as range partitioning cuts anew whenever it is run again.
    """
    slice_rows = max(1, slice_rows)
    large = large_keys(df, keys, slice_rows) if loads is None else loads.where(F.col("_rows") > slice_rows)
    rows = None if large is None else large.agg(F.sum("_rows")).first()[0]
    if not rows:
        return df.select("*", F.lit(False).alias("_large"), F.lit(0).alias("_slice"))
    marked = df.join(large.select(*keys, F.lit(True).alias("_large")), list(keys), "left")
    marked = marked.select(*df.columns, F.coalesce("_large", F.lit(False)).alias("_large"))
    ranged = marked.where("_large").repartitionByRange(math.ceil(rows / slice_rows), *keys, *order)
    cut = materialized(ranged.withColumn("_slice", F.spark_partition_id()))
    return marked.where("not _large").withColumn("_slice", F.lit(0)).union(cut)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    carried: Mapping[str, Column] | None = None,
    slice_rows: int = SLICE_ROWS,
    loads: DataFrame | None = None,
) -> DataFrame:
    """Running results per key along ``order``, which must be a total order.

    ``sums``      running sum up to and including the row
    ``previous``  value of the row before, null on the first row of the key
    ``carried``   last non-null value up to and including the row
    """
    sliced = sliced_keys(df, keys, order, slice_rows, loads)
    return scan_slices(
        sliced, keys, order, sums=sums, previous=previous, carried=carried
    ).drop("_large", "_slice")


def scan_slices(
    sliced: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    carried: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``scan`` over rows that already carry ``_large`` and ``_slice``, which are kept.

    Several scans along one order can follow each other without a new shuffle.
    """
    sums, previous, carried = dict(sums or {}), dict(previous or {}), dict(carried or {})
    columns = sliced.columns
    inputs = {**sums, **previous, **carried}
    sliced = sliced.select("*", *[value.alias(f"_in_{name}") for name, value in inputs.items()])

    place = [*keys, "_slice"]
    ordered = Window.partitionBy(*place).orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.select(
        "*",
        F.row_number().over(ordered).alias("_nth"),
        *[F.sum(f"_in_{n}").over(so_far).alias(f"_at_{n}") for n in sums],
        *[F.lag(f"_in_{n}").over(ordered).alias(f"_at_{n}") for n in previous],
        *[F.last(f"_in_{n}", ignorenulls=True).over(so_far).alias(f"_at_{n}") for n in carried],
    )

    at = F.struct(*order)
    ends = sliced.where("_large").groupBy(*place).agg(
        *[F.sum(f"_in_{n}").alias(f"_end_{n}") for n in sums],
        *[F.max_by(F.struct(f"_in_{n}"), at).alias(f"_end_{n}") for n in previous],
        *[
            F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), at)).alias(f"_end_{n}")
            for n in carried
        ],
    )
    brought = _brought(ends, keys, sums, previous, carried)
    return local.join(brought, place, "left").select(
        *[c for c in columns if c not in inputs],
        *[
            (F.col(f"_at_{n}") + F.coalesce(F.col(f"_from_{n}"), F.lit(0))).alias(n) for n in sums
        ],
        *[
            F.when(F.col("_nth") == 1, F.col(f"_from_{n}")[f"_in_{n}"])
            .otherwise(F.col(f"_at_{n}"))
            .alias(n)
            for n in previous
        ],
        *[F.coalesce(f"_at_{n}", f"_from_{n}").alias(n) for n in carried],
    )


def _before(
    frame: DataFrame, keys: Sequence[str], place: str, sums, previous, carried, name: str
) -> list[Column]:
    """What the rows of ``keys`` before ``place`` carry over, from columns ``_end_*``."""
    along = Window.partitionBy(*keys).orderBy(place)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return [
        *[F.sum(f"_end_{n}").over(earlier).alias(f"{name}{n}") for n in sums],
        *[F.lag(f"_end_{n}").over(along).alias(f"{name}{n}") for n in previous],
        *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"{name}{n}") for n in carried],
    ]


def _brought(ends: DataFrame, keys: Sequence[str], sums, previous, carried) -> DataFrame:
    """keys, ``_slice`` and, as ``_from_*``, what all earlier slices of the key carry over."""
    group = (F.col("_slice") / GROUP).cast("int").alias("_group")
    inside = ends.select("*", group)
    groups = inside.groupBy(*keys, "_group").agg(
        *[F.sum(f"_end_{n}").alias(f"_end_{n}") for n in sums],
        *[F.max_by(f"_end_{n}", "_slice").alias(f"_end_{n}") for n in previous],
        *[
            F.max_by(f"_end_{n}", F.when(F.col(f"_end_{n}").isNotNull(), F.col("_slice"))).alias(
                f"_end_{n}"
            )
            for n in carried
        ],
    )
    shared = (keys, "_group", sums, previous, carried, "_group_")
    outer = groups.select(*keys, "_group", *_before(groups, *shared))
    within = ([*keys, "_group"], "_slice", sums, previous, carried, "_inner_")
    inner = inside.select(*keys, "_group", "_slice", *_before(inside, *within))
    return inner.join(outer, [*keys, "_group"]).select(
        *keys,
        "_slice",
        *[
            (F.coalesce(f"_inner_{n}", F.lit(0)) + F.coalesce(f"_group_{n}", F.lit(0))).alias(
                f"_from_{n}"
            )
            for n in sums
        ],
        *[F.coalesce(f"_inner_{n}", f"_group_{n}").alias(f"_from_{n}") for n in [*previous, *carried]],
    )
