"""Ordered per-key computations that survive a hot key.

A plain window over one key sorts all its rows in one task.  Here the order axis is first cut into
slices of about equal row count (quantiles of the leading order column), so no (slice, key) group
can hold more than one slice of the table.  Each group is solved by itself; one summary row per
group carries the result into the next slice.  A key has at most as many summary rows as there are
slices, so the window over them is small whatever the key holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t


MOST_SLICES, QUANTILE_ERROR = 2_000, 1e-4


def _axis(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (t.TimestampType, t.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def cut_points(df: DataFrame, column: str, slices: int | None = None) -> list[float]:
    """Quantiles that cut the order axis into slices of about equal row count.

    One approximate-quantile pass over one column; a few numbers come back.  The error is fixed, so
    the sketches that tasks merge have one size whatever the cluster's; slices are at most MOST_SLICES.
    """
    parts = min(slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_SLICES)
    if parts <= 1:
        return []
    axis = df.select(_axis(df, column).alias("axis"))
    probabilities = [i / parts for i in range(1, parts)]
    return sorted(set(axis.approxQuantile("axis", probabilities, QUANTILE_ERROR)))


def sliced(df: DataFrame, column: str, cuts: Sequence[float]) -> DataFrame:
    """Add ``__seg``: the slice of the order axis a row falls into.

    The cut points are fixed in the plan, so a recomputed task assigns the same slices.
    """
    if not cuts:
        return df.withColumn("__seg", F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(
        splits=splits, inputCol="__axis", outputCol="__seg", handleInvalid="keep"
    ).transform(df.withColumn("__axis", _axis(df, column)))
    return bucketed.drop("__axis")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    add: Column,
    reset: Column,
    name: str,
    initial: Column | None = None,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Sum of ``add`` since the last row (itself included) where ``reset`` holds.

    A reset row starts over with its own ``add``.  ``initial`` is what a key starts with before any
    reset.  ``order`` must be unique within a key; its first column is numeric or a timestamp.
    ``cuts`` are the cut points of that column, when they are known already.
    """
    base = sliced(df, order[0], cut_points(df, order[0]) if cuts is None else cuts).select(
        "*",
        add.cast("long").alias("__add"),
        F.coalesce(reset, F.lit(False)).alias("__reset"),
        (initial if initial is not None else F.lit(0)).cast("long").alias("__init"),
    )
    group = ["__seg", *keys]
    upto = (Window.unboundedPreceding, Window.currentRow)
    local = Window.partitionBy(*group).orderBy(*order).rowsBetween(*upto)
    islands = base.withColumn("__island", F.sum(F.col("__reset").cast("long")).over(local))
    within = Window.partitionBy(*group, "__island").orderBy(*order).rowsBetween(*upto)
    running = islands.withColumn("__run", F.sum("__add").over(within))

    # What a group leaves behind: the total after its last row, and whether it saw a reset.
    at = F.struct(*order)
    summary = running.groupBy(*group).agg(
        F.max_by("__run", at).alias("__tail"),
        F.max("__island").alias("__resets"),
        F.min("__init").alias("__init"),
    )
    by_slice = Window.partitionBy(*keys).orderBy("__seg")
    chained = summary.withColumn(
        "__chain", F.sum(F.when(F.col("__resets") > 0, 1).otherwise(0)).over(by_slice.rowsBetween(*upto))
    )
    chain = Window.partitionBy(*keys, "__chain").orderBy("__seg").rowsBetween(*upto)
    start = F.when(F.col("__chain") == 0, F.col("__init")).otherwise(F.lit(0))
    left = chained.withColumn("__left", F.sum("__tail").over(chain) + start)
    carried = left.select(
        *group, F.coalesce(F.lag("__left").over(by_slice), F.col("__init")).alias("__carry")
    )
    total = F.col("__run") + F.when(F.col("__island") == 0, F.col("__carry")).otherwise(F.lit(0))
    return running.join(carried, group).select(*df.columns, total.alias(name))


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """``value`` of the preceding row of the same key; NULL on the first row."""
    base = sliced(df, order[0], cut_points(df, order[0]) if cuts is None else cuts)
    group = ["__seg", *keys]
    local = Window.partitionBy(*group).orderBy(*order)
    lagged = base.select(
        "*",
        F.lag(value).over(local).alias("__prev"),
        (F.row_number().over(local) == 1).alias("__first"),
    )
    last = base.groupBy(*group).agg(F.max_by(F.col(value), F.struct(*order)).alias("__last"))
    carried = last.select(
        *group, F.lag("__last").over(Window.partitionBy(*keys).orderBy("__seg")).alias("__carry")
    )
    previous = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev"))
    return lagged.join(carried, group).select(*df.columns, previous.alias(name))


def first_per_key(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; pre-aggregated before the shuffle, no window."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(key.alias("__key"))
        .agg(F.min_by(payload, F.struct(*order)).alias("__row"))
        .select("__row.*")
    )


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.max_by(payload, F.struct(*order)).alias("__row")
    ).select("__row.*")
