"""Filling missing values from records of the same group (problem 2).

Observations are first reduced to one row per group and time, so a group as large as a
third of the input is carried by its number of distinct times, not of its rows. The
time-ordered filling runs over those rows; the missing rows then look up their time.

Defined results: rows whose group key holds a null are never filled and give none; a null
time is no time, such rows neither observe nor get a value; conflicting observations of one
group and time resolve to the smallest text (numerics: to their mean); repeated rows are
filled each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.text import is_missing


def _keyed(df: DataFrame, keys: list[str], time: str, value: Column, *ids: str) -> DataFrame:
    ok = F.col(time).isNotNull()
    for k in keys:
        ok &= F.col(k).isNotNull()
    return df.where(ok).select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(time).cast("date").alias("t"), value.alias("v"), *[F.col(c).alias(f"id{i}") for i, c in enumerate(ids)]
    )


def fill_category(df: DataFrame, row_id: str, keys: list[str], time: str, col: str, max_gap_days: int | None = None) -> DataFrame:
    """(row_id, val, method, gap_days) of rows whose ``col`` is missing and can be filled.

    The value of the same time comes first (``same``), then the latest earlier one
    (``carried``), then the earliest later one (``back``); none beyond ``max_gap_days``.
    """
    d = _keyed(df, keys, time, F.when(~is_missing(F.col(col)), F.col(col)), row_id)
    by = [f"k{i}" for i in range(len(keys))]
    times = d.groupBy(*by, "t").agg(F.min("v").alias("v"), F.max(F.col("v").isNull()).alias("wanted"))
    w = Window.partitionBy(*by).orderBy("t")
    seen = F.when(F.col("v").isNotNull(), F.struct("t", "v"))
    filled = (
        times.withColumn("seen", seen)
        .withColumn("before", F.last("seen", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("after", F.first("seen", True).over(w.rowsBetween(1, Window.unboundedFollowing)))
        .where("wanted")
    )
    gap_b, gap_a = F.datediff("t", "before.t"), F.datediff("after.t", "t")
    limit = F.lit(max_gap_days if max_gap_days is not None else 2**31 - 1)
    pick = (
        F.when(F.col("v").isNotNull(), F.struct(F.col("v").alias("val"), F.lit("same").alias("method"), F.lit(0).alias("gap_days")))
        .when(gap_b <= limit, F.struct(F.col("before.v").alias("val"), F.lit("carried").alias("method"), gap_b.alias("gap_days")))
        .when(gap_a <= limit, F.struct(F.col("after.v").alias("val"), F.lit("back").alias("method"), gap_a.alias("gap_days")))
    )
    filled = filled.select(*by, "t", pick.alias("p")).where(F.col("p").isNotNull())
    return (
        d.where(F.col("v").isNull())
        .join(filled, [*by, "t"])
        .select(F.col("id0").alias("row_id"), "p.val", "p.method", "p.gap_days")
    )


def fill_numeric(df: DataFrame, row_id: str, keys: list[str], time: str, col: str, max_gap_days: int | None = None) -> DataFrame:
    """(row_id, val, method, gap_days) of rows whose number is missing and can be filled.

    Between observed neighbours the value is interpolated linearly in time
    (``interpolated``); ``same`` is the mean stated at that time; beyond the first or last
    observation the nearest is kept (``nearest``). NaN is missing.
    """
    d = _keyed(df, keys, time, F.when(~F.isnan(F.col(col)), F.col(col).cast("double")), row_id)
    by = [f"k{i}" for i in range(len(keys))]
    times = d.groupBy(*by, "t").agg(F.avg("v").alias("v"), F.max(F.col("v").isNull()).alias("wanted"))
    w = Window.partitionBy(*by).orderBy("t")
    seen = F.when(F.col("v").isNotNull(), F.struct("t", "v"))
    filled = (
        times.withColumn("seen", seen)
        .withColumn("b", F.last("seen", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("a", F.first("seen", True).over(w.rowsBetween(1, Window.unboundedFollowing)))
        .where("wanted")
    )
    gb, ga = F.datediff("t", "b.t"), F.datediff("a.t", "t")
    near = F.least(gb, ga)
    limit = F.lit(max_gap_days if max_gap_days is not None else 2**31 - 1)
    pick = (
        F.when(F.col("v").isNotNull(), F.struct(F.col("v").alias("val"), F.lit("same").alias("method"), F.lit(0).alias("gap_days")))
        .when(
            F.col("a").isNotNull() & F.col("b").isNotNull() & (near <= limit),
            F.struct((F.col("b.v") + (F.col("a.v") - F.col("b.v")) * gb / (gb + ga)).alias("val"), F.lit("interpolated").alias("method"), near.alias("gap_days")),
        )
        .when(near <= limit, F.struct(F.coalesce("b.v", "a.v").alias("val"), F.lit("nearest").alias("method"), near.alias("gap_days")))
    )
    filled = filled.select(*by, "t", pick.alias("p")).where(F.col("p").isNotNull())
    return (
        d.where(F.col("v").isNull())
        .join(filled, [*by, "t"])
        .select(F.col("id0").alias("row_id"), "p.val", "p.method", "p.gap_days")
    )
