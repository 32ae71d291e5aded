"""Exact interpolated quantiles from a histogram of integer values."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Values of one part differ by less than this, so a part has no more rows, and a group of
# 32-bit values no more parts.
PART_WIDTH = 1 << 16


def histogram_quantiles(
    histogram: DataFrame,
    group: str,
    value: str,
    frequency: str,
    quantiles: Mapping[str, float],
    *aggregates: Column,
) -> DataFrame:
    """Continuous quantiles per group, plus any further aggregates of the histogram.

    ``histogram`` has one row per group and distinct 32-bit value. Ranks are selected in two
    passes: the first adds up the frequencies of each part of the value range, which tells
    the parts that hold a wanted rank; the second ranks the values of those parts alone. So
    no task sees all values of a group, however many there are. A null value counts for the
    further aggregates only, and a group without values has null quantiles.
    """
    known = histogram.filter(F.col(value).isNotNull()).select(
        group,
        F.col(value).alias("_value"),
        F.col(frequency).alias("_counted"),
        F.floor(F.col(value) / PART_WIDTH).alias("_part"),
    )
    whole = Window.partitionBy("_group")
    sizes = known.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_held")).agg(
        F.sum("_counted").alias("_size")
    )
    placed = sizes.select(
        "*",
        (F.sum("_size").over(whole.orderBy("_held")) - F.col("_size")).alias("_before"),
        F.sum("_size").over(whole).alias("_total"),
    )
    positions = {
        name: F.lit(float(quantile)) * (F.col("_total") - 1) for name, quantile in quantiles.items()
    }
    in_part = [
        (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_size"))
        for position in positions.values()
        for rank in (F.floor(position), F.ceil(position))
    ]
    wanted = placed.filter(reduce(or_, in_part))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_held"))
    by_part = Window.partitionBy("_group", "_held").orderBy("_value")
    ranked = known.join(wanted, same).select(
        "_group",
        "_value",
        "_counted",
        "_total",
        (F.col("_before") + F.sum("_counted").over(by_part)).alias("_rank_end"),
    )

    def at(rank: Column) -> Column:
        holds = (rank < F.col("_rank_end")) & (rank >= F.col("_rank_end") - F.col("_counted"))
        return F.max(F.when(holds, F.col("_value"))).cast("double")

    results = []
    for name, position in positions.items():
        low, high = at(F.floor(position)), at(F.ceil(position))
        part = F.max(position - F.floor(position))
        results.append((low + (high - low) * part).alias(name))
    found = ranked.groupBy("_group").agg(*results)
    every = histogram.groupBy(group).agg(F.lit(1).alias("_one"), *aggregates).drop("_one")
    return every.join(found, F.col(group).eqNullSafe(F.col("_group")), "left").select(
        group, *positions, *every.columns[1:]
    )
