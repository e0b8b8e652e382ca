"""Ordered carry of the last or next known value along time series of any length.

One series may hold a third of all rows, so a window over the whole series is not an option.
A series is cut into calendar chunks. Each chunk is ordered on its own, and only one row per
chunk is ordered along the series to bring in what came from earlier or later chunks.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlens.functions.quantiles import join_on


def carry(
    ticks: DataFrame, keys, time: str, last: dict = None, next: dict = None, chunk: str = "month"
) -> DataFrame:
    """Add, for each output name, the last (or next) known value of an expression.

    ``ticks`` holds at most one row per (keys, time). ``last`` maps an output column to the
    column whose latest known value at or before the row is wanted; ``next`` looks strictly
    after the row. The result keeps every row.
    """
    keys, last, next = list(keys), last or {}, next or {}
    cut = ticks.withColumn("_chunk", F.date_trunc(chunk, F.col(time)))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(time)
    back = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = inside.rowsBetween(1, Window.unboundedFollowing)
    local = cut.select(
        "*",
        *[F.last(c, ignorenulls=True).over(back).alias(f"_in_{o}") for o, c in last.items()],
        *[F.first(c, ignorenulls=True).over(ahead).alias(f"_in_{o}") for o, c in next.items()],
    )

    def edge(agg, c):
        return agg(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(time)))

    per_chunk = cut.groupBy(*keys, "_chunk").agg(
        *[edge(F.max_by, c).alias(f"_e_{o}") for o, c in last.items()],
        *[edge(F.min_by, c).alias(f"_e_{o}") for o, c in next.items()],
    )
    along = Window.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    after = along.rowsBetween(1, Window.unboundedFollowing)
    brought = per_chunk.select(
        *keys, "_chunk",
        *[F.last(f"_e_{o}", ignorenulls=True).over(before).alias(f"_out_{o}") for o in last],
        *[F.first(f"_e_{o}", ignorenulls=True).over(after).alias(f"_out_{o}") for o in next],
    )
    outputs = [*last, *next]
    return join_on(local, brought, [*keys, "_chunk"]).select(
        *ticks.columns,
        *[F.coalesce(f"_in_{o}", f"_out_{o}").alias(o) for o in outputs],
    )
