"""Neighbouring values in a group by two levels of windows.

``lag`` over one member sends every row of that member to one task; when a
member holds a third of all rows, that task holds a third of the work.  Here
a member's rows are cut along their order into spans (a day, a month): inside
a span the neighbour is a plain ``lag``; the first row of a span takes the
last row of the span before, which comes from one combined aggregate per
(member, span) and a window over those few rows.  It is handed over as an
extra row of the span, so the wide rows are shuffled once, by (member, span),
and are joined with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPAN, _RANK, _VALUES, _NEAR = "__wl_span", "__wl_rank", "__wl_values", "__wl_near"


def _neighbour(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], values: Sequence[str], span: Column,
               step: int, prefix: str) -> DataFrame:
    group = list(group_by)
    near, edge = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    rows = df.withColumn(_SPAN, span).withColumn(_VALUES, F.struct(*values))
    edges = rows.groupBy(*group, _SPAN).agg(edge(_VALUES, F.struct(*order_by)).alias(_VALUES))
    of_group = Window.partitionBy(*group).orderBy(F.col(_SPAN).asc_nulls_first())
    carried = edges.withColumn(_VALUES, near(_VALUES).over(of_group)).where(F.col(_VALUES).isNotNull())
    # a carried row stands before (or after) all rows of the span itself
    both = rows.withColumn(_RANK, F.lit(0)).unionByName(carried.withColumn(_RANK, F.lit(step)),
                                                        allowMissingColumns=True)
    of_span = Window.partitionBy(*group, _SPAN).orderBy(_RANK, *[F.col(c).asc_nulls_first() for c in order_by])
    out = both.withColumn(_NEAR, near(_VALUES).over(of_span)).where(F.col(_RANK) == 0)
    return out.select(*df.columns, *[F.col(f"{_NEAR}.{v}").alias(f"{prefix}{v}") for v in values])


def previous_in_group(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], values: Sequence[str],
                      span: Column, prefix: str = "previous_") -> DataFrame:
    """``lag(v) over (partition by group_by order by order_by)`` for each of ``values``.

    ``order_by`` must make the order total within a group; ``span`` never
    falls along it (a NULL span counts as the lowest) and cuts a group into
    parts that fit a task.
    """
    return _neighbour(df, group_by, order_by, values, span, -1, prefix)


def next_in_group(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], values: Sequence[str],
                  span: Column, prefix: str = "next_") -> DataFrame:
    """``lead(v) over (partition by group_by order by order_by)``, as above."""
    return _neighbour(df, group_by, order_by, values, span, 1, prefix)
