"""Ordered scans: prefix sums and previous values over a sequence.

``scan`` adds, for every row, the sum of some expressions over the rows before
it and the latest non-null value of others. Two physical forms exist:

* without ``block`` one window per sequence, a single shuffle. Right where a
  sequence is one document's list, which one input row already held;
* with ``block`` (columns that never decrease along the order) windows run per
  ``(key, block)``, so a very long sequence is spread over tasks; block totals
  are aggregated map-side, scanned per key (one row per block) and joined back.

Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    block: Sequence[str] | None = None,
) -> DataFrame:
    sums, lasts = dict(sums or {}), dict(lasts or {})
    if block is None:
        before = _before(keys, order)
        return df.withColumns(
            {n: _sum(v, before) for n, v in sums.items()}
            | {n: F.last(v, ignorenulls=True).over(before) for n, v in lasts.items()}
        )
    return _blocked(df, list(keys), list(order), sums, lasts, list(block))


def _before(keys: Sequence[str], order: Sequence[str]):
    return (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )


def _sum(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _blocked(df, keys, order, sums, lasts, block) -> DataFrame:
    cells = keys + [b for b in block if b not in keys]
    position = F.struct(*order)
    totals = df.groupBy(*cells).agg(
        *[F.sum(v).alias(f"_sum_{n}") for n, v in sums.items()],
        *[
            F.max_by(F.when(v.isNotNull(), v), F.when(v.isNotNull(), position)).alias(f"_last_{n}")
            for n, v in lasts.items()
        ],
    )
    over_blocks = _before(keys, block)
    carry = totals.select(
        *cells,
        *[_sum(F.col(f"_sum_{n}"), over_blocks).alias(f"_carry_{n}") for n in sums],
        *[
            F.last(f"_last_{n}", ignorenulls=True).over(over_blocks).alias(f"_carry_{n}")
            for n in lasts
        ],
    )
    inside = _before(cells, order)
    # Dealt out first: what the windows take is worked out behind the shuffle, not sent through it.
    local = df.repartition(*cells).select(
        "*",
        *[_sum(v, inside).alias(n) for n, v in sums.items()],
        *[F.last(v, ignorenulls=True).over(inside).alias(n) for n, v in lasts.items()],
    )
    joined = local.join(carry, cells, "left")
    fixed = {n: F.col(n) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0)) for n in sums}
    fixed |= {n: F.coalesce(F.col(n), F.col(f"_carry_{n}")) for n in lasts}
    return joined.withColumns(fixed).select(*local.columns)
