"""Filling gaps up to a row limit without crossing barriers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

UNLIMITED = "unlimited"


def blocked_fill(
    df: DataFrame,
    columns: Sequence[str],
    w: WindowSpec,
    *,
    backward: int = 0,
    forward: int | str = 0,
    block: Column | Mapping[str, Column] | None = None,
    reset: Column | None = None,
) -> DataFrame:
    """Fill nulls from at most ``backward`` rows ahead, then from at most ``forward`` rows behind.

    Rows where ``block`` holds lose their value and stop both passes. Rows
    where ``reset`` holds lose their value and stop the backward pass only; the
    forward pass then treats them, and what they blanked, as gaps. ``reset``
    wins where both hold. ``block`` may differ by column; columns it does not
    name are not blocked.

    A barrier is a struct that is present but has no value: ``first`` and
    ``last`` find it like any other non-null entry.
    """
    types = dict(df.dtypes)
    blocks = block if isinstance(block, Mapping) else {c: block for c in columns}

    def holds(condition: Column | None) -> Column:
        return F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))

    def box(value: Column, is_reset: bool) -> Column:
        return F.struct(value.alias("v"), F.lit(is_reset).alias("reset"))

    def boxed(c: str) -> Column:
        nothing = F.lit(None).cast(types[c])
        return (
            F.when(holds(reset), box(nothing, True))
            .when(holds(blocks.get(c)), box(nothing, False))
            .when(F.col(c).isNotNull(), box(F.col(c), False))
        )

    ahead = w.rowsBetween(0, backward)
    behind = w.rowsBetween(Window.unboundedPreceding if forward == UNLIMITED else -forward, 0)
    out = df.withColumns({f"_box_{c}": boxed(c) for c in columns})
    if backward:
        out = out.withColumns({f"_box_{c}": F.first(f"_box_{c}", ignorenulls=True).over(ahead) for c in columns})
    kept = {c: F.when(~F.col(f"_box_{c}.reset"), F.col(f"_box_{c}")) for c in columns}
    if forward:
        filled = {c: F.last(kept[c], ignorenulls=True).over(behind).getField("v") for c in columns}
    else:
        filled = {c: kept[c].getField("v") for c in columns}
    return out.withColumns(filled).drop(*(f"_box_{c}" for c in columns))
