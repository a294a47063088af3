"""Status codes, indicator flags and removal candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from daygrid.functions.days import by_entity
from daygrid.operators.fill import blocked_fill

STATUS_FILL_ROWS = 2
STATUS_CODES = range(7)
MIN_REMOVAL_DENSITY = 0.5
MIN_REMOVAL_QUALITY = 3.0

# Indicator column, rule, threshold, symbol.
INDICATORS = (
    ("purity_pct", "below", 80.0, "%N"),
    ("ph", "outside", (7.8, 8.2), "pH"),
    ("rotifers", "from", 1.0, "R"),
    ("attached_fd", "from", 1.0, "FD A"),
    ("floating_fd", "from", 1.0, "FD FF"),
    ("golden_flagellates", "from", 1.0, "GF"),
    ("diatoms", "from", 0.5, "D"),
    ("tetra", "from", 0.5, "T"),
    ("green_algae", "from", 0.5, "GA"),
)


def status_code(df: DataFrame, w: WindowSpec | None = None, rows: int = STATUS_FILL_ROWS) -> DataFrame:
    """Add ``status_code`` 0..6 from state, density (filled over short gaps) and quality.

    0 inactive, 1 incomplete, 2..6 by the first limit that applies.
    """
    w = w or by_entity()
    out = df.withColumn("_d", F.col("density"))
    out = blocked_fill(out, ["_d"], w, forward=rows, block=~F.col("active"))
    d, q = F.col("_d"), F.col("quality_val")
    code = (
        F.when(~F.col("active"), 0)
        .when(d.isNull() | q.isNull(), 1)
        .when(d < 0.25, 2)
        .when(q < 2.5, 3)
        .when((d < 0.5) | (q < 3.0), 4)
        .when(d < 0.8, 5)
        .otherwise(6)
    )
    return out.withColumn("status_code", code).drop("_d")


def indicator_flags(indicators: tuple = INDICATORS) -> Column:
    """Symbols of the indicators over their limit, in table order. Missing readings count as 0."""
    def flag(column: str, rule: str, limit, symbol: str) -> Column:
        v = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
        if rule == "below":
            hit = v < limit
        elif rule == "outside":
            hit = (v < limit[0]) | (v > limit[1])
        else:
            hit = v >= limit
        return F.when(hit, F.lit(symbol))

    return F.array_compact(F.array(*(flag(*i) for i in indicators)))


def value_bucket(latest: Column, active: Column) -> Column:
    """Bucket of the newest quality value: red below 2, yellow below 3, green from 3."""
    return (
        F.when(~F.coalesce(active, F.lit(False)), "inactive")
        .when(latest.isNull(), "grey")
        .when(latest < 2, "red")
        .when(latest < 3, "yellow")
        .otherwise("green")
    )


def removal_candidates(
    df: DataFrame, min_density: float = MIN_REMOVAL_DENSITY, min_quality: float = MIN_REMOVAL_QUALITY
) -> DataFrame:
    """Rows dense and good enough with something to remove; ``drop_to`` is the depth left after it."""
    keep = (
        (F.col("density") >= min_density)
        & (F.col("quality_val") >= min_quality)
        & (F.col("removable_mass_corrected") != 0)
    )
    return df.filter(keep).withColumn("drop_to", F.col("depth") - F.col("removable_inches"))


def candidate_order() -> list[Column]:
    """Longest since an event first, then most mass; the id breaks ties."""
    return [
        F.col("days_since_event").desc_nulls_last(),
        F.col("removable_mass_corrected").desc_nulls_last(),
        F.col("entity_id").asc(),
    ]
