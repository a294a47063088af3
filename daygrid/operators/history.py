"""The newest measurements of an entity and the change between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daygrid.functions.days import by_entity
from daygrid.operators.fill import UNLIMITED, blocked_fill

HISTORY_DAYS = 90
HISTORY_COUNT = 3


def carry_measurements(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Carry quality readings forward over days without one, not across inactive days.

    Adds ``measured_on`` (day of the reading) and ``is_measured``. A reading
    on an inactive day is blanked while ``is_measured`` stays true. Where the
    frame has ``carried_from``, a value with such a date was carried already
    by an earlier run.
    """
    w = w or by_entity()
    read = F.col("quality_val").isNotNull()
    carried = F.col("carried_from") if "carried_from" in df.columns else F.lit(None).cast("date")
    out = df.withColumns(
        {
            "is_measured": F.when(read & carried.isNull(), True),
            "measured_on": F.when(read, F.coalesce(carried, F.col("obs_date"))),
        }
    ).drop("carried_from")
    columns = [c for c in ("quality_val", "quality_total", "measured_on") if c in out.columns]
    return blocked_fill(out, columns, w, forward=UNLIMITED, block=~F.col("active"))


def last_measurements(
    df: DataFrame, w: WindowSpec | None = None, days: int = HISTORY_DAYS, count: int = HISTORY_COUNT
) -> DataFrame:
    """Add ``recent``: for every row the newest measurements up to it, newest first.

    Only true measurements of the last ``days`` days count, and none before
    the latest row whose value is null (an inactive day). Works for all report
    dates at once: each measurement links to the one before it, and rows in
    between carry the newest chain.
    """
    w = w or by_entity()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = F.coalesce(F.col("is_measured"), F.lit(False)) & F.col("quality_val").isNotNull()
    entry = F.struct(F.col("day_no").alias("day_no"), F.col("quality_val").alias("value"))
    out = df.withColumns({"_real": real, "_m0": F.when(real, entry)})
    for i in range(1, count):
        older = F.last(f"_m{i - 1}", ignorenulls=True).over(before)
        out = out.withColumn(f"_m{i}", F.when(F.col("_real"), older))
    chain = F.when(F.col("_real"), F.array(*(f"_m{i}" for i in range(count))))
    out = out.withColumns(
        {
            "_chain": F.last(chain, ignorenulls=True).over(so_far),
            "_break": F.max(F.when(F.col("quality_val").isNull(), F.col("day_no"))).over(so_far),
        }
    )
    oldest = F.greatest(F.col("day_no") - days, F.col("_break") + 1)
    recent = F.filter("_chain", lambda m: m.isNotNull() & (m["day_no"] >= oldest))
    out = out.withColumn("recent", F.coalesce(recent, F.filter(F.array("_m0"), lambda m: F.lit(False))))
    return out.drop("_real", "_chain", "_break", *(f"_m{i}" for i in range(count)))


def change_between(df: DataFrame, recent: str = "recent") -> DataFrame:
    """Newest value against the second and the third, with day gaps and a sign label."""
    def part(i: int, field: str) -> Column:
        return F.get(F.col(recent), F.lit(i)).getField(field)

    def sign(delta: Column) -> Column:
        return F.when(delta > 0, "up").when(delta < 0, "down").when(delta == 0, "flat")

    out = {
        "latest_value": part(0, "value"),
        "latest_date": F.date_from_unix_date(part(0, "day_no")),
        "measurements": F.size(recent),
    }
    for i in (1, 2):
        delta = part(0, "value") - part(i, "value")
        out[f"change_{i}"] = delta
        out[f"change_{i}_days"] = part(0, "day_no") - part(i, "day_no")
        out[f"change_{i}_sign"] = sign(delta)
    return df.withColumns(out)
