"""Classifying removals and splits and estimating the mass they moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from daygrid.functions.days import by_entity, with_missing
from daygrid.functions.measures import LITERS_PER_GALLON
from daygrid.operators.fill import blocked_fill
from daygrid.operators.state import active_status

FILL_ROWS = 5


def _column(df: DataFrame, name: str, type_: str = "double") -> Column:
    """A column that a source may not have."""
    return F.col(name) if name in df.columns else F.lit(None).cast(type_)


def movement_class(df: DataFrame, w: WindowSpec | None = None, strict: bool = False) -> DataFrame:
    """Add ``move_class``: HC, H, SC, S, or null for no movement.

    The code of the entity's next row decides between a partial and a complete
    movement. Rows that fit no rule get ``move_unmatched`` = true, or stop the
    job with ``strict``.
    """
    w = w or by_entity()
    out = with_missing(df, {"_next_code": F.lead("move_code").over(w)})
    code, following = F.upper(F.col("move_code")), F.upper(F.col("_next_code"))
    removed, split = F.col("removed_volume"), _column(df, "split_volume")
    idle_code = code.isNull() | (code == "I")
    rules = (
        F.when(removed.isNull() & split.isNull() & idle_code, F.lit("none"))
        .when((code == "HC") | ((following == "I") & (code == "H")), F.lit("HC"))
        .when((following == "I") & code.isNull(), F.lit("HC"))
        .when(code == "H", F.lit("H"))
        .when((code == "SC") | ((following == "I") & (code == "S")), F.lit("SC"))
        .when(code == "S", F.lit("S"))
        .when(removed > 0, F.lit("H"))
        .when(split > 0, F.lit("S"))
    )
    if strict:
        rules = F.coalesce(rules, F.raise_error(F.concat(F.lit("no movement rule for "), F.col("entity_id"))))
    out = out.withColumn("_rule", rules)
    return out.withColumns(
        {"move_class": F.nullif(F.col("_rule"), F.lit("none")), "move_unmatched": F.col("_rule").isNull()}
    ).drop("_next_code", "_rule")


def mass_differential(df: DataFrame, w: WindowSpec | None = None, mass: str = "mass_corrected") -> DataFrame:
    """Mass moved, from the standing mass of this row and the next.

    Partial movements lose the difference, complete ones everything. A
    negative difference shows that nothing was moved: class and estimates
    become null.
    """
    w = w or by_entity()
    kind = F.col("move_class")
    out = with_missing(df, {"_next_mass": F.lead(mass).over(w)})
    drop = F.col(mass) - F.col("_next_mass")
    out = out.withColumn(
        "_moved", F.when(kind.isin("H", "S"), drop).when(kind.isin("HC", "SC"), F.col(mass))
    )
    moved = F.col("_moved")
    wrong = F.coalesce(moved < 0, F.lit(False))
    return out.withColumns(
        {
            "est_removed_mass": F.when(kind.isin("H", "HC") & ~wrong, moved),
            "est_split_mass": F.when(kind.isin("S", "SC") & ~wrong, moved),
            "move_class": F.when(~wrong, kind),
        }
    ).drop("_next_mass", "_moved")


def volume_log_estimate(
    df: DataFrame, w: WindowSpec | None = None, reset_always: bool = True, fill_rows: int = FILL_ROWS
) -> DataFrame:
    """Add ``est_removed_log`` and ``est_split_log``: mass from the logged volume.

    Density and purity are filled up to ``fill_rows`` rows both ways. A day
    with a logged movement discards its own readings (with
    ``reset_always=False`` only when density is missing), as they may stem from
    after the movement. Inactive days block density, not purity. Estimates are
    null on rows that are not active; the log holds no split volumes to use.
    """
    w = w or by_entity()
    moved = F.coalesce((F.col("removed_volume") > 0) | (_column(df, "split_volume") > 0), F.lit(False))
    if not reset_always:
        moved = moved & F.col("density").isNull()
    out = df.withColumns({"_moved": moved, "_density": F.col("density"), "_purity": F.col("purity_pct")})
    out = blocked_fill(
        out,
        ["_density", "_purity"],
        w,
        backward=fill_rows,
        forward=fill_rows,
        block={"_density": ~F.col("active")},
        reset=F.col("_moved"),
    )
    estimate = (
        F.col("_density") * (F.col("_purity") / 100) * F.col("removed_volume") * F.lit(LITERS_PER_GALLON) / 1000
    )
    return out.withColumns(
        {
            "est_removed_log": F.when(F.col("active"), estimate),
            "est_split_log": F.lit(None).cast("double"),
        }
    ).drop("_moved", "_density", "_purity")


def estimate_fallback(df: DataFrame) -> DataFrame:
    """Use the log estimate where a movement has no estimate from standing mass."""
    def best(estimate: str, backup: str) -> Column:
        gap = F.col(estimate).isNull() & F.col("move_class").isNotNull()
        return F.when(gap, F.col(backup)).otherwise(F.col(estimate))

    return df.withColumns(
        {
            "est_removed_mass": best("est_removed_mass", "est_removed_log"),
            "est_split_mass": best("est_split_mass", "est_split_log"),
        }
    ).drop("est_removed_log", "est_split_log")


def standing_moves(df: DataFrame, w: WindowSpec | None = None, strict: bool = False) -> DataFrame:
    """Class, estimate from standing mass, and state; their look-ups share one window."""
    w = w or by_entity()
    df = df.withColumns(
        {
            "_next_code": F.lead("move_code").over(w),
            "_next_mass": F.lead("mass_corrected").over(w),
            "_prev_code": F.lag("move_code").over(w),
        }
    )
    return active_status(mass_differential(movement_class(df, w, strict), w), w)


def movement_masses(df: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """State, class and mass estimates of every movement, on one entity partitioning."""
    w = w or by_entity()
    return estimate_fallback(volume_log_estimate(standing_moves(df, w), w))
