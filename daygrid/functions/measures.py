"""Physical and cost measures as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.functions.cleaning import is_large, present

# Fixed values.
LITERS_PER_GALLON = 3.78541
GALLONS_PER_INCH = 35000
LITERS_PER_INCH = 35000 * 3.78541
TARGET_DEPTH = 13.0
TARGET_DENSITY = 0.4
MIN_DENSITY = 0.5
NORMAL_DENSITY = 0.5
SITE_UNIT_COST = 0.15
# Cost per unit of the seven inputs (gal; kg for the sixth).
INPUT_RATES = {
    "in_1": 2.08,
    "in_2": 4.25,
    "in_3": 3.15,
    "in_4": 0.41,
    "in_5": 0.60,
    "in_6": 3.17,
    "in_7": 49.07,
}


def positive(value: Column) -> Column:
    """Value, or null when it is zero or below."""
    return F.when(value > 0, value)


def mass_volume(
    df: DataFrame,
    density: str = "density",
    depth: str = "depth",
    purity_pct: str = "purity_pct",
    entity: str = "entity_id",
) -> DataFrame:
    """Standing mass and the part that can be removed, per entity and day.

    Mass is in kg from g/L and inches. The removable depth leaves
    ``TARGET_DENSITY`` after topping off to ``TARGET_DEPTH``, rounded down to
    1/8 inch. Large units hold twice the volume. Zero results become null.
    """
    d, h = F.col(density), F.col(depth)
    known = present(d) & present(h)
    size = F.when(is_large(F.col(entity)), 2.0).otherwise(1.0)
    liters = F.lit(LITERS_PER_INCH) * size

    def mass(inches: Column) -> Column:
        return F.round(d * liters * inches / 1000, 2)

    spare = F.floor((h * d - TARGET_DEPTH * TARGET_DENSITY) / d * 8) / 8
    share = F.col(purity_pct) / 100
    out = df.withColumns(
        {
            "mass": F.when(known, mass(h)),
            # d <> 0 is tested first, so the division never sees a zero.
            "removable_inches": F.when(known & (d >= MIN_DENSITY), F.greatest(spare.cast("double"), F.lit(0.0))),
        }
    )
    inches = F.col("removable_inches")
    out = out.withColumns(
        {
            "mass_corrected": F.round(F.col("mass") * share, 2),
            "removable_gallons": inches * GALLONS_PER_INCH * size,
            "removable_mass": mass(inches),
        }
    )
    out = out.withColumn("removable_mass_corrected", F.round(F.col("removable_mass") * share, 2))
    results = ("mass", "mass_corrected", "removable_inches", "removable_gallons", "removable_mass",
               "removable_mass_corrected")
    return out.withColumns({c: positive(F.col(c)) for c in results})


def liters(depth: Column, entity: Column | None = None) -> Column:
    """Volume of a depth in inches. Doubled for large units only when ``entity`` is given."""
    volume = depth * F.lit(LITERS_PER_INCH)
    return volume if entity is None else volume * F.when(is_large(entity), 2.0).otherwise(1.0)


def normalized_liters(volume: Column, density: Column) -> Column:
    """Volume rescaled to the normal density."""
    return volume * (density / NORMAL_DENSITY)


def linear_cost(df: DataFrame, usage: str, rate: float = SITE_UNIT_COST, cost: str = "site_cost") -> DataFrame:
    """Usage times a unit cost; rows without usage are dropped."""
    return df.dropna(subset=[usage]).withColumn(cost, F.col(usage) * F.lit(rate))


def cost_by_rate(df: DataFrame, rates: Mapping[str, float] = INPUT_RATES, digits: int = 2) -> DataFrame:
    """Replace every input column by its cost ``<input>_cost``, missing inputs as 0."""
    costs = [
        F.round(F.coalesce(F.col(c), F.lit(0.0)) * F.lit(rate), digits).alias(f"{c}_cost")
        for c, rate in rates.items()
    ]
    return df.select(*(c for c in df.columns if c not in rates), *costs)


def weather_conform(df: DataFrame, date: str = "obs_date") -> DataFrame:
    """Six station measures under their table names, metric to imperial (pressure stays hPa)."""
    def fahrenheit(c: str) -> Column:
        return F.col(c) * 9 / 5 + 32

    return df.select(
        F.col(date),
        fahrenheit("tavg").alias("temp_avg"),
        fahrenheit("tmin").alias("temp_min"),
        fahrenheit("tmax").alias("temp_max"),
        (F.col("prcp") / 25.4).alias("precipitation"),
        (F.col("wspd") * 0.621371).alias("wind_speed"),
        F.col("pres").alias("pressure"),
    )
