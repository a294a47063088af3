"""Reading free-text sample labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _id_and_date(label: str, digits: str, part: int) -> Column:
    """Part of the first standing token of so many digits that a standing token of 6 digits follows, or null."""
    pattern = rf"(?<!\S)(\d{{{digits}}})(?!\S).*?(?<!\S)(\d{{6}})(?!\S)"
    return F.nullif(F.regexp_extract(F.col(label), pattern, part), F.lit(""))


def two_digit_date(text: Column) -> Column:
    """A yymmdd date; years 69 to 99 lie in the last century. Null if it is no date."""
    century = F.when(F.left(text, F.lit(2)) >= "69", "19").otherwise("20")
    return F.to_date(F.try_to_timestamp(F.concat(century, text), F.lit("yyyyMMdd")))


def parse_sample_labels(
    df: DataFrame,
    label: str = "sample_label",
    value: str = "val_text",
    total: str = "val_total_text",
    entities: DataFrame | None = None,
    scale: float = 1.0,
) -> DataFrame:
    """Labels such as ``S 0104 240105 rpt`` with two readings, as typed rows.

    The id is the first token of 4 or more digits before a date, else a 3-digit
    token with a leading zero; the date the 6-digit token (yymmdd) after the
    id. Readings are multiplied by ``scale`` (100 for fractions that should be
    percent). Rows are dropped when the id, the date or a reading cannot be
    read, when the first reading is 0, or when the id is not in ``entities``.
    """
    rest = [c for c in df.columns if c not in (label, value, total)]
    parsed = F.struct(
        F.coalesce(_id_and_date(label, "4,", 1), F.concat(F.lit("0"), _id_and_date(label, "3", 1))).alias("entity_id"),
        two_digit_date(F.coalesce(_id_and_date(label, "4,", 2), _id_and_date(label, "3", 2))).alias("obs_date"),
        (F.col(value).try_cast("double") * scale).alias("quality_val"),
        (F.col(total).try_cast("double") * scale).alias("quality_total"),
    )
    # A one-row array: filters on its fields stay above it, so each pattern runs once per row.
    read = df.select(*rest, F.inline(F.array(parsed)))
    read = read.dropna(subset=["entity_id", "obs_date", "quality_val", "quality_total"])
    read = read.filter((F.col("quality_val") != 0) & ~F.isnan("quality_val") & ~F.isnan("quality_total"))
    if entities is None:
        return read
    return known_entities(read, entities)


def known_entities(df: DataFrame, entities: DataFrame, key: str = "entity_id") -> DataFrame:
    """Rows whose entity is in the dimension. Spark broadcasts it when its size allows."""
    return df.join(entities.select(key), key, "left_semi")
