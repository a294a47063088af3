"""Scalar cleaning rules as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the tag that marks a unit holding growth medium only.
MEDIA_TAG = "(media only)"


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with every key present, keys as text."""
    kept = df.dropna(subset=list(keys))
    return kept.withColumns({k: F.col(k).cast("string") for k in keys})


def tag_extract(df: DataFrame, label: str, flag: str = "media_only", tag: str = MEDIA_TAG) -> DataFrame:
    """Turn a tag inside ``label`` into a boolean column and strip it from the text."""
    text = F.col(label)
    return df.withColumns(
        {
            flag: F.lower(text).contains(tag.strip("()")),
            label: F.trim(F.regexp_replace(text, "(?i)" + re.escape(tag), "")),
        }
    )


def suffix_group(entity: Column) -> Column:
    """Layout group of an entity: the last character of its id."""
    return F.right(entity, F.lit(1))


def is_large(entity: Column, suffixes: Sequence[str] = ("06", "08")) -> Column:
    """Double-size units by the last two characters of the id."""
    return F.right(entity, F.lit(2)).isin(*suffixes)


def zero_to_null(value: Column) -> Column:
    return F.when(value != 0, value)


def present(value: Column) -> Column:
    """True for a value that is neither null nor zero."""
    return F.coalesce(value != 0, F.lit(False))


def pair_or_null(left: Column, right: Column) -> tuple[Column, Column]:
    """Both measures, or two nulls where either is missing or zero."""
    both = present(left) & present(right)
    return F.when(both, left), F.when(both, right)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in the sources; in Spark it would compare as the largest number."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def first_positive(*sources: Column) -> Column:
    """First source above zero in priority order, else 0."""
    return F.coalesce(*(F.when(s > 0, s) for s in sources), F.lit(0.0))
