"""Column names of hand-kept sheets."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Remarks that tell a measurement from another; a name with one of them keeps all its remarks.
TELLING = ("filter", "filtered")
#: Columns whose content is a sheet's own.
OWN = ("Notes", "Comments")
# How spreadsheet and CSV readers name a column without a header.
_NAMELESS = re.compile(r"\s*|Unnamed.*|_c\d+")
_REMARK = re.compile(r"\([^)]*\)")


def clean_header(name: str, telling: Sequence[str] = TELLING) -> str:
    """A name without remarks in brackets, such as units, and with single spaces."""
    keeps = any(f"({remark})" in name.lower() for remark in telling)
    return " ".join((name if keeps else _REMARK.sub(" ", name)).split())


def clean_headers(
    df: DataFrame,
    sheet: str,
    rename: Mapping[str, str] | None = None,
    own: Sequence[str] = OWN,
    telling: Sequence[str] = TELLING,
) -> DataFrame:
    """A sheet with clean column names, by position, so names may repeat or hold any character.

    Columns without a name are dropped; remarks go; ``own`` columns get the
    sheet's name behind theirs; ``rename`` is by clean names. Two columns with
    one name left are an error, since either may be meant.
    """
    new, kept = [], []
    for at, name in enumerate(df.columns):
        if _NAMELESS.fullmatch(name):
            continue
        name = clean_header(name, telling)
        name = f"{name}-{sheet}" if name in own else name
        new.append((rename or {}).get(name, name))
        kept.append(at)
    twice = sorted(name for name, n in Counter(new).items() if n > 1)
    if twice:
        raise ValueError(f"columns of sheet {sheet} with one name: {twice}")
    # Numbered first: a column cannot be named where another has the same name.
    numbered = df.toDF(*(f"c{at}" for at in range(len(df.columns))))
    return numbered.select(*(F.col(f"c{at}").alias(name) for at, name in zip(kept, new, strict=True)))


def fold_headers(df: DataFrame, row: str, rows: int = 4) -> DataFrame:
    """A sheet read without a header whose names stand somewhere in its first ``rows`` rows.

    ``row`` numbers the sheet's rows from 0. A column's name is the first entry from the top; one without any entry is
    dropped, as ``clean_headers`` drops columns without a name. Only the header rows come to the driver.
    """
    columns = [c for c in df.columns if c != row]
    top = df.filter(F.col(row) < rows).orderBy(row).limit(rows).select(*(F.col(f"`{c}`") for c in columns)).collect()
    named = []
    for at, column in enumerate(columns):
        entries = (str(r[at]).strip() for r in top if r[at] is not None)
        name = " ".join(next((e for e in entries if e), "").split())
        if name:
            named.append((column, name))
    twice = sorted(name for name, n in Counter([row, *(name for _, name in named)]).items() if n > 1)
    if twice:
        raise ValueError(f"columns with one name: {twice}")
    return df.filter(F.col(row) >= rows).select(row, *(F.col(f"`{c}`").alias(name) for c, name in named))
