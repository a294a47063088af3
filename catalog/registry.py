"""Registering a query together with its check.

A column spec such as ``"obs_date:d entity_id mass:2"`` fixes the columns both
sides return: ``:d`` prints a date as yyyy-mm-dd text, ``:i`` gives a long and
``:n`` rounds to n places (the engines add doubles in different orders).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.sql import with_ctes
from daygrid.durable import ensure_local_folder, settled

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _parts(spec: str) -> list[tuple[str, str]]:
    return [(name, kind) for name, _, kind in (item.partition(":") for item in spec.split())]


def _exact(digits: str) -> str:
    """A decimal type that clears the noise of double sums before rounding, which would decide ties otherwise."""
    return f"decimal(38, {int(digits) + 3})"


def shown(df: DataFrame, spec: str) -> DataFrame:
    def column(name: str, kind: str):
        c = F.col(name)
        if kind == "d":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "i":
            c = c.cast("bigint")
        elif kind:
            c = F.round(c.cast("double").cast(_exact(kind)), int(kind)).cast("double")
        return c.alias(name)

    return df.select(*(column(*p) for p in _parts(spec)))


def shown_sql(spec: str) -> str:
    def column(name: str, kind: str) -> str:
        if kind == "d":
            return f"strftime({name}, '%Y-%m-%d') as {name}"
        if kind == "i":
            return f"cast({name} as bigint) as {name}"
        if kind:
            return f"cast(round(cast(cast({name} as double) as {_exact(kind)}), {kind}) as double) as {name}"
        return name

    return ", ".join(column(*p) for p in _parts(spec))


def query(
    name: str, spec: str, uses: str = "", sql: str | None = None, dense: bool = False, long: bool = False
) -> Callable[[Query], Query]:
    """Register a function under ``name``; ``sql`` may use the shared views named in ``uses``.

    With ``dense`` these views rest on readings for every day, with ``long``
    on the readings of seven years.
    """

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ensure_local_folder(spark)
            return settled(spark, lambda: shown(fn(spark, sf), spec))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"{with_ctes(uses.split(), dense, long)} select {shown_sql(spec)} from ({sql}) as result"
        return fn

    return register
