from __future__ import annotations

import pytest

#: Names that operators use inside, as columns of the inputs.
CLASHING = {"th": "x", "id": 1, "word": "w", "line": "l", "h": 2, "score": 0.5, "n_lines": 9, "rank": 3, "c0": 4, "band": "b"}


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text[, lang]) rows, with columns whose names clash."""

    def make(rows, lang="en"):
        full = [(r[0], r[1], r[2] if len(r) > 2 else lang, "s", len(r[1] or ""), *CLASHING.values()) for r in rows]
        kinds = {str: "string", int: "int", float: "double"}
        extra = ", ".join(f"{c} {kinds[type(v)]}" for c, v in CLASHING.items())
        return spark.createDataFrame(full, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")

    return make


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
