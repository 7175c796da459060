"""Names for helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(rows: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``rows`` has, whatever the case of its letters."""
    taken, out = {c.lower() for c in rows.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out
