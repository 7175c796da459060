"""Running aggregates over the rows of a key that no single task could sort.

With ``parts`` above 1 the rows of all keys are cut into parts at quantiles of time, so
that a key with most of the rows spreads over as many tasks as there are parts. A window
runs inside each part of a key; of each part one row is kept, and a window over these
few rows tells what came before it. That reads the rows once more for each step, so it
is for keys that are too busy for one task: ``spread`` counts and says how many parts
there must be. Results are the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .names import fresh

#: Rows of a key that one task may sort.
BUSY = 5_000_000
FIRST, CURRENT = Window.unboundedPreceding, Window.currentRow


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join by columns of the same names in which nulls are equal; the right side's don't appear."""
    theirs = fresh(left, *[f"their_{c}" for c in on])
    right = right.withColumnsRenamed(dict(zip(on, theirs, strict=True)))
    met = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(t)) for c, t in zip(on, theirs, strict=True)])
    return left.join(right, met, how).drop(*theirs)


def spread(rows: DataFrame, key: list[str], busy: int = BUSY) -> int:
    """Parts into which the busiest key must be cut so that a task has about ``busy`` rows; one narrow count."""
    most = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return max(1, -(-(most or 0) // busy))


def with_parts(rows: DataFrame, key: list[str], time: str, name: str, parts: int = 1) -> DataFrame:
    """Adds the part of each row, of about equal sizes; rows of one time share a part, rows without a time are in the first one, as are those whose key holds a null."""
    if parts <= 1:
        return rows.withColumn(name, F.lit(0))
    (bounds,) = fresh(rows, "bounds")
    cuts = F.percentile_approx(F.col(time), F.array(*[F.lit(i / parts) for i in range(1, parts)]), F.lit(1000))
    whole = reduce(lambda a, k: a & F.col(k).isNotNull(), key, F.lit(True))
    placed = rows.crossJoin(F.broadcast(rows.agg(F.array_distinct(cuts).alias(bounds))))  # one row
    part = F.size(F.filter(bounds, lambda b: b <= F.col(time)))
    return placed.withColumn(name, F.when(whole & F.col(bounds).isNotNull(), part).otherwise(0)).drop(bounds)


@dataclass(frozen=True)
class Running:
    """A running aggregate of ``value``: ``sum``, ``min``, ``max``, ``last`` (the last that is not null) or ``lag`` (of the row before, as a struct of one field ``x``, null before the first row).

    inclusive: whether it counts the row itself.
    """

    kind: str
    value: Column
    inclusive: bool = True


def _join(kind: str, a: Column, b: Column) -> Column:
    """Of what came first and what came then."""
    if kind == "sum":
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    return {"min": F.least, "max": F.greatest}[kind](a, b) if kind in ("min", "max") else F.coalesce(b, a)


def running(rows: DataFrame, key: list[str], order: list[str], part: str, columns: dict[str, Running], parts: int = 1) -> DataFrame:
    """Adds running aggregates in ``order`` over each ``key``. part: the column of ``with_parts`` over the first of ``order``, with so many ``parts``."""
    names = list(columns)
    carried = dict(zip(names, fresh(rows, *[f"before_{n}" for n in names]), strict=True))
    inside = Window.partitionBy(*key, *([part] if parts > 1 else [])).orderBy(*order)
    ends, local, before = [], {}, {}
    for name, r in columns.items():
        span = inside.rowsBetween(FIRST, CURRENT if r.inclusive else -1)
        if r.kind == "lag":
            value = F.struct(r.value.alias("x"))
            local[name] = F.lag(value).over(inside)
            ends.append(F.max_by(value, F.struct(*order)).alias(carried[name]))
        elif r.kind == "last":
            local[name] = F.last(r.value, ignorenulls=True).over(span)
            ends.append(F.max_by(r.value, F.when(r.value.isNotNull(), F.struct(*order))).alias(carried[name]))
        else:
            f = {"sum": F.sum, "min": F.min, "max": F.max}[r.kind]
            local[name] = f(r.value).over(span)
            ends.append(f(r.value).alias(carried[name]))
        past = Window.partitionBy(*key).orderBy(part).rowsBetween(FIRST, -1)
        end = F.col(carried[name])
        before[name] = ({"sum": F.sum, "min": F.min, "max": F.max}[r.kind](end) if r.kind in ("sum", "min", "max") else F.last(end, ignorenulls=True)).over(past)
    if parts <= 1:
        return rows.withColumns(local)
    seen = rows.groupBy(*key, part).agg(*ends)
    seen = seen.select(*key, part, *[before[n].alias(carried[n]) for n in names])
    rows = rows.withColumns(local).join(seen, [*key, part], "left")
    return rows.withColumns({n: _join(r.kind, F.col(carried[n]), F.col(n)) for n, r in columns.items()}).drop(*carried.values())
