"""Keep-latest deduplication (one row per key).

``row_number() OVER (PARTITION BY keys ORDER BY latest DESC, tiebreak ASC)``
with the ``= 1`` filter directly above the window.  Catalyst turns that
shape into a partial ``WindowGroupLimit`` *before* the shuffle, so a hot
key (NULL ids all share one window partition) is cut to at most one row
per map task before it is exchanged: the skewed group never reaches one
reducer whole.  NULL ordering values sort last, as in the audited job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__dedup_rn"


def _orderable(df: DataFrame, column: str) -> Column:
    """The column, or its text where its type has no order."""
    kind = df.schema[column].dataType
    return F.to_json(F.struct(column)) if "map<" in kind.simpleString() else F.col(column)


def dedup_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str],
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep, per ``keys``, the row greatest by ``latest_by``; ties go to the smallest ``tiebreak``.

    Rows of one micro-batch share their ingest time, so ties are the normal
    case.  Without a tiebreak all remaining columns decide, in their order:
    the survivor then depends on the rows alone, never on their partitioning.
    """
    order = [F.col(c).desc_nulls_last() for c in latest_by]
    rest = list(tiebreak) or [c for c in df.columns if c not in (*keys, *latest_by)]
    order += [_orderable(df, c).asc_nulls_last() for c in rest]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


COPIES = "copies"
_ASCENDING = ("timestamp", "timestamp_ntz", "date", "tinyint", "smallint", "int", "bigint")


def _falling(df: DataFrame, column: str) -> Column:
    """A BIGINT that falls as an instant, date or whole number rises; NULL comes last."""
    kind = df.schema[column].dataType.simpleString()
    if kind not in _ASCENDING:
        raise TypeError(f"{column}: {kind} has no inverse order; use dedup_latest")
    if kind.startswith("timestamp"):
        value = F.unix_micros(F.col(column).cast("timestamp"))
    else:
        value = F.unix_date(column) if kind == "date" else F.col(column).cast("bigint")
    return F.coalesce(F.bitwise_not(value), F.lit(2**63 - 1))


def dedup_latest_counted(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """The rows of ``dedup_latest`` with ``copies``, how many rows their key had: one aggregate, one shuffle.

    The copies are counted in the data, so a map task that runs again after
    a lost executor is not counted twice, as it would be by a metric below
    the shuffle.  The partial aggregate keeps one row and one count per key
    and task, so a hot key (NULL ids) crosses the shuffle as one row a task.
    The kept row is the least of structs that begin with the order, so a
    column that decides is sorted and moved once, not in an order and in a
    row.  ``latest_by`` holds instants, dates or whole numbers.
    """
    others = [c for c in df.columns if c not in keys]
    rest = list(tiebreak) or [c for c in others if c not in latest_by]
    order = [_falling(df, c).alias(f"l{i}") for i, c in enumerate(latest_by)]
    order += [x for i, c in enumerate(rest) for x in (F.col(c).isNull().alias(f"n{i}"), _orderable(df, c).alias(f"t{i}"))]
    place = {c: f"c{i}" for i, c in enumerate(others) if c not in rest} | {c: f"t{i}" for i, c in enumerate(rest)}
    if any("map<" in df.schema[c].dataType.simpleString() for c in others):  # such a column has no order, so no struct of it has
        place = {c: f"c{i}" for i, c in enumerate(others)}
        kept = F.min_by(F.struct(*[F.col(c).alias(place[c]) for c in others]), F.struct(*order))
    else:
        kept = F.min(F.struct(*order, *[F.col(c).alias(place[c]) for c in others if c not in rest]))
    best = df.groupBy(*keys).agg(kept.alias("_best"), F.count(F.lit(1)).alias(COPIES))
    return best.select(*[c if c in keys else F.col(f"_best.{place[c]}").alias(c) for c in df.columns], COPIES)
