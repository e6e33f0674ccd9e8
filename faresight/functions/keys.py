"""Derived keys and small scalar rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faresight.constants import AIRLINE_PLACEHOLDER


def route_key(dep="depart_airport", arr="arrival_airport") -> Column:
    """``dep || '_' || arr``; null if either side is null (SQL ``||`` semantics, not ``concat_ws``)."""
    return F.concat(F.col(dep), F.lit("_"), F.col(arr))


def airline_or_placeholder(c="airline") -> Column:
    return F.coalesce(F.col(c), F.lit(AIRLINE_PLACEHOLDER))


def option_id(*cols: str) -> Column:
    """``seat.airline.agency.fare_class`` — callers drop rows with a null part first."""
    return F.concat_ws(".", *[F.col(c) for c in cols])


def bool_text(c) -> Column:
    """Python-style ``True`` / ``False`` text of a boolean."""
    return F.initcap(F.col(c).cast("string"))


def null_safe_true(pred: Column) -> Column:
    """A predicate with null read as false (SQL DELETE leaves rows whose predicate is null)."""
    return F.coalesce(pred, F.lit(False))
