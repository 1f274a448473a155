"""Predicates given as text in a business rule.

* condition list ``field[op]value,field[op]value`` (``op`` in eq ne gt lt ge
  le, any case), ANDed, compared as strings like cells of a wide table; where a
  column's type compares alike (see :meth:`Condition.typed`) the value is turned
  into that type, so row-group statistics can skip what does not match;
* relative date window ``field#unit#n`` (see
  :func:`kestrel.functions.dates.relative_window`).

Both become ordinary Column predicates, so Catalyst pushes them into the
parquet / JDBC scan.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kestrel.functions.dates import relative_window

# The comparison names of a condition string.
OPERATORS = {
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "lt": lambda c, v: c < v,
    "ge": lambda c, v: c >= v,
    "le": lambda c, v: c <= v,
}

_COND = re.compile(r"^\s*(?P<field>[^\[\]]+?)\s*\[(?P<op>[A-Za-z]{2})\]\s*(?P<value>.*?)\s*$")


_DAY = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_SECOND = re.compile(r"^\d{4}-\d{2}-\d{2} ([01]\d|2[0-3]):[0-5]\d:[0-5]\d$")
_WHOLE = re.compile(r"^(0|-?[1-9]\d{0,17})$")


def _is_day(text: str) -> bool:
    try:
        return dt.date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


@dataclass(frozen=True)
class Condition:
    field: str
    op: str
    value: str

    @classmethod
    def parse(cls, text: str) -> "Condition":
        m = _COND.match(text)
        if not m or m.group("op").lower() not in OPERATORS:
            raise ValueError(f"bad condition {text!r}: expected field[op]value")
        return cls(m.group("field"), m.group("op").lower(), m.group("value"))

    def typed(self, field_type: str | None) -> Column | None:
        """The comparison in the column's own type, where that gives what comparing text
        gives; else None.

        Dates and zone-free timestamps are written in order of time, a time of day behind
        its date.  Whole numbers are only equal alike: as text, 10 is below 9.
        """
        c, v = F.col(self.field), self.value
        if field_type == "date" and _DAY.match(v) and _is_day(v):
            return OPERATORS[self.op](c, F.lit(v).cast("date"))
        if field_type == "timestamp_ntz" and _is_day(v[:10]):
            if _SECOND.match(v):
                return OPERATORS[self.op](c, F.lit(v).cast("timestamp_ntz"))
            if _DAY.match(v):
                # every time of the day, midnight too, is written longer than the day alone
                midnight = F.lit(v).cast("timestamp_ntz")
                return {"ge": c >= midnight, "gt": c >= midnight, "lt": c < midnight, "le": c < midnight,
                        "eq": F.lit(False), "ne": F.lit(True)}[self.op]
        if field_type in ("tinyint", "smallint", "int", "bigint") and self.op in ("eq", "ne") and _WHOLE.match(v):
            return OPERATORS[self.op](c, F.lit(int(v)))
        return None

    def column(self, missing_passes: bool = True, field_type: str | None = None) -> Column:
        c, pred = F.col(self.field), self.typed(field_type)
        if pred is None:
            pred = OPERATORS[self.op](c.cast("string"), F.lit(self.value))
        # A row lacking the field passes unless told otherwise.
        return (c.isNull() | pred) if missing_passes else (c.isNotNull() & pred)


def parse_conditions(text: str | None) -> list[Condition]:
    if not text or not text.strip():
        return []
    return [Condition.parse(p) for p in text.split(",") if p.strip()]


def conditions_predicate(text: str | None, missing_passes: bool = True, df=None) -> Column | None:
    """The conditions, ANDed; None when there are none.  With the DataFrame they are built
    for its columns' types."""
    conds = parse_conditions(text)
    if not conds:
        return None
    types = dict(df.dtypes) if df is not None else {}
    return reduce(lambda a, b: a & b, [c.column(missing_passes, types.get(c.field)) for c in conds])


def where_condition_predicate(text: str | None, as_of=None, df=None) -> Column | None:
    """``field#unit#n`` -> relative date window; None when absent.

    With the DataFrame the window is built for the column's type, so a date
    or timestamp column gets a predicate the scan can push down.
    """
    if not text or not text.strip():
        return None
    parts = text.strip().split("#")
    if len(parts) != 3:
        raise ValueError(f"bad date condition {text!r}: expected field#unit#n")
    field, unit, n = parts
    field_type = dict(df.dtypes).get(field.strip()) if df is not None else None
    return relative_window(F.col(field.strip()), unit, int(n), as_of, field_type)
