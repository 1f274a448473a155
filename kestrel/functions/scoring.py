"""Threshold scoring: map a measure onto a 1..5 score with a bucket table.

A bucket table is a list of ``(low, high, score)`` with inclusive ends, as the
scores are written in the tag specifications, or ``(low, high, score, True)``
when ``high`` itself is excluded (a ``< high`` rule).  ``low`` or ``high`` may
be ``None`` for an open end.  Scores are doubles, the form the clustering
step takes them in.

* ``strict=True`` keeps the closed ranges exactly, so a value that falls in a
  hole between two ranges (or below the first) scores null;
* ``strict=False`` (the default) turns the table into half-open buckets: each
  range runs from its own ``low`` up to the next range's ``low``; the first
  range also takes everything below it and the last everything above.

Both build one ``CASE WHEN`` chain, evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score tables of the customer-value (RFM) and activity (RFE)
# tag specifications, inclusive ranges as written there.
RFM_RECENCY = [(1, 3, 5), (4, 6, 4), (7, 9, 3), (10, 15, 2), (16, None, 1)]
RFM_FREQUENCY = [(1, 49, 1), (50, 99, 2), (100, 149, 3), (150, 199, 4), (200, None, 5)]
RFM_MONETARY = [(None, 10000, 1, True), (10000, 49999, 2), (50000, 99999, 3),
                (100000, 199999, 4), (200000, None, 5)]
RFE_RECENCY = [(1, 15, 5), (16, 30, 4), (31, 45, 3), (46, 60, 2), (61, None, 1)]
RFE_FREQUENCY = [(None, 99, 1), (100, 199, 2), (200, 299, 3), (300, 399, 4), (400, None, 5)]
RFE_ENGAGEMENT = [(None, 49, 1, True), (50, 149, 2), (150, 199, 3), (200, 249, 4), (250, None, 5)]
# Days subtracted from the evaluation date before measuring RFE recency.
RFE_RECENCY_SHIFT_DAYS = 200


def score(value: Column, buckets, strict: bool = False) -> Column:
    """CASE chain scoring ``value`` with the bucket table (see module doc)."""
    ordered = _ordered(buckets)
    expr = None
    for i, (lo, hi, s, hi_excl) in enumerate(ordered):
        s = float(s)
        if strict:
            cond = F.lit(True)
            if lo is not None:
                cond = cond & (value >= F.lit(lo))
            if hi is not None:
                cond = cond & ((value < F.lit(hi)) if hi_excl else (value <= F.lit(hi)))
        else:
            nxt = ordered[i + 1][0] if i + 1 < len(ordered) else None
            cond = F.lit(True) if nxt is None else (value < F.lit(nxt))
        expr = F.when(cond, F.lit(s)) if expr is None else expr.when(cond, F.lit(s))
    # A null measure scores null in both modes.
    return F.when(value.isNull(), F.lit(None).cast("double")).otherwise(expr)


def _ordered(buckets):
    if not buckets:
        raise ValueError("empty bucket table")
    rows = [tuple(b) + (False,) * (4 - len(b)) for b in buckets]
    return sorted(rows, key=lambda b: float("-inf") if b[0] is None else b[0])
