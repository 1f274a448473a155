"""Broadcast only behind a size check.

``checked_broadcast`` counts at most ``max_rows + 1`` rows of the small side and
their bytes (a bounded job) and adds the broadcast hint only when the side is
within both bounds; otherwise the plain DataFrame is returned and the join
falls back to a shuffle join, which AQE may still convert at runtime from
real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rule, range and label tables hold one row per attribute tag (dozens);
# this bound leaves room and keeps a broadcast well under a few MB.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 << 20


def within(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
           max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (as JSON).

    A plan over in-memory literal rows only (``LocalRelation`` leaves, no
    join or generator that could multiply rows) is bounded by its leaves'
    row counts, known without running anything; otherwise one bounded job over
    at most ``max_rows + 1`` rows decides.
    """
    bound = _literal_bound(df)
    if bound is not None and bound <= max_rows:
        return True
    rows = df.limit(max_rows + 1).select(F.octet_length(F.to_json(F.struct(*df.columns))).alias("b"))
    n, size = rows.agg(F.count(F.lit(1)), F.sum("b")).first()
    return n <= max_rows and (size or 0) <= max_bytes


def _literal_bound(df: DataFrame) -> int | None:
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        text = plan.toString()
        if "Join" in text or "Generate" in text or "Expand" in text:
            return None
        leaves = plan.collectLeaves()
        total = 0
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.getClass().getSimpleName() != "LocalRelation":
                return None
            total += leaf.data().size()
        return total
    except Exception:  # plan API not reachable (e.g. a remote session): count instead
        return None


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if within(df, max_rows) else df
