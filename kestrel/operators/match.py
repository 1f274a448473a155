"""Labelling a business column with attribute tags.

Attribute tags are level-5 rows of the tag catalog, ``(id, name, rule, level)``.
Their ``rule`` is a literal value, a ``start-end`` range or a rank.

* ``rule_table`` / ``range_table`` turn the level-5 rows into small lookup
  tables (never collected to the driver);
* ``rule_match`` is an equi join of the business column with the rule table;
* ``range_match`` finds the range that contains a value.

The lookup side is broadcast behind a row-count check
(:mod:`kestrel.operators.broadcast`); beyond it the joins stay shuffle joins.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.text import range_end, range_start
from kestrel.operators.broadcast import MAX_BROADCAST_ROWS, checked_broadcast

ATTRIBUTE_LEVEL = 5
BUSINESS_LEVEL = 4
ON_UNMATCHED = ("drop", "null", "error")
FEW_RANGES = 48  # ranges that one CASE chain tests
MANY_RANGES = 20_000  # ranges that literal arrays hold


def rule_table(tags: DataFrame) -> DataFrame:
    """Level-5 rows -> ``(rule, name)``, one row per rule.

    When two attribute tags share a rule the smallest name wins, so the
    result does not depend on row order.
    """
    return (tags.where(F.col("level") == ATTRIBUTE_LEVEL)
            .where(F.col("rule").isNotNull())
            .groupBy(F.trim(F.col("rule")).alias("rule"))
            .agg(F.min("name").alias("name")))


def range_table(tags: DataFrame) -> DataFrame:
    """Level-5 range rules -> ``(name, start, end)`` with integer bounds."""
    return (tags.where(F.col("level") == ATTRIBUTE_LEVEL)
            .select("name", range_start("rule").alias("start"), range_end("rule").alias("end")))


def rule_match(biz: DataFrame, field: str, tags: DataFrame, *, key: str = "id",
               out: str | None = None, on_unmatched: str = "drop",
               max_rules: int = MAX_BROADCAST_ROWS, keep: list[str] = ()) -> DataFrame:
    """``(userId, out)``: the attribute tag whose rule equals ``biz[field]``.

    Columns listed in ``keep`` are carried through from ``biz``.

    ``on_unmatched``: ``drop`` removes users whose value has no rule (inner
    join), ``null`` keeps them with a null tag, ``error`` fails the job at the
    first such row (``raise_error``, evaluated on the executors).
    """
    if on_unmatched not in ON_UNMATCHED:
        raise ValueError(f"on_unmatched must be one of {ON_UNMATCHED}")
    out = out or field
    rules = checked_broadcast(rule_table(tags), max_rules)
    left = biz.select(F.col(key).alias("userId"), *[F.col(c) for c in keep],
                      F.trim(F.col(field).cast("string")).alias("__v"))
    how = "inner" if on_unmatched == "drop" else "left"
    j = left.join(rules, left["__v"] == rules["rule"], how)
    name = F.col("name")
    if on_unmatched == "error":
        name = F.when(name.isNull() & F.col("__v").isNotNull(),
                      F.raise_error(F.concat(F.lit(f"no attribute tag for {field} = "),
                                             F.col("__v")))).otherwise(name)
    return j.select("userId", *keep, name.alias(out))


def disjoint(ranges: list[tuple]) -> list[tuple]:
    """``(start, end, name)`` ranges, None for an open end, as sorted ranges that don't
    overlap: where several hold a value, the one that starts first wins, then the smallest
    name."""
    low, high = -(1 << 63), (1 << 63) - 1
    closed = sorted((low if a is None else a, name, high if b is None else b) for a, b, name in ranges)
    edges = sorted({a for a, _, _ in closed} | {b + 1 for _, _, b in closed if b < high})
    out, live, k = [], [], 0
    for i, edge in enumerate(edges):
        while k < len(closed) and closed[k][0] <= edge:
            heapq.heappush(live, closed[k])
            k += 1
        while live and live[0][2] < edge:
            heapq.heappop(live)
        if live:
            stop = edges[i + 1] - 1 if i + 1 < len(edges) else high
            if out and out[-1][2] == live[0][1] and out[-1][1] == edge - 1:
                out[-1] = (out[-1][0], stop, live[0][1])
            else:
                out.append((edge, stop, live[0][1]))
    return out


def _searched(value: Column, ranges: list[tuple]) -> Column:
    """The name of the range that holds a long: a binary search over the sorted starts.

    The table is three literal arrays; the search is a fold over the powers of two, which
    stays in the JVM and needs no join.
    """
    def table(values, kind):
        return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")

    starts, ends, names = (table([r[k] for r in ranges], kind) for k, kind in enumerate(("bigint", "bigint", "string")))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(ranges).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(ranges)) & (F.get(starts, at + step - 1) <= value), at + step).otherwise(at))
    return F.transform(F.array(at), lambda i: F.when(F.get(ends, i - 1) >= value, F.get(names, i - 1)))[0]


def range_match(biz: DataFrame, value, tags_or_ranges: DataFrame, *, key: str = "id",
                out: str = "tag", on_unmatched: str = "drop",
                few: int = FEW_RANGES, many: int = MANY_RANGES) -> DataFrame:
    """``(userId, out)``: the range tag whose ``[start, end]`` holds ``value``.

    ``tags_or_ranges`` is either catalog rows (level-5 range rules) or a range
    table ``(name, start, end)``, where a null bound is an open end.  Where ranges overlap,
    the one that starts first wins, then the smallest name, so a user gets one tag.  A malformed
    range (a rule without bounds, or an end before its start) fails the call.

    Up to ``few`` ranges become one ``CASE`` chain, up to ``many`` a binary search over
    literal arrays, both without a join.  More are
    joined by equality: a range lies in at most three buckets of its own length
    class (a power of two), and each distinct value looks into one bucket a
    class, so neither a wide range nor an open-ended one is copied often.
    """
    if on_unmatched not in ("drop", "null"):
        raise ValueError("range_match supports on_unmatched 'drop' or 'null'")
    rules = "start" not in tags_or_ranges.columns
    ranges = range_table(tags_or_ranges.where(F.col("rule").isNotNull())) if rules else tags_or_ranges
    ranges = ranges.select("name", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    v = (F.col(value) if isinstance(value, str) else value).cast("long")
    left = biz.select(F.col(key).alias("userId"), v.alias("__v"))
    good = F.coalesce(F.col("start") <= F.col("end"), F.lit(not rules))
    listed = ranges.select("start", "end", "name", good.alias("good")).limit(many + 1).collect()
    bad = [r["name"] for r in listed if not r["good"]]
    if len(listed) > many and not bad:
        bad = [r["name"] for r in ranges.where(~good).select("name").take(1)]
    if bad:
        raise ValueError(f"range rule of tag {bad[0]!r} is not 'start-end'")
    if len(listed) <= many:
        table = disjoint([(r["start"], r["end"], r["name"]) for r in listed])
        if len(table) <= few:
            found = F.lit(None).cast("string")
            for start, end, name in reversed(table):
                found = F.when(F.col("__v").between(start, end), F.lit(name)).otherwise(found)
        else:
            found = _searched(F.col("__v"), table)
        tagged = left.select("userId", found.alias(out))
        return tagged.where(F.col(out).isNotNull()) if on_unmatched == "drop" else tagged

    ranges = ranges.select("name", F.coalesce("start", F.lit(-(1 << 63))).alias("start"),
                           F.coalesce("end", F.lit((1 << 63) - 1)).alias("end"))
    # class c: the smallest power of two that is at least the range's length (as a double: the
    # length of an open range is beyond a long)
    cls = F.ceil(F.log2(F.col("end").cast("double") - F.col("start").cast("double") + 1.0)).cast("int")
    width = F.pow(F.lit(2.0), F.col("c"))
    first = F.floor(F.col("start").cast("double") / width)
    classed = ranges.withColumn("c", cls)
    cells = classed.withColumn("b", F.explode(F.array_distinct(F.array(
        first, F.try_add(first, F.lit(1).cast("long")), F.floor(F.col("end").cast("double") / width)))))
    classes = [r["c"] for r in classed.select("c").distinct().collect()]  # 65 at most
    values = left.select("__v").where(F.col("__v").isNotNull()).distinct()
    looks = values.withColumn("c", F.explode(F.array(*[F.lit(c) for c in sorted(classes)]))).withColumn(
        "b", F.floor(F.col("__v").cast("double") / width))
    found = (looks.join(cells, ["c", "b"]).where(F.col("__v").between(F.col("start"), F.col("end")))
             .groupBy("__v").agg(F.min(F.struct("start", "name"))["name"].alias(out)))
    return left.join(found, "__v", "inner" if on_unmatched == "drop" else "left").select("userId", out)


def label_by_rank(pred: DataFrame, ranks: DataFrame, tags: DataFrame, *,
                  prediction: str = "prediction", out: str = "tag",
                  key: str = "userId") -> DataFrame:
    """Cluster -> tag name.  ``ranks`` is ``(cluster, rank)`` (see
    :func:`kestrel.operators.ml.rank_centers`); the attribute tag whose rule
    is the rank's text names the cluster."""
    lookup = (ranks.join(rule_table(tags), F.col("rank").cast("string") == F.col("rule"))
              .select(F.col("cluster"), F.col("name")))
    lookup = checked_broadcast(lookup)
    return (pred.join(lookup, pred[prediction] == lookup["cluster"], "left")
            .select(F.col(key).alias("userId"), F.col("name").alias(out)))
