"""Per-user measures behind the statistics and mining tags.

Each is one ``groupBy(user).agg(...)``: Spark aggregates partially on the
map side, so the shuffle carries one row per (map task, user) whatever the
skew of a single user.  Money is summed as ``decimal(18,2)`` (exact, order
independent) and handed on as double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.dates import as_of_date
from kestrel.functions.scoring import score


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


MONEY = "decimal(18,2)"


def cents(amount) -> Column:
    """A money amount with at most two decimals as whole cents (long)."""
    return F.round(_c(amount).cast("double") * 100).cast("long")


def rfm_measures(orders: DataFrame, *, user: str, order_id: str, amount: str, ts: str,
                 as_of=None, in_cents: bool = False) -> DataFrame:
    """``(userId, recency, frequency, monetary)``.

    recency = days from the latest order to ``as_of``; frequency = number of
    orders; monetary = order total, summed exactly: as ``decimal(18,2)``, or
    with ``in_cents=True`` (amounts with at most two decimals) as long cents,
    the same sum in plain long arithmetic.
    """
    money = F.sum(cents(amount)) if in_cents else F.sum(_c(amount).cast(MONEY))
    g = (orders.groupBy(_c(user).alias("userId"))
         .agg(F.max(F.to_date(_c(ts))).alias("__last"),
              F.count(_c(order_id)).alias("frequency"),
              money.alias("__m")))
    monetary = (F.col("__m").cast("double") / F.lit(100.0)) if in_cents else F.col("__m").cast("double")
    return g.select("userId",
                    F.datediff(as_of_date(as_of), F.col("__last")).cast("long").alias("recency"),
                    "frequency", monetary.alias("monetary"))


def rfe_measures(events: DataFrame, *, user: str, ts: str, page: str,
                 recency_ts: Column | None = None, as_of=None, shift_days: int = 0,
                 approx_rsd: float | None = None) -> DataFrame:
    """``(userId, recency, frequency, engagements)``.

    recency = days from the latest visit (or the latest ``recency_ts`` when
    given, e.g. only purchases) to ``as_of - shift_days``; frequency = visits;
    engagements = distinct pages (exact ``count(DISTINCT)``, which Spark runs
    as two aggregations keyed first on (user, page), so a heavy user is spread
    over many tasks).  With ``approx_rsd`` the count is a HyperLogLog++
    estimate with that relative error: one aggregation, no (user, page)
    shuffle.
    """
    last = F.max(F.to_date(recency_ts if recency_ts is not None else _c(ts)))
    distinct = (F.countDistinct(_c(page)) if approx_rsd is None
                else F.approx_count_distinct(_c(page), approx_rsd))
    g = (events.groupBy(_c(user).alias("userId"))
         .agg(last.alias("__last"),
              F.count(F.lit(1)).alias("frequency"),
              distinct.alias("engagements")))
    ref = F.date_sub(as_of_date(as_of), shift_days) if shift_days else as_of_date(as_of)
    return g.select("userId", F.datediff(ref, F.col("__last")).cast("long").alias("recency"),
                    "frequency", "engagements")


def score_measures(measures: DataFrame, tables: dict, strict: bool = False) -> DataFrame:
    """Replace each measure column named in ``tables`` by ``<name>_score``."""
    cols = [F.col("userId")]
    for name, buckets in tables.items():
        cols.append(score(F.col(name), buckets, strict).alias(f"{name[0]}_score"))
    return measures.select(*cols)


# Fixed value: price-sensitivity score of a user with no discount at all.
PSM_NULL_DEFAULT = 1e-8


def psm_partial_sums(lines: DataFrame, keys: list, *, amount: Column, coupon: Column,
                     cents: bool = False) -> DataFrame:
    """Per-key partial sums of price sensitivity: ``__n`` lines, ``__s``
    discounted lines, ``__ra`` receivable (amount + coupon), ``__da`` coupon.

    All sums are exact (integer cents, or ``decimal(18,2)``), so partial sums
    can be summed again at a coarser key with the same result; e.g. sum per
    order before joining the orders, then per user.
    """
    if cents:
        a, c = amount.cast("long"), coupon.cast("long")
    else:
        a, c = amount.cast(MONEY), coupon.cast(MONEY)
    return (lines.groupBy(*[_c(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("__n"),
                 F.sum(F.when(c != 0, 1).otherwise(0)).alias("__s"),
                 F.sum(a + c).alias("__ra"),
                 F.sum(c).alias("__da")))


def psm_from_sums(sums: DataFrame, *, user: str, cents: bool = False,
                  null_default: float | None = PSM_NULL_DEFAULT) -> DataFrame:
    """``(userId, tdonr, tdar, adar, psm)`` from partial sums (see
    :func:`psm_partial_sums`) carrying a ``user`` column."""
    as_money = ((lambda c: c.cast("double") / F.lit(100.0)) if cents
                else (lambda c: c.cast("double")))
    g = (sums.groupBy(_c(user).alias("userId"))
         .agg(F.sum("__n").alias("__n"), F.sum("__s").alias("__s"),
              as_money(F.sum("__ra")).alias("__ra"), as_money(F.sum("__da")).alias("__da")))
    n = F.col("__n").cast("double")
    s = F.col("__s").cast("double")
    tdonr = F.try_divide(s, n)
    tdar = F.try_divide(F.col("__da"), F.col("__ra"))
    adar = F.try_divide(F.try_divide(F.col("__da"), s), F.try_divide(F.col("__ra"), n))
    psm = tdonr + tdar + adar
    if null_default is not None:
        psm = F.coalesce(psm, F.lit(float(null_default)))
    return g.select("userId", tdonr.alias("tdonr"), tdar.alias("tdar"), adar.alias("adar"),
                    psm.alias("psm"))


def psm_measures(lines: DataFrame, *, user: str, order_id: str, amount: Column, coupon: Column,
                 null_default: float | None = PSM_NULL_DEFAULT, cents: bool = False) -> DataFrame:
    """Price sensitivity ``(userId, tdonr, tdar, adar, psm)`` from order lines.

    ra (receivable) = amount + coupon; da = coupon; state = coupon != 0.
    tdonr = discounted orders / orders, tdar = sum(da) / sum(ra),
    adar = (sum(da) / discounted orders) / (sum(ra) / orders);
    psm = tdonr + tdar + adar, null (no discounted order) -> ``null_default``.
    A zero divisor gives null, not an error.

    Money is summed exactly: as ``decimal(18,2)``, or with ``cents=True`` as
    long integer cents (the caller passes cents; same sums, but plain long
    arithmetic inside whole-stage codegen instead of wide decimals).
    """
    lines = lines.where(_c(order_id).isNotNull())
    sums = psm_partial_sums(lines, [_c(user).alias("__user")], amount=amount, coupon=coupon,
                            cents=cents)
    return psm_from_sums(sums, user="__user", cents=cents, null_default=null_default)


def most_frequent(df: DataFrame, *, user: str, value: str, out: str | None = None) -> DataFrame:
    """``(userId, out)``: each user's most frequent value; ties go to the smallest value.

    Two aggregations: count per (user, value), then per user the minimum of
    ``struct(-count, value)``.  Both aggregate partially before their
    shuffle, so no task ever holds all rows of one user.
    """
    out = out or value
    counts = df.groupBy(_c(user).alias("userId"), _c(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    best = counts.groupBy("userId").agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col("__v").alias("v"))).alias("__b"))
    return best.select("userId", F.col("__b.v").alias(out))


def share_counts(labelled: DataFrame, *, user: str = "userId", label: str = "label") -> DataFrame:
    """``(userId, total, male_total, female_total)`` from 0/1 line labels."""
    return (labelled.groupBy(_c(user).alias("userId"))
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col(label) == 0).alias("male_total"),
                 F.count_if(F.col(label) == 1).alias("female_total")))


def share_partials(labelled: DataFrame, keys: list, *, label: str = "label") -> DataFrame:
    """The same counts per ``keys`` (e.g. per order), to be summed per user
    later with :func:`share_from_partials`."""
    return (labelled.groupBy(*[_c(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col(label) == 0).alias("male_total"),
                 F.count_if(F.col(label) == 1).alias("female_total")))


def share_from_partials(partials: DataFrame, *, user: str) -> DataFrame:
    return (partials.groupBy(_c(user).alias("userId"))
            .agg(F.sum("total").alias("total"), F.sum("male_total").alias("male_total"),
                 F.sum("female_total").alias("female_total")))


# Fixed value: share of lines that decides a purchase gender.
GENDER_SHARE = 0.6


def share_rule(total: Column, male: Column, female: Column, share: float = GENDER_SHARE) -> Column:
    """Rule text of the purchase-gender tag: ``0`` male, ``1`` female, ``-1`` neutral."""
    t = total.cast("double")
    return (F.when(male.cast("double") / t >= share, F.lit("0"))
            .when(female.cast("double") / t >= share, F.lit("1"))
            .otherwise(F.lit("-1")))
