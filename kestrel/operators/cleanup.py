"""Row clean-up used by the loaders and the models.

* ``dict_encode``: name -> id from a dimension table, unknown -> 0;
* ``mean_impute``: nulls of a column replaced by its mean, rounded;
* ``clean_orders``: the order clean-up rules.  Where a rule picks a random
  replacement, the pick here is a hash of the row key, so reruns (and task
  retries after an executor loss) give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.dates import shift_epoch_days_midnight
from kestrel.operators.broadcast import checked_broadcast


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dict_encode(df: DataFrame, column: str, dim: DataFrame, *, dim_id: str = "id",
                dim_name: str = "name", out: str | None = None, unknown: int = 0) -> DataFrame:
    """Add ``out``: the dimension id of ``df[column]``, ``unknown`` when absent.

    The dimension is broadcast behind a size check (one row per distinct
    name, deduplicated by the smallest id).
    """
    out = out or f"{column}_id"
    d = (dim.groupBy(F.col(dim_name).alias("__name")).agg(F.min(dim_id).alias("__id")))
    d = checked_broadcast(d)
    return (df.join(d, df[column] == d["__name"], "left")
            .withColumn(out, F.coalesce(F.col("__id").cast("int"), F.lit(unknown)))
            .drop("__name", "__id"))


def mean_impute(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """Nulls in ``columns`` -> the column mean rounded to ``digits``.

    One aggregation job returns one row of means (bounded), then a lazy fill.
    """
    means = df.agg(*[F.round(F.avg(c), digits).alias(c) for c in columns]).first().asDict()
    return df.fillna({c: v for c, v in means.items() if v is not None})


# The multiplier and modulus of the MINSTD (Lehmer) generator.
LEHMER_A = 48271
LEHMER_M = 2147483647


def lehmer_step(x: Column) -> Column:
    """One MINSTD step on a non-negative long; stays below 2^31 (no overflow)."""
    return F.pmod(F.pmod(x, F.lit(LEHMER_M)) * F.lit(LEHMER_A), F.lit(LEHMER_M))


def hash_pick(key: Column, n: int, offset: int = 1, steps: int = 1) -> Column:
    """Deterministic pick in ``offset .. offset + n - 1`` from an integer row key.

    Plain integer arithmetic, so reruns, task retries and a SQL engine all
    give the same pick.
    """
    x = key.cast("long")
    for _ in range(steps):
        x = lehmer_step(x)
    return (F.pmod(x, F.lit(n)) + F.lit(offset)).cast("long")


# Payment codes and names of the shop's orders.
PAY_CODES = ["alipay", "wxpay", "chinapay", "cod"]
PAY_NAMES = {"alipay": "支付宝", "wxpay": "微信支付", "chinapay": "银联支付", "cod": "货到付款"}
# Fixed value: days added to an order's finish time by the clean-up.
FINISH_SHIFT_DAYS = 350


def clean_orders(orders: DataFrame, *, key: str, member: str, pay_code: str, finish: str,
                 member_limit: int,
                 pay_codes=PAY_CODES, pay_names=PAY_NAMES,
                 shift_days: int = FINISH_SHIFT_DAYS, tz: str | None = None) -> DataFrame:
    """Order clean-up.

    * member id ``>= member_limit`` -> ``1 .. member_limit`` (hash of the key);
    * payment code not in ``pay_codes`` -> one of them (hash of the key);
    * payment name looked up from the code;
    * finish time (epoch seconds) + ``shift_days``, truncated to midnight
      (of the session zone, or of ``tz``).
    """
    codes = F.array(*[F.lit(c) for c in pay_codes])
    k = _c(key)
    member_c = F.when(_c(member).cast("long") >= member_limit, hash_pick(k, member_limit)).otherwise(
        _c(member).cast("long"))
    code_c = F.when(_c(pay_code).isin(*pay_codes), _c(pay_code)).otherwise(
        F.element_at(codes, hash_pick(k, len(pay_codes), steps=2).cast("int")))
    names = F.create_map(*[x for c in pay_codes for x in (F.lit(c), F.lit(pay_names.get(c, c)))])
    return (orders.withColumn(member, member_c)
            .withColumn(pay_code, code_c)
            .withColumn("paymentname", names[F.col(pay_code)])
            .withColumn(finish, shift_epoch_days_midnight(_c(finish), shift_days, tz)))
