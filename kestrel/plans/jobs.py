"""Run one tag model by tag id: the template with a named model.

    python -m kestrel.plans.jobs --catalog <parquet of tags> --tag 318 \\
        --model gender --profile <shared folder> [--as-of 2020-07-13] [--base <folder>]

The catalog holds ``(id, name, rule, level, pid)``; the business tag's rule
says where its data lives (see :mod:`kestrel.sources.meta`).  Column names
default to those of the shop's wide tables and can be overridden with
``--param key=value``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators import ml
from kestrel.operators.broadcast import checked_broadcast
from kestrel.plans import models


def _rule_model(field: str):
    def compute(biz: DataFrame, tags: DataFrame, key: str = "id", out: str | None = None,
                on_unmatched: str = "drop", **_):
        return models.match_tag(biz, tags, field, key=key, out=out or field, on_unmatched=on_unmatched)
    return compute


def _age(biz, tags, key="id", birthday="birthday", out="agerange", **_):
    return models.age_band_tag(biz, tags, key=key, birthday=birthday, out=out)


def _cycle(biz, tags, user="memberid", finishtime="finishtime", as_of=None, out="consumecycle", **_):
    return models.consume_cycle_tag(biz, tags, user=user, finish_epoch=finishtime, as_of=as_of, out=out)


def _pay(biz, tags, user="memberid", code="paymentcode", out="paymenttype", **_):
    return models.pay_type_tag(biz, tags, user=user, code=code, out=out)


def _rfm(biz, tags, as_of=None, **kw):
    return models.rfm_tag(biz, tags, as_of=as_of, **{"sweep": None, **kw})


def _rfm_scaled(biz, tags, as_of=None, **kw):
    return models.rfm_tag(biz, tags, as_of=as_of, **{"scale": True, "sweep": (10, 20, 50), **kw})


def _rfe(biz, tags, as_of=None, **kw):
    return models.rfe_tag(biz, tags, as_of=as_of, **kw)


def _psm(biz, tags, user="memberid", order_id="ordersn", amount="orderamount",
         coupon="couponcodevalue", **kw):
    return models.psm_tag(biz, tags, user=user, order_id=order_id, amount=F.col(amount),
                          coupon=F.col(coupon), **kw)


def _usg_lines(biz, user, colour, kind, female_colours, female_kinds):
    """Order lines labelled 1 where the goods' colour or type is in a female list."""
    colours = [c.strip() for c in female_colours.split(",") if c.strip()]
    kinds = [c.strip() for c in female_kinds.split(",") if c.strip()]
    female = F.col(colour).isin(*colours) | F.col(kind).isin(*kinds)
    return biz.select(F.col(user).alias("userId"), F.col(colour).alias("colour"), F.col(kind).alias("kind"),
                      F.when(female, 1).otherwise(0).alias("label"))


def _named(biz, column, table):
    """``biz`` with the codes of ``column`` replaced by the names of a dimension table
    (parquet of id, name); codes without a name stay as they are."""
    if not table:
        return biz
    names = biz.sparkSession.read.parquet(table).select(
        F.col("id").cast("string").alias("__id"), F.col("name").alias("__name")).dropDuplicates(["__id"])
    j = biz.join(checked_broadcast(names), F.col(column).cast("string") == F.col("__id"), "left")
    return j.withColumn(column, F.coalesce("__name", F.col(column).cast("string"))).drop("__id", "__name")


def _usg(biz, tags, user="memberid", colour="ogcolor", kind="producttype", female_colours="",
         female_kinds="", colour_table=None, kind_table=None, learned=False, share=0.6, store=None, **_):
    """Purchase gender by rules, or with ``learned`` by a tree fitted to the rules' labels."""
    biz = _named(_named(biz, colour, colour_table), kind, kind_table)
    lines = _usg_lines(biz, user, colour, kind, female_colours, female_kinds)
    if learned:
        return models.usg_learned_tag(lines, tags, categorical=["colour", "kind"], store=store)
    return models.usg_rule_tag(lines, tags, share=share)


def _usg_learned(biz, tags, **kw):
    return _usg(biz, tags, **{**kw, "learned": True})


def _bp(biz, tags, user="global_user_id", url="loc_url", **kw):
    return models.preference_tag(biz, user=user, url=url, **kw)


# Model name -> compute(business_df, tag_df, **params) -> (userId, tag column)
MODELS = {
    "gender": _rule_model("gender"),
    "job": _rule_model("job"),
    "nationality": _rule_model("nationality"),
    "political": _rule_model("politicalface"),
    "age_range": _age,
    "consume_cycle": _cycle,
    "pay_type": _pay,
    "rfm": _rfm,
    "rfm_scaled": _rfm_scaled,
    "rfe": _rfe,
    "psm": _psm,
    "usg": _usg,
    "usg_learned": _usg_learned,
    "preference": _bp,
}
# Models that take the evaluation date.
DATED = {"consume_cycle", "rfm", "rfm_scaled", "rfe"}
# Models that load or save a fitted model when a model folder is given.
FITTED = {"rfm", "rfm_scaled", "rfe", "psm", "usg_learned"}


def run(spark, catalog: DataFrame, tag_id: int, model: str, *, store=None, as_of=None,
        base: str | None = None, model_root: str | None = None, **params) -> DataFrame:
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; one of {sorted(MODELS)}")
    fn = MODELS[model]
    if model_root and model in FITTED:
        params["store"] = ml.ModelStore(model_root)
    if model in DATED:
        params["as_of"] = as_of
    return models.run_tag_model(spark, catalog, tag_id, lambda biz, tags: fn(biz, tags, **params),
                                store=store, as_of=as_of, base=base)


def _typed(text: str):
    """A job parameter: an integer, a decimal number, true or false, else text."""
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def main(argv=None):
    from pyspark.sql import SparkSession

    from kestrel.operators.bucket_store import BucketStore
    from kestrel.operators.profile import ProfileStore, TagColumnStore

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--catalog", required=True, help="parquet folder of tag rows")
    ap.add_argument("--tag", type=int, required=True)
    ap.add_argument("--model", required=True, choices=sorted(MODELS))
    ap.add_argument("--profile", required=True, help="shared folder of the profile versions")
    ap.add_argument("--layout", choices=("wide", "columns", "buckets"), default="columns",
                    help="one narrow table per tag, wide parquet versions, or wide copy-on-write buckets")
    ap.add_argument("--recommendations", default=None,
                    help="shared folder of the recommendation table; item preferences go there, not into the profile")
    ap.add_argument("--models", default=None, help="shared folder of fitted models")
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--base", default=None, help="folder of tables named by 'table=' rules")
    ap.add_argument("--param", action="append", default=[], help="key=value model parameter")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    params = {k: _typed(v) for k, v in (p.split("=", 1) for p in a.param)}
    if a.model == "preference" and a.recommendations:
        # a table of its own, of which a run replaces the users it recommends to
        store = BucketStore(spark, a.recommendations, replace=True)
    else:
        store = {"wide": ProfileStore, "columns": TagColumnStore, "buckets": BucketStore}[a.layout](spark, a.profile)
    run(spark, spark.read.parquet(a.catalog), a.tag, a.model, store=store, as_of=a.as_of,
        base=a.base, model_root=a.models, **params)
    print("saved")


if __name__ == "__main__":
    main()
