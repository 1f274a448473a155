"""The tag models run on the shop tables (customer, orders, lineitem, part,
events, pages, nation, region, supplier, documents).

How the tag inputs map onto the tables:

* users: ``customer`` (``c_custkey``; ``c_mktsegment`` is the coded field);
* orders: ``orders`` (member ``o_custkey``, order ``o_orderkey``, amount
  ``o_totalprice``, finish time ``o_orderdate``, payment ``o_orderpriority``);
* order lines: ``lineitem`` joined to ``orders``, goods attributes from
  ``part`` (brand as colour, type as product type); a line's coupon is its
  discount when the discount is at least 10 %;
* visit logs: ``events`` (``user_id``, ``ts``; the ``props`` key is the page,
  purchases give recency);
* tag catalog: literal attribute rows below for the shop's tags, and a
  geography catalog derived from ``region`` / ``nation`` / ``customer``.

Thresholds are parameters of the operators; the values here fit the spread of
these tables (the tag specifications' own tables would put everyone in one
bucket) and are listed with the other fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.dates import ntz_epoch_micros
from kestrel.functions.text import extract_or_null
from kestrel.operators import catalog as cat
from kestrel.operators import cleanup, match, measures, profile
from kestrel.operators.broadcast import checked_broadcast
from kestrel.session import ensure_checkpoint_dir
from kestrel.sources.tables import Tables

# Fixed value: the tables hold wall-clock timestamps (timestamp_ntz); epoch
# values derived from them are UTC, whatever the session zone.
DATA_TZ = "UTC"
# Evaluation dates of the order and the event tables.
ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"

# Attribute tags of the shop catalog, (id, name, rule).
SEGMENT_TAG = 400
SEGMENT_RULES = [(401, "car owner", "AUTOMOBILE"), (402, "builder", "BUILDING"),
                 (403, "home maker", "FURNITURE"), (404, "engineer", "MACHINERY")]
FIRST_ORDER_TAG = 410
FIRST_ORDER_RULES = [(411, "early 1995", "19950101-19950630"),
                     (412, "late 1995", "19950701-19951231"),
                     (413, "1996", "19960101-19961231"), (414, "1997", "19970101-19971231"),
                     (415, "1998-1999", "19980101-19991231")]
CYCLE_TAG = 420
CYCLE_RULES = [(421, "within 54 days", "0-54"), (422, "within 123 days", "55-123"),
               (423, "within 219 days", "124-219"), (424, "within 390 days", "220-390")]
PRIORITY_TAG = 430
PRIORITY_RULES = [(431, "urgent", "1-URGENT"), (432, "high", "2-HIGH"),
                  (433, "medium", "3-MEDIUM"), (434, "unspecified", "4-NOT SPECIFIED"),
                  (435, "low", "5-LOW")]
RFM_TAG = 440
RFM_RULES = [(441, "top value", "0"), (442, "high value", "1"), (443, "mid value", "2"),
             (444, "low value", "3"), (445, "lowest value", "4")]
RFE_TAG = 450
RFE_RULES = [(451, "very active", "0"), (452, "active", "1"), (453, "quiet", "2"),
             (454, "dormant", "3")]
PSM_TAG = 460
PSM_RULES = [(461, "most sensitive", "0"), (462, "sensitive", "1"), (463, "neutral", "2"),
             (464, "insensitive", "3"), (465, "most insensitive", "4")]
USG_TAG = 470
USG_RULES = [(471, "male", "0"), (472, "female", "1"), (473, "neutral", "-1")]

# Score tables fitted to the shop data (inclusive ranges).
SHOP_RFM_RECENCY = [(None, 54, 5), (55, 123, 4), (124, 219, 3), (220, 390, 2), (391, None, 1)]
SHOP_RFM_FREQUENCY = [(None, 7, 1), (8, 9, 2), (10, 11, 3), (12, 13, 4), (14, None, 5)]
SHOP_RFM_MONETARY = [(None, 1710000, 1, True), (1710000, 2229999, 2), (2230000, 2669999, 3),
                     (2670000, 3249999, 4), (3250000, None, 5)]
SHOP_RFE_RECENCY = [(None, 1, 5), (2, 2, 4), (3, 4, 3), (5, 7, 2), (8, None, 1)]
SHOP_RFE_FREQUENCY = [(None, 59, 1), (60, 64, 2), (65, 69, 3), (70, 74, 4), (75, None, 5)]
SHOP_RFE_ENGAGEMENT = [(None, 44, 1, True), (45, 47, 2), (48, 50, 3), (51, 53, 4), (54, None, 5)]

# Closed ranges with holes that hold users (strict scoring).
SHOP_RFM_STRICT = {"recency": [(None, 40, 5), (55, 123, 4), (130, 219, 3), (220, 390, 2), (400, None, 1)],
                   "frequency": [(None, 6, 1), (8, 9, 2), (11, 11, 3), (12, 13, 4), (15, None, 5)],
                   "monetary": [(None, 1500000, 1, True), (1710000, 2229999, 2), (2300000, 2669999, 3),
                                (2670000, 3249999, 4), (3400000, None, 5)]}

# Goods that label an order line female (1), others male (0).
FEMALE_BRANDS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4"]
FEMALE_TYPES = ["PROMO", "SMALL"]
# Product-type dimension (STANDARD is missing on purpose: -> 0).
TYPE_DIM = [(1, "ECONOMY"), (2, "LARGE"), (3, "MEDIUM"), (4, "PROMO"), (5, "SMALL")]
# Fixed value: discount from which an order line counts as couponed.
COUPON_MIN_DISCOUNT = 0.10
# Fixed value: page-id pattern of the page URLs (language folder, then digits,
# then at least one more character).
PAGE_URL_PATTERN = r"^.+/[a-z]{2}/(\d+)(\.html)?.+$"
# Payment code of each order priority for the clean-up input.
PRIORITY_PAY = {"1-URGENT": "alipay", "2-HIGH": "wxpay", "3-MEDIUM": "chinapay",
                "4-NOT SPECIFIED": "cod"}
MEMBER_LIMIT = 1000
# Conditions of the filter queries.
ORDER_CONDITIONS = "o_orderstatus[eq]F,o_orderpriority[le]2-HIGH,o_orderdate[GE]1997-01-01"
ORDER_WINDOW = ("o_orderdate", "month", 6)
TOP_K = 20
# The nation tag of the single-tag queries; price bands; region bounds of the split export.
NATION_TAG = 1003
BAND_WIDTH, N_BANDS = 2500, 200
EXPORT_SPLITS = ["1", "25", "5", "7"]


def tag_rows(tag_id: int, name: str, rules, rule: str = "") -> list[tuple]:
    """Catalog rows ``(id, name, rule, level, pid)`` of one business tag."""
    return ([(tag_id, name, rule, 4, 300)] +
            [(i, n, r, 5, tag_id) for i, n, r in rules])


CATALOG_SCHEMA = "id long, name string, rule string, level int, pid long"


def shop_tags(spark: SparkSession, tag_id: int, name: str, rules) -> DataFrame:
    """Catalog rows of one tag as an in-memory literal table (a local relation,
    whose size the planner knows)."""
    import pandas as pd
    rows = pd.DataFrame(tag_rows(tag_id, name, rules), columns=["id", "name", "rule", "level", "pid"])
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


# ---------------------------------------------------------------- rule tags

def rule_match_inner(spark, sf_dir):
    """Segment tag (exact rule; customers without a rule get no row)."""
    from kestrel.plans.models import match_tag
    tags = shop_tags(spark, SEGMENT_TAG, "segment", SEGMENT_RULES)
    return match_tag(_t(spark, sf_dir).customer, tags, "c_mktsegment", key="c_custkey", out="segment")


def rule_match_left_default(spark, sf_dir):
    from kestrel.plans.models import match_tag
    tags = shop_tags(spark, SEGMENT_TAG, "segment", SEGMENT_RULES)
    return match_tag(_t(spark, sf_dir).customer, tags, "c_mktsegment", key="c_custkey", out="segment",
                     on_unmatched="null")


def age_range(spark, sf_dir):
    """First-order date as a ``yyyy-MM-dd`` string (the birthday input of the
    age model) -> yyyyMMdd int -> band; users outside every band get no row."""
    from kestrel.plans.models import age_band_tag
    first = (_t(spark, sf_dir).orders.groupBy("o_custkey")
             .agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first_order")))
    tags = shop_tags(spark, FIRST_ORDER_TAG, "first order", FIRST_ORDER_RULES)
    return age_band_tag(first, tags, key="o_custkey", birthday="first_order", out="first_order_band")


def consume_cycle(spark, sf_dir):
    """Days since the latest order (finish times as epoch seconds, as the
    cycle model takes them) -> cycle band; beyond the last band: no row."""
    from kestrel.plans.models import consume_cycle_tag
    o = _t(spark, sf_dir).orders.select("o_custkey", F.unix_timestamp("o_orderdate").alias("finish"))
    tags = shop_tags(spark, CYCLE_TAG, "consumption cycle", CYCLE_RULES)
    return consume_cycle_tag(o, tags, user="o_custkey", finish_epoch="finish", as_of=ORDERS_AS_OF,
                             out="cycle", tz=DATA_TZ)


def pay_type_top1(spark, sf_dir):
    """Most used order priority per customer (ties -> smallest value) -> tag."""
    from kestrel.plans.models import pay_type_tag
    tags = shop_tags(spark, PRIORITY_TAG, "payment preference", PRIORITY_RULES)
    return pay_type_tag(_t(spark, sf_dir).orders, tags, user="o_custkey", code="o_orderpriority",
                        out="pay_type")


# Fixed value: business rule of the template query's payment tag.
RECENT_PAY_RULE = ("inType=parquet\ntable=orders\n"
                   "selectFieldNames=o_custkey,o_orderpriority\nwhereCondition=o_orderdate#year#2")


def template_pay_type(spark, sf_dir):
    """The tag template end to end: fetch the business tag and its attribute
    tags from the catalog, parse the rule, read the orders it names (last two
    years before the evaluation date), compute the payment preference."""
    from kestrel.plans.models import pay_type_tag, run_tag_model
    catalog = spark.createDataFrame(tag_rows(PRIORITY_TAG, "recent payment", PRIORITY_RULES,
                                             RECENT_PAY_RULE), CATALOG_SCHEMA)
    compute = lambda biz, tags: pay_type_tag(biz, tags, user="o_custkey",
                                             code="o_orderpriority", out="pay_type")
    return run_tag_model(spark, catalog, PRIORITY_TAG, compute, as_of=ORDERS_AS_OF, base=sf_dir)


def top1_window(spark, sf_dir):
    """Richest customer per nation, in SQL with a CTE and ``ROW_NUMBER``."""
    t = _t(spark, sf_dir)
    customer = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return spark.sql("""
        WITH ranked AS (
          SELECT c_nationkey, c_custkey, c_name, c_acctbal,
                 ROW_NUMBER() OVER (PARTITION BY c_nationkey
                                    ORDER BY c_acctbal DESC, c_custkey ASC) AS rn
          FROM {customer})
        SELECT c_nationkey, c_custkey, c_name, c_acctbal FROM ranked WHERE rn = 1""", customer=customer)


# ------------------------------------------------------------- value scores

def _rfm(spark, sf_dir):
    t = _t(spark, sf_dir)
    return measures.rfm_measures(t.orders, user="o_custkey", order_id="o_orderkey",
                                 amount="o_totalprice", ts="o_orderdate", as_of=ORDERS_AS_OF,
                                 in_cents=True)


SHOP_RFM_TABLES = {"recency": SHOP_RFM_RECENCY, "frequency": SHOP_RFM_FREQUENCY,
                   "monetary": SHOP_RFM_MONETARY}
SHOP_RFE_TABLES = {"recency": SHOP_RFE_RECENCY, "frequency": SHOP_RFE_FREQUENCY,
                   "engagements": SHOP_RFE_ENGAGEMENT}


def rfm_measures(spark, sf_dir):
    return _rfm(spark, sf_dir)


def rfm_scores(spark, sf_dir):
    return measures.score_measures(_rfm(spark, sf_dir), SHOP_RFM_TABLES)


def rfm_scores_strict(spark, sf_dir):
    return measures.score_measures(_rfm(spark, sf_dir), SHOP_RFM_STRICT, strict=True)


def _rfe(spark, sf_dir):
    t = _t(spark, sf_dir)
    e = t.events
    return measures.rfe_measures(
        e, user="user_id", ts="ts", page="props",
        recency_ts=F.when(F.col("event_type") == "purchase", F.col("ts")), as_of=EVENTS_AS_OF)


def rfe_measures(spark, sf_dir):
    return _rfe(spark, sf_dir)


def rfe_scores(spark, sf_dir):
    return measures.score_measures(_rfe(spark, sf_dir), SHOP_RFE_TABLES)


def rfe_scores_strict(spark, sf_dir):
    """Activity scores with the closed ranges kept exactly (holes score null)."""
    return measures.score_measures(_rfe(spark, sf_dir), SHOP_RFE_TABLES, strict=True)


def order_lines(t: Tables) -> DataFrame:
    """Order lines with their member: lineitem joined to orders on the order key."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"])


def _half_up_div(x: F.Column, d: int) -> F.Column:
    """Integer ``x / d`` rounded half up (x >= 0)."""
    return F.floor((x + F.lit(d // 2)) / F.lit(d)).cast("long")


def line_money(t: Tables) -> tuple[DataFrame, F.Column, F.Column]:
    """Order lines with amount and coupon in whole cents.

    Prices and discounts carry two decimals, so price x discount is exact in
    1/10000 units; rounding half up to cents is an integer division.  This is
    the decimal(18,2) arithmetic of the tag, done in long integers.
    """
    lines = t.lineitem.select("l_orderkey", "l_extendedprice", "l_discount")
    price_c = F.round(F.col("l_extendedprice") * 100).cast("long")
    disc_pct = F.round(F.col("l_discount") * 100).cast("long")
    amount = _half_up_div(price_c * (F.lit(100) - disc_pct), 100)
    coupon = F.when(F.col("l_discount") >= COUPON_MIN_DISCOUNT,
                    _half_up_div(price_c * disc_pct, 100)).otherwise(F.lit(0).cast("long"))
    return lines, amount, coupon


def price_band(spark, sf_dir):
    """Orders by price band: 200 ranges, every second a unit short and the last without an
    end, and 199 more that lie across the bounds; where two hold a price the earlier wins."""
    k, width = F.col("id"), F.lit(BAND_WIDTH)
    bands = spark.range(N_BANDS).select(
        F.concat(F.lit("band "), k.cast("string")).alias("name"), (k * width).alias("start"),
        F.when(k < N_BANDS - 1, (k + 1) * width - 1 - F.pmod(k, F.lit(2))).alias("end"))
    upper = spark.range(N_BANDS - 1).select(
        F.concat(F.lit("upper "), k.cast("string")).alias("name"), (k * width + 2000).alias("start"),
        (k * width + 2999).alias("end"))
    o = _t(spark, sf_dir).orders
    return match.range_match(o, F.floor("o_totalprice"), bands.unionByName(upper), key="o_orderkey", out="band")


def psm_score(spark, sf_dir):
    """Price sensitivity per customer.  Lines are summed per order first
    (exact integer sums), so the join with orders takes one row per order
    instead of one per line; the per-order sums are then summed per user."""
    t = _t(spark, sf_dir)
    lines, amount, coupon = line_money(t)
    per_order = measures.psm_partial_sums(lines, ["l_orderkey"], amount=amount, coupon=coupon,
                                          cents=True)
    o = t.orders.select("o_orderkey", "o_custkey")
    joined = per_order.join(o, per_order["l_orderkey"] == o["o_orderkey"])
    return measures.psm_from_sums(joined, user="o_custkey", cents=True)


# ------------------------------------------------------------ purchase gender

def labelled_lines(t: Tables) -> DataFrame:
    """``(userId, brand, ptype, label)``: 1 when the goods say female, else 0.

    The label is computed on the part side before the join, so queries that
    only need the label shuffle one int per part instead of two strings.
    """
    lines = order_lines(t)
    p = t.part.select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("ptype"),
                      female_label().alias("label"))
    j = lines.join(p, lines["l_partkey"] == p["p_partkey"])
    return j.select(F.col("o_custkey").alias("userId"), "l_orderkey", "l_linenumber",
                    "brand", "ptype", "label")


def usg_line_label(spark, sf_dir):
    t = _t(spark, sf_dir)
    return labelled_lines(t).select("l_orderkey", "l_linenumber", "userId", "label")


def female_label() -> F.Column:
    """1 when the goods (brand, type) say female, else 0."""
    return F.when(F.col("p_brand").isin(*FEMALE_BRANDS) | F.col("p_type").isin(*FEMALE_TYPES),
                  1).otherwise(0)


def part_labels(t: Tables) -> DataFrame:
    """``(p_partkey, label)`` per part."""
    return t.part.select("p_partkey", female_label().alias("label"))


def usg_share_label(spark, sf_dir):
    """Purchase gender per customer.  Lines are labelled by their part and
    counted per order first; the join with orders then takes one row per
    order, and the per-order counts are summed per customer."""
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = part_labels(t)
    per_order = measures.share_partials(li.join(p, li["l_partkey"] == p["p_partkey"]), ["l_orderkey"])
    o = t.orders.select("o_orderkey", "o_custkey")
    counts = measures.share_from_partials(per_order.join(o, per_order["l_orderkey"] == o["o_orderkey"]),
                                          user="o_custkey")
    coded = counts.withColumn("__rule", measures.share_rule(F.col("total"), F.col("male_total"),
                                                            F.col("female_total")))
    tags = shop_tags(spark, USG_TAG, "purchase gender", USG_RULES)
    return match.rule_match(coded, "__rule", tags, key="userId", out="usg",
                            keep=["total", "male_total", "female_total"])


def dict_encode(spark, sf_dir):
    t = _t(spark, sf_dir)
    import pandas as pd
    dim = spark.createDataFrame(pd.DataFrame(TYPE_DIM, columns=["id", "name"]), "id int, name string")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    p = t.part.select("p_partkey", "p_type")
    j = lines.join(p, lines["l_partkey"] == p["p_partkey"]).select("l_orderkey", "l_linenumber", "p_type")
    return cleanup.dict_encode(j, "p_type", dim, out="product_id")


# ------------------------------------------------------------ sources, text

def condition_filter(spark, sf_dir):
    """Wide-table scan: selected columns as strings, condition list ANDed."""
    from kestrel.sources.meta import wide_scan
    return wide_scan(spark, f"{sf_dir}/orders.parquet",
                     ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"],
                     filter_conditions=ORDER_CONDITIONS)


def relative_date_filter(spark, sf_dir):
    from kestrel.functions.dates import window_on
    o = _t(spark, sf_dir).orders
    field, unit, n = ORDER_WINDOW
    return (o.where(window_on(o, field, unit, n, ORDERS_AS_OF))
            .select("o_orderkey", "o_custkey", F.date_format(field, "yyyy-MM-dd").alias("order_date")))


def url_extract(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t.pages.select("page_id", extract_or_null(F.col("url"), PAGE_URL_PATTERN, 1).alias("product"))


def click_counts(t: Tables) -> DataFrame:
    e = t.events.where(F.col("event_type") == "click")
    item = F.get_json_object("props", "$.k").try_cast("int")
    return (e.groupBy(F.col("user_id").alias("userId"), item.alias("productId"))
            .agg(F.count(F.lit(1)).alias("clicks")))


def click_ratings(spark, sf_dir):
    return click_counts(_t(spark, sf_dir))


# ------------------------------------------------------------------- store

def profile_upsert(spark, sf_dir):
    old = rule_match_inner(spark, sf_dir)
    new = consume_cycle(spark, sf_dir)
    return profile.upsert(old, new)


def profile_store_upsert(spark, sf_dir):
    """The profile in copy-on-write buckets: all segment tags, then the consumption cycle of
    some customers, whose buckets alone are rewritten."""
    import uuid

    from kestrel.operators.bucket_store import BucketStore
    store = BucketStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/profile-{uuid.uuid4().hex}", buckets=16)
    store.save(rule_match_inner(spark, sf_dir))
    store.save(consume_cycle(spark, sf_dir).where(F.col("userId") % 100 < 3))
    return store.read()


def export_regions(spark, sf_dir):
    """Split-aligned export of the customers' cells: each region's keys, cells, and whether
    its files follow each other without overlap."""
    import uuid

    from pyspark.sql import Window

    from kestrel.sources.sinks import export_split_cells
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/regions-{uuid.uuid4().hex}"
    files = export_split_cells(_t(spark, sf_dir).customer, "c_custkey", "user", folder, EXPORT_SPLITS)
    # a row per file
    before = F.lag("last_key").over(Window.partitionBy("region").orderBy("first_key", "last_key"))
    return files.withColumn("in_order", F.coalesce(before <= F.col("first_key"), F.lit(True))).groupBy("region").agg(
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"), F.sum("n_cells").alias("n_cells"),
        F.bool_and("in_order").alias("in_order"))


def sync_table_strings(spark, sf_dir):
    return profile.sync_strings(_t(spark, sf_dir).customer)


def to_cells(spark, sf_dir):
    return profile.to_cells(_t(spark, sf_dir).customer, key="c_custkey", family="user")


def raw_lines(t: Tables) -> DataFrame:
    """Text lines of two kinds: tab-separated event records and document lines."""
    e = t.events.select(F.concat_ws("\t", F.col("event_id").cast("string"),
                                    ntz_epoch_micros("ts").cast("string"),
                                    F.col("user_id").cast("string"), "event_type",
                                    F.col("value").cast("string"), "props").alias("value"))
    d = t.documents.select(F.explode(F.split("text", "\n")).alias("value"))
    return e.unionByName(d)


EVENT_FIELDS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def drop_malformed(spark, sf_dir):
    from kestrel.sources.meta import parse_delimited_lines
    return parse_delimited_lines(raw_lines(_t(spark, sf_dir)), EVENT_FIELDS, "\t",
                                 types={"event_id": "long", "user_id": "long", "value": "double"})


def log_cells(spark, sf_dir):
    """Raw lines -> well-formed event records -> (row_key, family, qualifier, value)."""
    return profile.log_lines_to_cells(raw_lines(_t(spark, sf_dir)), EVENT_FIELDS, "event_id", "detail")


# Fixed value: conditions of the cell-scan query (compared as strings).
CELL_CONDITIONS = "c_mktsegment[eq]BUILDING,c_nationkey[lt]2"


def cells_round_trip(spark, sf_dir):
    """Customer rows exported as key-value cells (family ``user``) into the
    shared checkpoint folder, then read back as a wide all-string table with
    a condition list, like a scan of the key-value store."""
    import uuid

    from kestrel.sources.meta import cells_scan
    from kestrel.sources.sinks import export_cells
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cells-{uuid.uuid4().hex}"
    export_cells(_t(spark, sf_dir).customer, "c_custkey", "user", folder, include_key=False)
    return cells_scan(spark, folder, "user", ["c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"],
                      CELL_CONDITIONS, key="c_custkey")


def sql_group_order(spark, sf_dir):
    """Hand-written SQL: one-key GROUP BY with ORDER BY."""
    return spark.sql("""
        SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 2) AS avg_bal
        FROM {customer} GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment""",
                     customer=_t(spark, sf_dir).customer)


def sql_two_key_count(spark, sf_dir):
    """Hand-written SQL: two-key GROUP BY with two counts, ordered by member."""
    return spark.sql("""
        SELECT o_custkey, o_orderpriority, count(o_custkey) AS n_member,
               count(o_orderpriority) AS n_code
        FROM {orders} GROUP BY o_custkey, o_orderpriority ORDER BY o_custkey, o_orderpriority""",
                     orders=_t(spark, sf_dir).orders)


def tags_string_to_cells(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    s = c.select("c_custkey", F.concat(F.lit("segment:"), "c_mktsegment", F.lit(",nation:"),
                                        F.col("c_nationkey").cast("string")).alias("tags"))
    return profile.tags_string_to_cells(s, "c_custkey", "tags")


def order_cleanup(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    pay = F.create_map(*[x for k, v in PRIORITY_PAY.items() for x in (F.lit(k), F.lit(v))])
    src = o.select("o_orderkey", F.col("o_custkey").alias("memberid"),
                   F.coalesce(pay[F.col("o_orderpriority")], F.col("o_orderpriority")).alias("paymentcode"),
                   F.unix_timestamp("o_orderdate").alias("finishtime"))
    return cleanup.clean_orders(src, key="o_orderkey", member="memberid", pay_code="paymentcode",
                                finish="finishtime", member_limit=MEMBER_LIMIT, tz=DATA_TZ)


def mean_impute(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    x = c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"))
    return cleanup.mean_impute(x, ["acctbal"])


def contingency(spark, sf_dir):
    t = _t(spark, sf_dir)
    n = t.nation.select("n_nationkey", "n_regionkey")
    cust = t.customer
    c = cust.join(checked_broadcast(n), cust["c_nationkey"] == n["n_nationkey"])
    return c.groupBy("c_mktsegment", "n_regionkey").agg(F.count(F.lit(1)).alias("n"))


def topk_limit(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    spend = o.groupBy("o_custkey").agg(
        (F.sum(measures.cents("o_totalprice")).cast("double") / F.lit(100.0)).alias("spend"))
    return spend.orderBy(F.col("spend").desc(), F.col("o_custkey").asc()).limit(TOP_K)


# ------------------------------------------------------------ tag catalog

def geo_catalog(t: Tables) -> DataFrame:
    """A catalog built from the data: shop -> geography -> region -> nation ->
    the segments present among the nation's customers."""
    spark = t.spark
    top = spark.createDataFrame([(1, "shop", "", 1, -1), (2, "geography", "", 2, 1)], CATALOG_SCHEMA)
    regions = t.region.select((F.lit(100) + F.col("r_regionkey")).cast("long").alias("id"),
                              F.col("r_name").alias("name"), F.lit("").alias("rule"),
                              F.lit(3).alias("level"), F.lit(2).cast("long").alias("pid"))
    nation_rule = F.concat(F.lit("inType=parquet\ntable=customer\nselectFieldNames=c_custkey,c_mktsegment\n"
                                 "filterConditions=c_nationkey[eq]"), F.col("n_nationkey").cast("string"))
    nations = t.nation.select((F.lit(1000) + F.col("n_nationkey")).cast("long").alias("id"),
                              F.col("n_name").alias("name"), nation_rule.alias("rule"),
                              F.lit(4).alias("level"),
                              (F.lit(100) + F.col("n_regionkey")).cast("long").alias("pid"))
    segs = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    attrs = segs.select((F.lit(100000) + F.col("c_nationkey") * 100 +
                         F.ascii("c_mktsegment")).cast("long").alias("id"),
                        F.lower("c_mktsegment").alias("name"), F.col("c_mktsegment").alias("rule"),
                        F.lit(5).alias("level"), (F.lit(1000) + F.col("c_nationkey")).cast("long").alias("pid"))
    catalog = top.unionByName(regions).unionByName(nations).unionByName(attrs)
    return catalog


def tag_fetch_union(spark, sf_dir):
    """Each nation tag with its attribute children (``id = x UNION pid = x``)."""
    g = geo_catalog(_t(spark, sf_dir))
    n = g.where(F.col("level") == 4).select(F.col("id").alias("tag"))
    own = g.join(n, g["id"] == n["tag"]).select("tag", "id", "name", "level")
    kids = g.join(n, g["pid"] == n["tag"]).select("tag", "id", "name", "level")
    return own.union(kids).distinct()


def tag_children(spark, sf_dir):
    g = geo_catalog(_t(spark, sf_dir))
    parents = g.select(F.col("id").alias("parent_id"), F.col("name").alias("parent"))
    return (g.join(parents, g["pid"] == parents["parent_id"])
            .groupBy("parent_id", "parent").agg(F.count(F.lit(1)).alias("n_children")))


def tag_path(spark, sf_dir):
    return cat.paths(geo_catalog(_t(spark, sf_dir)))


def tag_fetch(spark, sf_dir):
    """One nation's tag with its attribute tags, as the tag template fetches it."""
    return cat.fetch_tag(geo_catalog(_t(spark, sf_dir)), NATION_TAG).select("id", "name", "level")


def tag_level_children(spark, sf_dir):
    """All tags of level 4, and the children of one of them."""
    g = geo_catalog(_t(spark, sf_dir))
    kinds = [(cat.at_level(g, 4), "level 4"), (cat.children(g, NATION_TAG), "child")]
    a, b = (df.select("id", "name", F.lit(kind).alias("kind")) for df, kind in kinds)
    return a.unionByName(b)


def deep_catalog(t: Tables) -> DataFrame:
    """The geography catalog carried on to nine levels: under a nation's segments the
    balance decade of its customers, their hundreds, tens and keys."""
    g = geo_catalog(t).select("id", "name", "level", "pid")
    c = t.customer.select("c_custkey", (F.lit(100000) + F.col("c_nationkey") * 100 + F.ascii("c_mktsegment"))
                          .cast("long").alias("top"))
    base = F.lit(10**9).cast("long")
    parts = []
    for level, size in ((6, 1000), (7, 100), (8, 10), (9, 1)):
        group = F.floor(F.col("c_custkey") / size).cast("long")
        above = F.floor(F.col("c_custkey") / (size * 10)).cast("long")
        scope = F.col("top") * 10**7
        node = base * level * 10**3 + scope + group
        parent = F.col("top") if level == 6 else base * (level - 1) * 10**3 + scope + above
        parts.append(c.select(node.alias("id"), group.cast("string").alias("name"), F.lit(level).alias("level"),
                              parent.cast("long").alias("pid")).distinct())
    for p in parts:
        g = g.unionByName(p)
    return g


def tag_deep_path(spark, sf_dir):
    """Ancestor paths of the leaves of a nine-level catalog."""
    return cat.paths(deep_catalog(_t(spark, sf_dir)), level=9)


CHAIN = ["l1", "l2", "l3", "l4"]


def catalog_merge(spark, sf_dir):
    """Get-or-create chains merged into the stored geography catalog: the regions' nations
    are there already, payment habits per nation are new."""
    import uuid
    t = _t(spark, sf_dir)
    store = cat.CatalogStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}")
    geo = geo_catalog(t).select("id", "name", "level", "pid")
    geo.write.parquet(f"{store.root}/v=1")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    known = n.join(checked_broadcast(r), n["n_regionkey"] == r["r_regionkey"]).select(
        F.lit("shop").alias("l1"), F.lit("geography").alias("l2"), F.col("r_name").alias("l3"), F.col("n_name").alias("l4"))
    o = t.orders.select("o_custkey", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey")
    habits = (o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderpriority", "c_nationkey").distinct()
              .join(checked_broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.lit("shop").alias("l1"), F.lit("payment").alias("l2"), F.col("o_orderpriority").alias("l3"),
                      F.col("n_name").alias("l4")))
    store.merge(known.unionByName(habits), CHAIN)
    return store.read()


def tag_model_left(spark, sf_dir):
    """Nation tags left-joined to the models registered for them (a model per
    nation that has suppliers)."""
    t = _t(spark, sf_dir)
    models = (t.supplier.select("s_nationkey").distinct()
              .select((F.lit(5000) + F.col("s_nationkey")).cast("long").alias("id"),
                      (F.lit(1000) + F.col("s_nationkey")).cast("long").alias("tag_id"),
                      F.concat(F.lit("supply_model_"), F.col("s_nationkey").cast("string")).alias("model_name")))
    tags = geo_catalog(t).where(F.col("level") == 4).select("id", "name")
    return cat.with_models(tags, models).select("id", "name", "model_id", "model_name")


def center_rank(spark, sf_dir):
    """Rank of each segment's mean RFM score vector by descending coordinate sum."""
    t = _t(spark, sf_dir)
    scores = rfm_scores(spark, sf_dir)
    seg = t.customer.select(F.col("c_custkey").alias("userId"), "c_mktsegment")
    centers = (scores.join(seg, "userId").groupBy("c_mktsegment")
               .agg((F.avg("r_score") + F.avg("f_score") + F.avg("m_score")).alias("s")))
    from kestrel.operators.ml import rank_center_table
    return rank_center_table(centers, cluster="c_mktsegment").withColumnRenamed("cluster", "c_mktsegment")
