"""Name -> query callable ``(spark, sf_dir) -> DataFrame`` and name -> SQL oracle."""

from __future__ import annotations

from kestrel.plans import mining, shop
from kestrel.plans.oracle import ORACLE

SQL_CHECKED = [
    "rule_match_inner", "rule_match_left_default", "age_range", "consume_cycle",
    "pay_type_top1", "top1_window", "rfm_measures", "rfm_scores", "rfm_scores_strict",
    "rfe_measures", "rfe_scores", "rfe_scores_strict", "psm_score", "usg_line_label", "usg_share_label",
    "dict_encode", "condition_filter", "relative_date_filter", "url_extract", "click_ratings",
    "profile_upsert", "sync_table_strings", "to_cells", "drop_malformed",
    "tags_string_to_cells", "order_cleanup", "mean_impute", "contingency", "topk_limit",
    "tag_fetch_union", "tag_children", "tag_path", "tag_model_left", "center_rank",
    "log_cells", "sql_group_order", "sql_two_key_count", "template_pay_type", "cells_round_trip",
    "tag_fetch", "tag_level_children", "tag_deep_path", "catalog_merge", "price_band", "profile_store_upsert",
    "export_regions",
]


def queries() -> dict:
    return {name: getattr(shop, name) for name in SQL_CHECKED} | mining.QUERIES


def oracle_sql() -> dict:
    return {k: v for k, v in ORACLE.items() if k in queries()}
