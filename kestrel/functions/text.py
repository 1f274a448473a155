"""String helpers: rule ranges, URL ids, not-blank tests, positional splits.

All return built-in Column expressions (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: product-page pattern of the click logs; the id is group 1 and
# at least one character must follow ".html".
PRODUCT_URL_PATTERN = r"^.+/product/(\d+)\.html.+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_start(rule) -> Column:
    """``'19500101-19591231'`` -> 19500101 (null when not a number)."""
    return F.split_part(_c(rule), F.lit("-"), F.lit(1)).try_cast("int")


def range_end(rule) -> Column:
    return F.split_part(_c(rule), F.lit("-"), F.lit(2)).try_cast("int")


def parse_range(rule) -> Column:
    """Range rule -> ``struct(start int, end int)``."""
    return F.struct(range_start(rule).alias("start"), range_end(rule).alias("end"))


def extract_or_null(value, pattern: str, group: int = 1) -> Column:
    """Regex group, null when the pattern does not match (or input is null)."""
    return F.nullif(F.regexp_extract(_c(value), pattern, group), F.lit(""))


def url_to_product(url, pattern: str = PRODUCT_URL_PATTERN) -> Column:
    return extract_or_null(url, pattern, 1)


def date_to_int(date_str) -> Column:
    """``'1992-05-31'`` -> 19920531 (null when malformed)."""
    return F.regexp_replace(_c(date_str), "-", "").try_cast("int")


def not_blank(c) -> Column:
    return F.length(F.trim(_c(c))) > 0


def blank_to_null(c) -> Column:
    c = _c(c)
    return F.when(not_blank(c), c)
