"""Benchmark decontamination as a prefix-filtered set join, without Python code.

A benchmark item is cut into windows of consecutive words.  A text contains a
window only if it contains every one of its words, so the rarest of them, by its
count over all documents, is the one token a document must share to be a candidate
(containment in full makes the necessary prefix one token long).  A candidate is a
place of that token in a text; the token's offset in the window and the text's
length bound where the window could lie; the words there are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import let, whole, words, written
from kestrel.operators.broadcast import checked_broadcast
from kestrel.sources.tables import table

WINDOW = 13          # words of a window
SHARE = 20           # contaminated: n_hit * SHARE >= n_words
BLOCK = 50_000       # so many tokens go into a plan as a list; more take more passes
BROADCAST_ROWS = 50_000
KEY = ["doc_id", "h"]


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id (string), window (array of words): every window of ``window`` words, or
    the whole item if it has fewer; none for items without words."""
    def cut(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - window + 1, F.lit(1)))
        return F.when(F.size(ws) > 0, F.transform(starts, lambda i: F.slice(ws, i, window)))

    return (items.select(F.col("item_id").cast("string"), F.explode(let(words(F.col("text")), cut))
                         .alias("window")).distinct())


def blocks(tokens: DataFrame, block: int = BLOCK) -> list[str]:
    """The tokens (column token, distinct) as SQL lists of about ``block`` words each.

    Words have no ASCII punctuation, so nothing needs escaping.
    """
    n = max(1, -(-tokens.count() // block))
    out = []
    for i in range(n):
        part = tokens.filter(F.pmod(F.xxhash64("token"), F.lit(n)) == i) if n > 1 else tokens
        out.append(",".join(f"'{r['token']}'" for r in part.collect()) or "''")
    return out


def rarity(docs: DataFrame, tokens: DataFrame, block: int = BLOCK) -> DataFrame:
    """token, n: how often each token occurs in the texts of ``docs`` (column words), 0
    included; summed in the tasks before the shuffle."""
    counts = None
    for listed in blocks(tokens, block):
        found = docs.select(F.explode(F.expr(f"filter(words, w -> w IN ({listed}))")).alias("token"))
        counts = found if counts is None else counts.unionAll(found)
    counts = counts.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return tokens.join(counts, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each distinct window with its rarest word ``token`` (ties: the smallest word) and
    that word's first ``offset`` in it, from 0."""
    places = windows.select("window").distinct().select(
        "window", F.posexplode("window").alias("offset", "token"))
    best = places.join(counts, "token").groupBy("window").agg(F.min(F.struct("n", "token", "offset")).alias("r"))
    return best.select("window", F.col("r.token").alias("token"), F.col("r.offset").alias("offset"))


def places(listed: str, window: int = WINDOW) -> Column:
    """Of an array column words: each place ``at`` of a listed token with the up to
    ``window - 1`` words on either side, ``before`` of them ahead of it."""
    at = F.expr(f"array_compact(transform(words, (w, i) -> CASE WHEN w IN ({listed}) THEN i END))")

    def cut(ws: Column, i: Column) -> Column:
        first = F.greatest(i - (window - 1), F.lit(0))
        return F.struct(i.alias("at"), ws[i].alias("token"), (i - first).alias("before"),
                        F.slice(ws, first + 1, i - first + window).alias("around"))

    return let(F.struct(F.col("words").alias("words"), at.alias("at")),
               lambda s: F.transform(s["at"], lambda i: cut(s["words"], i)))


def occurrences(found: DataFrame, prefix: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, h, item_id, start, length of every window that lies around a place."""
    first = F.col("before") - F.col("offset")
    n = F.size("window")
    fits = (first >= 0) & (first + n <= F.size("around"))
    exact = F.slice("around", F.greatest(first, F.lit(0)) + 1, n) == F.col("window")
    held = (found.join(checked_broadcast(prefix, BROADCAST_ROWS), "token").filter(fits & exact)
            .select(*KEY, "window", (F.col("at") - F.col("offset")).alias("start"), n.alias("length"))
            .distinct())
    return held.join(checked_broadcast(windows, BROADCAST_ROWS), "window").select(
        *KEY, "item_id", "start", "length")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, h (a hash of the text), n_words, n_hit, items (sorted item_ids): a row for
    each row of ``docs``, repeated ones included.

    Null or empty texts have no words and are never hit; a null doc_id is a key like
    any other; an empty table of either kind gives no hits.
    """
    split = docs.select("doc_id", F.xxhash64(whole(F.col("text"))).alias("h"),
                        words(F.col("text")).alias("words"))
    windows = written(item_windows(items, window), "decontaminate-windows")
    tokens = windows.select(F.explode("window").alias("token")).distinct()
    prefix = written(prefixes(windows, rarity(split, tokens, block)), "decontaminate-prefix")
    lists = blocks(prefix.select("token").distinct(), block)
    scans = [written(split.select(*KEY, F.size("words").cast("long").alias("n_words"),
                                  places(listed, window).alias("places")), "decontaminate-places")
             for listed in lists]
    found = None
    for scan in scans:
        part = scan.select(*KEY, F.explode("places").alias("p")).select(*KEY, "p.*")
        found = part if found is None else found.unionAll(part)
    hits = written(occurrences(found, prefix, windows), "decontaminate-hits")
    n_hit = (hits.select(*KEY, F.explode(F.expr("sequence(start, start + length - 1)")).alias("at")).distinct()
             .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit")))
    items_of = (hits.select(*KEY, "item_id").distinct().groupBy(*KEY)
                .agg(F.sort_array(F.collect_list("item_id")).alias("items")))
    rows = scans[0].select(*KEY, "n_words")
    marks = n_hit.join(items_of, [n_hit[c].eqNullSafe(items_of[c]) for c in KEY]).select(
        n_hit["doc_id"].alias("__id"), n_hit["h"].alias("__h"), "n_hit", "items")
    return rows.join(marks, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left").select(
        *KEY, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row per row of ``documents``, of any length; see :func:`contamination`."""
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go, all others stay unchanged."""
    bad = (contamination(docs, table(spark, sf_dir, "benchmark")).filter(is_contaminated())
           .select(F.col("doc_id").alias("__id"), F.col("h").alias("__h")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(whole(F.col("text"))) == F.col("__h"))
    return docs.join(bad, same, "left_anti")


#: DuckDB: plain list comparison of every word window of the items' lengths.
SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 12], ' ') AS win, least(len(ws), 13) AS n
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM w),
dw AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lens WHERE len(ws) >= n)),
h AS (SELECT DISTINCT doc_id, item_id, i, dw.n FROM dw JOIN w ON dw.win = w.win AND dw.n = w.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
