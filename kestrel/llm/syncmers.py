"""Document fingerprints from closed syncmers, without Python code.

Units are words.  Of every k consecutive words (a k-mer) the inner s-mers are hashed;
the k-mer is an anchor if the smallest of them is its first or its last.  Whether a
k-mer is chosen depends on its own words only, so equal passages give equal anchors
in any context, at the same distances, and an edit moves only the anchors it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kestrel.llm.common import let, whole, words

K, S = 5, 2
BUCKET_ROWS = 1024       # rows of a bucket of consecutive ids
MOST_BUCKETS = 1 << 16   # beyond these, buckets grow


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<at:int, hash:bigint>>: the closed syncmers of a whole text in order.

    A text with words but without a closed syncmer (of fewer than ``k`` words, or
    of a few more) has one anchor: all its words.  A null or empty text has none.
    """
    inner = k - s + 1

    def shifted(column: Column, by: int, n: Column) -> Column:
        return F.slice(column, by + 1, n)

    def smers(h: Column) -> Column:
        n = F.greatest(F.size(h) - s + 1, F.lit(0))
        cols = F.arrays_zip(*[shifted(h, j, n).alias(f"w{j}") for j in range(s)])
        return F.transform(cols, lambda e: F.xxhash64(*[e[f"w{j}"] for j in range(s)]))

    def choose(sm: Column) -> Column:
        n = F.greatest(F.size(sm) - inner + 1, F.lit(0))
        zipped = F.arrays_zip(*[shifted(sm, j, n).alias(f"s{j}") for j in range(inner)])
        names = [f"s{j}" for j in range(inner)]

        def pick(e: Column, i: Column) -> Column:
            edge = F.least(e[names[0]], e[names[-1]])
            closed = edge <= F.least(*[e[x] for x in names[1:-1]], edge) if inner > 2 else F.lit(True)
            return F.when(closed, F.struct(i.alias("at"), F.xxhash64(*[e[x] for x in names]).alias("hash")))

        return F.array_compact(F.transform(zipped, pick))

    def of_hashes(h: Column) -> Column:
        whole_text = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(h).alias("hash")))
        none = F.array().cast("array<struct<at:int,hash:bigint>>")
        closed = F.when(F.size(h) >= k, let(smers(h), choose)).otherwise(none)
        return let(closed, lambda c: F.when((F.size(c) > 0) | (F.size(h) == 0), c).otherwise(whole_text))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of_hashes)


def fingerprint(found: Column) -> Column:
    """The anchors' hashes (32 bits each, hexadecimal) in the order of the text."""
    return F.array_join(F.transform(found, lambda a: F.hex(a["hash"].bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two anchor lists, from 0 to 1; two empty ones are alike."""
    x, y = a.getField("hash"), b.getField("hash")
    either = F.size(F.array_union(x, y))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / either)


def shared_places(a: Column, b: Column) -> Column:
    """array<struct<at, other>>: places of ``a``'s anchors in both texts, for matching
    passages by position; a repeated anchor meets the first equal one of ``b``."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: F.array_compact(F.transform(
        s["a"], lambda x: let(F.array_position(s["b"]["hash"], x["hash"]), lambda p: F.when(
            p > 0, F.struct(x["at"].alias("at"), F.element_at(s["b"], p.cast("int"))["at"].alias("other")))))))


def _cuts(df: DataFrame, doc_id: str) -> tuple[list[int], int | None, bool]:
    """Ids that start each bucket but the first, the lowest id, and whether ids are null."""
    n, lowest, nulls = df.agg(F.count(F.lit(1)), F.min(doc_id),
                              F.max(F.col(doc_id).isNull().cast("int"))).first()
    n_buckets = min(MOST_BUCKETS, -(-n // BUCKET_ROWS))
    if n_buckets < 2 or lowest is None:
        return [], lowest, bool(nulls)
    at = [i / n_buckets for i in range(1, n_buckets)]
    found = df.agg(F.percentile_approx(doc_id, at, 100_000).alias("c")).first()["c"]
    return sorted(set(found)), lowest, bool(nulls)


def _bucket(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts are at most ``doc_id`` (0 for null): among every g-th, then among g."""
    if not cuts:
        return F.lit(0)
    g = max(1, int(len(cuts) ** 0.5))

    def longs(values):
        return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")")

    heads = longs(cuts[::g])
    groups = F.expr("array(" + ",".join(
        "array(" + ",".join(f"{v}L" for v in cuts[i:i + g]) + ")" for i in range(0, len(cuts), g)) + ")")
    full = F.greatest(F.size(F.filter(heads, lambda c: c <= doc_id)) - 1, F.lit(0))
    return let(full, lambda f: f * g + F.size(F.filter(F.get(groups, f), lambda c: c <= doc_id)))


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, anchors, next_text, next_anchors, a row for each row of ``df``: the
    next row by (doc_id, text), null ids first; after the last comes the first.

    Rows are exchanged once, into buckets of consecutive ids; a bucket's first rows
    are also sent, as guests, to the bucket before, and the first of all to the last.
    """
    cuts, lowest, nulls = _cuts(df, doc_id)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    rows = rows.withColumn("b", F.coalesce(_bucket(F.col("doc_id"), cuts), F.lit(0)))
    is_lowest = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(lowest)
    starts = F.lit(False)
    if cuts:
        starts = F.get(F.expr("array(" + ",".join(f"{v}L" for v in cuts) + ")"), F.col("b") - 1) == F.col("doc_id")

    def place(b: Column, guest: int, wrap: int) -> Column:
        return F.struct(b.cast("int").alias("bucket"), F.lit(guest).alias("guest"), F.lit(wrap).alias("wrap"))

    places = F.array_compact(F.array(
        place(F.col("b"), 0, 0),
        F.when(starts, place(F.col("b") - 1, 1, 0)),
        F.when(is_lowest, place(F.lit(len(cuts)), 1, 1))))
    dealt = (rows.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.*")
             .repartition("bucket").withColumn("anchors", anchors(F.col("text"))))
    order = W.partitionBy("bucket").orderBy("wrap", F.col("doc_id").asc_nulls_first(), "text", "guest")
    return (dealt.withColumns({"next_text": F.lead("text").over(order),
                               "next_anchors": F.lead("anchors").over(order)})
            .filter(F.col("guest") == 0).drop("bucket", "guest", "wrap"))


def query(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint and that of its edited text: the last half of the code
    points (rounded down) gives way to the first as many, or all, of the next text.

    A null text is empty; rows with a null or a repeated doc_id are rows like any other; an
    empty table gives an empty one; columns beyond doc_id and text are not read.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.col("n_chars").cast("int") - half
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring("next_text", F.lit(1), half))
    rows = (with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("edited", edited).withColumn("edited_anchors", anchors(F.col("edited"))))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))
