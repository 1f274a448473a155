"""Near-duplicate classes by improved consistent weighted sampling (ICWS).

A text is the weighted set of its five-word shingles: a shingle weighs how often it
occurs times its inverse document frequency.  The frequency is taken from the
shingle's words: a shingle's own would be that of the copies sought, which lowers the
weight of what copies share and lifts that of what an edit changed.  Samples that agree
with the probability of the weighted Jaccard similarity are banded; texts that share a
band are compared exactly, over their whole shingle sets, and verified links give the
classes as connected components.

No list of all pairs of a group is made.  A band's members meet its most connected member
first.  In bands that this leaves apart, members meet again where they share further
samples too, in every such part one member of each component meets the largest one's; so
a member is compared a few dozen times, however large its group is, and mostly with those
most like it.  This joins most links.  The rest, also those of texts that share no band, an
exact join finds: similar texts share one of the first shingles of an order common to all
(prefix filter), and of the texts that do, those of unlike components are compared, whole
blocks of them in one task where a shingle has many.  No link is lost.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import whole, words, written

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 14, 5      # 1 - (1 - 0.8^5)^14 = 0.996 of the pairs at 0.8
WORD_BITS = 20           # words' document frequencies are counted in 2^20 cells
MANY = 1 << 22           # pairs of a block: a bucket of more is dealt into several
# Parts of a band: how many further samples its members share, and from which on behind the
# band's own.  A pair at 0.8 shares 8 of them six times as often, relative to one at 0.65.
PARTS = ((0, 0), (2, 0), (4, 16), *((8, 8 * k) for k in range(8)))
ROUNDS = 3               # times that parts are formed, while components grow
LEAST = SIMILAR / (1 + SIMILAR)  # of two texts' weights together, what similar ones share at least
SLACK = 1e-5             # relative, for weights in single precision: bounds err towards comparing
HOT = 64                 # texts of one token: more are compared in blocks, fewer pair by pair
SIDE, LOAD = 1024, 1 << 18  # texts and shingles of a block, about; a longer text is alone
BITS = 1024              # of a text's parities, at least; longer texts have 2 to 4 a shingle
STEPS = 255              # in which the weight from a token on is told, from 0.8 of the text's to all
ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 1000        # rows sent to Python at once: they hold the words of whole texts
SEED = 0x9E3779B97F4A7C15


# ---------------------------------------------------------------- weighted sets

def shingles(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a text's word hashes, and their weights.

    A text of fewer than five words, but not none, is one shingle of all its words.
    """
    keys, weight, counts, _ = _shingles(hashes, idf)
    return keys, weight * counts


def _shingles(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct shingle hashes, the weight of one occurrence, the occurrences, and the
    rarity of the shingle's rarest word."""
    h = np.asarray(hashes, dtype=np.int64).view(np.uint64)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.float32)
    n = min(SHINGLE, len(h))
    rare = idf[(h >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
    mixed = np.full(len(h) - n + 1, SEED, dtype=np.uint64)
    weight = np.zeros(len(h) - n + 1)
    rarest = np.zeros(len(h) - n + 1, np.float32)
    with np.errstate(over="ignore"):
        for i in range(n):
            mixed = (mixed ^ h[i:len(h) - n + 1 + i]) * np.uint64(0xFF51AFD7ED558CCD)
            mixed ^= mixed >> np.uint64(32)
            weight += rare[i:len(h) - n + 1 + i]
            np.maximum(rarest, rare[i:len(h) - n + 1 + i], out=rarest)
    # Equal shingles weigh the same, so any of them will do: no stable sort as ``np.unique`` takes.
    order = np.argsort(mixed)
    mixed = mixed[order]
    head = np.flatnonzero(np.append(True, mixed[1:] != mixed[:-1]))
    first = order[head]
    return mixed[head], weight[first] / n, np.diff(np.append(head, len(mixed))), rarest[first]


def _in_order(weight: np.ndarray) -> np.ndarray:
    """Places of the shingles, which are sorted by hash, in an order common to all texts: heavy
    ones first, then by hash."""
    return np.argsort(-weight, kind="stable")


def ordered(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's shingles, ``_in_order``, and their weights."""
    keys, weight, counts, _ = _shingles(hashes, idf)
    at = _in_order(weight)
    return keys[at], (weight * counts)[at]


def prefix(keys: np.ndarray, weight: np.ndarray, counts: np.ndarray, rarest: np.ndarray) -> np.ndarray:
    """The tokens of a text, ``_in_order``, each with the share of the weight from it on.

    The tokens are its shingles up to the one from which on 0.8 of its weight remain, by the
    higher 56 bits of their hashes; the lower 8 tell the share, rounded up (see ``_after``).  Two
    similar texts share at least ``LEAST`` of their weights together, all of it from their
    first common shingle on: so that one is a token of both, and no less remains there in
    either.
    """
    order = _in_order(weight)
    after = np.cumsum((weight * counts)[order][::-1])[::-1]
    # A word of rarity 2 is counted in one row only (see ``inverse_frequencies``).
    at = np.flatnonzero((after >= SIMILAR * (1 - SLACK) * after[0]) & (rarest[order] < 2))
    step = np.ceil(np.clip(after[at] / after[0] - SIMILAR, 0, 1 - SIMILAR) * (STEPS / (1 - SIMILAR)))
    return (keys[order][at] & ~np.uint64(255) | np.minimum(step, STEPS).astype(np.uint64)).view(np.int64)


def _after(token: Column, mass: Column) -> Column:
    """At least the weight of a text of ``mass`` from its token on."""
    return mass * (SIMILAR + token.bitwiseAND(F.lit(255)) * ((1 - SIMILAR) / STEPS))


def parities(keys: np.ndarray) -> np.ndarray:
    """Whether an odd number of the shingles falls into each of ``BITS`` cells, or the least power
    of two that is twice the shingles.

    Where two texts' bits differ, a shingle is in one of them only; it weighs 1 at least.
    The bits of half as many cells are both halves' exclusive or (see ``folded``).
    """
    n = max(BITS, 1 << (2 * len(keys) - 1).bit_length())
    cells = np.bincount((keys >> np.uint64(32)).astype(np.int64) % n, minlength=n)
    return np.packbits(cells & 1 == 1).view(np.int64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Parities of fewer cells: ``words`` times 64."""
    while len(bits) > words:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima; two sets without shingles are not similar."""
    (ka, wa), (kb, wb) = a, b
    if not len(ka) or not len(kb):
        return 0.0
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    low = np.minimum(wa, wb[at])[kb[at] == ka].sum()
    return float(low / (wa.sum() + wb.sum() - low))


def _gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of ``n`` even cells, by Newton steps on
    its distribution 1 - (1 + x) e^-x."""
    u = (np.arange(n) + 0.5) / n
    x = np.where(u < 0.5, np.sqrt(2 * u), -np.log1p(-u) + np.log1p(-np.log1p(-u)))
    for _ in range(60):
        x = np.maximum(x / 2, x - (1 - (1 + x) * np.exp(-x) - u) / np.maximum(x * np.exp(-x), 1e-300))
    return x


class Sampler:
    """ICWS of many sets at once: ``BANDS * ROWS`` samples of 32 bits each.

    A shingle's r and c ~ Gamma(2, 1) and beta ~ U(0, 1) of a sample come from 16 bits
    each of its hash times the sample's own odd number.
    """

    def __init__(self):
        gamma = _gamma_quantiles()
        self.gamma, self.log_gamma = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        self.odd = np.random.default_rng(20).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """A row of int32 samples for each set; the sets are not empty."""
        keys = np.concatenate([k for k, _ in sets])
        log_w = np.log(np.concatenate([w for _, w in sets])).astype(np.float32)
        sizes = np.array([len(k) for k, _ in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        out = np.empty((len(sets), len(self.odd)), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for s, odd in enumerate(self.odd):
                mixed = keys * odd                           # the highest 48 bits are well mixed
                r = self.gamma.take((mixed >> np.uint64(48)).view(np.int64), mode="clip")
                beta = mixed.view(np.uint16)[1::4].astype(np.float32)
                beta += np.float32(0.5)
                beta *= np.float32(1 / (1 << 16))
                t = log_w / r
                t += beta
                np.floor(t, out=t)
                a = beta
                a -= t
                a -= 1
                a *= r
                a += self.log_gamma.take((mixed >> np.uint64(32) & np.uint64(0xFFFF)).view(np.int64), mode="clip")
                hit = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), sizes))
                at = hit[np.searchsorted(hit, starts)]
                out[:, s] = (keys[at] ^ (t[at].astype(np.int64).view(np.uint64) * np.uint64(SEED))) * odd
        return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _batched(pairs, most: int = 1 << 15):
    """Lists of (row, set) with about ``most`` shingles each, a single larger set alone."""
    held, n = [], 0
    for row, s in pairs:
        if held and n + len(s[0]) > most:
            yield held
            held, n = [], 0
        held.append((row, s))
        n += len(s[0])
    if held:
        yield held


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def inverse_frequencies(hashed: DataFrame) -> np.ndarray:
    """For each cell of word hashes (column w of ``hashed``), 1 + ln(N / df) / ln(N): 2
    for a word of one text, 1 for a word of all.

    Counted over all texts; tasks send ranges of cells, which are summed in two steps,
    so a group holds few of them, and the driver gets one number a cell.
    """
    cells, ranges, together = 1 << WORD_BITS, 256, 64
    step = cells // ranges

    def count(batches):
        df, rows = np.zeros(cells, np.int32), 0
        for pdf in batches:
            for w in pdf["w"]:
                h = np.asarray(w, dtype=np.int64).view(np.uint64) >> np.uint64(64 - WORD_BITS)
                df[h.view(np.int64)] += 1            # once a cell, however often it is named
            rows += len(pdf)
        salt = TaskContext.get().partitionId() // together  # a group has the ranges of so many tasks
        for i in range(ranges):
            part = df[i * step:(i + 1) * step]
            at = np.flatnonzero(part)
            if len(at) or i == 0:
                yield pd.DataFrame({"range": [i], "salt": [salt], "cell": [at.astype(np.int32)],
                                    "n": [part[at].astype(np.int64)], "rows": [rows if i == 0 else 0]})

    def total(key, pdf):
        df = np.zeros(step, np.int64)
        for c, n in zip(pdf["cell"], pdf["n"]):
            df[np.asarray(c, dtype=np.int64)] += np.asarray(n, dtype=np.int64)
        at = np.flatnonzero(df)
        return pd.DataFrame({"range": [key[0]], "salt": [0], "cell": [at.astype(np.int32)], "n": [df[at]],
                             "rows": [int(pdf["rows"].sum())]})

    schema = "range int, salt int, cell array<int>, n array<bigint>, rows long"
    got = (hashed.select("w").mapInPandas(count, schema)
           .groupBy("range", "salt").applyInPandas(total, schema)
           .groupBy("range").applyInPandas(total, schema).collect())
    df = np.ones(cells)
    for r in got:
        df[r["range"] * step + np.asarray(r["cell"], dtype=np.int64)] = r["n"]
    n = max(2, sum(r["rows"] for r in got))
    return (1 + np.log(n / df) / np.log(n)).astype(np.float32)


# ---------------------------------------------------------------- links and classes

def node_of(text: Column) -> Column:
    """A text's node: the 16 bytes of its MD5; null counts as empty."""
    return F.unhex(F.md5(whole(text).cast("binary")))


def signatures(hashed: DataFrame, idf) -> DataFrame:
    """node, samples (array of ints), mass (sum of weights), size (distinct shingles), bits
    (see ``parities``) and tokens (see ``prefix``) of each distinct text that has words.

    ``hashed`` has node, w; ``idf`` is a broadcast array of fixed size.
    """
    def sample(batches):
        sampler = Sampler()
        for pdf in batches:
            rows = ((node, _shingles(w, idf.value)) for node, w in zip(pdf["node"], pdf["w"]) if len(w))
            for held in _batched(rows):
                sets = [(k, w * n) for _, (k, w, n, _) in held]
                found = sampler.samples(sets)
                first = [prefix(*x) for _, x in held]
                yield pd.DataFrame({"node": [n for n, _ in held], "samples": list(found),
                                    "mass": [float(w.sum()) for _, w in sets],
                                    "size": [len(k) for k, _ in sets], "bits": [parities(k) for k, _ in sets],
                                    "tokens": first})

    schema = "node binary, samples array<int>, mass double, size int, bits array<bigint>, tokens array<bigint>"
    return hashed.select("node", "w").mapInPandas(sample, schema).dropDuplicates(["node"])


def _band(samples: Column, band: Column) -> Column:
    return F.slice(samples, band * ROWS + 1, ROWS)


def _bands(signed: DataFrame, *keep: str) -> DataFrame:
    """A row for each band of each node, with the hash ``key`` of its samples."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, _band(F.col("samples"), b)))
    return signed.select(*keep, F.posexplode(keys).alias("band", "key"))


def buckets(signed: DataFrame) -> DataFrame:
    """bucket, band, node for every band that at least two texts share."""
    return _shared(_bands(signed, "node").select(F.col("key").alias("bucket"), "band", "node"))


def _shared(rows: DataFrame) -> DataFrame:
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows.join(sizes, "bucket").select("bucket", "band", "node", "size")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def verify(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """a, b, similarity of the ``pairs`` (a, b).

    ``texts`` has node, text; a pair's texts are joined to it and compared whole.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    hashed = both.select("a", "b", word_hashes(F.col("text_a")).alias("wa"), word_hashes(F.col("text_b")).alias("wb"))

    @F.pandas_udf("double")
    def similarity(wa: pd.Series, wb: pd.Series) -> pd.Series:
        return pd.Series([weighted_jaccard(shingles(x, idf.value), shingles(y, idf.value))
                          for x, y in zip(wa, wb)], dtype=float)

    return hashed.select("a", "b", similarity("wa", "wb").alias("similarity"))


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that edges (a, b) connect a node with.

    Each round takes the neighbours' least label and then the label's own label; the
    rounds grow with the logarithm of a component's width.  Every round is written, so
    a lost executor costs one round at most.
    """
    both = written(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        least = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                 F.least("label", "near").alias("label"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = written(least.join(own, "label").select("node", "old", F.least("label", "up").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter(F.col("old") != F.col("label")).isEmpty():
            return labels


def extend(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after the edges are added: only their distinct pairs of unlike labels
    are connected anew, however many edges run between two components."""
    named = _with_label(_with_label(edges.select("a", "b"), labels, "a", "a_label"), labels, "b", "b_label")
    between = named.filter("a_label != b_label").select(*_pair(F.col("a_label"), F.col("b_label"))).distinct()
    joined = components(between)
    lone = joined.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    new = joined.select(F.col("node").alias("label"), F.col("label").alias("new"))
    return written(labels.unionByName(lone).join(new, "label", "left").select(
        "node", F.coalesce("new", "label").alias("label")), "labels")


def _with_label(rows: DataFrame, labels: DataFrame, node: str = "node", label: str = "label") -> DataFrame:
    known = labels.select(F.col("node").alias(node), F.col("label").alias("__l"))
    return rows.join(known, node, "left").withColumn(label, F.coalesce("__l", node)).drop("__l")


def _may_match(x: str, y: str) -> Column:
    """Whether rows ``x`` and ``y`` of one bucket need an exact comparison.

    Not if they met in an earlier band; not if the triangle inequality of the weighted
    Jaccard distance tells it from both texts' similarities to the bucket's leader; not
    if the lighter text weighs less than 0.8 of the heavier.  No similar pair is lost.
    """
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    a, b, band = of(x, "samples"), of(y, "samples"), of(x, "band")
    earlier = F.exists(F.filter(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: j < band),
                       lambda j: _band(a, j) == _band(b, j))
    near = F.coalesce(F.abs(of(x, "to_leader") - of(y, "to_leader")) <= 1 - SIMILAR + 1e-9, F.lit(True))
    heavy = F.greatest(of(x, "mass"), of(y, "mass")) * (SIMILAR - 1e-6)
    even = F.least(of(x, "mass"), of(y, "mass")) >= heavy
    return (of(x, "label") != of(y, "label")) & near & even & ~earlier


def _apart(now: DataFrame, signed: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of a bucket's members apart with those of other components
    that ``_may_match`` lets through; blocks only deal them out."""
    side = max(1, int(MANY ** 0.5))
    apart = F.col("label") != F.col("lead_label")
    open_ = now.groupBy("bucket").agg(
        F.ceil(F.count_if(apart) / side).cast("int").alias("n_some"),
        F.ceil(F.count(F.lit(1)) / side).cast("int").alias("n_all")).filter("n_some > 0")
    rows = now.join(open_, "bucket").join(signed, "node")

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def blocks(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    some = rows.filter(apart).withColumn("i", block("n_some")).withColumn("j", blocks("n_all")).alias("x")
    others = rows.withColumn("j", block("n_all")).withColumn("i", blocks("n_some")).alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("bucket", "i", "j")]
    # Two members apart would meet twice.
    once = (F.col("y.label") == F.col("y.lead_label")) | (F.col("x.node") < F.col("y.node"))
    met = some.join(others, same[0] & same[1] & same[2] & once & _may_match("x", "y"))
    return met.select(*_pair(F.col("x.node"), F.col("y.node"))).distinct()


def _parts(now: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (a, b) of members apart that share a band and further samples: in each part
    one member of each component meets the largest component's.

    A component is one row a part, so the pairs are at most ``len(PARTS)`` a row of ``now``.
    """
    open_ = now.filter("label != lead_label").select("bucket").distinct()
    rows = now.join(open_, "bucket").join(signed.select("node", "samples"), "node")
    twice = F.concat("samples", "samples")

    def key(part: Column) -> Column:
        return F.xxhash64("bucket", part["c"], F.slice(twice, (F.col("band") + 1) * ROWS + part["at"] + 1, part["n"]))

    parts = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(n).alias("n"), F.lit(at).alias("at"))
                      for c, (n, at) in enumerate(PARTS)])
    dealt = rows.select("node", "label", F.explode(F.transform(parts, key)).alias("part"))
    # One member a component and part; another one in another part.
    reps = dealt.groupBy("part", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node", "part").alias("h"), "node"))["node"].alias("node"))
    reps = written(reps, "neardup-parts")
    lead = reps.groupBy("part").agg(F.count(F.lit(1)).alias("labels"),
                                    F.max(F.struct("n", F.xxhash64("part", "node").alias("h"), "node"))["node"].alias("leader"))
    met = reps.join(lead.filter("labels > 1"), "part").filter("node != leader")
    return met.select(*_pair(F.col("node"), F.col("leader"))).distinct()


def _tokens(signed: DataFrame, labels: DataFrame) -> DataFrame:
    """token, id (hash of the node), label (hash), mass, after, n (texts) of the tokens that several
    components hold, but for texts with which not even the token's lightest could be similar."""
    rows = signed.select("node", "mass", "tokens").withColumn("known", _among(labels)(F.col("node")))
    # Only texts that may have a label are exchanged for it.
    named = _with_label(rows.filter("known"), labels).unionByName(
        rows.filter("NOT known").withColumn("label", F.col("node"))).select(
        F.xxhash64("node").alias("id"), F.col("mass").cast("float"), "tokens",
        F.when(F.col("label") != F.col("node"), F.xxhash64("label")).alias("other"))
    rows = named.select("id", "other", "mass", F.explode("tokens").alias("packed")).select(
        F.col("packed").bitwiseAND(F.lit(~255)).alias("token"), "id", "other", "mass", "packed")
    # What is exchanged is token by token: as few and as short columns as will do.
    rows = rows.repartition("token").select(
        "token", "id", F.coalesce("other", "id").alias("label"), "mass", _after(F.col("packed"), F.col("mass")).alias("after"))
    of = Window.partitionBy("token")
    held = rows.withColumns({"n": F.count(F.lit(1)).over(of),
                             "first": F.min("label").over(of), "last": F.max("label").over(of),
                             "least": F.min("mass").over(of)})
    fits = F.col("after") >= (F.col("mass") + F.col("least")) * (LEAST * (1 - SLACK))
    return held.filter((F.col("first") != F.col("last")) & fits).select("token", "id", "label", "mass", "after", "n")


def _token_pairs(rows: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (a, b) of unlike components that share a token, where enough weight remains in
    both for 0.8 and few enough bits differ."""
    x, y = rows.alias("x"), rows.alias("y")
    both = (F.col("x.mass") + F.col("y.mass")) * (LEAST * (1 - SLACK))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.id") < F.col("y.id"))
                 & (F.col("x.label") != F.col("y.label"))
                 & (F.col("x.after") >= both) & (F.col("y.after") >= both))
    pairs = written(met.select(F.col("x.id").alias("a_id"), F.col("y.id").alias("b_id")).distinct(), "neardup-ids")
    ids = written(pairs.select(F.col("a_id").alias("id")).unionAll(pairs.select(F.col("b_id").alias("id"))).distinct(),
                  "neardup-met")
    held = signed.withColumn("id", F.xxhash64("node")).filter(_among(ids, "id")(F.col("id")))
    for side in "ab":
        pairs = pairs.join(held.select(F.col("id").alias(f"{side}_id"), F.col("node").alias(f"{side}_node"),
                                       F.col("mass").alias(f"{side}_mass"), F.col("bits").alias(f"{side}_bits")), f"{side}_id")

    @F.pandas_udf("int")
    def unlike(a: pd.Series, b: pd.Series) -> pd.Series:
        def differ(v, w):
            words = min(len(v), len(w))
            return int(np.bitwise_count((folded(v, words) ^ folded(w, words)).view(np.uint64)).sum())
        return pd.Series([differ(v, w) for v, w in zip(a, b)], dtype="int32")

    few = unlike("a_bits", "b_bits") <= (F.col("a_mass") + F.col("b_mass")) * (1 - 2 * LEAST + SLACK)
    return pairs.filter(few).select(*_pair(F.col("a_node"), F.col("b_node")))


def _common(x: list[tuple[np.ndarray, np.ndarray]], y: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The summed minima of every set of ``x`` with every one of ``y``, by the shingles of both."""
    out = np.zeros((len(x), len(y)))
    sides = []
    for sets in (x, y):
        keys = np.concatenate([k for k, _ in sets])
        at = np.argsort(keys, kind="stable")
        sides.append((keys[at], np.concatenate([w for _, w in sets])[at],
                      np.repeat(np.arange(len(sets)), [len(k) for k, _ in sets])[at]))
    (kx, wx, ix), (ky, wy, iy) = sides
    shared = np.intersect1d(kx, ky)
    for a, b, c, d in zip(np.searchsorted(kx, shared), np.searchsorted(kx, shared, "right"),
                          np.searchsorted(ky, shared), np.searchsorted(ky, shared, "right")):
        out[np.ix_(ix[a:b], iy[c:d])] += np.minimum.outer(wx[a:b], wy[c:d])
    return out


def _near(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Rows x and y of a block's two sides, what each two share at least if they are similar, and
    whether they are of unlike components and enough weight remains in both for that."""
    own, label, mass, after = (pdf[c].to_numpy() for c in ("own", "label", "mass", "after"))
    low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
    x, y = np.flatnonzero(own == low), np.flatnonzero(own == high)
    need = (mass[x, None] + mass[None, y]) * (LEAST * (1 - SLACK))
    near = (label[x, None] != label[None, y]) & (after[x, None] >= need) & (after[None, y] >= need)
    if low == high:
        near &= x[:, None] < y[None, :]
    return x, y, need, near


def _unlike(pdf: pd.DataFrame, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bits differ of every two texts, the longer one's folded to the other's cells."""
    bits = [np.asarray(b, dtype=np.int64) for b in pdf["bits"]]
    widths = np.array([len(b) for b in bits])
    unlike = np.zeros((len(x), len(y)), np.uint32)
    for v in np.unique(widths[x]):
        for w in np.unique(widths[y]):
            words = min(v, w)
            i, j = np.flatnonzero(widths[x] == v), np.flatnonzero(widths[y] == w)
            # Of signed ones the absolute value is counted.
            left, right = (np.stack([folded(bits[k], words) for k in side]).view(np.uint64) for side in (x[i], y[j]))
            part = np.zeros((len(i), len(j)), np.uint32)
            for word in range(words):
                part += np.bitwise_count(left[:, None, word] ^ right[None, :, word])
            unlike[np.ix_(i, j)] = part
    return unlike


def _first_common(token: int, keys: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether ``token`` is the first that every two texts have in common; ``keys`` are ``_in_order``."""
    keys = [k & ~255 for k in keys]
    heads = [k[:int(np.flatnonzero(k == token)[0])] for k in keys]
    heads = [(k, np.ones(len(k))) for k in heads]
    return _common([heads[i] for i in x], [heads[i] for i in y]) == 0


def _block_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """The texts of a block with one of which they may be similar, by weights and bits, and,
    where there are ``tokens``, of which they have this token as the first in common."""
    x, y, need, near = _near(pdf)
    if near.any():
        near &= _unlike(pdf, x, y) <= need / LEAST * (1 - 2 * LEAST + 3 * SLACK)
    if "tokens" in pdf and near.any():
        rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        x, y, near = x[rows], y[cols], near[np.ix_(rows, cols)]
        keys = [np.asarray(t, dtype=np.int64) for t in pdf["tokens"]]
        near &= _first_common(pdf["token"].iloc[0], keys, x, y)
    at = np.union1d(x[near.any(axis=1)], y[near.any(axis=0)])
    return pdf.iloc[at][["token", "id", "label", "mass", "after", "size"]]


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links a, b, similarity of one block of a token's texts, as many as join their components.

    Two texts meet at their first common token only.
    """
    sets = [(np.asarray(k, dtype=np.int64), np.asarray(w)) for k, w in zip(pdf["keys"], pdf["weights"])]
    label = pdf["label"].to_numpy()
    x, y, need, near = _near(pdf)
    if near.any():
        near &= _first_common(pdf["token"].iloc[0], [k for k, _ in sets], x, y)
    rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    found = []
    if len(rows):
        x, y, cut = x[rows], y[cols], np.ix_(rows, cols)
        near = near[cut] & (_common([sets[i] for i in x], [sets[i] for i in y]) >= need[cut])
        up, by_hash = {}, {}

        def root(c):
            while up.get(c, c) != c:
                c = up[c]
            return c

        def by_keys(r):
            if r not in by_hash:
                k = sets[r][0].view(np.uint64)
                by_hash[r] = k[np.argsort(k)], sets[r][1][np.argsort(k)]
            return by_hash[r]

        for i, j in zip(*np.nonzero(near)):
            p, q = root(label[x[i]]), root(label[y[j]])
            if p != q:
                similarity = weighted_jaccard(by_keys(x[i]), by_keys(y[j]))
                if similarity >= SIMILAR:
                    up[p] = q
                    found.append((pdf["node"].iloc[x[i]], pdf["node"].iloc[y[j]], similarity))
    return pd.DataFrame(found, columns=["a", "b", "similarity"])


def _block_sets(texts: DataFrame, idf) -> DataFrame:
    """id, node, keys, weights: the ``ordered`` shingles of each text."""
    def sets(batches):
        for pdf in batches:
            got = [ordered(w, idf.value) for w in pdf["w"]]
            yield pdf[["id", "node"]].assign(keys=[k.view(np.int64) for k, _ in got], weights=[w for _, w in got])

    return texts.select(F.xxhash64("node").alias("id"), "node", word_hashes(F.col("text")).alias("w")).mapInPandas(
        sets, "id long, node binary, keys array<bigint>, weights array<double>")


def _blocks(rows: DataFrame, beside: DataFrame, blocks: Column, body, schema: str) -> DataFrame:
    """``body`` of every two blocks of each token's texts; ``beside`` has further columns of an id."""
    dealt = rows.withColumn("blocks", F.ceil(blocks).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("id", "token"), F.col("blocks")).cast("int"))
    met = dealt.join(beside, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    return met.groupBy("token", "low", "high").applyInPandas(body, schema)


def _among(rows: DataFrame, name: str = "node"):
    """A function of a column: false for most values that are not in the column ``name`` of
    ``rows``, true for all that are.

    It looks up a bit of the value's hash.  The bits are 8 to 16 a row, 2^26 at most (8 MB):
    beyond 8 million rows it lets more of the others through, never less of ``rows``.
    """
    log = min(26, max(16, (8 * rows.count()).bit_length()))
    cell = F.shiftrightunsigned(F.xxhash64(name), 64 - log)
    got = rows.select(F.shiftright(cell, 6).alias("at"), F.pmod(cell, F.lit(64)).cast("int").alias("bit")).groupBy("at").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toPandas()
    bits = np.zeros(1 << log - 6, np.int64)
    bits[got["at"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    @F.pandas_udf("boolean")
    def held(hashes: pd.Series) -> pd.Series:
        cells = hashes.to_numpy(dtype=np.int64).view(np.uint64) >> np.uint64(64 - log)
        return pd.Series(shared.value[(cells >> np.uint64(6)).astype(np.int64)] >> (cells & np.uint64(63)) & np.uint64(1) == 1)

    return lambda value: held(F.xxhash64(value))


def _texts(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """node, text of the distinct texts that are among ``nodes``."""
    rows = docs.select(node_of(F.col(text)).alias("node"), whole(F.col(text)).alias("text"))
    # Both sides are exchanged at every size: what the texts are joined to grows with them.
    return written(rows.filter(_among(nodes)(F.col("node"))).join(nodes.hint("merge"), "node", "left_semi")
                   .dropDuplicates(["node"]), "neardup-texts")


def _rest(docs: DataFrame, text: str, signed: DataFrame, labels: DataFrame, met: DataFrame, idf) -> DataFrame:
    """a, b, similarity: the links between components that the bands left, as many as join them.

    Of two similar texts both have their first common shingle among their ``tokens``, so all
    texts that share one meet: pair by pair where they are few, in blocks where many.
    """
    rows = written(_tokens(signed, labels), "neardup-tokens")
    few, many = rows.filter(F.col("n") <= HOT), rows.filter(F.col("n") > HOT)
    pairs = written(_token_pairs(few, signed).join(met, ["a", "b"], "left_anti"), "neardup-rest")
    columns = "token long, id long, label long, mass float, after double, size int"
    of = Window.partitionBy("token")
    # Texts alike share most of their tokens: those that would only meet again are told before
    # whole sets are dealt out.
    for beside in (["bits"], ["bits", "tokens"]):
        ids = written(many.select("id").distinct(), "neardup-ids")
        named = signed.withColumn("id", F.xxhash64("node"))
        held = named.filter(_among(ids, "id")(F.col("id"))).select("id", "size", *beside)
        many = written(_blocks(many.drop("size"), held, F.col("n") / SIDE, _block_rows, columns).distinct(),
                       "neardup-many").withColumn("n", F.count(F.lit(1)).over(of))
    held = written(named.select("id", "node").join(many.select("id").distinct(), "id", "left_semi").select("node"),
                   "neardup-held")
    texts = _texts(docs, text, pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
                   .unionAll(held).distinct())
    # Written first: a filter would be moved before the column and every pair compared twice, by two
    # Python workers a task.
    seen = written(verify(pairs, texts, idf), "neardup-met").filter(F.col("similarity") >= SIMILAR)
    if many.isEmpty():
        return seen
    sets = written(_block_sets(texts.join(held.hint("merge"), "node", "left_semi"), idf), "neardup-sets")
    many = many.withColumn("load", F.sum("size").over(of))
    found = _blocks(many, sets, F.greatest(F.col("n") / SIDE, F.col("load") / LOAD), _block_links,
                    "a binary, b binary, similarity double")
    return written(found.unionAll(seen), "neardup-met")


@contextmanager
def _few_rows_at_once(spark):
    """At most ``ARROW_ROWS`` rows at once to Python meanwhile: 10,000 texts' words take tens
    of MB in the JVM and again in each Python worker, which keep that memory."""
    before = spark.conf.get(ARROW_CONF)
    if int(before) <= 0 or int(before) > ARROW_ROWS:
        spark.conf.set(ARROW_CONF, str(ARROW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(ARROW_CONF, before)


def links(docs: DataFrame, text: str = "text", exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(edges, labels) among the nodes of all distinct texts of ``docs``.

    In each bucket all members meet the one that shares most buckets.  Members that
    this leaves outside its component are apart: they meet in parts of the bucket (see
    ``_parts``), up to ``ROUNDS`` times while that joins components.  With ``exact`` they meet
    the members of other components for which ``_may_match`` holds, at any size of the
    bucket; a bucket of more than ``MANY`` such pairs is dealt into blocks of members, and
    every block of those apart meets every block of all, each two under a key of their own.
    Both ways ``_rest`` adds the links that are still missing between components, so the
    labels are those of all links; the edges are some of them that connect each component.
    """
    with _few_rows_at_once(docs.sparkSession):
        return _links(docs, text, exact)


def _links(docs: DataFrame, text: str, exact: bool) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    hashed = docs.select(node_of(F.col(text)).alias("node"), word_hashes(F.col(text)).alias("w"))
    idf = spark.sparkContext.broadcast(inverse_frequencies(hashed))  # 4 MB at any size
    signed = written(signatures(hashed, idf), "neardup-samples")
    members = written(buckets(signed), "neardup-buckets")
    fame = written(members.groupBy("node").agg(F.sum("size").alias("fame")), "neardup-fame")
    texts = _texts(docs, text, fame.select("node"))
    lead = members.join(fame, "node").groupBy("bucket").agg(F.max(F.struct("fame", "node"))["node"].alias("leader"))
    led = written(members.join(lead, "bucket").select("bucket", "band", "node", "leader"), "neardup-led")
    pairs = led.filter("node != leader").select(*_pair(F.col("node"), F.col("leader"))).distinct()
    met = written(verify(pairs, texts, idf), "neardup-met")
    alone = spark.createDataFrame([], "node binary, label binary")
    labels = extend(alone, met.filter(F.col("similarity") >= SIMILAR))

    for _ in range(1 if exact else ROUNDS):
        now = _with_label(_with_label(led, labels), labels, "leader", "lead_label")
        if exact:
            to_leader = met.select("a", "b", F.col("similarity").alias("to_leader"))
            now = now.withColumns(dict(zip(("a", "b"), _pair(F.col("node"), F.col("leader"))))).join(
                to_leader, ["a", "b"], "left").select(
                "bucket", "band", "node", "label", "lead_label",
                F.when(F.col("node") == F.col("leader"), 1.0).otherwise(F.col("to_leader")).alias("to_leader"))
        now = written(now, "neardup-now")
        meet = _apart(now, signed) if exact else _parts(now, signed)
        rest = written(meet.join(met, ["a", "b"], "left_anti"), "neardup-rest")
        if rest.isEmpty():
            break
        seen = written(verify(rest, texts, idf), "neardup-met")
        met = met.unionAll(seen)
        similar = seen.filter(F.col("similarity") >= SIMILAR)
        if similar.isEmpty():
            break
        labels = extend(labels, similar)
    rest = _rest(docs, text, signed, labels, met.select("a", "b"), idf)
    if not rest.isEmpty():
        labels = extend(labels, rest)
    return met.filter(F.col("similarity") >= SIMILAR).unionByName(rest), labels


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", exact: bool = False) -> DataFrame:
    """doc_id, node, label, class_id: a row per row of ``docs``; class_id is the smallest
    doc_id of the class.

    Equal texts are one class at once (null is the empty text), whatever their words;
    texts without words have no other links.  Rows without doc_id get the class's id,
    which is null only where no member has one.  An empty table has no rows.
    """
    _, labels = links(docs, text, exact)
    rows = _with_label(docs.select(F.col(doc_id).alias("doc_id"), node_of(F.col(text)).alias("node")), labels)
    ids = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return rows.join(ids, "label").select("doc_id", "node", "label", "class_id")


def query(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "class_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the document with the smallest doc_id stays, of
    repeated rows one; columns and values stay as they are."""
    all_rows = written(classes(docs), "neardup-classes")
    best = all_rows.groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("b"))
    counted = all_rows.groupBy("label", "doc_id", "node").agg(F.count(F.lit(1)).alias("n"))
    kept = counted.join(best, "label").filter(F.struct("doc_id", "node") == F.col("b"))
    # names of our own, as the documents may have any
    kept = written(kept.select(F.col("doc_id").alias("__kept_id"), F.col("node").alias("__kept_node"),
                               F.col("n").alias("__kept_rows")), "neardup-kept")
    rows = docs.withColumn("__own_node", node_of(F.col("text")))
    same = (F.col("__own_node") == F.col("__kept_node")) & F.col("doc_id").eqNullSafe(F.col("__kept_id"))
    out = rows.join(kept, same)
    single, repeated = out.filter("__kept_rows = 1"), out.filter("__kept_rows > 1")
    return single.select(*docs.columns).unionAll(
        repeated.dropDuplicates(["doc_id", "__own_node"]).select(*docs.columns))
