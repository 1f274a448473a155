"""Byte-level BPE encoding and decoding with Spark higher-order functions.

A text is cut into pieces by the tokenizer's pattern.  The distinct pieces that occur
most often are encoded once: a fold turns a piece's bytes into ids and merges
neighbours, lowest rank first, until no pair of them is a token.  Ranks are looked up
in a fixed table that the plan holds as one literal value (the result of a scalar
subquery): an array that two hashes of a pair point into.  The encoded pieces are a table
of bounded size that every task gets; there a text's pieces are looked up, and what its
ids come to (the ids, their bytes, the bytes they decode to) is joined piece by piece.
Pieces that are too rare for the table are merged where they stand by the same rule in
Python: the fold itself takes some ten times as long a piece.  Decoding concatenates the
ids' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import let, whole, written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
KNOWN_PIECES = 1 << 18   # frequent pieces in the table, at most (some 25 MB)
ID_BITS = 20             # ids are below 2^20
SHORT = 48               # bytes; longer pieces are merged with a heap and not counted
NONE = (1 << 31) - 1     # rank of a pair that is no token
KEPT = 1 << 16           # rare pieces that a task keeps the ids of
FOLD_TASKS = 64          # tasks that fold the frequent pieces


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _cuckoo(first: np.ndarray, second: np.ndarray, values: np.ndarray, size: int) -> np.ndarray | None:
    """A table of ``size`` slots, -1 if free, with each value in one of its two places;
    None if they don't fit."""
    held = np.full(size, -1, dtype=np.int64)  # which entry a slot has
    lone, entry = np.unique(first, return_index=True)
    held[lone] = entry                        # of those that share a first place, one stays
    left = np.setdiff1d(np.arange(len(first)), entry, assume_unique=True)
    for e in left.tolist():
        at = int(second[e])
        for _ in range(500):
            e, held[at] = int(held[at]), e
            if e < 0:
                break
            a, b = int(first[e]), int(second[e])
            at = b if at == a else a
        else:
            return None
    return np.where(held < 0, -1, values[held])


def _prime(least: int) -> int:
    n = least | 1
    while any(n % d == 0 for d in range(3, int(n ** 0.5) + 1, 2)):
        n += 2
    return n


# Multipliers of the two places of a pair: (left * p + right * q) mod size.
_PLACES = ((0x9E37, 0x79B9), (0x85EB, 0xCA6B))


def pair_table(ranks: dict[bytes, int]) -> np.ndarray:
    """Slots of every pair of tokens that makes a token: left, right and merged id."""
    pairs = [(a, b, merged) for token, merged in ranks.items() for i in range(1, len(token))
             if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
    a, b, merged = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
    size = _prime(3 * len(pairs) + 3)
    while True:
        first, second = ((a * p + b * q) % size for p, q in _PLACES)
        table = _cuckoo(first, second, ((a << ID_BITS) | b) << ID_BITS | merged, size)
        if table is not None:
            return table
        size = _prime(size + size // 2)


_FIELDS = {"bytes": pa.list_(pa.int32()), "pairs": pa.list_(pa.int64()), "tokens": pa.list_(pa.binary())}


@dataclass
class Tables:
    """What the expressions look up, of a size that the ranks bound.

    ``row`` is one row with one struct: the id of each byte, the pair slots, and of each id
    its token's bytes.  Plans hold it as a scalar subquery, so it reaches the tasks as one
    literal value.  ``beside`` adds it as a column, which one expression of the next
    projection may use: Catalyst then puts the subquery in its place, and no row carries
    the tables.
    """

    row: DataFrame
    n_pairs: int

    def beside(self, df: DataFrame) -> DataFrame:
        return df.withColumn("__tables", self.row.scalar())


def tables(spark: SparkSession, ranks: dict[bytes, int]) -> Tables:
    if max(ranks.values()) >= 1 << ID_BITS:
        raise ValueError("token ids must be below 2^20")
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    pairs = pair_table(ranks)
    row = (pa.array([ranks[bytes([b])] for b in range(256)]), pa.array(pairs), pa.array(tokens))
    columns = {name: pa.ListArray.from_arrays([0, len(values)], values.cast(kind.value_type))
               for (name, kind), values in zip(_FIELDS.items(), row)}
    one = spark.createDataFrame(pa.table(columns)).select(F.struct(*_FIELDS).alias("t"))
    return Tables(one, len(pairs))


# White space as Unicode defines it; Java's own \s knows ASCII only, and its flag for
# Unicode classes takes twice the time.
_SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def java_pattern(pattern: str) -> str:
    r"""``pattern`` with \s and \S written out as classes of Unicode white space."""
    out, inside = [], False
    for part in re.findall(r"\\.|.", pattern, re.DOTALL):
        if part == r"\s":
            out.append(_SPACE if inside else f"[{_SPACE}]")
        elif part == r"\S":
            out.append(f"[^{_SPACE}]")
        else:
            inside = part == "[" or (inside and part != "]")
            out.append(part)
    return "".join(out)


def pieces(text: Column, pattern: str = PATTERN) -> Column:
    """The pattern's matches in a whole text."""
    return F.regexp_extract_all(whole(text), F.lit(java_pattern(pattern)), F.lit(0))


def fold(t: Column, n_pairs: int, piece: Column) -> Column:
    """The ids of a piece: its bytes' ids, the leftmost pair of the lowest rank merged
    again and again."""
    mask = F.lit((1 << ID_BITS) - 1).cast("long")

    def rank(a: Column, b: Column) -> Column:
        a, b = a.cast("long"), b.cast("long")
        key = a * (1 << ID_BITS) + b
        found = F
        for p, q in _PLACES:
            entry = F.get(t["pairs"], ((a * p + b * q) % n_pairs).cast("int"))
            found = found.when(F.shiftright(entry, ID_BITS) == key, entry.bitwiseAND(mask).cast("int"))
        return found.otherwise(NONE)

    def merge(p: Column, ranks: Column, least: Column, at: Column) -> Column:
        left, right = F.get(p, at - 2), F.get(p, at + 1)
        beside = F.array_compact(F.array(F.when(left.isNotNull(), rank(left, least)),
                                         F.when(right.isNotNull(), rank(least, right))))
        n = F.size(p)
        return F.struct(F.concat(F.slice(p, 1, at - 1), F.array(least), F.slice(p, at + 2, n)).alias("p"),
                        F.concat(F.slice(ranks, 1, F.greatest(at - 2, F.lit(0))), beside,
                                 F.slice(ranks, at + 2, n)).alias("ranks"))

    def step(s: Column) -> Column:
        least = F.array_min(s["ranks"])
        return let(F.struct(least.alias("r"), F.array_position(s["ranks"], least).cast("int").alias("at")),
                   lambda x: F.when(x["r"] < NONE, merge(s["p"], s["ranks"], x["r"], x["at"])).otherwise(s))

    def start(p: Column) -> Column:
        ranks = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), rank)
        return F.struct(p.alias("p"), ranks.alias("ranks"))

    chars = F.filter(F.split(F.decode(piece.cast("binary"), "ISO-8859-1"), ""), lambda c: c != "")
    first = F.transform(chars, lambda c: F.get(t["bytes"], F.ascii(c)))
    return let(first, lambda p: F.when(F.size(p) < 2, p).otherwise(F.aggregate(
        F.sequence(F.lit(2), F.size(p)), start(p), lambda s, _: step(s), lambda s: s["p"])))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """What ``fold`` gives, for one piece in a task."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    if len(parts) > SHORT:
        return merge_long(parts, ranks)
    pairs = [ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
    while pairs and (least := min(pairs)) < NONE:
        i = pairs.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
        if i + 1 < len(parts):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NONE)
    return [ranks[p] for p in parts]


def merge_long(parts: list, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap of pairs, for pieces too long to scan at each merge."""
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts) and (r := ranks.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (r, i, parts[i], parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or parts[i] != a or parts[j] != b:
            continue  # one of them has been merged meanwhile
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[p] for p in parts if p is not None]


def frequent_pieces(docs: DataFrame, text: str, pattern: str, most: int) -> DataFrame:
    """piece: the distinct pieces that occur most often in all texts, at most ``most``.

    Counts are summed in the tasks; a histogram of the counts' logarithms says from
    which count on they fit, so no sort and no single task is needed.
    """
    counts = written(docs.select(F.explode(pieces(F.col(text), pattern)).alias("piece"))
                     .filter(F.octet_length("piece") <= SHORT)
                     .groupBy("piece").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bpe-counts")
    size = F.floor(F.log2("n") * 8).cast("int")
    cut, total = 1 << 20, 0
    for r in sorted(counts.groupBy(size.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        total += r["n"]
        if total > most:
            break
        cut = r["s"]
    return counts.filter(size >= cut).select("piece")


class Encoder:
    """A task's look-up of pieces: known ones, tokens that are whole pieces, and, for as
    long as ``KEPT`` allows, the rare ones it merged itself."""

    def __init__(self, ranks: dict[bytes, int], known: bytes, pattern: str):
        self.ranks, self.find, self.known, self.rare = ranks, regex.compile(pattern).findall, {}, {}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        for batch in pa.ipc.open_stream(known):
            ids = batch["ids"].cast(pa.list_(pa.uint32()))
            flat, at = ids.flatten().to_numpy(), (ids.offsets.to_numpy() - ids.offsets[0].as_py()).tolist()
            for piece, a, b in zip(batch["piece"].to_pylist(), at, at[1:]):
                self.known[piece] = self.entry(flat[a:b])

    def entry(self, ids) -> tuple[bytes, bytes]:
        """The ids as unsigned 32-bit integers, low byte first, and the bytes of their tokens."""
        return np.asarray(ids, dtype="<u4").tobytes(), b"".join([self.tokens[i] for i in ids])

    def __call__(self, text: str) -> list[tuple[bytes, bytes]]:
        out, known, rare = [], self.known, self.rare
        for piece in self.find(text):
            found = known.get(piece) or rare.get(piece)
            if found is None:
                raw = piece.encode("utf-8")
                own = self.ranks.get(raw)
                found = self.entry(merge(raw, self.ranks) if own is None else [own])
                if len(raw) <= SHORT:
                    if len(rare) >= KEPT:
                        rare.clear()
                    rare[piece] = found
            out.append(found)
        return out


_ENCODERS: dict = {}


def _encoder(shared) -> Encoder:
    """The encoder of a broadcast, made once in a Python worker."""
    if shared.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.id] = Encoder(*shared.value)
    return _ENCODERS[shared.id]


@dataclass
class SharedEncoder:
    """What tasks make their encoder of: the ranks and the known pieces, bounded by them."""

    id: str
    content: object    # broadcast of ranks, known pieces as an Arrow stream, pattern

    @property
    def value(self):
        return self.content.value


def encoder(df: DataFrame, text: str = "text", ranks_path: str = RANKS, pattern: str = PATTERN,
            known_pieces: int = KNOWN_PIECES) -> tuple[SharedEncoder, Tables]:
    """The encoder for the texts of ``df``, whose most frequent pieces it knows."""
    spark = df.sparkSession
    ranks = load_ranks(ranks_path)
    bare = tables(spark, ranks)
    known = pa.table({"piece": pa.array([], pa.string()), "ids": pa.array([], pa.list_(pa.int32()))})
    if known_pieces:
        frequent = frequent_pieces(df, text, pattern, known_pieces).repartition(FOLD_TASKS)
        own = spark.createDataFrame(pa.table({"token": pa.array(list(ranks), pa.binary())}))
        # a piece that is a token has that token's id, whether or not merges would lead there
        other = frequent.join(F.broadcast(own), frequent["piece"].cast("binary") == own["token"], "left_anti")
        folded = bare.beside(other).select(
            "piece", let(F.struct(F.col("__tables").alias("t"), "piece"),
                         lambda s: fold(s["t"], bare.n_pairs, s["piece"])).alias("ids"))
        known = folded.toArrow()  # known_pieces rows at most
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as w:
        w.write_table(known)
    shared = spark.sparkContext.broadcast((ranks, sink.getvalue().to_pybytes(), pattern))
    return SharedEncoder(uuid.uuid4().hex, shared), bare


def with_ids(df: DataFrame, text: str = "text", out: str = "ids", ranks_path: str = RANKS,
             pattern: str = PATTERN, known_pieces: int = KNOWN_PIECES) -> tuple[DataFrame, Tables]:
    """``df`` plus the ids of its whole text (array<int>), and the tables for decoding.

    Null and empty texts have no ids; special tokens are ordinary text; repeated rows
    and an empty table are rows like any other.
    """
    shared, known = encoder(df, text, ranks_path, pattern, known_pieces)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        encode = _encoder(shared)
        return pd.Series([np.frombuffer(b"".join([e[0] for e in encode(t or "")]), "<u4").astype(np.int32)
                          for t in texts], dtype=object)

    return df.withColumn(out, ids(F.col(text).cast("string"))), known


def _bytes(table: Column, ids: Column) -> Column:
    """The table's byte strings of the ids, one after the other; strings of any bytes
    are joined as they are."""
    return F.array_join(F.transform(ids, lambda i: F.get(table, i).cast("string")), "").cast("binary")


def decoded(t: Column, ids: Column) -> Column:
    """The bytes of the ids' tokens, one after the other."""
    return _bytes(t["tokens"], ids)


def with_text(df: DataFrame, known: Tables, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` plus the binary text that its ids stand for; null for null ids."""
    state = F.struct(F.col("__tables").alias("t"), F.col(ids).alias("ids"))
    return known.beside(df).select(*df.columns, let(state, lambda s: decoded(s["t"], s["ids"])).alias(out))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the bytes they decode to."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared, _ = encoder(rows)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        encode, out = _encoder(shared), []
        for t in texts:
            found = encode(t or "")
            ids, back = b"".join([e[0] for e in found]), b"".join([e[1] for e in found])
            out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.select("doc_id", digests("text").alias("d")).select("doc_id", "d.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: every document's number of tokens and the digests of
    its ids and of their decoded bytes.  Repeated rows are encoded alike."""
    return query(docs)
