"""Alignment of two tokenizers over the corpus by coalescing byte intervals.

Tokenizer A is a byte-level BPE that encodes a space and the text, B a piece BPE that adds
that space itself.  Every token is an interval of bytes.  All A and B intervals are sorted
by start (``lexsort``), the running maximum of their ends is taken
(``maximum.accumulate``), and a group begins where a start reaches it: there tokens of both
sides end together.  Within a group the overlapping A-B pairs are expanded; those whose
ends agree are links.

How it runs:

1. documents are worked on where they are read.  Neither tokenizer joins bytes across a
   space that follows a non-space, so a text is cut there into units; each distinct unit
   of a chunk is encoded and aligned once.  One row per chunk of documents is written:
   the documents' figures and, for each, its linked id pairs with their numbers.
2. The pairs' corpus-wide counts are sums over those rows.  A pair of ids is one int, and
   a chunk sends each of its pairs once, so even a pair of all documents is one row a
   chunk; the highest count of each B id is a second small aggregation.
3. Each chunk asks for the counts of its own pairs by a join and adds them up for its
   documents.  Nothing is collected to the driver or broadcast but the vocabularies.

A text that is null, empty, or not given back byte for byte by both tokenizers has no
tokens: zeros and an empty string of groups.  Special tokens' strings are plain text.  Rows
are independent, so null ids and repeated rows stay and count like any others; an empty
table gives an empty one; columns beyond doc_id and text are not read.  A text of any
length is one task's.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import uuid

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import chunks, written

A_FILE, B_FILE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"  # the first has the ranks of byte_bpe_50k.json
CHUNK_BYTES = 4 << 20   # text of a written row
BLOCK = 1 << 15         # characters of units that are encoded in one piece
B_IDS = 1 << 15         # a pair of ids as one int: a * B_IDS + b

# Both tokenizers end a token where a space follows a non-space (a last single space stays
# where it is: B encodes no empty text).
_UNIT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)


@functools.cache
def tokenizers(a_path: str, b_path: str):
    """Encoders of A and B and the bytes of each of their ids."""
    with open(a_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    if max(ranks.values()) * B_IDS + B_IDS >= 1 << 31 or b.get_piece_size() > B_IDS:
        raise ValueError("vocabularies too large for pairs of ids in 31 bits")
    a_bytes = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        a_bytes[rank] = token
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
               else b.id_to_piece(i).replace("▁", " ").encode("utf-8") for i in range(b.get_piece_size())]
    return a, b, a_bytes, b_bytes


@functools.cache
def lengths(a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each id of A and B."""
    return tuple(np.array([len(t) for t in table], dtype=np.int64) for table in tokenizers(a_path, b_path)[2:])


def coalesce(sizes: tuple[np.ndarray, np.ndarray]):
    """Groups and overlaps of two tilings of the same bytes, given by their tokens' sizes.

    Returns the group of each A token, that of each B token, and the index pairs of A and B
    tokens that overlap.  Sizes are at least one byte.
    """
    ends = [np.cumsum(s) for s in sizes]
    starts = [e - s for e, s in zip(ends, sizes)]
    start, end = np.concatenate(starts), np.concatenate(ends)
    side = np.repeat([0, 1], [len(s) for s in sizes])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.append(True, start[order][1:] >= reach[:-1])[:len(order)]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    of_a, of_b = group[:len(sizes[0])], group[len(sizes[0]):]
    # Overlaps of an A token: from the first B token that ends behind its start to the last
    # that starts before its end, all in the token's group.
    first = np.searchsorted(ends[1], starts[0], side="right")
    last = np.searchsorted(starts[1], ends[0], side="left")
    count = last - first
    pair_a = np.repeat(np.arange(len(count)), count)
    pair_b = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return of_a, of_b, pair_a, pair_b


def _encoded(blocks: list[list[str]], a_path: str, b_path: str):
    """Units of which all bytes are given back, with the ids of both tokenizers.

    A block of units is encoded in one piece; where that fails its halves are, so only the
    units at fault are left out.
    """
    a, b, a_bytes, b_bytes = tokenizers(a_path, b_path)
    units, all_a, all_b = [], [], []
    while blocks:
        texts = ["".join(block) for block in blocks]
        b_ids, failed = b.encode([t[1:] for t in texts], num_threads=1), []
        for block, text, of_b in zip(blocks, texts, b_ids):
            of_a, raw = a.encode_ordinary(text), text.encode("utf-8")
            if raw == b"".join([a_bytes[i] for i in of_a]) and raw == b"".join([b_bytes[i] for i in of_b]):
                units += block
                all_a += of_a
                all_b += of_b
            elif len(block) > 1:
                failed += [block[:len(block) // 2], block[len(block) // 2:]]
        blocks = failed
    return units, np.array(all_a, dtype=np.int64), np.array(all_b, dtype=np.int64)


class Units:
    """Distinct units, encoded and aligned: numbers of A and B tokens and of groups of each,
    its groups as text, and its links, those of unit k being links[edge[k]:edge[k + 1]]."""

    def __init__(self, distinct: list[str], a_path: str, b_path: str):
        blocks, size = [[]], 0
        for unit in distinct:
            if unit[-1].isspace() or "\u2581" in unit:       # joined to the next it might be cut otherwise
                blocks.insert(0, [unit])
                continue
            if size > BLOCK:
                blocks.append([])
                size = 0
            blocks[-1].append(unit)
            size += len(unit)
        units, ids_a, ids_b = _encoded([block for block in blocks if block], a_path, b_path)
        self.place = {unit: k for k, unit in enumerate(units)}
        a_len, b_len = lengths(a_path, b_path)
        size_a, size_b = a_len[ids_a], b_len[ids_b]
        of_a, of_b, pair_a, pair_b = coalesce((size_a, size_b))
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        together = end_a[pair_a] == end_b[pair_b]
        pair_a, pair_b = pair_a[together], pair_b[together]
        self.links = (ids_a[pair_a] * B_IDS + ids_b[pair_b]).astype(np.int32)
        # A unit ends a group, so all that belongs to it is one stretch of each array.
        ends = np.cumsum([len(unit.encode("utf-8")) for unit in units], dtype=np.int64)
        edge_a = np.append(0, np.searchsorted(end_a, ends) + 1)
        edge_b = np.append(0, np.searchsorted(end_b, ends) + 1)
        if not (np.isin(ends, end_a).all() and np.isin(ends, end_b).all()):
            raise ValueError("a token goes across a unit's end")
        n_groups = int(of_a[-1]) + 1 if len(of_a) else 0
        edge_group = np.append(of_a[edge_a[:-1]], n_groups) if len(units) else np.zeros(1, np.int64)
        self.edge = np.searchsorted(pair_a, edge_a)
        self.n_a, self.n_b, self.n_groups = np.diff(edge_a), np.diff(edge_b), np.diff(edge_group)
        cut_a = np.searchsorted(of_a, np.arange(n_groups + 1)).tolist()
        cut_b = np.searchsorted(of_b, np.arange(n_groups + 1)).tolist()
        text_a, text_b = ([str(i) for i in ids.tolist()] for ids in (ids_a, ids_b))
        groups = [f"{text_a[i]}|{text_b[k]}" if j - i == m - k == 1 else
                  f"{','.join(text_a[i:j])}|{','.join(text_b[k:m])}"
                  for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        edge_group = edge_group.tolist()
        self.groups = [";".join(groups[g:h]) for g, h in zip(edge_group, edge_group[1:])]


def _chunk(texts: list[str], a_path: str, b_path: str) -> dict:
    """Figures of a chunk's documents; ``links`` has, for the documents one after the other,
    places in ``pairs`` and numbers of occurrences."""
    split = [_UNIT.split(" " + t) if t else [] for t in texts]
    units = Units(list(dict.fromkeys(u for doc in split for u in doc)), a_path, b_path)
    place, known, digests = units.place, [], []
    for doc in split:
        mine = [place.get(u, -1) for u in doc]
        if not mine or -1 in mine:
            mine, digest = [], ""
        else:
            digest = hashlib.sha256(";".join([units.groups[k] for k in mine]).encode("ascii")).hexdigest()
        known.append(mine)
        digests.append(digest)
    flat = np.array([k for mine in known for k in mine], dtype=np.int64)
    edges = np.cumsum([0, *map(len, known)])

    def of_docs(values):
        sums = np.append(0, np.cumsum(values))
        return sums[edges[1:]] - sums[edges[:-1]]

    n_links = np.diff(units.edge)[flat]
    at = np.arange(n_links.sum()) - np.repeat(np.cumsum(n_links) - n_links - units.edge[flat], n_links)
    pairs, pair = np.unique(units.links, return_inverse=True)
    doc = np.repeat(np.repeat(np.arange(len(texts)), np.diff(edges)), n_links)
    keys, number = np.unique(doc * max(1, len(pairs)) + pair[at], return_counts=True)
    doc, pair = keys // max(1, len(pairs)), keys % max(1, len(pairs))
    total = np.bincount(pair, weights=number, minlength=len(pairs)).astype(np.int64)
    used = total > 0                      # units of documents that are not given back count nowhere
    pair = (np.cumsum(used) - 1)[pair]
    return {"n_a": of_docs(units.n_a[flat]), "n_b": of_docs(units.n_b[flat]),
            "n_groups": of_docs(units.n_groups[flat]), "n_links": of_docs(n_links), "groups_sha256": digests,
            "pairs": pairs[used], "total": total[used], "cuts": np.bincount(doc, minlength=len(texts)).astype(np.int32),
            "links": np.stack([pair, number]).astype(np.int32).tobytes()}


def _align(batches, a_path, b_path):
    for pdf in batches:
        texts = [t or "" for t in pdf["text"]]
        ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
        yield pd.DataFrame([{"chunk": uuid.uuid4().hex, "doc_id": ids[start:stop],
                             **_chunk(texts[start:stop], a_path, b_path)}
                            for start, stop in chunks(texts, CHUNK_BYTES)])


def _score(batches):
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            place, number = np.frombuffer(row.links, np.int32).reshape(2, -1)
            count, best = np.zeros(len(row.pairs), np.int64), np.zeros(len(row.pairs), np.int64)
            if row.known is not None and len(row.known):
                at = np.searchsorted(row.pairs, [k["pair"] for k in row.known])
                count[at] = [k["count"] for k in row.known]
                best[at] = [k["best"] for k in row.known]
            edges = np.cumsum([0, *row.cuts])
            sums = np.append(0, np.cumsum(count[place] * number))
            bests = np.append(0, np.cumsum(best[place].astype(np.int64) * number))
            out.append(pd.DataFrame({
                "doc_id": pd.array([None if pd.isna(i) else int(i) for i in row.doc_id], dtype="Int64"),
                "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups, "n_links": row.n_links,
                "n_best": bests[edges[1:]] - bests[edges[:-1]], "count_sum": sums[edges[1:]] - sums[edges[:-1]],
                "groups_sha256": row.groups_sha256}))
        if out:
            yield pd.concat(out)


def aligned_chunks(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """The written rows of step 1 (see the module's text)."""
    a_path = a_path or public_tokenizers.path(A_FILE)
    b_path = b_path or public_tokenizers.path(B_FILE)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInPandas(
        lambda batches: _align(batches, a_path, b_path),
        "chunk string, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
        "n_links array<long>, groups_sha256 array<string>, pairs array<int>, total array<long>, cuts array<int>, "
        "links binary"), "alignment")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``a_id``, ``b_id``, ``count`` and whether that is the highest of its B id."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "total")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.total").alias("count"))
    counts = counts.withColumn("b_id", F.col("pair") % B_IDS)
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b_id").select(
        "pair", F.expr(f"pair div {B_IDS}").cast("int").alias("a_id"), "b_id", "count",
        (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """A row for each document: numbers of tokens, groups and links, links whose pair is its
    B id's most frequent one, the sum of the links' counts, and the groups' digest."""
    aligned = aligned_chunks(docs, a_path, b_path)
    asked = aligned.select("chunk", F.explode("pairs").alias("pair"))
    known = (asked.join(pair_counts(aligned).select("pair", "count", "best"), "pair")
             .groupBy("chunk").agg(F.collect_list(F.struct("pair", "count", "best")).alias("known")))
    return aligned.drop("total").join(known, "chunk", "left").mapInPandas(
        _score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                "groups_sha256 string")


def query(docs: DataFrame) -> DataFrame:
    return align(docs)
