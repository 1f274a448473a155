"""Removal of repeated passages by equality classes of 50-byte windows.

A byte goes if it lies in a 50-byte string that also starts in a document with a
smaller id.  Two equal strings of that length have the same smallest inner hash (their
anchor), so only strings with equal anchors need to meet:

1. documents, dealt into groups by id, send the anchors of their runs of windows;
2. an anchor's group tells which are found in two documents at least, a text's group
   which document holds it first;
3. documents that hold their text first send the bytes around repeated anchors;
4. an anchor's group sorts the 50-byte windows there by a hash and compares the bytes of
   those with equal ones, a bounded number at a time.  A class of equal windows has a
   least document, and a longest previous factor would reach 50 bytes exactly where that
   is smaller; no suffix array beyond 50 bytes and no factor lengths are computed;
5. the documents drop what was found, later copies of a whole text drop everything.

Groups hold a few megabytes: repeats within a group are settled where they are, so a
passage that a third of all documents share is sent once a group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import written

LENGTH = 50              # bytes of a repeated string
ANCHOR = 20              # bytes that an anchor's hash covers
GROUP_BYTES = 4 << 20    # text of a group of documents, about
LEAST_GROUPS = 64
PART = 1 << 16           # windows of an anchor group that are hashed or compared at once

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD)]


def anchor_runs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and anchors of the maximal runs of windows with one anchor."""
    n = len(raw)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h1 = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
        h2 = h1[:-1] * _ODD[0] + h1[1:]
        h4 = h2[:-2] * _ODD[1] + h2[2:]
        h8 = h4[:-4] * _ODD[2] + h4[4:]
        h16 = h8[:-8] * _ODD[3] + h8[8:]
        h = h16[:-4] * _ODD[4] + h4[16:]        # ANCHOR bytes
        h ^= h >> np.uint64(31)
        h *= _ODD[5]
        h ^= h >> np.uint64(29)
    width, have = LENGTH - ANCHOR + 1, 1         # smallest of the hashes in each window
    while 2 * have <= width:
        h, have = np.minimum(h[:-have], h[have:]), 2 * have
    if have < width:
        h = np.minimum(h[:len(h) - (width - have)], h[width - have:])
    starts = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
    lengths = np.diff(np.append(starts, len(h)))
    with np.errstate(over="ignore"):             # minima are small numbers: spread them again
        u = (h[starts] ^ (h[starts] >> np.uint64(27))) * _ODD[0]
    return starts, lengths, u ^ (u >> np.uint64(33))


class Group:
    """The distinct (doc_id, text) of a group of documents, in ascending order.

    ``of`` maps the group's rows to them; ``text_of`` maps them to distinct texts, of
    which ``texts`` has the digests and ``least`` the smallest ids.
    """

    def __init__(self, pdf: pd.DataFrame):
        rows = [(int(i), (t or "").encode("utf-8")) for i, t in zip(pdf["doc_id"], pdf["text"])]
        self.docs = sorted(set(rows))
        where = {d: k for k, d in enumerate(self.docs)}
        self.of = [where[r] for r in rows]
        seen: dict[bytes, int] = {}
        self.text_of, self.least, self.holder = [], [], []
        for k, (i, raw) in enumerate(self.docs):
            digest = hashlib.md5(raw).digest()
            if digest not in seen:
                seen[digest] = len(seen)
                self.least.append(i)
                self.holder.append(k)
            self.text_of.append(seen[digest])
        self.texts = np.array([np.frombuffer(d, ">u8") for d in seen], dtype=np.uint64).reshape(-1, 2)

    def anchors(self, n_buckets: int):
        """Sorted distinct anchors, whether two documents here have them, and bounds and
        order by bucket."""
        each = [np.unique(anchor_runs(self.docs[k][1])[2]) for k in self.holder]
        u, counts = np.unique(np.concatenate([*each, np.zeros(0, np.uint64)]), return_counts=True)
        bucket = (u % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        return u, counts > 1, order, bounds


def send_anchors(pdf: pd.DataFrame, n: int) -> pd.DataFrame:
    group, pid = Group(pdf), int(pdf["pid"].iloc[0])
    u, several, order, bounds = group.anchors(n)
    out = []
    for b in np.flatnonzero(np.diff(bounds)):
        at = order[bounds[b]:bounds[b + 1]]
        # 32 bits of an anchor: beside the bucket they tell all but a few apart, and what is taken
        # for repeated by mistake is only sent to be compared.
        out.append((int(b), pid, (u[at] >> np.uint64(32)).astype(np.uint32).tobytes(), np.packbits(several[at]).tobytes()))
    texts, least = group.texts, np.array(group.least, dtype=np.int64)
    bucket = (texts[:, 0] % np.uint64(n)).astype(np.int64)
    for b in np.unique(bucket):
        at = bucket == b
        out.append((n + int(b), pid, texts[at].tobytes(), least[at].tobytes()))
    return pd.DataFrame(out, columns=["bucket", "pid", "keys", "more"])


def find_repeats(pdf: pd.DataFrame, n: int) -> pd.DataFrame:
    """For anchors, bits that tell the repeated ones; for texts, their first documents."""
    bucket, out = int(pdf["bucket"].iloc[0]), []
    if bucket < n:
        each = [np.frombuffer(k, np.uint32) for k in pdf["keys"]]
        several = [np.unpackbits(np.frombuffer(m, np.uint8))[:len(k)].astype(bool) for k, m in zip(each, pdf["more"])]
        u, back, counts = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        known = counts > 1
        known[back[np.concatenate(several)]] = True
        mask, at = known[back], 0
        for pid, k in zip(pdf["pid"], each):
            part = mask[at:at + len(k)]
            at += len(k)
            if part.any():
                out.append((int(pid), bucket, np.packbits(part).tobytes()))
    else:
        each = [np.frombuffer(k, np.uint64).reshape(-1, 2) for k in pdf["keys"]]
        ids = np.concatenate([np.frombuffer(m, np.int64) for m in pdf["more"]])
        keys = np.concatenate(each)
        order = np.lexsort((ids, keys[:, 1], keys[:, 0]))
        ordered = keys[order]
        head = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
        first = np.empty(len(ids), np.int64)
        first[order] = ids[order][np.flatnonzero(head)[np.cumsum(head) - 1]]
        at = 0
        for pid, k in zip(pdf["pid"], each):
            out.append((int(pid), bucket, first[at:at + len(k)].tobytes()))
            at += len(k)
    return pd.DataFrame(out, columns=["pid", "bucket", "found"])


def _firsts(group: Group, found: pd.DataFrame, n: int) -> np.ndarray:
    """The id of the first document of each distinct text of a group."""
    bucket = (group.texts[:, 0] % np.uint64(n)).astype(np.int64)
    first = np.array(group.least, dtype=np.int64)
    for b, data in zip(found["bucket"], found["found"]):
        if b >= n:
            first[bucket == b - n] = np.frombuffer(data, np.int64)
    return first


def send_segments(pdf: pd.DataFrame, found: pd.DataFrame, n: int) -> pd.DataFrame:
    """Bytes around repeated anchors, packed by bucket; under bucket -1 the spans that a
    smaller document of the same group already settles."""
    columns = ["bucket", "pid", "docs", "ids", "starts", "lengths", "data"]
    if not len(pdf):
        return pd.DataFrame([], columns=columns)
    group, pid = Group(pdf), int(pdf["pid"].iloc[0])
    u, _, order, bounds = group.anchors(n)
    repeated = np.zeros(len(u), dtype=bool)
    for b, data in zip(found["bucket"], found["found"]):
        if b < n:
            at = order[bounds[b]:bounds[b + 1]]
            repeated[at] = np.unpackbits(np.frombuffer(data, np.uint8))[:len(at)].astype(bool)
    repeated = u[repeated]
    first = _firsts(group, found, n)
    seen: dict[bytes, int] = {}
    sent: dict[int, list] = {}
    settled = []
    for k, (doc, raw) in enumerate(group.docs):
        t = group.text_of[k]
        if group.holder[t] != k or first[t] != doc or not len(repeated):
            continue
        starts, lengths, mine = anchor_runs(raw)
        at = np.minimum(np.searchsorted(repeated, mine), len(repeated) - 1)
        for j in np.flatnonzero(repeated[at] == mine):
            a = int(starts[j])
            m = int(lengths[j]) + LENGTH - 1
            segment = raw[a:a + m]
            if seen.setdefault(segment, doc) < doc:
                settled.append((k, doc, a, m))
            else:
                sent.setdefault(int(mine[j] % np.uint64(n)), []).append((k, doc, a, m, segment))
    pack = zstandard.ZstdCompressor(level=1).compress
    out = []
    for b, rows in [*sent.items(), (-1, [(*s, b"") for s in settled])]:
        if rows:
            docs, ids, starts, lengths, parts = zip(*rows)
            out.append((b, pid, np.array(docs, np.int32).tobytes(), np.array(ids, np.int64).tobytes(),
                        np.array(starts, np.int32).tobytes(), np.array(lengths, np.int32).tobytes(),
                        pack(b"".join(parts))))
    return pd.DataFrame(out, columns=columns)


def _words(data: np.ndarray, at: np.ndarray):
    """The windows at ``at`` of ``data`` as seven numbers each, one after the other."""
    view = np.lib.stride_tricks.sliding_window_view(data, 8)
    for offset in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        yield np.ascontiguousarray(view[at + offset]).view(np.uint64).ravel()


def window_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for word in _words(data, at):
            h = (h ^ word) * _ODD[5]
            h ^= h >> np.uint64(29)
    return h


def previous_factors(data: np.ndarray, at: np.ndarray, ids: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Whether a smaller id has the ``LENGTH`` bytes at ``at`` of ``data`` too: what a
    longest previous factor of that length would say, from classes of equal windows.

    The windows come in classes of equal hashes, which begin at ``heads``; only classes of
    unlike bytes are sorted.
    """
    sizes = np.diff(np.append(heads, len(at)))
    of = np.repeat(heads, sizes)
    if not any((word != word[of]).any() for word in _words(data, at)):
        return np.repeat(np.minimum.reduceat(ids, heads), sizes) < ids
    words = np.stack([*_words(data, at)])
    order = np.lexsort((ids, *words[::-1]))       # equal windows by document
    words, ordered = words[:, order], ids[order]
    head = np.concatenate([[True], (words[:, 1:] != words[:, :-1]).any(axis=0)])
    smallest = ordered[np.flatnonzero(head)[np.cumsum(head) - 1]]
    out = np.empty(len(at), dtype=bool)
    out[order] = smallest < ordered
    return out


def find_spans(pdf: pd.DataFrame) -> pd.DataFrame:
    """The spans of an anchor group's segments that a smaller document holds too.

    The group's windows are numbered; all at once have a hash, its place in their order
    and a bit each, the rest is made for ``PART`` of them at a time.
    """
    unpack = zstandard.ZstdDecompressor().decompress
    data = np.frombuffer(b"".join(unpack(d) for d in pdf["data"]), np.uint8)
    docs, ids, starts, lengths = (np.concatenate([np.frombuffer(x, kind) for x in pdf[c]]) for c, kind in (
        ("docs", np.int32), ("ids", np.int64), ("starts", np.int32), ("lengths", np.int32)))
    pids = np.repeat(pdf["pid"].to_numpy(), [len(x) // 4 for x in pdf["docs"]])
    ends = np.cumsum(lengths.astype(np.int64) - LENGTH + 1)
    begins = np.concatenate([[0], ends[:-1]])     # of segments, in windows
    shift = np.cumsum(lengths, dtype=np.int64) - lengths - begins
    n = int(ends[-1]) if len(ends) else 0
    h = np.empty(n, np.uint64)
    for low in range(0, n, PART):
        high = min(low + PART, n)
        a, b = np.searchsorted(ends, [low, high - 1], "right")
        each = np.minimum(ends[a:b + 1], high) - np.maximum(begins[a:b + 1], low)
        h[low:high] = window_hashes(data, np.arange(low, high) + np.repeat(shift[a:b + 1], each))
    order = np.argsort(h)
    h = h[order]
    same = h[1:] == h[:-1]
    del h
    # Windows whose hash occurs once have no match.
    more, again = np.append(same, False), np.append(False, same)
    some = order[more | again]
    heads = np.flatnonzero(more[more | again] & ~again[more | again])
    del order, same, more, again
    hit = np.zeros(n, dtype=bool)
    cuts = np.unique(np.searchsorted(heads, np.arange(0, len(some), PART)))   # whole classes
    for i, j in zip(cuts, [*cuts[1:], len(heads)]):
        if i < j:
            low, high = heads[i], heads[j] if j < len(heads) else len(some)
            k = some[low:high]
            s = np.searchsorted(ends, k, "right")
            hit[k] = previous_factors(data, k + shift[s], ids[s], heads[i:j] - low)
    inner = np.ones(n + 1, dtype=bool)            # whether a window's segment has the one before, too
    inner[begins[:len(docs)]] = inner[n] = False
    before, after = np.append(False, hit[:-1]) & inner[:-1], np.append(hit[1:], False) & inner[1:]
    first, last = np.flatnonzero(hit & ~before[:n]), np.flatnonzero(hit & ~after[:n])
    s = np.searchsorted(ends, first, "right")
    spans = pd.DataFrame({"pid": pids[s], "doc": docs[s], "start": starts[s] + first - begins[s],
                          "length": last - first + LENGTH})
    out = [(int(pid), -2, _packed(g)) for pid, g in spans.groupby("pid")]
    return pd.DataFrame(out, columns=["pid", "bucket", "found"])


def local_spans(batches):
    """Spans settled within a group, in the form of ``find_spans``."""
    for pdf in batches:
        out = []
        for pid, docs, starts, lengths in zip(pdf["pid"], pdf["docs"], pdf["starts"], pdf["lengths"]):
            out.append((int(pid), -2, np.stack([np.frombuffer(x, np.int32) for x in (docs, starts, lengths)],
                                               axis=1).tobytes()))
        yield pd.DataFrame(out, columns=["pid", "bucket", "found"])


def _packed(spans: pd.DataFrame) -> bytes:
    return spans[["doc", "start", "length"]].to_numpy(dtype=np.int32).tobytes()


def drop_spans(pdf: pd.DataFrame, found: pd.DataFrame, n: int) -> pd.DataFrame:
    """A row for each row of the group: what stays of its text and how much went."""
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    if not len(pdf):
        return pd.DataFrame([], columns=columns)
    group = Group(pdf)
    first = _firsts(group, found, n)
    spans: dict[int, list] = {}
    for b, data in zip(found["bucket"], found["found"]):
        if b == -2:
            for doc, start, length in np.frombuffer(data, np.int32).reshape(-1, 3).tolist():
                spans.setdefault(doc, []).append((start, length))
    done = []
    for k, (doc, raw) in enumerate(group.docs):
        size = len(raw)
        if size >= LENGTH and doc > first[group.text_of[k]]:
            done.append((size, size, 1, b""))
        elif k in spans:
            depth = np.zeros(size + 1, np.int32)
            pairs = np.array(spans[k], dtype=np.int64)
            np.add.at(depth, pairs[:, 0], 1)
            np.add.at(depth, pairs[:, 0] + pairs[:, 1], -1)
            gone = np.cumsum(depth)[:-1] > 0
            n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            done.append((size, int(gone.sum()), n_spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
        else:
            done.append((size, 0, 0, raw))
    return pd.DataFrame([(group.docs[k][0], *done[k]) for k in group.of], columns=columns)


def without_repeats(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary): a row for each row of ``docs``.

    A null text is empty.  A null doc_id is neither smaller nor larger than any: such
    rows stay whole and remove nothing.  Rows equal in id and text are alike, so none
    removes the other.  Texts under 50 bytes stay whole.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(LEAST_GROUPS, -(-total // group_bytes))
    known = rows.filter("doc_id IS NOT NULL")
    dealt = known.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("pid"), "doc_id", "text")

    groups = dealt.groupBy("pid")
    anchors = groups.applyInPandas(
        lambda pdf: send_anchors(pdf, n), "bucket int, pid int, keys binary, more binary")
    found = anchors.groupBy("bucket").applyInPandas(
        lambda pdf: find_repeats(pdf, n), "pid int, bucket int, found binary")
    found = written(found, "suffix-repeats")
    segments = written(groups.cogroup(found.groupBy("pid")).applyInPandas(
        lambda pdf, f: send_segments(pdf, f, n),
        "bucket int, pid int, docs binary, ids binary, starts binary, lengths binary, data binary"),
        "suffix-segments")
    spans = segments.filter("bucket >= 0").groupBy("bucket").applyInPandas(
        find_spans, "pid int, bucket int, found binary")
    settled = segments.filter("bucket < 0").mapInPandas(local_spans, "pid int, bucket int, found binary")
    notes = found.filter(F.col("bucket") >= n).unionAll(spans).unionAll(settled)
    kept = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    done = groups.cogroup(notes.groupBy("pid")).applyInPandas(lambda pdf, f: drop_spans(pdf, f, n), kept)
    nameless = rows.filter("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return done.unionAll(nameless)


def query(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                        F.sha2("kept", 256).alias("kept_sha256"))
