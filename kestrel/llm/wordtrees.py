"""Removal of repeated word passages with prefix-partitioned suffix trees.

A word goes if it lies in 35 consecutive words that also start anywhere else, in the same
document or another.  The suffixes of a corpus are split by prefixes of varying length
into groups that fit a task's memory, and each group's suffixes make a tree of their own;
an inner node of 35 words or more is a passage that occurs again.

So that only suffixes with a partner are moved, and not each with its 35 words:

1. *Packs.* Equal texts become one (with whether there are several); some megabytes of
   distinct texts are one row of a written table, the unit of all that follows.
2. *Anchors.* The anchor of a window is its 8 words of smallest hash.  Equal windows have
   equal anchors, so consecutive windows of one anchor (a segment, some 50 words) go
   together, and those whose anchor occurs once stay at home: nothing equals them.
3. *Prefixes.* A segment belongs to the prefix of its anchor: the first word, or the first
   2, 4 or 8 where too many words begin so.  Prefixes are counted before anything is
   moved, and small ones share a group.  Where even the 8 words are too many, their
   windows are split by all 35 words instead: that prefix is a node already, and whether
   it has several leaves is a count, however often it occurs.
4. *Trees.* A group's windows are its suffixes, each up to its segment's end.  They are
   sorted, and the common prefixes of neighbours give the inner nodes; a suffix is
   repeated as far as its deepest node, and what the suffix before it covers is left out.
5. Packs drop the words that were found; documents take the result of their text.

Every row is an occurrence: repeated rows, and rows with equal texts, remove each other if
they have 35 words; ids, null or not, play no part.  Null, empty and shorter texts keep
all their words.  An empty table gives an empty one; columns beyond doc_id and text are not
read.  A text of any length is in one pack.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import chunks, whole, written

WINDOW = 35                 # words of a repeated passage
ANCHOR = 8                  # words of an anchor
PREFIXES = (1, 2, 4, 8)     # words of a prefix; 16 bits of an anchor's key each
PACK_BYTES = 4 << 20        # text of a pack
GROUP_WORDS = 1 << 20       # words of a group of trees, about
PREFIX_WORDS = GROUP_WORDS // 4  # words of one prefix, at most
DEPTH = 2 * WINDOW          # nodes are told apart up to this depth; longer repeats overlap
BLOCK = 1 << 18             # bytes hashed, or anchors looked for, at a time

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[1]
    return x ^ (x >> np.uint64(29))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start (in bytes) and hash of each word between ASCII white space."""
    data, at, hashes, starts = np.frombuffer(raw, np.uint8), 0, [], []
    while at < len(data):
        stop = at + BLOCK
        if stop < len(data):                    # cut where white space is, however long the word
            while stop < len(data):
                space = np.flatnonzero(_SPACE[data[stop:stop + BLOCK]])
                if len(space):
                    stop += int(space[0])
                    break
                stop += BLOCK
        b = data[at:stop]
        space = _SPACE[b]
        first = np.flatnonzero(~space & np.append(True, space[:-1]))
        if len(first):
            inside = np.arange(first[0], len(b)) - np.repeat(first, np.diff(np.append(first, len(b))))
            power = np.cumprod(np.full(int(inside.max()) + 1, _ODD[0], dtype=np.uint64))
            value = np.where(space[first[0]:], np.uint64(0), (b[first[0]:].astype(np.uint64) + np.uint64(1)))
            hashes.append(_mix(np.add.reduceat(value * power[inside], first - first[0])))
            starts.append(first + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


class Pack:
    """Distinct texts of a pack: their words and the segments of their windows.

    ``words`` has the number of words of each text, ``base`` its first word's number in the
    pack.  Segment k has ``count[k]`` windows, the first at word ``start[k]`` of the pack,
    and the anchor ``key[k]``; ``again[k]`` tells whether that occurs in it more than once.
    """

    def __init__(self, row):
        self.pack = int(row.pack)
        self.sizes = np.frombuffer(row.sizes, np.int64)
        self.several = np.frombuffer(row.several, np.uint8).astype(bool)
        self.digests = [row.digests[k:k + 32] for k in range(0, len(row.digests), 32)]
        self.raw = zstandard.ZstdDecompressor().decompress(row.data)

    def texts(self) -> list[bytes]:
        edges = np.append(0, np.cumsum(self.sizes + 1)).tolist()
        return [self.raw[a:b - 1] for a, b in zip(edges, edges[1:])]

    def find_segments(self) -> None:
        at, h = word_hashes(self.raw)
        edges = np.append(0, np.cumsum(self.sizes + 1))
        self.base = np.searchsorted(at, edges[:-1])
        self.words = np.searchsorted(at, edges[1:]) - self.base
        self.start = self.count = np.zeros(0, np.int64)
        self.key, self.again = np.zeros(0, np.uint64), np.zeros(0, bool)
        if len(h) < WINDOW:
            return
        grams = [h]                                                # of 1, 2, 4 and 8 words
        for width, odd in zip(PREFIXES, _ODD[1:]):
            if width < ANCHOR:
                g = grams[-1]
                grams.append(_mix(g[:-width] * odd + g[width:]))
        order = _mix(grams[-1] * _ODD[0])
        low, have, width = order, 1, WINDOW - ANCHOR + 1           # smallest in each window
        while 2 * have <= width:
            low, have = np.minimum(low[:-have], low[have:]), 2 * have
        if have < width:
            low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
        text = np.repeat(np.arange(len(self.words)), self.words)
        inside = text[:len(low)] == text[WINDOW - 1:]
        fresh = np.append(True, (low[1:] != low[:-1]) | (text[1:len(low)] != text[:len(low) - 1]))
        head = np.flatnonzero(inside & (fresh | ~np.append(False, inside[:-1])))
        tail = np.flatnonzero(inside & np.append(fresh[1:] | ~inside[1:], True))
        self.start, self.count, self.text = head, tail - head + 1, text[head]
        first, last = np.empty(len(head), np.int64), np.empty(len(head), np.int64)
        for k in range(0, len(head), BLOCK):                       # leftmost and rightmost anchor
            a, b = head[k:k + BLOCK], tail[k:k + BLOCK]
            first[k:k + BLOCK] = a + np.argmax(order[a[:, None] + np.arange(width)] == low[a][:, None], axis=1)
            last[k:k + BLOCK] = b + width - 1 - np.argmax(
                order[b[:, None] + np.arange(width - 1, -1, -1)] == low[b][:, None], axis=1)
        self.again = first < last
        key = np.zeros(len(head), np.uint64)
        for level, g in enumerate(grams):
            key |= (g[first] >> np.uint64(48)) << np.uint64(48 - 16 * level)
        self.key = key


def _pack(batches):
    number = TaskContext.get().partitionId() << 32
    pack = zstandard.ZstdCompressor(level=3).compress
    for pdf in batches:
        raws = [t.encode("utf-8") for t in pdf["text"]]
        out = []
        for start, stop in chunks(raws, PACK_BYTES):
            part = raws[start:stop]
            out.append((number, b"".join(bytes(d) for d in pdf["digest"][start:stop]),
                        (pdf["copies"][start:stop] > 1).to_numpy(np.uint8).tobytes(),
                        np.array([len(r) for r in part], dtype=np.int64).tobytes(),
                        pack(b"".join(r + b"\n" for r in part))))
            number += 1
        yield pd.DataFrame(out, columns=["pack", "digests", "several", "sizes", "data"])


def _anchors(batches):
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            pack = Pack(row)
            pack.find_segments()
            if not len(pack.key):
                continue
            u, back, n = np.unique(pack.key, return_inverse=True, return_counts=True)
            again = np.bincount(back, weights=pack.again | pack.several[pack.text]) > 0
            words = np.bincount(back, weights=pack.count + WINDOW - 1).astype(np.int64)
            yield pd.DataFrame({"key": u.view(np.int64), "pack": pack.pack, "words": words, "again": again | (n > 1)})


def _segments(batches):
    """Rows (group, pack, data, twice): a pack's distinct segments of a group; group -1 a
    single window, ``number`` its place; group -2 where the segments lie in the pack."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            pack = Pack(row)
            pack.find_segments()
            wanted = np.array([w["key"] for w in row.wanted], dtype=np.int64).view(np.uint64)
            group_of = np.array([w["group"] for w in row.wanted], dtype=np.int64)
            order = np.argsort(wanted)
            wanted, group_of = wanted[order], group_of[order]
            at = np.minimum(np.searchsorted(wanted, pack.key), len(wanted) - 1)
            chosen = np.flatnonzero(wanted[at] == pack.key)
            group = group_of[at[chosen]]
            by_text = np.searchsorted(pack.text[chosen], np.arange(len(pack.words) + 1)).tolist()
            sent: dict[int, dict[bytes, list]] = {}
            places = []
            texts = pack.texts()
            start, count = pack.start[chosen].tolist(), pack.count[chosen].tolist()
            group = group.tolist()
            for t in np.unique(pack.text[chosen]).tolist():
                words, base, several = texts[t].split(), int(pack.base[t]), int(pack.several[t])
                for k in range(by_text[t], by_text[t + 1]):
                    a, g = start[k] - base, group[k]
                    stretches = ([(a, a + count[k] + WINDOW - 1)] if g >= 0 else
                                 [(i, i + WINDOW) for i in range(a, a + count[k])])
                    known = sent.setdefault(g, {})
                    for i, j in stretches:
                        seen = known.setdefault(b" ".join(words[i:j]), [len(known), -1])
                        seen[1] += 1 + several
                        places.append((t, i, g, seen[0]))
            for g, known in sent.items():
                twice = np.array([s[1] > 0 for s in known.values()], dtype=np.uint8)
                if g >= 0:
                    out.append((g, pack.pack, 0, squeeze(b"\n".join(known)), twice.tobytes()))
                else:
                    out += [(g, pack.pack, k, w, twice[k].tobytes()) for k, w in enumerate(known)]
            if places:
                out.append((-2, pack.pack, 0, squeeze(np.array(places, dtype=np.int64).tobytes()), b""))
        if out:
            yield pd.DataFrame(out, columns=["group", "pack", "number", "data", "twice"])


def deep_nodes(ids: np.ndarray, sizes: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Rows (segment, start, length) of the repeated passages of a group's segments, from
    the nodes of their suffix tree that are at least a window deep.

    ``ids`` has the segments' words one after the other, as numbers from 0; ``twice`` marks
    segments that occur more than once.
    """
    base, n = np.cumsum(sizes) - sizes, len(ids)
    windows = sizes - WINDOW + 1
    segment = np.repeat(np.arange(len(sizes)), windows)
    inside = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = base[segment] + inside
    # Suffixes whose first 35 words have a hash of their own are leaves below no deep node.
    power = np.cumprod(np.full(WINDOW, _ODD[3], dtype=np.uint64))
    mixed, h = _mix((ids.astype(np.uint64) + np.uint64(1)) * _ODD[0]), np.zeros(max(0, n - WINDOW + 1), np.uint64)
    for k in range(WINDOW):
        h += mixed[k:n - WINDOW + 1 + k] * power[k]
    u, back, number = np.unique(h[at], return_inverse=True, return_counts=True)
    some = np.flatnonzero((number[back] > 1) | twice[segment])
    if not len(some):
        return np.zeros((0, 3), np.int64)
    at, segment, inside, head = at[some], segment[some], inside[some], back[some]
    end = base[segment] + sizes[segment]
    # Words of each suffix, three to a column; those behind its segment's end are 0.
    padded, bits = np.append(ids + 1, np.zeros(DEPTH + 3, np.int64)), np.int64(1 << 21)
    if n >= 1 << 21:
        bits = np.int64(1 << 31)
    per = 3 if bits == 1 << 21 else 2
    columns = []
    for k in range(0, DEPTH, per):
        column = np.zeros(len(at), np.int64)
        for j in range(k, min(k + per, DEPTH)):
            column = column * bits + np.where(at + j < end, padded[at + j], 0)
        columns.append(column)
    order = np.lexsort((*columns[::-1], head))
    # Longest common prefix of neighbours, not beyond either's end.
    a, b = at[order][:-1], at[order][1:]
    room = np.minimum(np.minimum(end[order][:-1] - a, end[order][1:] - b), DEPTH)
    common, live = np.zeros(len(a), np.int64), np.arange(len(a))
    for k in range(DEPTH):
        live = live[(room[live] > k)]
        live = live[ids[a[live] + k] == ids[b[live] + k]]
        if not len(live):
            break
        common[live] += 1
    depth = np.zeros(len(at), np.int64)
    depth[order] = np.maximum(np.append(0, common), np.append(common, 0))
    whole_leaf = np.minimum(end - at, DEPTH)
    depth = np.where(twice[segment], whole_leaf, depth)
    deep = depth >= WINDOW
    covered = np.append(False, deep[:-1] & (segment[1:] == segment[:-1]) & (inside[1:] == inside[:-1] + 1)
                        & (depth[:-1] > depth[1:]))
    keep = deep & ~covered
    return np.stack([segment[keep], inside[keep], depth[keep]], axis=1)


def _trees(pdf: pd.DataFrame) -> pd.DataFrame:
    unpack = zstandard.ZstdDecompressor().decompress
    segments, edges = [], [0]
    for data in pdf["data"]:
        segments += unpack(data).split(b"\n")
        edges.append(len(segments))
    split = [s.split(b" ") for s in segments]
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    flat = np.empty(int(sizes.sum()), dtype=object)
    flat[:] = [w for words in split for w in words]
    twice = np.frombuffer(b"".join(pdf["twice"]), np.uint8).astype(bool)
    found = deep_nodes(pd.factorize(flat)[0].astype(np.int64), sizes, twice)
    cut = np.searchsorted(found[:, 0], edges)
    out = []
    for k, (pack, group) in enumerate(zip(pdf["pack"], pdf["group"])):
        mine = found[cut[k]:cut[k + 1]] - [edges[k], 0, 0]
        if len(mine):
            out.append((int(pack), int(group), mine.astype(np.int32).tobytes()))
    return pd.DataFrame(out, columns=["pack", "group", "found"])


def _finish(batches):
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            pack = Pack(row)
            covers: dict[tuple[int, int], list] = {}
            for note in row.notes if row.notes is not None else ():
                for k, start, length in np.frombuffer(note["found"], np.int32).reshape(-1, 3).tolist():
                    covers.setdefault((note["group"], k), []).append((start, length))
            for k in row.windows if row.windows is not None else ():
                covers[-1, int(k)] = [(0, WINDOW)]
            by_text: dict[int, list] = {}
            if row.places is not None:
                raw = zstandard.ZstdDecompressor().decompress(row.places)
                for t, i, g, k in np.frombuffer(raw, np.int64).reshape(-1, 4).tolist():
                    for start, length in covers.get((g, k), ()):
                        by_text.setdefault(t, []).append((i + start, length))
            out = []
            for t, raw in enumerate(pack.texts()):
                words = raw.split()
                gone = np.zeros(len(words), dtype=bool)
                if pack.several[t] and len(words) >= WINDOW:
                    gone[:] = True
                elif t in by_text:
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    spans = np.array(by_text[t], dtype=np.int64)
                    np.add.at(depth, spans[:, 0], 1)
                    np.add.at(depth, spans.sum(axis=1), -1)
                    gone = np.cumsum(depth)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2).tolist()
                kept = words if not edge else [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((pack.digests[t], len(words), int(gone.sum()),
                            [{"start": a, "length": b - a} for a, b in edge], b" ".join(kept).decode("utf-8")))
            yield pd.DataFrame(out, columns=["digest", "n_words", "n_removed", "spans", "kept"])


def prefix_groups(keys: DataFrame, group_words: int = GROUP_WORDS, prefix_words: int = PREFIX_WORDS) -> DataFrame:
    """``key`` and ``group``: the group of the shortest prefix of each key that stands for
    at most ``prefix_words`` words; -1 where the whole key stands for more."""
    total = keys.agg(F.sum("words").alias("n")).first()["n"] or 0
    n = max(1, -(-total // group_words))
    rest, out = keys, None
    for level in range(len(PREFIXES)):
        prefix = F.shiftrightunsigned("key", 48 - 16 * level)
        # Counted over what is left: all keys of a prefix are left at once or not at all.
        sums = rest.groupBy(prefix.alias("prefix")).agg(F.sum("words").alias("held"))
        tried = rest.withColumn("prefix", prefix).join(sums, "prefix")
        small = F.col("held") <= prefix_words
        done = tried.where(small).select("key", F.pmod(F.xxhash64(F.lit(level), "prefix"), F.lit(n)).alias("group"))
        out = done if out is None else out.unionAll(done)
        rest = tried.where(~small).select("key", "words")
    return out.unionAll(rest.select("key", F.lit(-1).cast("long").alias("group")))


def distinct_texts(docs: DataFrame) -> DataFrame:
    text = whole(F.col("text").cast("string"))
    return docs.select(digest(text).alias("digest"), text.alias("text")).groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))


def digest(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))


def repeats(docs: DataFrame, group_words: int = GROUP_WORDS, prefix_words: int = PREFIX_WORDS) -> DataFrame:
    """A row for each distinct text: digest, n_words, n_removed, spans (array of start and
    length, in words) and kept (the other words, joined by one space)."""
    packs = written(distinct_texts(docs).mapInPandas(
        _pack, "pack long, digests binary, several binary, sizes binary, data binary"), "tree-packs")
    anchors = written(packs.mapInPandas(_anchors, "key long, pack long, words long, again boolean"), "tree-anchors")
    keys = written(anchors.groupBy("key").agg(
        F.sum("words").alias("words"), F.count(F.lit(1)).alias("packs"), F.max("again").alias("again"))
        .where((F.col("packs") > 1) | F.col("again")).select("key", "words"), "tree-keys")
    wanted = (anchors.select("key", "pack").join(prefix_groups(keys, group_words, prefix_words), "key")
              .groupBy("pack").agg(F.collect_list(F.struct("key", "group")).alias("wanted")))
    segments = written(packs.join(wanted, "pack").mapInPandas(
        _segments, "group long, pack long, number int, data binary, twice binary"), "tree-segments")
    notes = (segments.where("group >= 0").groupBy("group")
             .applyInPandas(_trees, "pack long, group long, found binary")
             .groupBy("pack").agg(F.collect_list(F.struct("group", "found")).alias("notes")))
    # Windows of hot anchors: a prefix of 35 words has been spelled out, its leaves are counted.
    single = segments.where("group = -1").select("pack", "number", "data", (F.col("twice") == F.lit(b"\x01")).alias("twice"))
    again = (single.groupBy("data").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice"))
             .where((F.col("n") > 1) | F.col("twice")).select("data"))
    windows = single.join(again, "data").groupBy("pack").agg(F.collect_list("number").alias("windows"))
    places = segments.where("group = -2").select("pack", F.col("data").alias("places"))
    return (packs.join(places, "pack", "left").join(notes, "pack", "left").join(windows, "pack", "left").mapInPandas(
        _finish, "digest binary, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept string"))


def without_repeats(docs: DataFrame, **limits) -> DataFrame:
    """doc_id and the columns of :func:`repeats`: a row for each row of ``docs``."""
    return _of_docs(docs, repeats(docs, **limits))


def _of_docs(docs: DataFrame, found: DataFrame) -> DataFrame:
    text = whole(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(text).alias("digest")).join(
        found, "digest").drop("digest")


def query(docs: DataFrame) -> DataFrame:
    found = repeats(docs).select("digest", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return _of_docs(docs, found)
