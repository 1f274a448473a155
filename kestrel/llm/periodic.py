"""Runs of periodically repeated words, found by recompression.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends,
at least ``EXPONENT`` periods and ``LEAST`` words long.  Documents are worked on where
they are read, some megabytes of text at a time; nothing is shuffled.

1. *Candidates.* For each period ``q`` the words at multiples of ``q`` are looked at, n/q
   of them, so all periods together take n log n steps.  A run holds four neighbouring
   points of that grid, which have the same word: only such places are tried.
2. *Grammar.* The documents that have candidates are recompressed: blocks of one symbol
   become a symbol (symbol, count), then the symbols are split by a hash into left and
   right ones and each left-right neighbourhood becomes a symbol, and so on until one
   symbol is left.  Equal stretches are parsed alike but for their edges.
3. *Extensions.* How far two places agree, forwards and backwards, is read from the
   grammar: up the levels as long as both places start symbols, down again after the
   first two symbols that differ; one comparison a level each way.
4. Places of one run give the same stretch; its smallest period stays.

Null and empty texts have no words and no runs.  Rows are independent: repeated rows give
repeated results, a null doc_id changes nothing but the optional edit, an empty table
gives an empty one, and columns beyond doc_id and text are not read.  A text of any
length is one task's; memory is some 100 bytes a word.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import chunks

EXPONENT = 4            # periods in a run, at least
LEAST = 6               # words in a run, at least
CHUNK_BYTES = 2 << 20   # text worked on at a time
QUERIES = 1 << 18       # places extended at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- grammar

@dataclass
class Level:
    """A string of symbols and how it is grouped into the symbols of the next level."""
    symbols: np.ndarray
    parent: np.ndarray      # index of each symbol's group, the symbol of the next level
    first: np.ndarray       # of each group: its first symbol here
    last: np.ndarray
    blocks: bool            # groups of one repeated symbol; else pairs


def _level(symbols: np.ndarray, head: np.ndarray, blocks: bool) -> Level:
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(symbols)) - 1
    return Level(symbols, np.cumsum(head) - 1, first, last, blocks)


def recompress(word_ids: np.ndarray) -> list[Level]:
    """Levels of the grammar of a string, from the words up to one symbol.

    The string's first and last symbol occur once.  Symbols are equal exactly where what
    they derive is equal and was parsed alike.
    """
    levels, s, fresh, salt = [], word_ids.astype(np.int64), int(word_ids.max(initial=0)) + 1, 1
    while len(s) > 1:
        head = np.append(True, s[1:] != s[:-1])
        if not head.all():                                        # blocks
            level = _level(s, head, True)
            levels.append(level)
            count = level.last - level.first + 1
            s = s[level.first]
            many = np.flatnonzero(count > 1)
            _, new = np.unique(np.stack([s[many], count[many]]), axis=1, return_inverse=True)
            s[many] = fresh + new.ravel()
            fresh += len(many)
        with np.errstate(over="ignore"):                          # pairs
            h = (s.astype(np.uint64) + np.uint64(salt)) * _ODD
            h = (h ^ (h >> np.uint64(29))) * _ODD
        salt += 0x51ED27
        right = (h >> np.uint64(63)).astype(bool)
        joined = np.append(False, ~right[:-1] & right[1:])        # the right half of a pair
        if not joined.any():
            continue
        level = _level(s, ~joined, False)
        levels.append(level)
        at = np.flatnonzero(joined)
        _, new = np.unique(s[at - 1] * np.int64(fresh) + s[at], return_inverse=True)
        s = s[level.first]
        s[level.parent[at]] = fresh + new
        fresh += len(at)
    return levels


def extend(levels: list[Level], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """Number of symbols that agree from ``i`` and from ``j`` (not the same) on, both
    included; ``step`` is 1 forwards, -1 backwards."""
    x, y = i.astype(np.int64), j.astype(np.int64)
    top = np.zeros(len(x), dtype=np.int64)      # level of the first difference
    rising = np.arange(len(x))

    def room(level, at):                        # like symbols up to the edge of the group
        if not level.blocks:
            return 1
        group = level.parent[at]
        return level.last[group] - at + 1 if step > 0 else at - level.first[group] + 1

    def edge(level, at):                        # whether ``at`` is where its group begins
        group = level.parent[at]
        return (level.first if step > 0 else level.last)[group] == at

    for h, level in enumerate(levels):
        a, b = x[rising], y[rising]
        inside = ~(edge(level, a) & edge(level, b))
        same = inside & (level.symbols[a] == level.symbols[b])
        by = np.minimum(room(level, a), room(level, b)) * same * step
        a, b = a + by, b + by
        x[rising], y[rising] = a, b
        up = (~inside | same) & edge(level, a) & edge(level, b)
        top[rising[~up]] = h
        rising, a, b = rising[up], a[up], b[up]
        x[rising], y[rising] = level.parent[a], level.parent[b]
        if not len(rising):
            break
    if len(rising):
        top[rising] = len(levels)
    for h in range(int(top.max(initial=0)) - 1, -1, -1):
        level = levels[h]
        falling = np.flatnonzero(top > h)
        ends = level.first if step > 0 else level.last
        a, b = ends[x[falling]], ends[y[falling]]
        by = np.minimum(room(level, a), room(level, b)) * (level.symbols[a] == level.symbols[b]) * step
        x[falling], y[falling] = a + by, b + by
    return (x - i) * step


# ------------------------------------------------------------------- runs

def candidates(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
               exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, periods and documents of ``exponent`` neighbouring grid points that have one word.

    ``starts`` and ``sizes`` place the documents in ``ids``.
    """
    order = np.argsort(-sizes, kind="stable")
    by_size, at, out = sizes[order], starts[order], []
    for q in range(1, int(sizes.max(initial=0)) // exponent + 1):
        live = int(np.searchsorted(-by_size, -exponent * q, side="right"))
        if live <= 4:
            for d in range(live):
                grid = ids[at[d]:at[d] + by_size[d]:q]
                same = grid[1:] == grid[:-1]
                hit = same[:len(same) - exponent + 2].copy()
                for k in range(1, exponent - 1):
                    hit &= same[k:len(same) - exponent + 2 + k]
                found = np.flatnonzero(hit)
                if len(found):
                    out.append((at[d] + q * found, np.full(len(found), q), np.full(len(found), order[d])))
            continue
        counts = (by_size[:live] - 1) // q - exponent + 2
        doc = np.repeat(np.arange(live), counts)
        i = at[:live][doc] + q * (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts))
        for k in range(1, exponent):
            keep = ids[i] == ids[i + k * q]
            i, doc = i[keep], doc[keep]
        if len(i):
            out.append((i, np.full(len(i), q), order[doc]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part).astype(np.int64) for part in zip(*out))


def find_runs(ids: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, by document, start and period.

    ``ids`` holds the words of the documents one after the other, ``sizes`` their numbers.
    """
    starts = np.cumsum(sizes) - sizes
    i, q, doc = candidates(ids, starts, sizes, exponent)
    if not len(i):
        return np.zeros((0, 4), np.int64)
    # The grammar's string: the documents that have candidates, parted by symbols of their own.
    with_runs = np.unique(doc)
    held, n = sizes[with_runs], int(ids.max()) + 1
    placed = np.cumsum(held + 1) - held
    string = np.empty(int(held.sum()) + len(held) + 1, dtype=np.int64)
    inner = np.repeat(placed - (np.cumsum(held) - held), held) + np.arange(held.sum())
    string[inner] = ids[np.repeat(starts[with_runs] - (np.cumsum(held) - held), held) + np.arange(held.sum())]
    string[np.append(placed - 1, len(string) - 1)] = n + np.arange(len(held) + 1)
    levels = recompress(string)
    move = np.zeros(len(sizes), dtype=np.int64)
    move[with_runs] = placed - starts[with_runs]
    rows = []
    for k in range(0, len(i), QUERIES):
        d, p = doc[k:k + QUERIES], q[k:k + QUERIES]
        at = i[k:k + QUERIES] + move[d]
        ahead = extend(levels, at, at + p, 1)
        back = extend(levels, at - 1, at + p - 1, -1)
        length = back + p + ahead
        good = length >= np.maximum(least, exponent * p)
        rows.append(np.unique(np.stack([d, at - back - move[d] - starts[d], length, p], axis=1)[good], axis=0))
    rows = np.unique(np.concatenate(rows), axis=0)                # by document, start, length, period
    stretch = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))[:len(rows)]
    rows = rows[stretch]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def periodic_tail(doc_id, n: int):
    """The words that stand at each place after the contract's edit; None: no edit.

    One document in ten (by a checksum of its id) has its words from a place on replaced
    by repetitions of the first of them.  A null id has no edit.
    """
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    index = np.arange(n)
    index[a:] = a + (index[a:] - a) % p
    return index


def _collapse(batches, edit, exponent, least):
    for pdf in batches:
        raws = [(t or "").encode("utf-8") for t in pdf["text"]]
        doc_ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
        out = []
        for start, stop in chunks(raws, CHUNK_BYTES):
            split = [raw.split() for raw in raws[start:stop]]     # at ASCII white space
            for k, words in enumerate(split):
                index = edit(doc_ids[start + k], len(words)) if edit else None
                if index is not None:
                    split[k] = [words[j] for j in index.tolist()]
            sizes = np.array([len(words) for words in split], dtype=np.int64)
            flat = np.empty(int(sizes.sum()), dtype=object)
            flat[:] = [w for words in split for w in words]
            rows = find_runs(pd.factorize(flat)[0].astype(np.int64), sizes, exponent, least)
            bounds = np.searchsorted(rows[:, 0], np.arange(len(split) + 1))
            for k, words in enumerate(split):
                mine = rows[bounds[k]:bounds[k + 1], 1:]
                if len(mine):
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(depth, mine[:, 0] + mine[:, 2], 1)
                    np.add.at(depth, mine[:, 0] + mine[:, 1], -1)
                    gone = np.cumsum(depth) > 0
                    kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                else:
                    kept = b" ".join(words)
                runs = [{"start": s, "length": m, "period": q} for s, m, q in mine.tolist()]
                out.append((doc_ids[start + k], len(words), runs, kept.decode("utf-8")))
        yield pd.DataFrame(out, columns=["doc_id", "n_words", "runs", "kept"]).astype({"doc_id": "Int64"})


def collapse_runs(docs: DataFrame, edit=None, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start and period) and kept:
    the words without a run's repetitions, joined by one space.

    ``edit`` maps a doc_id and its number of words to the words that take each place.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(
        lambda batches: _collapse(batches, edit, exponent, least),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")


def query(docs: DataFrame) -> DataFrame:
    found = collapse_runs(docs, periodic_tail)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    # The digests are taken where the rows are: no second reading of the Python side's output.
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(text, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.period")).alias("period"),
                    F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))
