"""Secrets: fixed patterns, and tokens that a battery of randomness tests finds.

A long token's encoding is inferred from its characters.  Three tests ask whether its
symbols look uniform and independent in that encoding: chi-squared over the alphabet, runs
about the alphabet's middle, and lag-one serial correlation; their squared deviations add
up to the token's result, which is small for random symbols.

How small it is by chance for an ordinary token depends on encoding and length, so each
(encoding, length) has a null of its own: tokens joined from words of a letter chain that
is fitted to all documents, in the forms such tokens have there (one case, capitals, numbers
between, separators).  A token's p-value is the share of those that look at least as
random, and Benjamini-Hochberg over all tested tokens of the corpus bounds the share of
false discoveries at 1 %, as far as ordinary tokens are no more random than that null.
What the fixed patterns hold is known and not tested.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LEAST = 20                               # characters of a token to test
CLASSES = (20, 24, 28, 32, 40, 48, 64)   # lower ends of the length classes
STEP, BINS = 0.25, 400                   # width and number of the result's bins
RATE = 0.01                              # bound on the share of false discoveries
MARK = "[SECRET]"
SIMULATED = 40_000                       # tokens of each null
STATES = 37                              # a word's edge, letters, digits
COMMON = """the of and to in is that for it as was with be by on not he his but at are this have from or had an they
which one you were all her she there would their we him been has when who will no more if out so up said what its about
than into them can only other time new some could these two may first then do any like my now over such our man me even
most made after also did many off before must well back through years where much your way down should because long each
just state those people too mister how little good world make very year still see own work men day get here between
both life being under never same another know while last might us great old against go come since three""".split()

_DIGITS, _LOW = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UP = _LOW.upper()
ENCODINGS = (  # smallest first: a token gets the first that has all its characters
    ("decimal", _DIGITS), ("base26", _LOW), ("BASE26", _UP), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UP + "234567"), ("base36", _DIGITS + _LOW), ("BASE36", _DIGITS + _UP),
    ("base62", _DIGITS + _UP + _LOW), ("base64", _UP + _LOW + _DIGITS + "+/"),
    ("base64url", _UP + _LOW + _DIGITS + "-_"))
_VALUES = [(name, len(a), {c: i for i, c in enumerate(a)}) for name, a in ENCODINGS]
_NAMES = [name for name, _ in ENCODINGS]
ENCODING_SIZE = {name: len(a) for name, a in ENCODINGS}


def _blocks(alphabet: str) -> np.ndarray:
    """Bounds of the stretches of one kind of character."""
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in alphabet]
    return np.array([0, *(k for k in range(1, len(kinds)) if kinds[k] != kinds[k - 1]), len(kinds)])


BLOCKS = {name: _blocks(a) for name, a in ENCODINGS}
_TOKEN = np.zeros(128, dtype=bool)
_TOKEN[[ord(c) for c in _DIGITS + _LOW + _UP + "+/-_"]] = True


def runs(text: str, least: int = 16) -> list[tuple[int, int]]:
    """Maximal runs of at least ``least`` token characters, in code points."""
    chars = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    inside = np.zeros(len(chars) + 2, dtype=np.int8)
    inside[1:-1] = _TOKEN[np.minimum(chars, 127)] & (chars < 128)
    edge = np.flatnonzero(np.diff(inside))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return list(zip(start[long].tolist(), end[long].tolist()))


def base_spans(text: str, found: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns; ``found`` are the text's runs of 16 and more,
    which hold every access and hex match that is long enough."""
    out = []
    low = text.lower() if (":" in text or "=" in text) else ""
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                if len(m.group(2)) >= 8]
    for a, b in found:
        run = text[a:b]
        out += [("access", a + m.start(), a + m.end()) for m in ACCESS.finditer(run)
                if m.end() - m.start() >= 16]
        out += [("hex", a + m.start(), a + m.end()) for m in HEX.finditer(run)
                if m.end() - m.start() >= 32]
    return out


def encoding(token: str) -> tuple[str, int, dict] | None:
    chars = set(token)
    return next((e for e in _VALUES if chars <= e[2].keys()), None)


def battery(symbols: np.ndarray, size: int, blocks: np.ndarray) -> np.ndarray:
    """The result of each row of symbols 0..size-1: the squared deviations of the three
    tests, in standard deviations under uniform, independent symbols, added up.  Uniformity
    is asked of the alphabet's symbols and of its kinds of character (digits, capitals,
    small letters, signs: ``blocks`` has their bounds); only a surplus counts."""
    rows, n = symbols.shape
    cells = (symbols + np.arange(rows)[:, None] * size).ravel()
    counts = np.bincount(cells, minlength=rows * size).reshape(rows, size)
    chi = (counts.astype(np.float64) ** 2).sum(axis=1) * size / n - n
    uniform = np.maximum(0, (chi - (size - 1)) / np.sqrt(2.0 * (size - 1) * (n - 1) / n))
    width = np.diff(blocks)
    if len(width) > 1:
        held = np.stack([counts[:, a:b].sum(axis=1) for a, b in zip(blocks, blocks[1:])], axis=1)
        off = ((held - n * width / size) ** 2 / (n * width / size)).sum(axis=1)
        kinds = np.maximum(0, (off - (len(width) - 1)) / np.sqrt(2.0 * (len(width) - 1)))
    else:
        kinds = np.zeros(rows)
    high = symbols >= size / 2
    ones = high.sum(axis=1)
    pairs = ones * (n - ones)
    expected = 1 + 2.0 * pairs / n
    variance = np.maximum(1e-9, (expected - 1) * (expected - 2) / (n - 1))
    changes = (high[:, 1:] != high[:, :-1]).sum(axis=1)
    one_sided = np.sqrt(2.0 * n * np.log(2))     # symbols of one half only: 2^(1-n) of all
    runs_off = np.where(pairs > 0, (1 + changes - expected) / np.sqrt(variance), one_sided)
    centred = symbols - (size - 1) / 2.0
    serial = (centred[:, 1:] * centred[:, :-1]).sum(axis=1) / ((size * size - 1) / 12.0) / np.sqrt(n - 1)
    return uniform ** 2 + kinds ** 2 + runs_off ** 2 + serial ** 2


def tested(text: str, found: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Start, end, encoding, length class and the result's bin of each run of ``LEAST`` and
    more.  Of a run that no encoding holds, as it mixes + or / with - or _, the longest part
    between such signs is tested.  Digits alone are numbers, not secrets."""
    out = []
    for a, b in found:
        if b - a < LEAST:
            continue
        e = encoding(text[a:b])
        if e is None:
            parts = [m.span() for signs in ("+/", "-_") for m in re.finditer(f"[^{signs}]+", text[a:b])]
            start, end = max(parts, key=lambda x: (x[1] - x[0], -x[0]))
            a, b = a + start, a + end
            e = encoding(text[a:b])
        if b - a < LEAST or e is None or e[0] == "decimal":
            continue
        result = battery(np.array([[e[2][c] for c in text[a:b]]]), e[1], BLOCKS[e[0]])[0]
        cls = int(np.searchsorted(CLASSES, b - a, side="right")) - 1
        out.append((a, b, _NAMES.index(e[0]), cls, min(BINS - 1, int(result / STEP))))
    return out


def letter_pairs(text: str, found: list[tuple[int, int]]) -> np.ndarray:
    """Counts of what follows what in the text's words: 1..26 letters of either case,
    27..36 digits, 0 a word's edge.  The tokens to test, runs of ``LEAST`` and more in
    ``found``, are no words: a small corpus's secrets would be its words."""
    chars = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    chars = np.where((chars >= 65) & (chars <= 90), chars + 32, chars)
    for a, b in found:
        if b - a >= LEAST:
            chars[a:b] = 0
    state = np.zeros(len(chars) + 2, dtype=np.int64)
    state[1:-1] = np.where((chars >= 97) & (chars <= 122), chars - 96, np.where((chars >= 48) & (chars <= 57), chars - 21, 0))
    at = state[:-1] * STATES + state[1:]
    return np.bincount(at[at > 0], minlength=STATES * STATES).reshape(STATES, STATES)


def simulated(pairs: np.ndarray, name: str, n: int, rows: int = SIMULATED) -> np.ndarray:
    """Sorted results of ordinary tokens of ``n`` characters in the form of an encoding:
    words and numbers that follow the pairs, one after the other, in half of the tokens with
    capitals where the encoding has them, and with signs between where it has signs.
    Alike in every run."""
    rng = np.random.default_rng([n, len(name), ENCODING_SIZE[name]])
    _, size, values = next(e for e in _VALUES if e[0] == name)
    if name in ("hex", "HEX"):      # ordinary ones are numbers with a letter here and there
        letters = rng.random((rows, n)) < 0.15
        return np.sort(battery(np.where(letters, rng.integers(10, 16, (rows, n)), rng.integers(0, 10, (rows, n))), size, BLOCKS[name]))
    low, up = ([values.get(c, values.get(d, 0)) for c, d in zip(a, b)] for a, b in ((_LOW, _UP), (_UP, _LOW)))
    digits = [values.get(c, 0) for c in _DIGITS]
    low, up = np.array([0, *low, *digits]), np.array([0, *up, *digits])
    if name in ("base26", "BASE26"):
        pairs = pairs * (np.arange(STATES) < 27)
    steps = np.cumsum(pairs / np.maximum(1e-9, pairs.sum(axis=1, keepdims=True)), axis=1)
    first = np.cumsum(np.append(0.0, pairs[0, 1:] / max(1e-9, pairs[0, 1:].sum())))
    signs, capitals = [values[c] for c in "+/-_" if c in values], rng.random(rows) < 0.5
    state, out = np.zeros(rows, dtype=np.int64), np.empty((rows, n), dtype=np.int64)
    for k in range(n):
        after = np.minimum(STATES - 1, (rng.random(rows)[:, None] > steps[state]).sum(axis=1))
        ends = (state == 0) | (after == 0)       # the next word begins
        begin = np.clip((rng.random(rows)[:, None] > first).sum(axis=1), 1, STATES - 1)
        state = np.where(ends, begin, after)
        out[:, k] = np.where(ends & capitals, up[state], low[state])
        if signs and k:
            sign = ends & (rng.random(rows) < 0.6)
            out[:, k], state = np.where(sign, rng.choice(signs, rows), out[:, k]), np.where(sign, 0, state)
    return np.sort(battery(out, size, BLOCKS[name]))


def discoveries(cells: list[tuple[int, int, int, int]], pairs: np.ndarray, rate: float = RATE) -> dict[tuple[int, int], int]:
    """For (encoding, length class) the highest bin whose tokens are secrets, from counts of
    (encoding, class, bin, n) over the corpus, as Benjamini-Hochberg says.

    A bin's p-value is that of its upper end; the null is that of the class's least length,
    as shorter tokens look random more easily.  Letters of one case are a family of their
    own: most are long words, whose number would only raise the bar for the others.
    """
    letters = [c for c in cells if _NAMES[c[0]] in ("base26", "BASE26")]
    others = [c for c in cells if _NAMES[c[0]] not in ("base26", "BASE26")]
    return _family(letters, pairs, rate) | _family(others, pairs, rate)


def _family(cells, pairs, rate):
    nulls, ranked = {}, []
    for e, cls, b, n in cells:
        if (e, cls) not in nulls:
            nulls[e, cls] = simulated(pairs, _NAMES[e], CLASSES[cls])
        null = nulls[e, cls]
        below = np.searchsorted(null, (b + 1) * STEP, side="right") if b < BINS - 1 else len(null)
        ranked.append(((1 + below) / (1 + len(null)), e, cls, b, n))
    total, at, cut = sum(n for *_, n in cells), 0, -1.0
    for value, group in _by_value(sorted(ranked)):
        at += sum(r[4] for r in group)
        if value <= rate * at / total:
            cut = value
    out: dict[tuple[int, int], int] = {}
    for value, e, cls, b, _ in ranked:
        if value <= cut:
            out[e, cls] = max(b, out.get((e, cls), -1))
    return out


def _by_value(ranked):
    from itertools import groupby
    return ((value, list(group)) for value, group in groupby(ranked, key=lambda r: r[0]))


def fit(df: DataFrame, text: str = "text", rate: float = RATE) -> dict[tuple[int, int], int]:
    """Results and letter pairs are counted over all texts; the driver gets one row a cell
    and pair, some 30,000 at most."""
    def count(batches):
        seen, pairs = {}, np.zeros((STATES, STATES), dtype=np.int64)
        for pdf in batches:
            for t in pdf["text"]:
                if t:
                    found = runs(t)
                    pairs += letter_pairs(t, found)
                    base = base_spans(t, found)
                    for start, end, e, cls, b in tested(t, found):
                        if any(start < y and x < end for _, x, y in base):
                            continue             # known already
                        seen[e, cls, b] = seen.get((e, cls, b), 0) + 1
        out = [(*k, n) for k, n in seen.items()]
        out += [(-1, a, b, int(pairs[a, b])) for a, b in zip(*np.nonzero(pairs))]
        yield pd.DataFrame(out, columns=["e", "cls", "bin", "n"])

    rows = (df.select(F.col(text).alias("text")).mapInPandas(count, "e int, cls int, bin int, n long")
            .groupBy("e", "cls", "bin").agg(F.sum("n").alias("n")).collect())
    # common English words beside the corpus's own, so that a corpus of few words has a chain
    pairs = letter_pairs(" ".join(COMMON), []).astype(np.float64)
    for r in rows:
        if r["e"] < 0:
            pairs[r["cls"], r["bin"]] += r["n"]
    return discoveries([(r["e"], r["cls"], r["bin"], r["n"]) for r in rows if r["e"] >= 0], pairs, rate)


def spans(text: str | None, accepted: dict[tuple[int, int], int]) -> list[tuple[str, int, int]]:
    """All secrets of one whole text, by start, then by kind as listed in ``KINDS``."""
    if not text:
        return []
    found = runs(text)
    out = base_spans(text, found)
    base = list(out)
    out += [("random", a, b) for a, b, e, cls, bin_ in tested(text, found)
            if bin_ <= accepted.get((e, cls), -1) and not any(a < end and start < b for _, start, end in base)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def with_secrets(df: DataFrame, accepted: dict[tuple[int, int], int], text: str = "text",
                 out: str = "secrets") -> DataFrame:
    """``df`` plus an array of (kind, start, end) in code points, end exclusive."""
    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in spans(t, accepted)]
                          for t in texts])

    return df.withColumn(out, scan(F.col(text)))


def redact(text: str | None, found: list[tuple[str, int, int]], mark: str = MARK) -> str | None:
    """``text`` with each merged run of spans replaced by ``mark``."""
    if not found:
        return text
    out, at = [], 0
    for _, a, b in sorted(found, key=lambda x: x[1]):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def _joined(column):
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(docs: DataFrame) -> DataFrame:
    """A row per row of ``documents``, repeated rows and null ids included; null and empty
    texts have no spans, an empty table no rows; columns beyond doc_id and text are not read."""
    rows = with_secrets(docs.select("doc_id", "text"), fit(docs))
    base = F.filter("secrets", lambda s: s["kind"] != "random")

    def number(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(number, KINDS[:3]),
                       F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                       _joined(F.col("secrets")).alias("spans"), number("random"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, each secret replaced by ``[SECRET]`` and
    n_chars counted anew where the text has changed.  Repeated rows are cleaned alike."""
    accepted = fit(docs)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, spans(t, accepted)) for t in texts], dtype=object)

    cleaned = docs.withColumn("__clean", clean("text"))
    changed = ~F.col("__clean").eqNullSafe(F.col("text"))
    out = {"text": F.col("__clean").alias("text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length("__clean")).otherwise(F.col("n_chars")) \
            .cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return cleaned.select(*[out.get(c, F.col(c)) for c in docs.columns])
