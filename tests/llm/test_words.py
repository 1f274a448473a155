"""Periodic runs, tokenizer alignment and repeated word passages against brute force."""

import collections
import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kestrel.llm import alignment, periodic, wordtrees
from kestrel.llm.common import documents
from tests.conftest import SF
from tests.llm.conftest import DOCS


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, tuple(map(str, r[1:]))))


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def clashing(df):
    """The table with more columns, named like the operators' own ones."""
    for name in ("start", "pack", "key", "group", "pair", "chunk", "digest", "copies", "n_words", "runs", "kept", "best"):
        df = df.withColumn(name, F.lit("x"))
    return df


# ---------------------------------------------------------------- op11

def plain_runs(words):
    ids, best = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.zeros(0, int), {}
    for q in range(1, len(words) // 4 + 1):
        edge = np.diff(np.concatenate([[0], (ids[:-q] == ids[q:]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if b - a + q >= max(6, 4 * q):
                best.setdefault((a, b - a + q), q)
    return sorted((a, q, m) for (a, m), q in best.items())


def plain_op11(rows):
    out = []
    for i, text in rows:
        words = text.encode().split()
        h = 1 if i is None else zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(words)
        gone = set()
        for a, q, m in runs:
            gone.update(range(a + q, a + m))
        top = min(((-m, a, q) for a, q, m in runs), default=None)
        figures = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
        out.append((i, len(runs), *figures, sha("".join(f"{a},{m},{q}\n" for a, q, m in runs)),
                    sha(b" ".join(w for k, w in enumerate(words) if k not in gone))))
    return by_id(out)


def test_runs_equal_plain_scans():
    rng = np.random.default_rng(1)
    for _ in range(300):
        texts = []
        for _ in range(rng.integers(1, 6)):
            parts = [np.resize(rng.integers(0, rng.integers(1, 4), rng.integers(1, 9)), rng.integers(1, 50))
                     for _ in range(rng.integers(0, 5))]
            texts.append(np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64))
        rows = periodic.find_runs(np.concatenate(texts), np.array([len(t) for t in texts]))
        for k, t in enumerate(texts):
            assert [tuple(r) for r in rows[rows[:, 0] == k][:, [1, 3, 2]].tolist()] == plain_runs(t.tolist())


def test_grammar_extends_to_the_first_difference_both_ways():
    rng = np.random.default_rng(2)
    s = np.concatenate([[90], np.resize(rng.integers(0, 2, 37), 4000), rng.integers(0, 2, 500), [91]])
    levels = periodic.recompress(s)
    assert len(levels) < 80 and len(levels[-1].first) == 1
    i, j = rng.integers(1, 4400, (2, 400))
    i, j = i[i != j], j[i != j]
    for step in (1, -1):
        got = periodic.extend(levels, i, j, step)
        for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
            assert all(s[a + step * k] == s[b + step * k] for k in range(n)) and s[a + step * n] != s[b + step * n]


def test_runs_query_equals_plain_scans_on_the_table(spark):
    docs = documents(spark, SF)
    assert by_id(periodic.query(docs).collect()) == plain_op11(texts_of(docs))


def test_runs_of_odd_rows(spark, odd, none):
    docs = odd.unionByName(spark.createDataFrame(
        [(20, "ab " * 30_000 + "cd", None, None, 0), (21, "a\x0bb\x1cc  " * 40, None, None, 0)], DOCS))
    assert by_id(periodic.query(clashing(docs)).collect()) == plain_op11(texts_of(docs))
    assert periodic.query(none).count() == 0


# ---------------------------------------------------------------- op12

def plain_op12(rows):
    """Whole texts encoded by the two libraries, groups by common ends."""
    path = public_tokenizers.path
    with open(path("byte_bpe_50k.json")) as f:
        vocab = json.load(f)["model"]["vocab"]
    a = Tokenizer.from_file(path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    a_len = {i: bytes(byte_of[c] for c in w) for w, i in vocab.items() if i != 50256}
    b = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    b_len = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
             for i in range(b.get_piece_size())]
    each, count = [], collections.Counter()
    for i, text in rows:
        raw = (" " + text).encode()
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if not text or b"".join(a_len[t] for t in x) != raw or b"".join(b_len[t] for t in y) != raw:
            each.append((i, [], [], [], []))
            continue
        ends = [dict(zip(np.cumsum([len(table[t]) for t in ids]).tolist(), range(len(ids))))
                for ids, table in ((x, a_len), (y, b_len))]
        groups, links, p, q = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            m, n = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(map(str, x[p:m])) + "|" + ",".join(map(str, y[q:n])))
            links.append((x[m - 1], y[n - 1]))
            p, q = m, n
        count.update(links)
        each.append((i, x, y, groups, links))
    highest = {}
    for (_, t), c in count.items():
        highest[t] = max(highest.get(t, 0), c)
    return by_id((i, len(x), len(y), len(g), len(links), sum(count[e] == highest[e[1]] for e in links),
                  sum(count[e] for e in links), sha(";".join(g)) if x else "") for i, x, y, g, links in each)


def test_alignment_equals_whole_text_encoding_on_the_table(spark):
    docs = documents(spark, SF)
    assert by_id(alignment.query(docs).collect()) == plain_op12(texts_of(docs))


def test_alignment_of_odd_rows(spark, odd, none):
    odd_texts = ["a  b", " a", "a ", "a\n b", "a \n b", "a\tb", "a▁b", "\x00a", "<s> </s>", "<|endoftext|> x", "  ", "\n",
                 "\n\n  b", "a\r b", "x" * 3000, "don't  's 's", "a　 b", "café café", "ﬁne  ", "word " * 40_000]
    docs = odd.unionByName(spark.createDataFrame(
        [(50 + k, t, None, None, 0) for k, t in enumerate(odd_texts)], DOCS))
    assert by_id(alignment.query(clashing(docs)).collect()) == plain_op12(texts_of(docs))
    assert alignment.query(none).count() == 0


def test_coalescing_breaks_where_both_end_and_expands_overlaps():
    a, b, x, y = alignment.coalesce((np.array([2, 2, 3, 1]), np.array([1, 3, 2, 2])))
    assert a.tolist() == [0, 0, 1, 1] and b.tolist() == [0, 0, 1, 1]
    assert list(zip(x.tolist(), y.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3), (3, 3)]


# ---------------------------------------------------------------- op13

def plain_op13(rows):
    split = [text.encode().split() for _, text in rows]
    windows = [[b" ".join(w[k:k + 35]) for k in range(len(w) - 34)] for w in split]
    count = collections.Counter(x for each in windows for x in each)
    out = []
    for (i, _), words, each in zip(rows, split, windows):
        gone = np.zeros(len(words), bool)
        for k, x in enumerate(each):
            if count[x] > 1:
                gone[k:k + 35] = True
        out.append((i, len(words), int(gone.sum()), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return by_id(out)


@pytest.fixture(scope="module")
def passages(spark, odd):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)]
    shared = rng.choices(vocabulary, k=70)
    rows = []
    for i in range(200):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.3:
                parts += shared[rng.randint(0, 20):rng.randint(40, 70)]
            elif kind < 0.4:
                parts += ["ab"] * rng.randint(20, 90)
            elif kind < 0.5:
                parts += ["x", "y", "z\t\n"] * rng.randint(5, 40)
            else:
                parts += rng.choices(vocabulary, k=rng.randint(1, 80))
        rows.append((100 + i, " ".join(parts), None, None, 0))
    rows += [rows[5], (None, rows[7][1], None, None, 0), (901, "\x1c".join(vocabulary), None, None, 0),
             (902, "long " + "y" * 300_000 + " end", None, None, 0), (903, "z " * 50_000, None, None, 0)]
    return odd.unionByName(spark.createDataFrame(rows, DOCS)).cache()


def test_word_passages_equal_plain_search_on_the_table(spark):
    docs = documents(spark, SF)
    assert by_id(wordtrees.query(docs).collect()) == plain_op13(texts_of(docs))


@pytest.mark.parametrize("limits", [{}, {"group_words": 3000, "prefix_words": 700},
                                    {"group_words": 1000, "prefix_words": 0}])
def test_word_passages_whatever_the_groups(spark, passages, limits):
    """Longer prefixes, and windows of hot anchors, give the same words."""
    got = wordtrees.without_repeats(clashing(passages), **limits).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert by_id(got.collect()) == plain_op13(texts_of(passages))


def test_word_passages_of_an_empty_table(none):
    assert wordtrees.query(none).count() == 0


def test_prefixes_grow_only_where_needed(spark):
    """Keys of a small first word share its group; those of a frequent one are told apart."""
    rows = [(k << 48, 10) for k in range(50)] + [((99 << 48) | (k << 32), 30) for k in range(10)] + [((98 << 48) | 5, 500)]
    keys = spark.createDataFrame(rows, "key long, words long")
    groups = {r["key"]: r["group"] for r in wordtrees.prefix_groups(keys, 200, 100).collect()}
    assert len(groups) == len(rows)
    assert groups[(98 << 48) | 5] == -1 and all(g >= 0 for k, g in groups.items() if k != (98 << 48) | 5)
    together = {r["key"]: r["group"] for r in wordtrees.prefix_groups(keys, 10_000, 10_000).collect()}
    assert set(together.values()) == {0}


def test_deep_nodes_are_maximal_repeats():
    """One node covers a passage longer than a window; what it covers is not told again."""
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 50, 60)
    a = np.concatenate([rng.integers(100, 150, 5), shared, rng.integers(100, 150, 5)])
    b = np.concatenate([rng.integers(200, 250, 9), shared])
    rows = wordtrees.deep_nodes(np.concatenate([a, b]), np.array([len(a), len(b)]), np.zeros(2, bool))
    assert rows.tolist() == [[0, 5, 60], [1, 9, 60]]
