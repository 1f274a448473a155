"""Fingerprints and decontamination against plain Python."""

import hashlib
import re
import struct

import xxhash
from pyspark.sql import functions as F

from kestrel.llm import decontaminate, syncmers

SEPARATOR = re.compile(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SEPARATOR.split(low) if w]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return signed(h)


def plain_anchors(text):
    h = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in words(text)]
    if len(h) < 5:
        return [(0, chained(h))] if h else []
    s = [chained(h[i:i + 2]) for i in range(len(h) - 1)]
    return [(i, chained(s[i:i + 4])) for i in range(len(h) - 4) if min(s[i], s[i + 3]) == min(s[i:i + 4])]


def test_anchors_are_closed_syncmers(spark, odd):
    got = odd.select("text", syncmers.anchors(F.col("text")).alias("a")).collect()
    for r in got:
        assert [(x["at"], x["hash"]) for x in r["a"]] == plain_anchors(r["text"])


def test_short_texts_have_fingerprints_of_their_own(spark):
    texts = [" ".join(f"s{i}x{j}" for j in range(n)) for n in (5, 6, 7) for i in range(30)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select("text", syncmers.anchors(F.col("text")).alias("a")).collect()
    lone = [r for r in got if not plain_anchors(r["text"])]
    assert lone and all(r["a"] for r in got)
    for r in lone:
        h = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in words(r["text"])]
        assert [(x["at"], x["hash"]) for x in r["a"]] == [(0, chained(h))]
    assert len({r["a"][0]["hash"] for r in lone}) == len(lone)


def test_anchors_move_with_their_passage(spark):
    base = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(base, "a b c " + base)], "x string, y string")
    a, b = syncmers.anchors(F.col("x")), syncmers.anchors(F.col("y"))
    r = df.select(syncmers.shared_places(a, b).alias("p"), a.alias("a")).first()
    assert len(r["p"]) == len(r["a"]) and all(x["other"] - x["at"] == 3 for x in r["p"])


def test_edited_texts_and_likeness(spark, odd, monkeypatch):
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 2)  # several buckets, so guests matter
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    want = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, b, c = ({h for _, h in plain_anchors(x)} for x in (t, e, nxt))
        near = [len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c)]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), *near))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"])
           for r in syncmers.query(odd).collect()]
    key = lambda r: (r[0] is not None, r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_fingerprints_of_empty_tables_and_single_rows(spark, odd, none):
    assert syncmers.query(none).collect() == []
    one = syncmers.query(odd.filter("doc_id = 1")).first()
    assert one["near_next"] == 1.0 and one["fingerprint"]


def plain_contamination(docs, items, window=13):
    wins = {}
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            wins.setdefault(tuple(ws[i:i + window]), set()).add(str(item))
    out = []
    for i, text in docs:
        ws, hit, found = words(text), set(), set()
        for w, items_of in wins.items():
            for p in range(len(ws) - len(w) + 1):
                if tuple(ws[p:p + len(w)]) == w:
                    hit |= set(range(p, p + len(w)))
                    found |= items_of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(ws), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(ws)))
    return out


def test_contamination_matches_plain_search(spark, odd, monkeypatch):
    long = odd.filter("doc_id = 1").first()["text"].split()
    items = [(1, " ".join(long[100:140])), (2, "CAFÉ!"), (10, "Naïve, café"), (3, None), (4, ""),
             (5, " ".join(long[110:123])), (6, "x" * 700), (7, "never seen anywhere at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    key = lambda r: (r[0] is not None, r)
    want = sorted(plain_contamination(docs, items), key=key)
    for block in (decontaminate.BLOCK, 7):  # one list of tokens, several lists
        rows = decontaminate.contamination(odd, bench, block=block)
        got = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]),
                hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"]) for r in rows.collect()]
        assert sorted(got, key=key) == want


def test_contamination_with_empty_tables(spark, odd, none):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.query(none, bench).collect() == []
    rows = decontaminate.query(odd, bench.limit(0)).collect()
    assert len(rows) == odd.count() and not any(r["contaminated"] for r in rows)
