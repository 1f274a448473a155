"""Near-duplicates, repeated passages, shards, tokens and the pipeline."""

import hashlib
import struct
import tracemalloc

import numpy as np
import pandas as pd
import pytest
import tiktoken
import xxhash
from conftest import SF
from llm.test_native import words

import __spark_entry__
import corpus_pipeline
from kestrel.llm import bpe, neardup, sharding, suffixes
from kestrel.sources.tables import table


def plain_classes(rows):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    hashes = {t: np.array([xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words(t)], np.uint64) for t in texts}
    df = np.zeros(1 << neardup.WORD_BITS)
    for _, t in rows:
        df[np.unique(hashes[t or ""] >> np.uint64(64 - neardup.WORD_BITS)).astype(int)] += 1
    idf = (1 + np.log(len(rows) / np.maximum(1, df)) / np.log(len(rows))).astype(np.float32)
    names, sets = list(texts), [neardup.shingles(hashes[t].view(np.int64), idf) for t in texts]
    parent = list(range(len(names)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(names)):
        for b in range(a):
            if neardup.weighted_jaccard(sets[a], sets[b]) >= neardup.SIMILAR:
                parent[root(a)] = root(b)
    groups = {}
    for k, t in enumerate(names):
        groups.setdefault(root(k), []).extend(texts[t])
    return {i: min((x for x in g if x is not None), default=None) for g in groups.values() for i in g}


def test_classes_match_all_pairs(spark):
    docs = table(spark, SF, "documents")
    want = plain_classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: r["class_id"] for r in neardup.query(docs).collect()}
    assert got == want


def test_classes_of_odd_texts(spark, odd, none):
    got = [(r["doc_id"], r["class_id"]) for r in neardup.query(odd).collect()]
    assert len(got) == odd.count()
    ids = dict(got)
    assert ids[1] == ids[2] == ids[3] == 1 and ids[4] == ids[5] == 4 and got.count((6, 6)) == 2
    assert neardup.query(none).collect() == []
    extra = odd.withColumnRenamed("lang", "label").withColumnRenamed("source", "node")
    kept = neardup.stage(spark, extra, "")
    assert kept.columns == extra.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 6, 8, 9, 10, 11, 12]


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """A chain of texts that share most of a passage: buckets with many members apart."""
    monkeypatch.setattr(neardup, "MANY", 8)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:60] + [f"q{i}x{j}" for j in range(30 if i % 2 else 4)])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.query(df).collect()}
    assert got == plain_classes(rows)


def test_block_size_changes_no_class(spark, monkeypatch):
    """Chains whose neighbours are similar by 0.80 to 0.82, the others less."""
    rng = np.random.default_rng(11)
    rows = []
    for c in range(30):
        w = [f"v{x}" for x in rng.integers(0, 10 ** 9, 204 + 11 * 21)]
        rows += [(c * 12 + k, " ".join(w[k * 21:k * 21 + 204])) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for many in (neardup.MANY, 1):
        monkeypatch.setattr(neardup, "MANY", many)
        got.append({r["doc_id"]: r["class_id"] for r in neardup.query(df).collect()})
    assert got[0] == got[1]
    want = plain_classes(rows)
    assert set(want.values()) == {c * 12 for c in range(30)}
    assert len(set(got[1].values())) <= 33  # the bands miss 0.4 % of 330 links


def test_pairs_of_one_band_are_compared_however_few_samples_agree(spark):
    def row(node, shift, mass, near):
        samples = [i if i < neardup.ROWS else i + shift for i in range(neardup.BANDS * neardup.ROWS)]
        return (node, 0, node, samples, mass, near)

    schema = "node string, band int, label string, samples array<int>, mass double, to_leader double"
    x = spark.createDataFrame([row("a", 0, 100.0, None)], schema).alias("x")
    y = spark.createDataFrame([row("b", 1000, 81.0, None), row("c", 1000, 79.0, None)], schema).alias("y")
    got = [r["node"] for r in x.join(y, neardup._may_match("x", "y")).select("y.node").collect()]
    assert got == ["b"]


def _template_group(n, seed=3):
    """Copies of one text with some words replaced: many pairs just above and below 0.8."""
    import random
    rnd = random.Random(seed)
    vocabulary = [f"word{k}" for k in range(3000)]
    base = rnd.choices(vocabulary, k=150)
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(rnd.randint(1, 7)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        out.append((k, " ".join(words)))
    return out + [(n + k, " ".join(rnd.choices(vocabulary, k=150))) for k in range(300)]


def test_large_group_is_linear_and_keeps_its_links(spark, monkeypatch):
    """Against all pairs of a group of 400 near copies: nine in ten of those with a link are
    joined, and a member is compared some dozens of times; ``exact`` finds them all."""
    n = 400
    docs = spark.createDataFrame(_template_group(n), "doc_id long, text string")
    hashed = docs.select("doc_id", neardup.word_hashes(docs.text).alias("w"))
    idf = neardup.inverse_frequencies(hashed.select("w"))
    sets = {r["doc_id"]: neardup.shingles(r["w"], idf) for r in hashed.collect()}
    links = [(a, b) for a in range(n) for b in range(a) if neardup.weighted_jaccard(sets[a], sets[b]) >= neardup.SIMILAR]
    compared, plain = [], neardup.verify

    def counted(pairs, texts, idf):
        compared.append(pairs.count())
        return plain(pairs, texts, idf)

    monkeypatch.setattr(neardup, "verify", counted)
    for exact, least in ((False, 0.9), (True, 0.99)):
        compared.clear()
        got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs, exact=exact).collect()}
        assert sum(got[a] == got[b] for a, b in links) >= least * len(links)
        linked = {x for pair in links for x in pair}
        alone = {i for i in linked if sum(c == got[i] for c in got.values()) == 1}
        assert len(alone) <= (1 - least) * len(linked)
        assert all(got[n + k] == n + k for k in range(300))      # the others stay alone
        if not exact:
            assert sum(compared) <= 30 * n


def test_no_link_is_lost(spark, monkeypatch):
    """Chains, texts whose only links are just above 0.8 and pairs that share no band: the
    classes are those of all pairs, compared pair by pair or in blocks of any size."""
    rng = np.random.default_rng(11)
    rows = []
    for c in range(30):
        w = [f"v{x}" for x in rng.integers(0, 10 ** 9, 204 + 11 * 21)]
        rows += [(c * 12 + k, " ".join(w[k * 21:k * 21 + 204])) for k in range(12)]
    rows += [(1000 + i, t) for i, t in _template_group(150, seed=5)]
    rows += [(3000, "one two"), (3001, "one two"), (3002, "One, two!"), (3003, ""), (3004, None), (3005, "..")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_classes(rows)
    assert {want[c * 12 + 11] for c in range(30)} == {c * 12 for c in range(30)}
    for hot, side in ((neardup.HOT, neardup.SIDE), (1, 16)):
        monkeypatch.setattr(neardup, "HOT", hot)
        monkeypatch.setattr(neardup, "SIDE", side)
        assert {r["doc_id"]: r["class_id"] for r in neardup.query(df).collect()} == want


def test_links_without_a_common_band(spark, monkeypatch):
    """With samples that never agree the bands find nothing, the exact join all links."""
    from pyspark.sql import functions as F
    rows = _template_group(100, seed=8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = df.select(neardup.node_of(df.text).alias("node"), neardup.word_hashes(df.text).alias("w"))
    idf = spark.sparkContext.broadcast(neardup.inverse_frequencies(hashed))
    plain = neardup.signatures

    def unlike(hashed, idf):
        numbers = F.sequence(F.lit(1), F.lit(neardup.BANDS * neardup.ROWS))
        return plain(hashed, idf).withColumn("samples", F.transform(numbers, lambda k: F.hash("node", k)))

    monkeypatch.setattr(neardup, "signatures", unlike)
    assert neardup.buckets(neardup.signatures(hashed, idf)).count() == 0
    assert {r["doc_id"]: r["class_id"] for r in neardup.query(df).collect()} == plain_classes(rows)


def test_long_texts_unlike_share_few_bits():
    """Parities of 1,024 cells told nothing of texts with thousands of shingles."""
    rng = np.random.default_rng(3)
    base = rng.integers(1, 1 << 63, 4000, dtype=np.uint64)
    half = np.unique(np.append(base[:2000], rng.integers(1, 1 << 63, 2000, dtype=np.uint64)))
    near = np.unique(np.append(base[:3900], rng.integers(1, 1 << 63, 90, dtype=np.uint64)))
    short = np.unique(base[:300])
    bits = [neardup.parities(np.unique(k)) for k in (base, half, near, short)]

    def differ(v, w):
        words = min(len(v), len(w))
        return int(np.bitwise_count((neardup.folded(v, words) ^ neardup.folded(w, words)).view(np.uint64)).sum())

    most = 8000 * 1.5 * (1 - 2 * neardup.LEAST)   # weights of 1.5 a shingle
    assert differ(bits[0], bits[1]) > most > 190 >= differ(bits[0], bits[2])
    assert len(bits[3]) * 64 == neardup.BITS and differ(bits[0], bits[3]) <= 3700
    assert (neardup.folded(bits[0], 16) == np.packbits(np.bincount(
        (base >> np.uint64(32)).astype(np.int64) % 1024, minlength=1024) & 1 == 1).view(np.int64)).all()


def test_blocks_deal_out_texts_at_their_first_common_token_only():
    """Of 40 texts that share 30 tokens, whole sets went out 30 times."""
    import pandas as pd
    bits = neardup.parities(np.arange(1, 301, dtype=np.uint64) << np.uint64(40))
    tokens = np.arange(1, 31, dtype=np.int64) << 8
    rows = pd.DataFrame({"token": 0, "id": range(40), "label": range(40), "mass": 400.0, "after": 400.0, "size": 300,
                         "own": 0, "low": 0, "high": 0, "bits": [bits] * 40, "tokens": [tokens | k for k in range(40)]})
    dealt = [len(neardup._block_rows(rows.assign(token=int(t)))) for t in tokens]
    assert dealt == [40] + [0] * 29


def test_texts_are_looked_up_among_those_asked_for(spark):
    """All documents' texts were exchanged to find a few."""
    rows = spark.range(20000).selectExpr("md5(cast(id AS string)) AS node")
    asked = rows.limit(500).localCheckpoint()
    passed = rows.filter(neardup._among(asked)(rows.node))
    assert passed.join(asked, "node").count() == 500 and passed.count() < 4000
    none = neardup._among(asked.filter("false"))
    assert rows.filter(none(rows.node)).count() == 0


def test_words_are_those_of_a_plain_split(spark):
    import re
    from kestrel.llm.common import SEPARATORS, words as column
    texts = ["A bC-d  9Z", "ÄB İI \u212a Ça va ABC", None, "", "..", "ẞ Ω x" * 3, "naïve CAFÉ\x00B\nC"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", column("text").alias("w")).collect()
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert [r["w"] for r in got] == [[w for w in re.split(SEPARATORS, (r["text"] or "").translate(upper)) if w] for r in got]


def test_stage_keeps_one_document_of_each_class_of_all_links(spark, monkeypatch):
    """Also of classes whose members share no band."""
    from pyspark.sql import functions as F
    rows = _template_group(60, seed=9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = neardup.signatures
    numbers = F.sequence(F.lit(1), F.lit(neardup.BANDS * neardup.ROWS))
    monkeypatch.setattr(neardup, "signatures", lambda hashed, idf: plain(hashed, idf).withColumn(
        "samples", F.transform(numbers, lambda k: F.hash("node", k))))
    want = set(plain_classes(rows).values())
    assert len(want) < len(rows)
    assert sorted(r["doc_id"] for r in neardup.stage(spark, df, "").collect()) == sorted(want)


def test_few_rows_go_to_python_at_once(spark, monkeypatch):
    """Words of thousands of whole texts in one batch filled the executors' memory."""
    docs = spark.createDataFrame([(k, f"w{k} " * 20) for k in range(3000)], "doc_id long, text string")
    seen, plain, before = [], neardup._links, spark.conf.get(neardup.ARROW_CONF)

    def counted(docs, text, exact):
        def sizes(batches):
            for pdf in batches:
                yield pdf.assign(n=len(pdf))[["n"]]

        seen.extend(r["n"] for r in docs.select("doc_id").mapInPandas(sizes, "n long").distinct().collect())
        return plain(docs, text, exact)

    monkeypatch.setattr(neardup, "_links", counted)
    assert neardup.query(docs.coalesce(1)).count() == 3000
    assert seen and max(seen) <= 1000 and spark.conf.get(neardup.ARROW_CONF) == before


def test_documents_with_columns_of_any_name(spark, odd):
    from pyspark.sql import functions as F
    more = odd
    for name in ("n", "node", "b", "label", "__n", "class_id", "samples", "lang_pred", "score", "h"):
        more = more.withColumn(name, F.lit("x"))
    for operator in (neardup.stage, corpus_pipeline.STAGES[0][1]):
        out = operator(spark, more, SF)
        assert out.columns == more.columns and out.count() <= more.count()


def test_samples_agree_with_weighted_similarity():
    rng = np.random.default_rng(4)
    idf = (1 + rng.random(1 << neardup.WORD_BITS)).astype(np.float32)
    one, two, similar = [], [], []
    for i in range(300):
        a = rng.integers(-2 ** 62, 2 ** 62, 200)
        b = a.copy()
        b[50:50 + i % 15] = rng.integers(-2 ** 62, 2 ** 62, i % 15)
        one.append(neardup.shingles(a, idf))
        two.append(neardup.shingles(b, idf))
        similar.append(neardup.weighted_jaccard(one[-1], two[-1]))
    s = neardup.Sampler()
    same = (s.samples(one) == s.samples(two)).mean()
    assert abs(same - np.mean(similar)) < 0.01


def plain_repeats(rows, n=50):
    first, out = {}, []
    rows = [(i, (t or "").encode()) for i, t in rows]
    for i, b in rows:
        if i is not None:
            for p in range(len(b) - n + 1):
                w = b[p:p + n]
                first[w] = min(first.get(w, i), i)
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if i is not None and first[b[p:p + n]] < i:
                gone[p:p + n] = b"\1" * n
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats_match_plain_search(spark, odd, none):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    for df in (docs, odd.select("doc_id", "text")):
        want = plain_repeats([tuple(r) for r in df.collect()])
        assert sorted((tuple(r) for r in suffixes.query(df).collect()), key=str) == want
    assert suffixes.query(none).collect() == []


def _anchor_group(texts):
    """What one anchor group gets of the texts, each a group of documents by itself, and their segments."""
    groups = [pd.DataFrame({"pid": [i], "doc_id": [i], "text": [t]}) for i, t in enumerate(texts)]
    anchors = pd.concat([suffixes.send_anchors(g, 1) for g in groups])
    found = pd.concat([suffixes.find_repeats(g, 1) for _, g in anchors.groupby("bucket")])
    segments = pd.concat([suffixes.send_segments(g, found[found["pid"] == i], 1) for i, g in enumerate(groups)])
    return groups, anchors, found, segments


def test_anchor_groups_take_little_memory():
    """Some 30 bytes a window; about 200 when all were copied and sorted at once."""
    rng = np.random.default_rng(4)
    passages = ["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(100)]
    _, anchors, _, segments = _anchor_group(
        ["".join(passages[k][i:] for k in rng.permutation(100)) for i in range(3)])
    windows = sum(int((np.frombuffer(x, np.int32) - 49).sum()) for x in segments["lengths"])
    assert windows > 500_000
    sent = anchors[anchors["bucket"] == 0]
    assert all(len(k) <= 4 * 8 * len(m) for k, m in zip(sent["keys"], sent["more"]))  # 4 bytes an anchor
    tracemalloc.start()
    try:
        suffixes.find_spans(segments)
        assert tracemalloc.get_traced_memory()[1] < 64 * windows
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("part, alike", [(1 << 16, False), (7, False), (1 << 16, True), (7, True)])
def test_spans_whatever_the_parts_and_hashes(monkeypatch, part, alike):
    rng = np.random.default_rng(5)
    passages = ["".join(map(chr, rng.integers(97, 123, 90))) for _ in range(6)]
    texts = ["".join(passages[k] for k in rng.integers(0, 6, 5))[i:] + "é" * 40 * (i % 2) for i in range(8)]
    monkeypatch.setattr(suffixes, "PART", part)
    if alike:  # all strings have one hash: the bytes tell them apart
        monkeypatch.setattr(suffixes, "window_hashes", lambda data, at: np.zeros(len(at), np.uint64))
    groups, _, found, segments = _anchor_group(texts)
    notes = pd.concat([found[found["bucket"] >= 1], suffixes.find_spans(segments[segments["bucket"] >= 0])])
    got = pd.concat([suffixes.drop_spans(g, notes[notes["pid"] == i], 1) for i, g in enumerate(groups)])
    assert sorted((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in got.itertuples(index=False)) == plain_repeats(
        list(enumerate(texts)))
    assert got["n_removed"].sum() > 0


def test_shards(spark, odd, none):
    docs = table(spark, SF, "documents")
    n = docs.count()
    rows = sharding.query(docs).collect()
    assert len(rows) == n and {r["shard"] for r in rows} <= set(range(40))
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for shard in by.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
    sizes = [sum(r["size"] for r in by.get(s, [])) for s in range(40)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    assert sharding.query(none).collect() == [] and sharding.query(odd).count() == odd.count()


def test_shards_cut_a_hot_group_and_large_shards(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', concat('t', id)) AS text", "id AS n")
    out = sharding.shard_by_bytes(df, shards=5, part_bytes=4000)
    assert out.columns == ["doc_id", "text", "n", "shard", "slot"]
    by = {}
    for r in out.collect():
        by.setdefault(r["shard"], []).append(r)
    assert len(by) == 5 and all(sorted(r["slot"] for r in g) == list(range(len(g))) for g in by.values())
    sizes = [sum(len(r["text"]) + sharding.ROW_BYTES for r in g) for g in by.values()]
    assert max(sizes) - min(sizes) < 100


def test_tokens_match_the_library(spark, odd, none):
    ranks = bpe.load_ranks()
    lib = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for known in (0, 20):
        rows, tables = bpe.with_ids(odd.select("doc_id", "text"), known_pieces=known)
        got = rows.collect()
        assert len(got) == odd.count()
        assert all(list(r["ids"]) == lib.encode_ordinary(r["text"] or "") for r in got)
    back = bpe.with_text(spark.createDataFrame([(list(r["ids"]),) for r in got], "ids array<int>"), tables)
    assert sorted(bytes(r["text"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in got)
    for r in bpe.query(odd).collect():
        ids = lib.encode_ordinary(odd.filter(odd.doc_id.eqNullSafe(r["doc_id"])).first()["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert bpe.query(none).collect() == []


def test_tokens_of_the_table_match_the_library(spark):
    """Every row of the table: number of tokens, ids and what they decode to."""
    lib = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={})
    docs = table(spark, SF, "documents")
    want = []
    for r in docs.collect():
        ids = lib.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(lib.decode_bytes(ids)).hexdigest()))
    assert sorted(tuple(r) for r in bpe.query(docs).collect()) == sorted(want)


def test_fold_equals_task_merges(spark):
    from pyspark.sql import functions as F
    from kestrel.llm.common import let
    ranks = bpe.load_ranks()
    t = bpe.tables(spark, ranks)
    pieces = [" aaaa", "straßenbahn", "x", " thethethe", "été", "   ", "a" * 60]
    df = t.beside(spark.createDataFrame([(p,) for p in pieces], "piece string"))
    rows = df.select("piece", let(F.struct(F.col("__tables").alias("t"), "piece"),
                                  lambda s: bpe.fold(s["t"], t.n_pairs, s["piece"])).alias("ids")).collect()
    assert all(list(r["ids"]) == bpe.merge(r["piece"].encode(), ranks) for r in rows)


def test_pipeline_runs_its_stages(spark, odd, none):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "tokens"]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        from kestrel.llm.common import written
        before, kept = kept.count(), written(stage(spark, kept, SF), "test-stage")
        assert kept.columns == docs.columns and kept.count() <= before
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in kept.select("doc_id").collect()}
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []


def test_pipeline_sends_few_rows_to_python_at_once(spark, none):
    """Batches of 10,000 whole texts filled the executors' memory, also in the stages' last step."""
    before = spark.conf.get(neardup.ARROW_CONF)
    try:
        for given, want in ((10_000, 1000), (200, 200), (0, 1000)):
            spark.conf.set(neardup.ARROW_CONF, str(given))
            corpus_pipeline.STAGES[0][1](spark, none, SF)
            assert int(spark.conf.get(neardup.ARROW_CONF)) == want
    finally:
        spark.conf.set(neardup.ARROW_CONF, before)


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_words_are_counted_once_a_text(spark):
    """By a plain count, and without the sort that a text's distinct words took."""
    texts = [[5 << 44, 5 << 44, 7 << 44], [5 << 44], [-1, -1, -2], []]
    idf = neardup.inverse_frequencies(spark.createDataFrame([(w,) for w in texts], "w array<long>"))
    cells = {k: 1 + np.log(4 / n) / np.log(4) for k, n in ((5, 2), (7, 1), ((1 << 20) - 1, 1))}
    assert all(abs(idf[k] - v) < 1e-6 for k, v in cells.items()) and len(idf) == 1 << neardup.WORD_BITS


def test_shingles_and_samples_are_those_of_plain_formulas(monkeypatch):
    """Also without ``np.unique``, whose sort takes half of a text's time."""
    rng = np.random.default_rng(6)
    idf = (1 + rng.random(1 << neardup.WORD_BITS)).astype(np.float32)
    texts = [np.concatenate([w := rng.integers(-1 << 63, 1 << 63, n, dtype=np.int64), w[:n // 2], w[:n // 2]])
             for n in (1, 4, 30, 200, 900)]
    real = np.unique
    monkeypatch.setattr(np, "unique", None)
    got = [neardup._shingles(w, idf) for w in texts]
    monkeypatch.setattr(np, "unique", real)
    for w, (keys, weight, counts, rarest) in zip(texts, got):
        h, n, want = w.view(np.uint64).tolist(), min(5, len(w)), {}
        for i in range(len(h) - n + 1):
            mixed = neardup.SEED
            for x in h[i:i + n]:
                mixed = (mixed ^ x) * 0xFF51AFD7ED558CCD % (1 << 64)
                mixed ^= mixed >> 32
            rare = [idf[x >> 44] for x in h[i:i + n]]
            want[mixed] = (sum(map(float, rare)) / n, want.get(mixed, (0, 0))[1] + 1, max(rare))
        assert keys.tolist() == sorted(want) and list(zip(weight, counts, rarest)) == [want[k] for k in keys.tolist()]
        assert (neardup._in_order(weight) == np.lexsort((keys, -weight))).all()
    s, sets = neardup.Sampler(), [(k, w * c) for k, w, c, _ in got]
    for (keys, weight), row in zip(sets, s.samples(sets)):
        for odd, found in zip(s.odd[:9].tolist(), row):
            best = []
            for k, w in zip(keys.tolist(), np.log(weight).astype(np.float32)):
                mixed = k * odd % (1 << 64)
                r, log_c = s.gamma[mixed >> 48], s.log_gamma[mixed >> 32 & 0xFFFF]
                beta = np.float32(((mixed >> 16 & 0xFFFF) + 0.5) / (1 << 16))
                t = np.floor(w / r + beta)
                best.append(((beta - t - np.float32(1)) * r + log_c, k, int(t)))
            _, k, t = min(best, key=lambda x: x[0])
            assert int(found) & 0xFFFFFFFF == (k ^ t * neardup.SEED % (1 << 64)) * odd % (1 << 64) >> 32


def test_pairs_are_compared_once(spark, monkeypatch):
    plain, plans = neardup.written, []

    def seen(df, name):
        if name == "neardup-met":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(neardup, "written", seen)
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 60))) for i in range(4)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_classes(rows)
    assert [p.count("[similarity(") for p in plans if "[similarity(" in p] == [1, 1]  # of the bands, of the rest
