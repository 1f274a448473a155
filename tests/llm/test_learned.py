"""Language, toxicity, quality and secrets: held-out accuracy and defined results."""

import random
import zlib

import numpy as np
import pytest
from conftest import SF

from kestrel.llm import langid, quality, secrets, toxicity
from kestrel.sources.tables import table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def test_language_held_out_accuracy(spark, docs):
    rows = langid.query(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark, docs, odd, none):
    model = langid.fit(langid.learnable(docs))
    got = {(r["doc_id"], r["text"]): r for r in langid.with_language(odd, model).collect()}
    for k in ((4, None), (5, ""), (8, "!!! ??? ---")):
        assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0)
    assert langid.with_language(odd, model).count() == odd.count()
    assert (model.weights == 0).mean() > 0.1  # sparse
    assert langid.query(none).collect() == []
    assert {r["lang_pred"] for r in langid.query(odd).collect()} == {"und"}  # nothing to learn from
    kept = langid.stage(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()


def test_toxicity_tells_planted_words(spark, none):
    rng = random.Random(3)
    plain = [" ".join(rng.choice("alder birch cedar maple willow aspen rowan hazel".split()) + rng.choice("abcdefgh")
                      for _ in range(120)) for _ in range(240)]
    rows = [(i, t + " vermin filth vermin scoundrel filth" if i % 6 == 0 else t) for i, t in enumerate(plain)]
    df = spark.createDataFrame(rows + [(1000, None), (1001, "")], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(240)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.query(df, known).collect()}
    out = [(r["predicted"], i % 6 == 0) for i, r in got.items() if r["held_out"] and i < 240]
    assert np.mean([bool(p) == t for p, t in out]) >= 0.95 and any(t for _, t in out)
    assert got[1000]["predicted"] == got[1001]["predicted"] == 0 and got[1000]["score"] == got[1001]["score"]
    assert toxicity.query(none, known).collect() == []
    assert toxicity.query(df, known.limit(0)).filter("predicted = 1").count() == 0


def test_a_text_over_the_byte_bound_leaves_the_others(spark, monkeypatch):
    rows = [(i, "x " * 4000) if i == 0 else (i, f"text {i}") for i in range(20)]
    known = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lowest = df.selectExpr("doc_id", "xxhash64(doc_id) AS h").orderBy("h").first()["doc_id"]
    df = df.selectExpr(f"CASE doc_id WHEN 0 THEN {lowest} WHEN {lowest} THEN 0 ELSE doc_id END AS doc_id", "text")
    monkeypatch.setattr(toxicity, "fit_rows", lambda rows: rows)
    got = toxicity.fit(df, known, sample_bytes=4000)
    assert sorted(t for t, _ in got) == sorted(t for _, t in rows if len(t) < 100)


def test_windows_hold_the_whole_text():
    text = "Ärger über lange Wörter " * 50 + "x" * 500
    assert b"".join(toxicity.windows(text)).decode() == text.lower()


def test_quality_held_out_accuracy(spark, docs):
    truth = table(spark, SF, "labels")
    rows = quality.query(docs, truth).join(truth, "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in out]) >= 0.85


def test_quality_of_odd_texts(spark, odd, none, labels):
    rows = quality.query(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.query(none, labels).collect() == []
    assert {r["predicted"] for r in quality.query(odd, labels.limit(0)).collect()} <= {0, 1}


def test_flat_trees_fit_a_step():
    rng = np.random.default_rng(0)
    x = rng.random((400, len(quality.FEATURES)))
    y = (x[:, 3] > 0.6).astype(float)
    model = quality.fit_trees(x, y, trees=20)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.99
    assert len(quality.fit_trees(x[:0], y[:0]).score(x)) == 400


def test_base_secrets_by_the_patterns(spark, odd, none):
    h = "0123456789abcdef" * 3
    text = f"é token = \"{h[:40]}\" AKIAABCDEFGHIJKL12 AKIA12 {h}z password: short Api_Key='abcd=efgh' SECRET:12345678"
    found = secrets.spans(text, {})
    got = [(k, text[a:b]) for k, a, b in found]
    assert got == [("assign", f'token = "{h[:40]}'), ("hex", h[:40]), ("access", "AKIAABCDEFGHIJKL12"),
                   ("hex", h), ("assign", "Api_Key='abcd=efgh"), ("assign", "SECRET:12345678")]
    assert secrets.query(none).collect() == []
    rows = secrets.query(odd).collect()
    assert len(rows) == odd.count() and all(r["spans"] == "" for r in rows if not r["n_hex"] + r["n_random"])


def test_random_tokens_are_discovered_and_words_are_not(spark):
    rng = random.Random(1)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(alphabet) for _ in range(32)) for _ in range(30)]
    parts = "stein berg wald haus meister brucken strassen garten kirchen turm".split()
    words = ["".join(rng.choice(parts) for _ in range(5))[:rng.randint(20, 34)] for _ in range(3000)]
    rows = [(i, " ".join(words[i * 100:(i + 1) * 100] + [keys[i]] + ["1234567890" * 3])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    accepted = secrets.fit(df)
    found = [(k, t[a:b]) for _, t in rows for k, a, b in secrets.spans(t, accepted)]
    hit = [s for k, s in found if k == "random"]
    assert len(set(hit) & set(keys)) >= 25 and len(set(hit) - set(keys)) <= 1
    assert secrets.redact("a bc d", [("hex", 2, 4), ("random", 3, 5)]) == "a [SECRET]d"


def test_random_tokens_are_discovered_in_a_small_corpus_without_long_words(spark):
    rng = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(4)]
    paths = ["/usr/share/local/python/packages", "state-of-the-art-long-word", "getCustomerAddressForNextOrder"]
    rows = [(i, f"only a few short words {k} and {p} here") for i, (k, p) in enumerate(zip(keys, paths + ["no"]))]
    accepted = secrets.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    hit = {t[a:b] for _, t in rows for k, a, b in secrets.spans(t, accepted) if k == "random"}
    assert len(hit & set(keys)) >= 3 and not hit - set(keys)


def test_secret_stage_keeps_rows_and_other_columns(spark, odd):
    dirty = odd.unionAll(spark.createDataFrame([(50, "my token=abcdefgh12 here", None, "s", 24)], odd.schema))
    out = secrets.stage(spark, dirty, "")
    assert out.columns == dirty.columns and out.count() == dirty.count()
    r = out.filter("doc_id = 50").first()
    assert r["text"] == "my [SECRET] here" and r["n_chars"] == len(r["text"])
    assert out.filter("doc_id = 4").first()["text"] is None


def _with_keys(texts, lengths, n, seed=5):
    """Texts with ``n`` random base62 keys of each length, dealt over them."""
    rng = random.Random(seed)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = {m: ["".join(rng.choice(alphabet) for _ in range(m)) for _ in range(n)] for m in lengths}
    out = list(texts)
    for i, k in enumerate(k for ks in keys.values() for k in ks):
        at = i * 7919 % len(out)
        out[at] += f" {k} x"
    return out, keys


def test_short_keys_are_found_in_the_table(spark, docs):
    """24 characters and more; and nothing in the table as it is."""
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    for planted in (False, True):
        rows, keys = _with_keys(texts, (24, 32, 40), 40 if planted else 0)
        accepted = secrets.fit(spark.createDataFrame([(t,) for t in rows], "text string"))
        found = {t[a:b] for t in rows for k, a, b in secrets.spans(t, accepted) if k == "random"}
        for m, ks in keys.items():
            assert sum(k in found for k in ks) >= (0.9 if m == 24 else 0.95) * len(ks)
        assert not found - {k for ks in keys.values() for k in ks}


def test_keys_beside_other_signs_and_in_one_case(spark):
    rng = random.Random(9)
    token = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(64)) for _ in range(10)]
    mixed = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(44))
             for _ in range(10)]
    texts = [f"some words {a} and key-{b} more" for a, b in zip(token, mixed)]
    accepted = secrets.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    found = [t[a:b] for t in texts for k, a, b in secrets.spans(t, accepted) if k == "random"]
    assert sum(t in found for t in token) >= 8
    # the part without the hyphen, or, for a key without + or /, the whole run, or a long part of it
    assert sum(any(len(f) >= 22 and f in f"key-{m}" for f in found) for m in mixed) >= 8


def test_secrets_query_equals_a_plain_recomputation(spark, docs):
    """Every column over the table: leftmost matches per kind, by plain regular expressions."""
    import hashlib
    import re
    accepted = secrets.fit(docs)
    want = {}
    for r in docs.collect():
        t = r["text"] or ""
        base = [(m.start(), 0, m.end()) for m in re.finditer(
            r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
        base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base))
        n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        more = [s for s in secrets.spans(t, accepted) if s[0] == "random"]
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(
            [(secrets.KINDS[k], a, b) for a, k, b in base] + more, key=lambda s: (s[1], secrets.KINDS.index(s[0]))))
        want[r["doc_id"]] = (*n, hashlib.sha256(joined.encode()).hexdigest(), spans, len(more))
    got = {r["doc_id"]: tuple(r)[1:] for r in secrets.query(docs).collect()}
    assert got == want
