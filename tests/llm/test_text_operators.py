"""Licences, decontamination, mixing, languages, fingerprints, WARC and HTML."""

import hashlib
import html
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from strandflow.llm import decontaminate, fingerprints, html_text, language_id, licenses, mixing, warc
from strandflow.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import compare

KIND = "doc_id long, text string, lang string, source string, id string, n long"


def table(spark, texts, source="s", lang="en"):
    return spark.createDataFrame([(i, t, lang, source, "clash", 7) for i, t in enumerate(texts)], KIND)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    compare(spark, sf_dir, QUERIES, ORACLE_SQL, name)


# licences


def test_license_bounds_lose_nothing():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.THRESHOLD)
    for licence, _, text in licenses.TEMPLATES:
        for cut in range(0, 12, 3):
            seq = licenses.words(text)[cut:]
            grams = set(zip(seq, seq[1:]))
            for i, (_, _, other) in enumerate(licenses.TEMPLATES):
                o = licenses.words(other)
                og = set(zip(o, o[1:]))
                dice = 2 * len(grams & og) / (len(grams) + len(og)) if grams else 0
                assert (dice >= licenses.THRESHOLD) == (i in {k for _, k in scanner.part(seq)})


def test_license_edge_texts(spark):
    mit = "\n\n".join(t for licence, name, t in licenses.TEMPLATES if licence == "MIT" and name in ("grant", "notice", "warranty"))
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n", mit)
    texts = [None, "", "word", "Released under\nthe MIT License!", "x " * 100_000 + "\nLicensed under CC BY-NC 4.0.", wrapped, "Nothing here at all.", "Foo is great. Released under the MIT License.", "Made here. " * 30 + "Licensed under CC BY 4.0. Thanks!"]
    got = {}
    for r in licenses.scan(table(spark, texts)).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.score, r.n_parts)
    assert got[3]["MIT"][0] == 1.0 and got[4] == {"CC-BY-NC-4.0": (1.0, 2)} and got[5]["MIT"][1] == 4 and got[5]["MIT"][0] == 1.0
    assert got[7]["MIT"] == (1.0, 1) and got[8]["CC-BY-4.0"] == (1.0, 1) and set(got) == {3, 4, 5, 7, 8}
    assert licenses.scan(table(spark, texts).limit(0)).count() == 0


# decontamination


def words(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def shingles(seq):
    return list(dict.fromkeys(" ".join(seq[i : i + 5]) for i in range(max(1, len(seq) - 4)))) if seq else []


def naive_matches(docs, items):
    """Every item-sized window of a text that has a shingle of the item at all, against that item."""
    items = {i: words(t) for i, t in items.items() if words(t)}
    out = {}
    for d, text in docs.items():
        seq = words(text)
        runs = {r: {" ".join(seq[k : k + r]) for k in range(len(seq) - r + 1)} for r in range(1, 6)}
        for i, own in items.items():
            theirs, size = set(shingles(own)), min(len(own), len(seq))
            if not theirs & runs[min(5, len(own))]:
                continue
            for start in range(len(seq) - size + 1):
                mine = set(shingles(seq[start : start + size]))
                if common := sum(map(len, mine & theirs)):
                    alike = common / (sum(map(len, mine)) + sum(map(len, theirs)) - common)
                    if alike >= 0.8:
                        out[d, i] = max(out.get((d, i), (0, 0)), (alike, -start))
    return out


def test_decontaminate_query_equals_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): (r.similarity, -r.start_word) for r in QUERIES["op2_decontaminate"](spark, sf_dir).collect()}
    assert got == naive_matches(docs, items)


def test_decontaminate_edges_near_copies_and_ties(spark):
    long_item = " ".join(f"w{k}" for k in range(60))
    items = {0: long_item, 1: "Short item", 2: None, 3: "!!!", 4: long_item}
    near = long_item.split()
    near[30] = "other"
    texts = [None, "", "...", "before " + " ".join(near) + " after", long_item.upper().replace(" ", ", "), "x " * 5_000 + long_item, "a SHORT, item", "short item", long_item + " " + long_item, "w1 w2 w3 w4 w5 other words"]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items.items()], "item_id long, text string, doc_id long")
    docs = table(spark, texts)
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), -r.start_word) for r in decontaminate.matches(docs, bench).collect()}
    want = {k: (round(a, 9), s) for k, (a, s) in naive_matches(dict(enumerate(texts)), items).items()}
    assert got == want and {(3, 0), (4, 4), (5, 0), (6, 1), (7, 1), (8, 0)} <= set(got)
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(range(len(texts))) - {d for d, _ in got})
    assert decontaminate.matches(docs.limit(0), bench).count() == 0 and decontaminate.matches(docs, bench.limit(0)).count() == 0
    assert decontaminate.matches(docs.unionAll(docs), bench).count() == len(got)


def test_decontaminate_finds_reordered_halves_and_every_length(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9)))
    half = [[word() for _ in range(40)] for _ in range(2)]
    items = {0: " ".join(half[0] + half[1])} | {k: " ".join(word() for _ in range(k)) for k in (1, 2, 4, 5, 6, 9, 23, 120)}
    texts = [" ".join([word() for _ in range(7)] + half[1] + half[0] + [word() for _ in range(5)]), " ".join(half[1] + half[0] + half[1])]
    for k in (9, 23, 120):
        own = items[k].split()
        texts += [" ".join([word() for _ in range(n)] + own[c:] + own[:c] + [word()]) for n in (0, 3, 119, 121, 245) for c in (0, 1, k // 2)]
        texts += [" ".join(own[:-n]) for n in range(1, 1 + k // 8)]
    texts += [f"{word()} {items[k]} {word()}" for k in (1, 2, 4, 5, 6)]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = {k: (round(a, 9), s) for k, (a, s) in naive_matches(dict(enumerate(texts)), items).items()}
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), -r.start_word) for r in decontaminate.matches(table(spark, texts), bench).collect()}
    assert got == want and got[0, 0] == (want[0, 0][0], -7) and got[0, 0][0] > 0.85


def test_decontaminate_in_slices_and_recall_of_near_copies(spark, monkeypatch):
    """Of 1500 passages with a similarity from 0.8 up, the fingerprints lose none; a sliced benchmark gives the same."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9)))
    items = {i: [word() for _ in range(rnd.randint(15, 59))] for i in range(60)}
    texts, want = [], set()
    while len(texts) < 1500:
        i = rnd.choice(list(items))
        seq = list(items[i])
        for _ in range(rnd.randint(1, 2)):
            seq[rnd.randrange(len(seq))] = word()
        mine, theirs = set(shingles(seq)), set(shingles(items[i]))
        common = sum(map(len, mine & theirs))
        if common / (sum(map(len, mine)) + sum(map(len, theirs)) - common) >= 0.8:
            want.add((len(texts), i))
            texts.append(" ".join([word() for _ in range(3)] + seq + [word() for _ in range(3)]))
    bench = spark.createDataFrame([(i, " ".join(s)) for i, s in items.items()], "item_id long, text string")
    docs = table(spark, texts)
    got = {tuple(r) for r in decontaminate.matches(docs, bench).collect()}
    assert {r[:2] for r in got} == want
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 700)
    assert {tuple(r) for r in decontaminate.matches(docs, bench).collect()} == got


def test_clean_with_clashing_names(spark):
    item = " ".join(f"w{k}" for k in range(20))
    df = spark.createDataFrame([(1, item, 1, 2, 3, 4, 5), (2, "other", 1, 2, 3, 4, 5)], "doc_id long, text string, hit long, same long, key long, `hit_` long, `a.b` long")
    left = decontaminate.clean(df, spark.createDataFrame([(0, item)], "item_id long, text string"))
    assert left.columns == df.columns and [r.doc_id for r in left.collect()] == [2]


def test_clean_drops_only_the_rows_that_match(spark):
    item = " ".join(f"w{k}" for k in range(20))
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    rows = [(None, item), (None, "clean words here"), (3, "x " + item), (3, "other words"), (None, None)]
    left = decontaminate.clean(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, ""), (0, "clean words here"), (3, "other words")]


def test_block_tables_reach_the_radius():
    assert decontaminate.RADIUS // decontaminate.BLOCKS * decontaminate.BLOCKS + decontaminate.BLOCKS > decontaminate.RADIUS


def test_near_copy_of_21_bits_is_found(spark):
    r = random.Random(7190)  # a pair of similarity 0.818 whose fingerprints are 21 bits apart
    item = ["".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(59)]
    near = item[:-6] + ["".join(r.choices("abcdefghij", k=2)) for _ in range(6)]
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    (got,) = decontaminate.matches(table(spark, [" ".join(near)]), bench).collect()
    assert got.similarity >= 0.8 and got.hamming == 21


def test_decontaminate_is_native(spark, sf_dir):
    plan = QUERIES["op2_decontaminate"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Cartesian" not in plan and "NestedLoop" not in plan


# mixing


def test_poisson_inverts_the_distribution(spark):
    grid = [(m, u) for m in (0.01, 0.5, 1.0, 7.3, 16.0) for u in (0.0, 0.1, 0.5, 0.9, 0.999, 0.9999999, 1 - 1e-12)]
    df = spark.createDataFrame(grid, "m double, u double").select("m", "u", mixing.poisson(mixing.cumulative(F.col("m")), F.col("u")).alias("n"))
    for r in df.collect():
        below, n = math.exp(-r.m), 0
        term = below
        while below <= r.u and n < mixing.TERMS:
            n += 1
            term *= r.m / n
            below += term
        assert r.n == n


def test_mix_of_a_tiny_source_is_made_in_pieces_and_names_may_clash(spark, monkeypatch):
    rows = [(1, "x" * 200_000, "big", 1, 2, 3, 4, 5), (2, "y", "tiny", 1, 2, 3, 4, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, `of` long, rate long, n long, copy long, `a.b` long")
    whole = sorted((r.doc_id, r.copy) for r in mixing.mix(df, weights={"big": 1.0, "tiny": 0.02}).collect())
    assert sum(d == 2 for d, _ in whole) > 3000 and len(set(whole)) == len(whole)
    assert set(df.columns) < set(mixing.mix(df).columns) and "_mix_copies" not in mixing.mix(df).columns
    monkeypatch.setattr(mixing, "PIECE", 1 << 40)
    assert sorted((r.doc_id, r.copy) for r in mixing.mix(df, weights={"big": 1.0, "tiny": 0.02}).collect()) == whole


def test_mix_reaches_its_weights_and_handles_edges(spark):
    rows = [(i, "x" * 100, "en", s, "c", 1) for i, s in enumerate(["a"] * 2000 + ["b"] * 200 + [None] * 20)] + [(9000, None, "en", "a", "c", 1), (None, "yy", "en", "b", "c", 1)]
    df = spark.createDataFrame(rows, KIND)
    out = mixing.mix(df, weights={"a": 1.0, "b": 1.0, None: 2.0})
    n = Counter(r.source for r in out.collect())
    total = sum(n.values())
    assert abs(n["a"] / total - 0.25) < 0.04 and abs(n["b"] / total - 0.25) < 0.05 and abs(n[None] / total - 0.5) < 0.07
    assert set(df.columns) < set(out.columns)
    one = mixing.mix(df, weights={"a": 1.0})
    assert {r.source for r in one.collect()} == {"a"}
    assert sorted(map(str, one.collect())) == sorted(map(str, mixing.mix(df.repartition(7), weights={"a": 1.0}).collect()))
    assert mixing.mix(df.limit(0)).count() == 0


# languages


def test_language_accuracy_on_the_fold_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op4_language_id"](spark, sf).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) / len(out) >= 0.97


def _model(size=4):
    rng = np.random.default_rng(1)
    w = lambda *shape: rng.standard_normal(shape).astype(np.float32) * 0.5
    return [w(3 * size, 256), w(3 * size, 256), w(3 * size, size), w(3 * size, size), w(2, size), w(2, size), w(2)]


def test_backpropagation_equals_differences():
    weights = [x.astype(np.float64) for x in _model()]
    rng = np.random.default_rng(2)
    data, target = rng.integers(97, 103, (7, 3)).astype(np.uint8), np.array([0, 1, 1])
    mask = np.ones((7, 3))
    mask[5:, 1] = 0

    def loss():
        model = language_id.Model(["a", "b"], tuple(weights[:2]), tuple(weights[2:4]), tuple(weights[4:6]), weights[6])
        p = language_id.position_probabilities(model, data, mask)
        return -(np.log(p[:, target, np.arange(3)]) * mask).sum() / mask.sum()

    grads = language_id._gradients(weights, data, mask, target)
    for w, g in zip(weights, grads):
        for at in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(4)] + [(0, 98)[: w.ndim]] * (w.shape[-1] == 256):
            old = w[at]
            w[at] = old + 1e-3
            up = loss()
            w[at] = old - 1e-3
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-3 - g[at]) < 2e-4


def test_classify_does_not_depend_on_neighbours_and_counts_all_bytes():
    m = language_id.Model(["a", "b"], *(lambda w: (tuple(w[:2]), tuple(w[2:4]), tuple(w[4:6]), w[6]))(_model()))
    bodies = [b"x" * 1000, b"abc", b"q" * 128, b"long " * 5000]
    together, _ = language_id.classify(m, bodies)
    alone = np.concatenate([language_id.classify(m, [b])[0] for b in bodies])
    assert np.allclose(together, alone, atol=1e-5) and np.allclose(together.sum(axis=1), 1)


def test_language_edges(spark):
    texts = ["the house and the garden " * 20] * 30
    docs = table(spark, texts).unionAll(spark.createDataFrame([(100 + i, "der Garten und das Haus schön " * 20, "de", "s", "c", 1) for i in range(30)], KIND))
    model = language_id.fit(docs.unionAll(table(spark, ["no label"], lang=None)))
    assert model.langs == ["de", "en"]
    odd = table(spark, [None, "", "123 !!", "the garden and the house", "x" * 300_000])
    got = [(r.lang_pred, r.score) for r in language_id.predict(odd, model).orderBy("doc_id").collect()]
    assert got[:3] == [("und", 0.0)] * 3 and got[3][0] == "en"
    kept = language_id.keep_known(odd, model, least=0.0)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4]
    assert language_id.fit(odd.limit(0)) is None and language_id.fit(table(spark, texts, lang=None)) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}
    assert language_id.predict(odd.limit(0), model).count() == 0 and language_id.keep_known(odd, None).count() == 0


def test_language_model_of_rows_that_share_an_id(spark):
    rows = [(4, "the house and the garden of it " * 3, "en")] * 900 + [(4, f"der Garten und das Haus Nummer {k} " * 3, "de") for k in range(900)]
    rows += [(None, f"la casa y el jardín número {k} " * 3, "es") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert model is not None and model.langs == ["de", "en", "es"]


def test_language_query_equals_a_plain_forward_pass(spark):
    """Each byte's distribution by loops over one byte at a time, in stretches, averaged over the whole text."""
    w = _model()
    model = language_id.Model(["a", "b"], tuple(w[:2]), tuple(w[2:4]), tuple(w[4:6]), w[6])
    texts = ["abc", "some words " * 30, "é" * 100, "z" * language_id.SPAN]
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def states(d, data):
        size, h, out = w[2].shape[1], [0.0] * w[2].shape[1], []
        for byte in data:
            x, g = w[d][:, byte], [sum(float(w[2 + d][k, j]) * h[j] for j in range(size)) for k in range(3 * size)]
            z = [sigmoid(float(x[k]) + g[k]) for k in range(size)]
            r = [sigmoid(float(x[size + k]) + g[size + k]) for k in range(size)]
            n = [math.tanh(float(x[2 * size + k]) + r[k] * g[2 * size + k]) for k in range(size)]
            h = [n[k] + z[k] * (h[k] - n[k]) for k in range(size)]
            out.append(h)
        return out

    want = []
    for text in texts:
        body, total = text.encode(), [0.0, 0.0]
        for at in range(0, len(body), language_id.SPAN):
            data = body[at : at + language_id.SPAN]
            for f, b in zip(states(0, data), states(1, data[::-1])[::-1]):
                logits = [float(w[6][c]) + sum(float(w[4][c, k]) * f[k] + float(w[5][c, k]) * b[k] for k in range(len(f))) for c in (0, 1)]
                e = [math.exp(x) for x in logits]
                total = [t + x / sum(e) for t, x in zip(total, e)]
        want.append([t / len(body) for t in total])
    got = {r.doc_id: r for r in language_id.predict(table(spark, texts), model).collect()}
    for k, (a, b) in enumerate(want):
        assert got[k].lang_pred == ("a" if a >= b else "b") and abs(got[k].score - max(a, b)) < 1e-4


# fingerprints


def naive_winnowing(text, gram_hash):
    """Picked (hash, position) of a text by plain loops over the same units and gram hashes."""
    grams = gram_hash
    width = fingerprints.WINDOW
    out = set()
    for i in range(max(1, len(grams) - width + 1) if grams else 0):
        part = list(enumerate(grams[i : i + width], i))
        least = min(h for _, h in part)
        out.add(max(p for p, h in part if h == least))
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(text):
    """xxhash64 of a string as Spark has it."""
    return signed(xxhash.xxh64_intdigest(text.encode(), 42))


def naive_grams(text):
    n = fingerprints.GRAM
    return [(spark_hash(text[i : i + n]) & (1 << 64) - 1) >> 31 for i in range(max(1, len(text) - n + 1) if text else 0)]


def naive_print(text):
    """{(hash, position)} of a text by plain loops."""
    grams = naive_grams(text)
    return {(grams[p], p) for p in naive_winnowing(text, grams)}


def naive_likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def taken_apart(fingerprint):
    return {(int(g, 16) >> 30 & (1 << 33) - 1, int(g, 16) & fingerprints._POSITION) for g in fingerprint.split()}


def test_winnowing_picks_the_rightmost_least_of_each_window(spark):
    texts = ["", "a", "a b", "1234567", "12345678", "ab" * 40, "la " * 200, " ".join(f"w{k * k % 37}" for k in range(300)), "漢字" * 400, "one two\n\tthree " * 60, "😀é" * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for r in fingerprints.winnowed(df, "text", "p").select("i", fingerprints.as_text("p").alias("f")).collect():
        assert taken_apart(r.f) == naive_print(texts[r.i]), r.i


def test_fingerprint_query_equals_brute_force(spark, sf_dir):
    """Each row's fingerprints and likenesses against plain loops, and what they tell apart on a larger table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op7_winnowing"](spark, sf_dir).collect()}
    prints = {d.text: naive_print(d.text) for d in docs}
    for k, d in enumerate(docs):
        after = docs[(k + 1) % len(docs)].text
        cut = len(d.text) // 4
        edited = d.text[: len(d.text) - cut] + after[:cut]
        r = got[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(d.text), hashlib.sha256(edited.encode()).hexdigest())
        assert taken_apart(r.fingerprint) == prints[d.text] and taken_apart(r.edited_fingerprint) == naive_print(edited)
        assert math.isclose(r.near_edited, naive_likeness(prints[d.text], naive_print(edited)))
        assert math.isclose(r.near_next, naive_likeness(prints[d.text], prints[after]))
    rows = QUERIES["op7_winnowing"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r.near_edited > r.near_next for r in rows) / len(rows) > 0.99
    assert np.mean([r.near_edited for r in rows]) > 0.55 and max(r.near_next for r in rows) < 0.1 and np.mean([r.near_next for r in rows]) < 0.005


def test_fingerprint_edges(spark):
    df = spark.createDataFrame([(5, "é" * 7, 1), (-3, None, 1), (5, "abc", 1), (None, "null id text", 1), (10**15, "the last one, which wraps", 1)], "doc_id long, text string, q long")
    got = {(r.doc_id, r.n_chars): r.edited for r in fingerprints.compare_edits(df).collect()}
    assert got == {(None, 12): "null id t", (-3, 0): "", (5, 3): "abc", (5, 7): "éééééé" + "t", (10**15, 25): "the last one, which" + "null i"}
    single = fingerprints.compare_edits(df.where("q = 1 AND doc_id = -3"))
    assert single.first().near_next == 1.0
    assert fingerprints.compare_edits(df.limit(0)).count() == 0


def test_fingerprints_in_divided_quantiles(spark, sf_dir, monkeypatch):
    want = sorted((r.doc_id, r.edited) for r in fingerprints.compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect())
    monkeypatch.setattr(fingerprints, "QUANTILES", 5)
    monkeypatch.setattr(fingerprints, "PART_BYTES", 20_000)
    assert sorted((r.doc_id, r.edited) for r in fingerprints.compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()) == want


def test_fingerprints_are_native(spark, sf_dir):
    plan = QUERIES["op7_winnowing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_fingerprints_meet_across_text_sizes(spark):
    prose = [f"w{k * k % 9973}" for k in range(400)]
    brief, tiny, near = " ".join(prose[100:130]), "Zebra-Quartz 47!!", " ".join(prose[:60])
    han = "".join(chr(0x4E00 + k * k % 5003) for k in range(60))
    whole = " ".join(prose)
    texts = [whole, brief, tiny, " ".join(prose[200:300]) + " " + tiny + " " + han + " " + " ".join(prose[300:]), han * 8, near[:250], near[:260], whole[1000:1305], whole[1000:1229], whole[:240], whole, "x"]
    got = {r.doc_id: r for r in fingerprints.compare_edits(table(spark, texts)).collect()}
    for a, b in ((0, 1), (2, 3), (3, 4), (5, 6), (0, 7)):
        assert {h for h, _ in naive_print(texts[a])} & {h for h, _ in naive_print(texts[b])}, (a, b)
    assert got[5].near_next > 0.8 and got[7].near_edited > 0.5 and got[7].near_next > 0.6
    for k in (7, 9):
        want = naive_likeness(naive_print(texts[k]), naive_print(texts[k + 1]))
        assert want > 0 and math.isclose(got[k].near_next, want)


def test_fingerprints_of_the_edited_text_are_as_if_picked_anew(spark):
    prose = " ".join(f"w{k * k % 997}" for k in range(300))
    texts = [prose[k : k + n] for k, n in enumerate((0, 1, 2, 5, 9, 10, 11, 13, 17, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 40, 100, 300, 900))] + ["aaaa" * 30, "漢字😀" * 20, "é"]
    rows = fingerprints.winnowed(fingerprints.compare_edits(table(spark, texts)), "edited", "anew").collect()
    assert len(rows) == len(texts) and all(set(r.edited_picked) == set(r.anew) for r in rows)


def test_fingerprints_of_hot_ids_and_of_other_types(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "QUANTILES", 16)
    texts = [f"text number {k * 7919 % 101} of many" for k in range(60)]
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    parts = fingerprints.in_parts(df, "doc_id", "text")[0].groupBy("part").count().collect()
    assert len(parts) > 8 and max(r["count"] for r in parts) < 20
    key = lambda r: (r[0] is not None, r[0], (spark_hash(r[1]) & (1 << 64) - 1) >> 33, r[1])
    ranked = sorted(rows, key=lambda r: tuple(0 if x is None else x for x in key(r)))
    cut = lambda a, b: a[: len(a) - len(a) // 4] + b[: len(a) // 4]
    want = sorted((i or -1, cut(t, ranked[(k + 1) % 60][1])) for k, (i, t) in enumerate(ranked))
    assert sorted((r.doc_id or -1, r.edited) for r in fingerprints.compare_edits(df).collect()) == want
    named = spark.createDataFrame([(f"id-{k:03d}", t) for k, t in enumerate(texts)], "`doc.id` string, text string")
    got = {r[0]: r.edited for r in fingerprints.compare_edits(named, "doc.id").collect()}
    assert got == {f"id-{k:03d}": cut(t, texts[(k + 1) % 60]) for k, t in enumerate(texts)}


# WARC


def test_audit_locates_every_fault(spark):
    rows = [(0, 0, 1, "a"), (0, 70_000, 2, "b"), (3, 0, 3, "c"), (300, 1 << 33, 4, "d"), (-1, 5, None, "e")]
    kind = "file long, offset long, record_id long, digest string"
    ours = spark.createDataFrame(rows, kind)
    theirs = spark.createDataFrame([(0, 0, 1, "a"), (0, 70_000, 2, "B"), (300, 1 << 33, 4, "d"), (300, 1 << 34, 9, "x"), (-1, 5, None, "e")], kind)
    got = sorted((r.record_id, r.kind, r.ours, r.theirs) for r in warc.audit(ours, theirs).collect())
    assert got == [(2, "changed", "b", "B"), (3, "missing", "c", None), (9, "extra", None, "x")]
    assert warc.audit(ours, ours).count() == 0 and warc.audit(ours.limit(0), ours.limit(0)).count() == 0
    assert warc.audit(ours, ours.limit(0)).count() == 5
    assert [r.record_id for r in warc.audit(ours.unionAll(ours.where("record_id = 1")), ours).collect()] == [1]


def test_manifest_is_the_layout_of_the_bytes(spark):
    pages = spark.createDataFrame([(2, "http://b/", "<p>é</p>", 1), (1, None, None, 1), (1500, "u", "x", 1), (None, "n", "", 1)], "page_id long, url string, html string, file long")
    got = warc.manifest(pages).collect()
    first, second = sorted((r for r in got if r.file == 0), key=lambda r: r.offset)
    assert (first.record_id, first.offset, second.record_id, second.offset) == (1, 0, 2, first.length)
    body = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:2>\r\nWARC-Target-URI: http://b/\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 9\r\n\r\n<p>é</p>\r\n\r\n".encode()
    assert (second.length, second.digest) == (len(body), hashlib.sha256(body).hexdigest())
    assert sorted(max(-1, r.file) for r in got) == [-1, 0, 0, 1]


# HTML

WEIGHTS = html_text.Weights(html_text.LABELLED)


def test_html_query_on_all_pages(spark, sf_dir):
    got = {r.page_id: r for r in QUERIES["op9_html_text"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", inner))).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain text", "plain text"), ("<p>a &amp; b&nbsp;&#233; &lt;c&gt;</p>", "a & b é <c>"), ("<p>un<b>broken</b> word<br>next</p>", "unbroken word next"),
    ("<article><p>One.</p><div class='ad'>Buy</div><p>Two.</p><div id=comments><p>Me too, a long comment of many words that is not the text.</p></div></article>", "One. Two."),
    ("<body><nav><a>Home</a></nav><main><h1>T</h1><p>x y z</p><form><label>Mail</label><input></form><aside>see also</aside></main><footer>c</footer>", "T x y z"),
    ("<body><div class=sidebar><p>side words here</p></div><div class='content'><p>main words are here</p><script>var p='<p>no</p>'</script><style>p{}</style></div>", "main words are here"),
    ("<article><p>a < b and b > a</p><!-- gone <p>x</p> --><p>end</p></article>", "a < b and b > a end"), ("<p>open <b>tags <i>stay</p><p unclosed", "open tags stay"),
    ("<article><p>Text of it.</p><ol class=commentlist><li>First!</li></ol></article>", "Text of it."), ("<nav>only menus</nav>", ""), ("<div class='cookie-notice'>We use cookies</div><p>Text</p>", "Text"),
])
def test_html_cases(page, want):
    assert html_text.extract(page, WEIGHTS) == want


@pytest.mark.parametrize("page, want", [
    ("<article><h1>Word</h1><div><div><p>Then some main words follow here.</p></div></div><ul><li><a>Last</a></li></ul></article>", "Word Then some main words follow here. Last"),
    ("<nav><a>Home</a></nav><article><p>Few words before.</p>" + "<div><a><img></a></div>" * 60 + "<p>And quite a few more words after it.</p></article>", "Few words before. And quite a few more words after it."),
])
def test_html_blocks_at_the_edge_and_galleries_stay(page, want):
    assert html_text.extract(page, WEIGHTS) == want


@pytest.mark.parametrize("page", [
    '<script>var t="<main>"</script><div><p>{}</p></div>', "<!-- <article> --><div><p>{}</p></div>", '<div data-id="footer-12"><p>{}</p></div>',
    '<div data-role="banner"><p>{}</p></div>', '<div title="class=ad"><p>{}</p></div>', '<div class="socialist-history"><p>{}</p></div>', '<body class="has-sidebar comments-open"><p>{}</p>',
])
def test_html_ordinary_pages_keep_their_text(page):
    text = "An ordinary page says what it has to say in a sentence or two."
    assert html_text.extract(page.format(text), WEIGHTS) == text


HINTLESS = [
    "<div><a>Home</a><a>News</a><a>About</a></div><div><p>{}</p><p>{}</p></div><div><a>Next</a><a>Older</a></div>",
    "<table><tr><td><a>One</a></td><td><a>Two</a></td></tr></table><h1>{}</h1><p>{}</p><ul><li><a>Read more</a></li><li><a>Share</a></li></ul>",
    "<ul><li><a>Start</a></li><li><a>Shop now</a></li></ul><div><div><p>{}</p></div><div><p>{}</p></div></div><ul><li><a>Imprint</a></li></ul>",
]


@pytest.mark.parametrize("page", HINTLESS)
def test_html_region_is_what_the_scan_chooses(page):
    """No element or class says anything here: without the scan the links would stay."""
    texts = "The text of a page has words enough to pay for its tags.", "A second block follows it and counts as well."
    items = html_text.scored(page.format(*texts), WEIGHTS)
    assert html_text.extract(page.format(*texts), WEIGHTS) == " ".join(texts)
    assert " ".join("".join(t for _, t in items).split()) != " ".join(texts)


def test_best_stretch_equals_brute_force():
    rnd = random.Random(5)
    for _ in range(300):
        scores = [rnd.choice([-3, -1, -0.5, 0, 1, 2, 4]) for _ in range(rnd.randint(0, 14))]
        a, b = html_text.best_stretch(scores)
        assert sum(scores[a:b]) == max((sum(scores[i:j]) for i in range(len(scores) + 1) for j in range(i, len(scores) + 1)), default=0)


def test_html_depth_costs_no_more_than_length():
    began = time.process_time()
    page = "<div class=text>" * 100_000 + "<p>deep words here</p>" + "</b>" * 50_000 + "</div>" * 100_000
    assert html_text.extract(page, WEIGHTS) == "deep words here"
    assert time.process_time() - began < 10


def test_html_edges(spark):
    df = spark.createDataFrame([(1, "u", None, "t"), (2, None, "<p>x</p>" * 20_000, "t"), (None, "u", "<p>q</p>", "t")], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    assert got[1].text == "" and got[2].n_chars == 39_999 and got[None].text == "q"
    assert html_text.main_text(df.limit(0)).count() == 0 and html_text.main_text(df.unionAll(df)).count() == 6


def test_labelled_pages_are_told_apart():
    for page in html_text.LABELLED:
        want = " ".join(" ".join(re.sub(r"<[^>]*>", " ", x) for x in re.findall(r"\[\[(.*?)\]\]", page)).split())
        assert html_text.extract(page.replace("[[", "").replace("]]", ""), WEIGHTS) == want
