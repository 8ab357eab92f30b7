"""Substring, suffix and near dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash

from strandflow.llm import common, exchange, simhash_dedup, substring_dedup, suffix_dedup
from strandflow.llm.components import components
from strandflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def small_groups(monkeypatch):
    """Many groups and buckets, as large tables have them."""
    monkeypatch.setattr(common, "GROUP_BYTES", 10_000)
    monkeypatch.setattr(exchange, "BUCKET_KEYS", 50)


def table(spark, texts, **more):
    rows = [(i, t, "clash", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, g string")


def covered(seq, length, count, key=lambda x: x):
    gone = np.zeros(len(seq), bool)
    for i in range(len(seq) - length + 1):
        if count[key(seq[i : i + length])] > 1:
            gone[i : i + length] = True
    return gone


def byte_texts(seed):
    rnd = random.Random(seed)
    letters = "abcdé "
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(150, 900))) for _ in range(20)]
    texts = [None, "", "x" * 150, "y" * 199, "y" * 200, "z" * 500, "ab" * 400, "q" * 201 + "é" * 30]
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            s = rnd.choice(base)
            a = rnd.randrange(len(s))
            parts.append(s[a : a + rnd.choice([190, 198, 199, 200, 201, 205, 215, 216, 300, 800])])
            if rnd.random() < 0.6:
                parts.append("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))))
        texts.append("".join(parts))
    return texts + texts[20:24] + ["".join(base) * 3]


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_equals_brute_force(spark, seed):
    texts = byte_texts(seed)
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    got = {r.doc_id: r for r in suffix_dedup.find_repeats(table(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, b in enumerate(bodies):
        gone = covered(b, 200, count)
        r = got[i]
        assert (r.n_bytes, r.n_removed, bytes(r.kept)) == (len(b), int(gone.sum()), bytes(np.frombuffer(b, np.uint8)[~gone]))
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_suffix_dedup_answers_do_not_depend_on_groups(spark, monkeypatch):
    texts = byte_texts(9)
    seen = []
    for size in (3000, 1 << 22):
        monkeypatch.setattr(common, "GROUP_BYTES", size)
        seen.append(sorted((r.doc_id, bytes(r.kept)) for r in suffix_dedup.find_repeats(table(spark, texts)).collect()))
    assert seen[0] == seen[1]


def without_spark(texts, groups, n=3):
    """All rounds of the suffix dedup in this process."""
    tables = [pa.table({"g": pa.array([g] * len(ids), pa.int32()), "id": ids, "body": pa.array([(texts[i] or "").encode() for i in ids], pa.binary())}) for g, ids in enumerate(np.array_split(np.arange(len(texts)), groups)) if len(ids)]
    answered = exchange._ANSWERED.empty_table()
    for rounds, resolve in enumerate((lambda t: exchange.repeated_in(t, 1, 1), lambda t: exchange.refined_in(t, 2), lambda t: exchange.repeated_in(t, 3, 2))):
        asked = pa.concat_tables([exchange.ask(g, *suffix_dedup.refine(t, answered.filter(pc.equal(answered["g"], g)), rounds)[1:], n) for g, t in enumerate(tables)])
        replies = [resolve(asked.filter(pc.equal(asked["b"], b))) for b in pc.unique(asked["b"]).to_pylist()]
        answered = pa.concat_tables([answered, *replies])
    out = {}
    for g, t in enumerate(tables):
        group, gone, _ = suffix_dedup.refine(t, answered.filter(pc.equal(answered["g"], g)), 3)
        out |= {i: gone[k] for k, i in enumerate(group.ids)}
    return out


@pytest.mark.parametrize("chunk", [300, 700, 5000])
def test_long_texts_in_stretches_equal_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    texts = byte_texts(chunk)
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    got = without_spark(texts, 4)
    for i, b in enumerate(bodies):
        assert (got[i] == covered(b, 200, count)).all()


def test_words_hashed_in_blocks_are_the_same(monkeypatch):
    body = [b"  one two three\tfour " * 50, b"", b"x", b"one two three four"]
    whole = substring_dedup.Words(body)
    monkeypatch.setattr(substring_dedup, "BLOCK_WORDS", 7)
    parts = substring_dedup.Words(body)
    at = whole.anchors()
    assert (whole.name(at, 15, 0) == parts.name(at, 15, 0)).all()


def test_remove_repeats_keeps_the_columns(spark):
    df = table(spark, ["é" * 150 + "ab" + "x" * 200, "c" + "x" * 200, None])
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    # 200 bytes of two-byte characters repeat one character on: all of them go
    assert got == {0: "ab", 1: "c", 2: ""}


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocabulary = ["a", "bé", "c d", "dd", "e", "f", "gg"]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randint(30, 200))] for _ in range(20)]
    texts = [None, "", " ", "\n\n", "x " * 20, "y " * 35, "y " * 36, "a b " * 60]
    for _ in range(70):
        words = []
        for _ in range(rnd.randint(1, 3)):
            s = rnd.choice(base)
            a = rnd.randrange(len(s))
            words += s[a : a + rnd.choice([33, 34, 35, 36, 37, 40, 80])]
            if rnd.random() < 0.6:
                words += [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))]
        texts.append(rnd.choice(["", " "]) + "".join(w + rnd.choice([" ", " ", "\n", "\t ", "  ", "\x0b"]) for w in words) + rnd.choice(["", "z"]))
    texts += texts[20:24]
    seqs = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(s[i : i + 35]) for s in seqs for i in range(len(s) - 34))
    got = {r.doc_id: r for r in substring_dedup.find_repeats(table(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, s in enumerate(seqs):
        gone = covered(s, 35, count, tuple)
        kept = " ".join(w for w, g in zip(s, gone) if not g).encode()
        assert (got[i].n_words, sum(x.end - x.start for x in got[i].removed), bytes(got[i].kept)) == (len(s), int(gone.sum()), kept)


def test_difference_cover():
    for i in range(21):
        for j in range(21):
            assert any((i + k) % 21 in substring_dedup.COVER and (j + k) % 21 in substring_dedup.COVER for k in range(21))


def naive_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    prints = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op6_simhash_dedup"](spark, sf_dir).collect()}
    prints = [naive_fingerprint(r.text or "") for r in docs]
    for r, p, c in zip(docs, prints, naive_components(prints)):
        assert (got[r.doc_id].fingerprint, got[r.doc_id].component_id) == (f"{p:016x}", docs[c].doc_id)


def test_simhash_edge_texts(spark):
    texts = [None, "", " \n", "One", "one", "ONE two", "É", "é", "a b c"]
    got = sorted(simhash_dedup.near_duplicates(table(spark, texts)).collect())
    assert [r.fp & (1 << 64) - 1 for r in got] == [naive_fingerprint(t or "") for t in texts]
    assert [r.component_id for r in got] == [0, 0, 0, 3, 3, 5, 6, 7, 8]


@pytest.mark.parametrize("cell", [2, 32])
def test_links_of_dense_and_sparse_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash_dedup, "CELL", cell)
    rnd = random.Random(cell)
    prints = []
    for centre in (rnd.getrandbits(64) for _ in range(25)):
        for _ in range(rnd.choice([1, 2, 5, 80])):
            x = centre
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 4])):
                x ^= 1 << rnd.randrange(64)
            prints.append(x)
    prints = sorted(set(prints))
    nodes = spark.createDataFrame([(simhash_dedup._signed(x),) for x in prints], "fp long")
    root = {r.node: r.root for r in components(simhash_dedup.links(nodes), "a", "b").collect()}
    classes = {}
    for x, c in zip(prints, naive_components(prints)):
        classes.setdefault(c, set()).add(root.get(simhash_dedup._signed(x), simhash_dedup._signed(x)))
    assert all(len(v) == 1 for v in classes.values())
    assert len({next(iter(v)) for v in classes.values()}) == len(classes)


def test_pivot_tables_discard_pairs_and_do_not_stand_for_bits(spark):
    rnd = random.Random(1)
    tables = {}
    base = [rnd.getrandbits(64) for _ in range(200)]
    pairs = [(x, x ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64)) for x in base] + [(x, x & (1 << 32) - 1 | rnd.getrandbits(32) << 32) for x in base]
    far = lambda x: [(x ^ r).bit_count() for r in simhash_dedup.REFERENCES]
    df = spark.createDataFrame([(simhash_dedup._signed(x), simhash_dedup._signed(y)) for x, y in pairs], "x long, y long")
    df = df.select("x", "y", simhash_dedup.table(df.x).alias("a"), simhash_dedup.table(df.y).alias("b")).withColumn("ok", simhash_dedup.survives("a", "b"))
    got = {(r.x & (1 << 64) - 1, r.y & (1 << 64) - 1): r.ok for r in df.collect()}
    for x, y in pairs:
        spread = max(abs(a - b) for a, b in zip(far(x), far(y)))
        assert got[x, y] == (spread <= simhash_dedup.RADIUS) and ((x ^ y).bit_count() > 2 or got[x, y])
    assert sum(got[p] for p in pairs[:200]) == 200 and sum(got[p] for p in pairs[200:]) < 10
    # blocks of 16 bits that differ in many ways have one and the same distance to a reference
    tables = {tuple((x ^ r & 0xFFFF).bit_count() for r in simhash_dedup.REFERENCES[:1]) for x in range(1 << 16)}
    assert len(tables) == 17
    assert [len(m) for m in simhash_dedup.ROUNDS] == [6, 36, 216] and {m.bit_count() for m in simhash_dedup.ROUNDS[-1]} == {56}


def test_keep_first_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d", 1, 2, 3, 4), (2, "A b c d", 1, 2, 3, 4), (2, "A b c d", 1, 2, 3, 4), (3, "q r s t", 1, 2, 3, 4), (3, "q r s t", 1, 2, 3, 5)], "doc_id long, text string, known long, same long, nth_ long, `first.x` long")
    left = simhash_dedup.keep_first(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_replacement_characters_of_the_input_stay(spark):
    df = table(spark, ["a\ufffdb", "\ufffd" + "é" * 150 + "\ufffd", "c\ufffd" + "x" * 200, "x" * 200])
    got = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {0: "a\ufffdb", 1: "\ufffd\ufffd", 2: "c\ufffd", 3: ""}


def test_keep_first_keeps_one_of_each_group_and_of_repeated_rows(spark):
    df = table(spark, ["a b c d", "q r s t", "A b  c d", None, ""])
    df = df.unionAll(df.where("doc_id = 1"))
    assert sorted(r.doc_id for r in simhash_dedup.keep_first(df).collect()) == [0, 1, 3]


def test_keep_first_tells_rows_without_or_with_one_id_apart(spark):
    rows = [(None, "a b c d"), (None, "q r s t"), (None, "A b  c d"), (7, "u v w x"), (7, "k l m n"), (9, "k l m n"), (None, "k l m n")]
    got = simhash_dedup.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text.lower().split()[0]) for r in got) == [(0, "a"), (0, "q"), (7, "k"), (7, "u")]


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + k: 1000 for k in range(1, 200)}


@pytest.mark.parametrize("operator", [suffix_dedup.find_repeats, substring_dedup.find_repeats, simhash_dedup.near_duplicates])
def test_empty_table_and_repeated_rows(spark, operator):
    df = table(spark, ["word " * 100])
    assert operator(df.limit(0)).count() == 0
    assert operator(df.unionAll(df)).count() == 2


def test_queries_give_the_digests(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for name, size in (("op10_suffix_dedup", "n_bytes"), ("op5_substring_dedup", "n_words")):
        for r in QUERIES[name](spark, sf_dir).collect():
            body = docs[r.doc_id]
            assert r[size] == (len(body.encode()) if size == "n_bytes" else len(WORD.findall(body)))
            if not r.n_removed:
                left = body if size == "n_bytes" else " ".join(WORD.findall(body))
                assert r.kept_sha256 == hashlib.sha256(left.encode()).hexdigest()


@pytest.mark.parametrize("operator", [suffix_dedup.find_repeats, substring_dedup.find_repeats])
def test_ids_of_any_type(spark, operator):
    text = " ".join(f"word{k}" for k in range(60))
    df = spark.createDataFrame([("b", text), ("a", text), (None, "x " + text), ("c", "other")], "`doc.id` string, text string")
    got = {r[0]: r for r in operator(df, "doc.id").collect()}
    assert set(got) == {"a", "b", "c", None} and bytes(got["c"].kept) == b"other" and bytes(got["a"].kept) == b""


def test_remove_repeats_with_odd_column_names(spark):
    df = spark.createDataFrame([(1, "a" * 300, 5, 6), (2, "b", 7, 8)], "doc_id long, text string, `a.b` long, rest long")
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns and {tuple(r) for r in out.collect()} == {(1, "", 5, 6), (2, "b", 7, 8)}


def test_rows_of_an_exchange_do_not_outgrow_its_keys():
    """Rows and bytes a key, at a corpus of one and of ten: rows stay below the keys, bytes a key nearly level."""
    rng = np.random.default_rng(1)
    seen = []
    for times in (1, 10):
        keys, multi, _ = exchange.distinct(rng.integers(0, 1 << 63, (20_000, 1), dtype=np.uint64))
        out = exchange.ask(7, keys, multi, 40 * times)
        assert b"".join(out.column("keys").to_pylist()) == keys.tobytes() and out.num_rows <= len(keys)
        seen.append((out.num_rows / len(keys), out.nbytes / len(keys)))
    assert seen[1][0] < 0.05 and seen[1][1] < 1.2 * seen[0][1]


@pytest.mark.parametrize("operator", [suffix_dedup.find_repeats, substring_dedup.find_repeats])
def test_many_tasks_give_the_same(spark, monkeypatch, operator):
    df = table(spark, byte_texts(4))
    want = sorted((r.doc_id, bytes(r.kept)) for r in operator(df).collect())
    monkeypatch.setattr(common, "TASK_BYTES", 3000)
    found = operator(df)
    assert sorted((r.doc_id, bytes(r.kept)) for r in found.collect()) == want
