"""Each stage of the pipeline on what its predecessor kept, against plain Python."""

import re

import numpy as np
import pytest

import corpus_pipeline
from strandflow.llm import language_id
from tests.llm.test_dedup import covered, naive_components, naive_fingerprint
from tests.llm.test_text_operators import naive_matches


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The rows before and after each stage."""
    out, docs = [], spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = tmp_path_factory.mktemp("stages")
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, sf_dir).write.parquet(str(folder / f"{k}-{name}"))
        after = spark.read.parquet(str(folder / f"{k}-{name}"))
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_names_and_columns(stages, spark, sf_dir):
    assert list(stages) == [name for name, _ in corpus_pipeline.STAGES]
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(a.columns == columns for name, (_, a) in list(stages.items())[:-1])
    assert set(columns) < set(stages["source_mix"][1].columns)


def test_language_id_keeps_clean_documents(stages):
    before, after = map(rows, stages["language_id"])
    gone = set(before) - set(after)
    assert all(after[d] == before[d] for d in after) and len(gone) <= 0.02 * len(before)
    model = language_id.fit(stages["language_id"][0])
    for d in gone:
        text = before[d]["text"]
        assert not re.search(r"[^\W\d_]", text) or language_id.classify(model, [text.encode()])[0].max() < language_id.LEAST_SCORE


def test_near_dedup_keeps_one_of_each_component(stages):
    before, after = map(rows, stages["simhash_dedup"])
    ids = sorted(before)
    parts = naive_components([naive_fingerprint(before[d]["text"]) for d in ids])
    assert sorted(after) == sorted({ids[p] for p in parts}) and all(after[d] == before[d] for d in after)


def test_suffix_dedup_cuts_repeats(stages):
    from collections import Counter

    before, after = map(rows, stages["suffix_dedup"])
    bodies = {d: r["text"].encode() for d, r in before.items()}
    count = Counter(b[i : i + 200] for b in bodies.values() for i in range(len(b) - 199))
    for d, b in bodies.items():
        left = bytes(np.frombuffer(b, np.uint8)[~covered(b, 200, count)]).decode("utf-8", "ignore")
        assert (after[d]["text"], after[d]["n_chars"]) == (left, len(left))


def test_decontamination_drops_what_matches(stages, spark, sf_dir):
    before, after = map(rows, stages["decontaminate"])
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    hit = {d for d, _ in naive_matches({d: r["text"] for d, r in before.items()}, items)}
    assert set(after) == set(before) - hit


def test_mix_gives_copies_of_what_is_left(stages):
    before, after = stages["source_mix"]
    before = rows(before)
    got = after.collect()
    assert all({k: r[k] for k in before[r.doc_id]} == before[r.doc_id] for r in got)
    assert len({(r.doc_id, r.copy) for r in got}) == len(got) and 0.6 < len(got) / len(before) < 1.6


def test_run_equals_the_stages(stages, spark, sf_dir):
    want = sorted((r.doc_id, r.copy, r.text) for r in stages["source_mix"][1].collect())
    assert sorted((r.doc_id, r.copy, r.text) for r in corpus_pipeline.run(spark, sf_dir).collect()) == want
    assert corpus_pipeline.ORACLE_SQL is None
