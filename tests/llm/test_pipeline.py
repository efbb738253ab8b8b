"""The stages against brute force, each on its own input."""

import numpy as np
import pytest

import corpus_pipeline as cp
from stripeline.llm import mixing, toxicity
from stripeline.llm.common import stage, table

from .test_decontaminate import plain as contaminated
from .test_simhash import expected as classes
from .test_tokenstore import expected as stored


@pytest.fixture(scope="module")
def run(spark, sf):
    docs = [table(spark, sf, "documents")]
    for name, f in cp.STAGES[:-1]:
        docs.append(stage(f(spark, docs[-1], sf), name))
    return docs, cp.STAGES[-1][1](spark, docs[-1], sf)


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(run):
    docs, _ = run
    assert all(d.columns == docs[0].columns for d in docs)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_ids"]


def test_toxicity(run, spark, sf):
    docs, _ = run
    bad = {r.doc_id for r in toxicity.toxicity(docs[0], table(spark, sf, "labels")).where("score >= 0.3").collect()}
    assert sorted(rows(docs[1])) == sorted(r for r in rows(docs[0]) if r[0] not in bad)


def test_near_duplicates(run):
    docs, _ = run
    keep = {c for _, _, c in classes(rows(docs[1]))}
    assert sorted(rows(docs[2])) == sorted(r for r in rows(docs[1]) if r[0] in keep)


def test_benchmark(run, spark, sf):
    docs, _ = run
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    clean = {r[0] for r in contaminated(rows(docs[2]), items) if not r[-1]}
    assert sorted(rows(docs[3])) == sorted(r for r in rows(docs[2]) if r[0] in clean)


def test_mixture(run):
    docs, _ = run
    got = rows(docs[4])
    assert len(got) == len(set(got)) and set(got) <= set(rows(docs[3]))
    n = lambda rs: sum(len((t or "").split()) for _, t in rs)
    assert 0.4 * n(rows(docs[3])) < n(got) <= mixing.Mix().share * n(rows(docs[3]))  # each of the many small leaves stays under its budget by less than a document


def test_token_ids(run):
    from tokenizers import Tokenizer

    from stripeline.llm.tokenstore import default_tokenizer

    docs, out = run
    want = [r[:4] for r in stored(rows(docs[4]), Tokenizer.from_file(default_tokenizer()))]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want


def test_run(run, spark, sf):
    assert sorted(map(tuple, cp.run(spark, sf).collect())) == sorted(map(tuple, run[1].collect()))
    assert np.unique([r.doc_id for r in run[1].collect()]).size == run[1].count()
