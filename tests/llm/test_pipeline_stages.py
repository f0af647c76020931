from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from compare import connect, differences
from daygrain.llm import exact_dedup, language_id, mixing, queries, simhash
from daygrain.llm.common import stored
from llm.conftest import smallest_reachable


def test_stages_in_order(edge_docs, spark, data_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mix_sources", "bpe"]
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, data_dir), name)
        assert docs.columns == edge_docs.columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir)
    assert last.count() == docs.count()


def test_run_matches_the_stages_done_plainly(spark, data_dir, documents):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    kept = {r["id"] for r in language_id.predicted(documents).collect() if r["lang_pred"] != "und" and r["score"] >= language_id.MIN_SCORE}
    by_text = {}
    for id in sorted(kept):
        by_text[re.sub("[A-Z]", lambda m: m[0].lower(), rows[id])] = id
    kept = sorted(by_text.values())
    fps = [simhash.fingerprint(rows[i]) for i in kept]
    near = [(i, j) for i in range(len(kept)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    kept = {i for i, c in zip(kept, smallest_reachable(kept, near)) if i == c}
    mixed = mixing.mixed_documents(documents.filter(documents.doc_id.isin(sorted(kept)))).collect()
    truth = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed)
    got = Counter((r["doc_id"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, data_dir).collect())
    assert got == truth and set(i for i, _ in got) <= kept


def test_empty_corpus(no_docs, spark, data_dir):
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, data_dir), name)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_sql(name, spark, data_dir):
    assert differences(queries.QUERIES[name](spark, data_dir), connect(data_dir), queries.ORACLE[name]) == []


OF_DOCUMENTS = ["op1_mix_sources", "op3_substring_dedup", "op7_simhash", "op9_sharding"]


@pytest.fixture(scope="module")
def edge_dir(edge_docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("edges")
    pq.write_table(edge_docs.toArrow(), folder / "documents.parquet")
    return str(folder)


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_queries_match_sql_on_edge_rows(name, spark, edge_dir):
    assert differences(queries.QUERIES[name](spark, edge_dir), connect(edge_dir), queries.ORACLE[name]) == []


def test_native_operators_run_no_python(spark, data_dir, documents):
    for df in (mixing.words_taken(documents), mixing.mixed_documents(documents), exact_dedup.label_duplicates(documents),
               exact_dedup.drop_duplicates(documents)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
