"""The corpus pipeline against plain Python, and the registered queries."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from rowmill.llm import decontamination, quality_classifier, quality_rules

from helpers import SF, documents, odd_texts, save
from test_decontamination import plain_matches
from test_near_dedup import plain_components, plain_fingerprint


def expected(spark, folder):
    """doc_id to text of the documents that should reach the last stage."""
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    score = {r.doc_id: r.score for r in quality_classifier.score(docs, quality_classifier.train(docs, labels)).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect() if score[r.doc_id] >= 0.7)
    rows = [(i, t) for i, t in rows if quality_rules.passes(quality_rules.Text(t), list(quality_rules.RULES))]
    first = {}
    for root, row in zip(plain_components([plain_fingerprint(t) for _, t in rows]), rows):
        first.setdefault(root, row)
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    shingles = [set(decontamination.shingles(decontamination.words_of(x))) for x in items]
    kept = {}
    for i, t in first.values():
        own = set(decontamination.shingles(decontamination.words_of(t)))
        if not any(own & s and plain_matches(t, x) for s, x in zip(shingles, items)):
            kept[i] = t
    return kept


def test_pipeline_matches_plain_python(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = expected(spark, SF)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == want.keys() and len(got) > 50
    for i, t in want.items():
        ids = np.array(library.encode_ordinary(t), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    texts = odd_texts() * 2
    docs = documents(spark, texts, [*range(len(texts) - 2), 3, None]).selectExpr("*", "1 as score", "array(2) as fp", "'x' as kept", "4 as _row")
    save(spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), tmp_path, "labels")
    save(spark.createDataFrame([(1, "ab cd ef gh ij kl")], "item_id bigint, text string"), tmp_path, "benchmark")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() <= len(texts), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(texts)


def test_all_queries_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert names["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5
    assert set(entry.oracle_sql()) <= set(names)
