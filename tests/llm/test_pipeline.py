"""The pipeline against a plain version of its five stages."""

import brute as B
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from framewise.llm import pieces


def test_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())
    assert len(corpus_pipeline.STAGES) == 5


def plain(rows, items):
    kept = {i for i, _, k in B.rule_verdicts(rows) if k}
    docs = [(i, t) for i, _, t in rows if i in kept]
    keys = {(i, d): n for i, _, n, d in B.line_dedup(docs)}
    held = {}
    for i, t in docs:
        for k in {B.lower(x.strip(B.SPACE)) for x in (t or "").split("\n")}:
            held[k] = held.get(k, 0) + 1
    out = []
    for i, t in docs:
        left = "\n".join(x for x in (t or "").split("\n")
                         if not ((k := B.lower(x.strip(B.SPACE))) and held[k] >= 10))
        if left == (t or "") or left.strip(B.SPACE):
            out.append((i, left))
    assert keys
    out = [(i, t) for (i, t), (_, _, _, k) in zip(out, B.near_duplicates(out, 80)) if k]
    out = [(i, t) for (i, t), (*_, bad) in zip(out, B.contamination(out, items)) if not bad]
    return B.without_spans(out, items, 12)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_run_equals_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = plain([(r.doc_id, r.source, r.text) for r in docs], items)
    raw = open(pieces.MODEL, "rb").read()
    got = {r.doc_id: r.input_ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == dict(zip((i for i, _ in want), pieces.encode_texts(raw, [t for _, t in want])))
    assert 0 < len(got) < len(docs)


def test_stages_on_odd_rows(spark, edge, empty, sf_small):
    for frame in (edge, empty):
        docs = frame.selectExpr("doc_id", "text", "'en' lang", "source", "cast(length(text) as long) n_chars")
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_small)
            assert out.count() <= docs.count()
            if k < 4:
                assert out.columns == columns
                if k:  # the rules alone leave little of the odd rows
                    docs = out
