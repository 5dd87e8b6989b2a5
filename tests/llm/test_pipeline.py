"""The pipeline: columns of every stage, and the packed pieces against the mixed documents."""

from pathlib import Path

import corpus_pipeline
from loglark.llm.packing import encode
from loglark.session import shared_folder

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.Stage(stage(spark, docs, DATA), f"test-{name}").df
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    want = sum(len(encode(r.text)) for r in docs.collect())
    assert sum(p.length for p in pieces) == want


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_odd_rows_and_an_empty_table_through_all_stages(spark, odd, empty):
    """Nulls, empty and long texts, repeated rows and columns with names that stages use inside."""
    for rows in (odd, empty.selectExpr("*", "'x' as part", "'x' as _key")):
        docs, columns = rows, rows.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.Stage(stage(spark, docs, DATA), f"odd-{name}").df
            assert docs.columns == columns
        kept = docs.collect()
        assert all(r[columns[-1]] == "x" and any(c.isalpha() for c in r.text) for r in kept)
        lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
        assert len({r.text.encode().translate(lower) for r in kept}) == len({(r.doc_id, r.text) for r in kept})
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
        assert sum(p.length for p in pieces) == sum(len(encode(r.text)) for r in kept)


def test_stage_outputs_go_when_the_next_is_written(spark):
    shared = Path(shared_folder(spark))
    before = set(shared.iterdir())
    assert corpus_pipeline.run(spark, DATA).count() > 0
    left = set(shared.iterdir()) - before
    assert [p.name.split("-")[1] for p in left if p.name.startswith("pipeline-")] == ["packing"]
