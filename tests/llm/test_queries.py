"""The registered queries and the pipeline run on the given tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from footfall.llm import decontamination, minhash_dedup, privacy, quality_gbt
from footfall.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_rows(spark, name):
    result = QUERIES[name](spark, SF)
    assert result.count() > 0
    assert set(ORACLES) <= set(QUERIES)


def test_pipeline(spark):
    assert {"pipeline", *QUERIES} <= set(entry.queries())
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < len(rows) < docs.count()
    assert len({r.doc_id for r in rows}) == len(rows)


def test_stages_take_odd_rows(spark, docs, no_docs):
    for start in (docs, no_docs):
        frame = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SF)
            assert frame.columns == start.columns
        last = corpus_pipeline.STAGES[-1][1](spark, frame, SF)
        assert last.count() == frame.count()


def test_stages_do_what_their_operators_find(spark):
    docs, labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    quality, near, benchmarks, personal, pieces = (stage for _, stage in corpus_pipeline.STAGES)

    def ids(frame, condition="true"):
        return sorted(r.doc_id for r in frame.where(condition).select("doc_id").collect())

    good = quality(spark, docs, SF).cache()
    assert ids(good) == ids(quality_gbt.quality_scores(docs, labels), "predicted = 1")
    distinct = near(spark, good, SF).cache()
    assert ids(distinct) == ids(minhash_dedup.components(good, width=5, percent=80), "kept")
    clean = benchmarks(spark, distinct, SF).cache()
    found = set(ids(decontamination.overlaps(distinct, benchmark)))
    assert found and ids(clean) == [i for i in ids(distinct) if i not in found]
    private = personal(spark, clean, SF).cache()
    counts = privacy.report(private).selectExpr("sum(n_email + n_ip + n_card + n_phone) n").first().n
    before = privacy.report(clean).selectExpr("sum(n_email + n_ip + n_card + n_phone) n").first().n
    assert ids(private) == ids(clean) and before > 0 and counts == 0
    whole = {r.doc_id: r.text or "" for r in private.collect()}
    assert {r.doc_id: r.decoded for r in pieces(spark, private, SF).collect()} == whole
