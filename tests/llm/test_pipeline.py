"""Each stage of the pipeline on its own input, against brute force."""

import corpus_pipeline
from conftest import SF_SMALL
from quarry.llm.common import Scratch
from quarry.llm.flow_mix import mix_sources
from quarry.llm.suffix_decon import find_contamination
from quarry.llm.zstd_quality import score_quality, train
from test_dedup import brute_near


def test_stages(spark):
    scratch = Scratch(spark, "test-pipeline")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.keep(stage(spark, given, SF_SMALL), name)
        if name == "quality":
            want = ids(score_quality(given, train(given, labels)).filter("predicted = 1"))
        elif name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
            want = sorted({c for _, _, c in brute_near(rows, 5, 80)[0]})
        elif name == "decontamination":
            want = ids(find_contamination(given, bench).filter("n_hit = 0"))
        elif name == "mixing":
            want = sorted(i for r in mix_sources(given).collect() for i in [r.doc_id] * r.copies)
        else:
            want = ids(given)
        assert ids(out) == want, name
        if name != "sharding":
            assert out.columns == docs.columns
        given = out
    load = [r["b"] for r in given.groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "b").collect()]
    largest = given.agg({"size": "max"}).first()[0]  # here nearly as large as an even share
    assert len(load) == 24 and max(load) <= sum(load) / 24 + largest / 2


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
