"""The pipeline's stages on a small corpus, each against what its operator decides."""

import corpus_pipeline
from pyspark.sql import functions as F
from test_operators import DOCUMENTS, LABELS, brute_components, brute_removal, clashing, corpus


def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], sf_dir).write.parquet(f"{sf_dir}/out-{name}")
        out.append(spark.read.parquet(f"{sf_dir}/out-{name}"))
    return out


def test_stages(spark, tmp_path):
    rows = corpus()
    clashing(spark.createDataFrame(rows, DOCUMENTS)).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 7 > 0), 0) for k in range(60)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs, quality, language, single, thinned, packed = stages(spark, str(tmp_path))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "repeated_passages", "packing"]
    for step in (quality, language, single, thinned):
        assert step.columns == docs.columns
    assert docs.count() >= quality.count() >= language.count() > single.count() == thinned.count() > 0
    before = [tuple(r)[:5] for r in language.collect()]
    assert sorted(r["doc_id"] for r in single.where("doc_id is not null").collect()) == sorted({d for d, _, c in brute_components(before) if d is not None and d == c})
    kept = [tuple(r)[:5] for r in single.collect()]
    removed = {r[0]: r[2] for r in brute_removal(kept)}
    after = {r["doc_id"]: r["text"] for r in thinned.collect()}
    for r in kept:
        left = len(r[1].encode()) - removed[r[0]]
        assert left - 6 <= len(after[r[0]].encode()) <= left  # a cut character may lose its other bytes
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in kept}
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_on_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
