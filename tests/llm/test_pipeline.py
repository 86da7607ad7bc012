"""The pipeline's stages on a small corpus with a planted case of each kind."""

import corpus_pipeline
from tollgate.llm import decontam, minhash, quality
from tollgate.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).checkpoint()
        sizes.append(docs.count())
        if name != "vector_packing":
            assert docs.columns == columns
        if name == "quality_rules":
            assert sizes[-1] == quality.quality_rules(before).filter("kept").count()
        if name == "minhash_near_dedup":
            assert sizes[-1] == before.count() - minhash.near_duplicates(before).filter("not kept").count()
        if name == "benchmark_decontamination":
            bad = {r[0] for r in decontam.contamination(before, table(spark, SF, "benchmark")).select("doc_id").collect()}
            assert sizes[-1] == sizes[-2] - len(bad)
        if name == "vector_packing":
            assert {r[0] for r in docs.select("doc_id").distinct().collect()} == {r[0] for r in before.select("doc_id").collect()}
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] < sizes[5]


def test_run_and_empty(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_nulls_and_repeats(spark):
    text = " ".join(f"word{i} and" for i in range(40))
    rows = [(1, text, None, None, None), (1, text, None, None, None), (None, text, "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert sorted((r[0] for r in docs.collect()), key=str) == [1, None]
