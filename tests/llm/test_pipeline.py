import corpus_pipeline
from meteomart.llm import lsh_forest, pii, quality_qda, raking

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.cut(stage(spark, docs, SF))
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            model = quality_qda.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            good = {r["doc_id"] for r in quality_qda.score(before, model).where("predicted = 1").collect()}
            assert {r["doc_id"] for r in docs.collect()} == good
        if name == "near_duplicates":
            found = lsh_forest.classes(before).collect()
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted({r["class_id"] for r in found})
        if name == "personal_data":
            want = {r["doc_id"]: pii.masked(r["text"]) for r in before.collect()}
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
            assert all(not pii.spans(r["text"]) for r in docs.collect())
        if name == "mixing":
            want = {r["doc_id"] for r in raking.decide(before).where("keep").collect()}
            assert {r["doc_id"] for r in docs.collect()} == want
        if name == "packing":
            tokens = sum(len(r["text"].encode().split()) + 1 for r in before.collect())
            assert docs.groupBy().sum("n_tokens").first()[0] == tokens
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, kept["packing"].collect()))
