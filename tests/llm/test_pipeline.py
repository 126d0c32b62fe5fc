import base64

import corpus_pipeline
from tarifa.llm import exact_dedup, mixing, quality, simhash
from tarifa.llm.queries import tokenizer_path


def test_stages_keep_the_columns_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir).cache()
        assert after.columns == columns and after.schema == docs.schema, name
        if stage is corpus_pipeline.good:
            model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            want = quality.scored(docs, model, keep=["doc_id"]).where("score >= 0.3").select("row.doc_id")
        elif stage is corpus_pipeline.distinct:
            want = exact_dedup.decisions(docs).where("kept").select("doc_id")
        elif stage is corpus_pipeline.apart:
            want = simhash.near_duplicates(docs).where("kept").select("doc_id")
        else:
            taken = {r.doc_id: r for r in mixing.taken(docs).collect()}
            counts = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
            assert all(counts.get(i, 0) * r.size == r.taken for i, r in taken.items())
            want = after.select("doc_id")
        assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in want.collect()), name
        docs = after


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    tokens = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(tokenizer_path(), "rb"))}
    assert rows
    for r in rows:
        assert b"".join(tokens[i] for i in r.ids).decode() == texts[r.doc_id] and r.n_tokens == len(r.ids)


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
