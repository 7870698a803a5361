"""Registered queries against their SQL; native ones run no Python; the pipeline stage by stage."""

from __future__ import annotations

import brute
import pytest
from oracle import connect, rows_of_duckdb, rows_of_spark

import __spark_entry__ as entries
import corpus_pipeline
from linkloom.llm import catalog
from linkloom.llm.sentencepiece_codec import read_model

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    assert rows_of_spark(catalog.QUERIES[name](spark, DATA)) == rows_of_duckdb(connect(DATA), catalog.ORACLES[name])


@pytest.mark.parametrize("number", [2, 6, 7, 8])
def test_native_queries_run_no_python(spark, plan, number):
    name = next(n for n in catalog.QUERIES if n.startswith(f"op{number}_"))
    text = plan(catalog.QUERIES[name](spark, DATA))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert {*catalog.QUERIES, "pipeline"} <= set(entries.queries())


def test_pipeline(spark, tmp_path):
    import sentencepiece

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append([(r.doc_id, r.text, r.source) for r in docs.collect()])
        if k < 4:
            assert docs.columns == columns
    quality, lines, near, mixed, _ = seen
    for doc, text, _ in quality:
        counts = brute.rule_counts(text)
        assert counts[0] >= 50 and 100 * counts[4] <= 50 * counts[0], doc
    deduped = brute.line_dedup([(d, t) for d, t, _ in quality])
    assert {d: t for d, t, _ in lines} == {d: x[2] for d, x in deduped.items()}
    components = brute.jaccard_components([(d, t) for d, t, _ in lines])
    assert {d for d, _, _ in near} == {c if n else d for (d, _, _), (n, c) in zip(lines, components, strict=True)}
    assert {d for d, _, _ in mixed} <= {d for d, _, _ in near}
    library = sentencepiece.SentencePieceProcessor(model_proto=read_model())
    for r in docs.collect():
        assert list(r.token_ids) == library.encode(r.text) and r.n_tokens == len(r.token_ids)


def test_pipeline_computes_every_stage_once(spark, tmp_path, monkeypatch):
    rows = spark.sparkContext.accumulator(0)

    def counted(spark, docs, sf_dir):
        def passing(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                yield batch

        # A stage that reads what it gets twice.
        return docs.mapInArrow(passing, docs.schema).join(docs.select("doc_id"), "doc_id")

    spark.range(50).withColumnRenamed("id", "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", counted), ("second", counted), ("third", counted)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 50
    assert rows.value == 3 * 50


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_of_hostile_rows_and_of_none(spark, hostile, tmp_path, empty):
    docs = hostile.where("false") if empty else hostile
    docs = docs.drop("token_ids")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(14, 1, 0), (15, 0, 0), (None, 1, None), (14, None, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    result = corpus_pipeline.run(spark, str(tmp_path))
    rows = result.collect()
    assert result.columns == [*docs.columns, "token_ids", "n_tokens"]
    assert all(len(r.token_ids) == r.n_tokens > 0 and r.text for r in rows)
    # Two long copies, and two texts near to one another: one of each stays, however often the mix takes it.
    stay = {r.doc_id for r in rows}
    assert (stay == set()) == empty and not {14, 15} <= stay and not {1, 8} <= stay
    assert stay.isdisjoint({3, 4, 5, 6, 7, 13})
