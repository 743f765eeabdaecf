import corpus_pipeline
from arealis.llm.common import documents, land
from tests.llm.helpers import ODD, SCHEMA, lower, near_components, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, kept = documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = land(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        rows, before = {r.doc_id: r for r in out.collect()}, {r.doc_id: r for r in docs.collect()}
        assert rows.keys() <= before.keys() and all(rows[k] == before[k] for k in rows)
        if name == "exact":
            best = {}
            for k, r in before.items():
                best[lower(r.text)] = max(k, best.get(lower(r.text), k))
            assert rows.keys() == set(best.values())
        if name == "near":
            assert rows.keys() == set(near_components({k: r.text for k, r in before.items()}).values())
        kept.append(len(rows))
        docs = out
    assert kept == sorted(kept, reverse=True) and kept[-1] > 10
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_run_matches_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def labels(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_on_odd_rows_with_clashing_columns(spark, tmp_path):
    sf = labels(spark, tmp_path, [(i, i % 2, 0) for i in range(1, 14)])
    docs = table(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        rows = [tuple(r) for r in out.collect()]
        assert len(rows) <= len(ODD) and set(rows) <= {tuple(r) for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in ODD}


def test_stages_on_an_empty_table(spark, tmp_path):
    sf = labels(spark, tmp_path, [])
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
