"""The pipeline: stage by stage against its operators, on the smallest table and on odd rows."""

import corpus_pipeline
from pagemill.llm import language, quality, simhash
from pagemill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_their_operators_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    first = corpus_pipeline.quality_rules(spark, docs, SF).cache()
    assert {r.doc_id for r in first.collect()} == good and first.columns == docs.columns
    second = corpus_pipeline.language_id(spark, first, SF).cache()
    clear = {r.doc_id for r in language.predict(first, language.learn(first)).where("not ambiguous and lang_pred <> 'und'").collect()}
    assert {r.doc_id for r in second.collect()} == clear
    third = corpus_pipeline.near_duplicates(spark, second, SF).cache()
    assert {r.doc_id for r in third.collect()} == {r.component_id for r in simhash.near_duplicates(second).collect()}
    fourth = corpus_pipeline.secret_scan(spark, third, SF)
    assert fourth.columns == docs.columns and fourth.count() == third.count()
    assert fourth.where("n_chars <> length(text)").count() == 0
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in third.collect()}


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (1, "", "en", "s", 0, 2), (2, "x " * 4000, None, None, 1, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, SF).columns == docs.columns
            stage(spark, table, SF).collect()
        corpus_pipeline.STAGES[-1][1](spark, table, SF).collect()


def test_one_query_for_each_operator():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 11)] == [1] * 10
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5
