"""The registered queries on the given tables, and the pipeline against its operators."""

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from doselens.llm import common, jaccard, language, oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("documents", "labels", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", oracles.oracle_sql())
def test_query_matches_sql(spark, database, name):
    result = queries.queries()[name](spark, SF)
    cursor = database.execute(oracles.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(names)
    expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(row)) for row in result.select(*names).collect()) == expected


def test_chat_windows_match_sql(spark, database):
    """All columns but the lengths of the formatted texts, which are the operator's own."""
    cursor = database.execute(oracles.CHATS)
    names = [column[0] for column in cursor.description]
    result = queries.queries()["op13_chat_windows"](spark, SF)
    assert result.where("formatted_chars <= loss_chars or n_windows < 1").count() == 0
    assert sorted(map(tuple, result.select(*names).collect())) == sorted(cursor.fetchall())


def test_one_query_for_each_operator(spark):
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    rows = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in names:
        if name.split("_")[0] not in ("op9", "op12", "op13"):
            assert queries.queries()[name](spark, SF).count() == rows


def test_native_queries_run_no_python(spark):
    for name in ("op7_mixing", "op10_quality_rules"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages_act_on_what_they_get(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    extra = docs.limit(2).select(
        (F.col("doc_id") + 10**6).alias("doc_id"), F.lit("12 %% 34").alias("text"), "lang", "source", "n_chars"
    )
    kept = stages["language"](spark, docs.unionByName(extra), SF)
    assert kept.columns == names and kept.where("doc_id >= 1000000").count() == 0
    assert kept.count() == docs.count()

    harmless = stages["toxicity"](spark, docs, SF)
    assert harmless.columns == names and 0 < harmless.count() < docs.count()

    one = stages["near copies"](spark, docs, SF)
    found = jaccard.jaccard_components(docs)
    assert one.columns == names
    assert {r.doc_id for r in one.collect()} == {r.component_id for r in found.collect()}
    doubled = stages["near copies"](spark, docs.unionAll(docs), SF)
    assert doubled.count() == one.count()

    mixed = stages["mixing"](spark, docs, SF)
    assert mixed.columns == names
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3

    coded = stages["ids"](spark, docs, SF)
    assert coded.count() == docs.count() and coded.where("not round_trip").count() == 0


def test_pipeline_runs_from_end_to_end(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.round_trip and 4 * r.n_tokens == len(r.ids) for r in rows)
    again = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in again.collect())


def test_recognised_needs_a_language(spark):
    rows = spark.createDataFrame([("en", 0.5), ("en", 0.01), ("und", 0.9)], "lang_pred string, score double")
    assert rows.where(language.recognised()).count() == 1


def test_pipeline_sends_texts_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = [(i, "a word of the text", "en", "s", i % 2) for i in range(1, 2001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, toxic int")
    folder = f"{common.new_folder(spark, 'batches')}"
    docs.select("doc_id", "toxic").write.parquet(f"{folder}/labels.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    stages = dict(corpus_pipeline.STAGES)
    before = spark.conf.get(name)
    try:
        for stage in ("language", "toxicity", "ids"):
            for given, most in (("10000", 600), ("0", 600), ("50", 50)):
                spark.conf.set(name, given)
                stages[stage](spark, docs.drop("toxic"), folder)
                found = docs.coalesce(1).mapInArrow(sizes, "n long").collect()
                assert max(n for (n,) in found) == most
                assert sum(n for (n,) in found) == 2000
    finally:
        spark.conf.set(name, before)
