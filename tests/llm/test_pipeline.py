"""The pipeline's stages on whole small tables, each judged on its own input."""

import json
import re

import duckdb

import corpus_pipeline
from wirelens.llm import decontaminate, neardup, pii, queries


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    spark_docs, sizes = docs, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = spark_docs
        spark_docs = stage(spark, before, sf)
        rows = spark_docs.collect()
        sizes.append(len(rows))
        if i < 4:
            assert spark_docs.columns == columns
            spark_docs = spark.createDataFrame(rows, docs.schema)
        if name == "language_id":
            assert sizes[-1] >= 0.97 * sizes[0]
        if name == "near_dedup":
            want = [r for r in neardup.near_duplicates(before, percent=80).collect() if r["kept"]]
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in want}
        if name == "decontamination":
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            assert decontaminate.find_leaks(spark_docs, bench).count() == 0
        if name == "personal_data":
            assert sizes[-1] == sizes[-2]
            assert not any(pii.base_spans(r["text"] or "") for r in rows)
    assert all(r["taken"] <= 3 * r["size"] for r in rows) and sizes[-1] == sizes[-2]
    assert corpus_pipeline.run(spark, sf).count() == sizes[-1]


def test_oracles(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        want = con.execute(sql).fetchdf()
        got = queries.QUERIES[name](spark, sf).toPandas()[list(want.columns)]
        key = list(want.columns)
        a, b = (json.loads(x.sort_values(key).to_json(orient="records")) for x in (want, got))
        assert a == b, name


def test_queries_cover_every_operator():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES if n != "pipeline"} == set(range(1, 14))
