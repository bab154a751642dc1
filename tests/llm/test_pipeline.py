"""The corpus pipeline stage by stage on the smallest tables, and the queries with SQL twins."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fathom.llm import jaccard, lines, mixing, quality
from fathom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append((name, docs, out))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        docs = out
    before, after = {n: b for n, b, _ in seen}, {n: a for n, _, a in seen}
    good = {r["doc_id"] for r in quality.quality(before["quality_rules"]).collect() if r["kept"]}
    assert {r["doc_id"] for r in after["quality_rules"].collect()} == good
    assert after["line_dedup"].count() == before["line_dedup"].count()
    assert lines.dedup_lines(after["line_dedup"]).agg(F.sum("n_lines_dropped")).first()[0] == 0
    groups = jaccard.similar_documents(before["ngram_jaccard"], 5, "0.8").where("doc_id = component_id").count()
    assert after["ngram_jaccard"].count() == groups
    taken = mixing.mix(before["mixing"]).agg(F.sum("taken")).first()[0]
    assert after["mixing"].agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken
    assert after["sentencepiece"].count() == before["sentencepiece"].count()
    assert after["sentencepiece"].where("n_tokens > 0").count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = c.execute(ORACLE_SQL[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    rows = lambda found: sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in found)
    assert rows([[r[k] for k in columns] for r in df.collect()]) == rows([[r[names.index(k)] for k in columns] for r in cursor.fetchall()])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_reruns_agree(spark, name):
    once = sorted(map(str, QUERIES[name](spark, SF).collect()))
    assert once and once == sorted(map(str, QUERIES[name](spark, SF).collect()))
