"""The queries of files and jobs against their SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from nassaj.sources import readers
from nassaj.workload import files, files_oracle, views
from tests.conftest import plan_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(files.QUERIES) == set(files_oracle.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(files.QUERIES))
def test_query_equals_its_sql(spark, tables, tmp_path, monkeypatch, name):
    monkeypatch.setattr(files, "named_folder", lambda spark: str(tmp_path))
    df = files.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    found = tables.execute(files_oracle.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    wanted = [dict(zip(names, row, strict=True)) for row in found.fetchall()]
    got = [r.asDict() for r in df.collect()]
    assert sorted(str([r[c] for c in columns]) for r in got) == sorted(str([r[c] for c in columns]) for r in wanted)


def test_a_cluster_names_its_folder(spark, monkeypatch):
    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"

    monkeypatch.setattr(files, "named_folder", lambda spark: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.work_folder(Elsewhere)


def test_numbering_rows_leaves_them_where_they_are(spark, tmp_path):
    spark.range(40).selectExpr("id AS v").repartitionByRange(3, "v").write.json(str(tmp_path / "rows"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = readers.with_row_id(spark.read.schema("v bigint").json(str(tmp_path / "rows")))
        assert "BroadcastHashJoin" in plan_of(numbered) and "SortMergeJoin" not in plan_of(numbered)
        assert sorted(tuple(r) for r in numbered.collect()) == [(i, i) for i in range(40)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_are_put_in_order_before_they_are_tagged(spark, tmp_path):
    rows = [(2, "One two 3"), (1, "Aa Bb"), (None, "x"), (3, None), (2, "y")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang").write.parquet(str(tmp_path / "documents.parquet"))
    tagged = views.tagged(spark, str(tmp_path), ordered=True)
    plan = plan_of(tagged)
    assert plan.index("split(") < plan.index("Exchange rangepartitioning")  # top down: what is made comes after the exchange
    assert [r["id"] for r in tagged.collect()] == [None, 1, 2, 2, 3]
    assert sorted(map(str, tagged.collect())) == sorted(map(str, views.tagged(spark, str(tmp_path)).collect()))
