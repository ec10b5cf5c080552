import zlib
from collections import defaultdict

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from nassaj.llm import bpe, jaccard
from nassaj.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_stages_keep_columns_and_rows(spark, docs):
    rows = docs.withColumn("measure", F.lit(1)).withColumn("verdict", F.lit(2))
    odd = spark.createDataFrame(
        [(90001, None, None, None, None), (90002, "", "en", "s", 0), (90003, "123 ...", "en", None, 7)], "doc_id long, text string, lang string, source string, n_chars long"
    ).selectExpr("*", "1 AS measure", "2 AS verdict")
    rows = rows.unionByName(odd.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema]))
    for name, function in cp.STAGES[:-1]:
        out = function(spark, rows, SMALL)
        assert out.columns == rows.columns, name
        kept = out.count()
        assert 0 < kept <= rows.count()
        if name in ("language", "quality"):
            assert kept >= 0.8 * docs.count()
        rows = cp.stage(out, "test-stage")
    assert {r[0] for r in rows.select("doc_id").collect()}.isdisjoint({90001, 90002, 90003})


def test_one_of_each_group_stays(spark, docs):
    some = docs.where("doc_id < 60")
    doubled = some.unionByName(some.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(some.where("doc_id = 3"))
    kept = sorted(r[0] for r in cp.one_of_each(spark, doubled, SMALL).select("doc_id").collect())
    classes = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(some).collect()}
    assert kept == sorted(k for k, c in classes.items() if k == c)


def test_one_of_each_goes_by_row(spark, docs):
    prose = [f"w{i} " for i in range(60)]
    near = "".join(prose)
    rows = [
        (5, near, "a"), (None, near, "a"), (7, near + "end", "b"), (5, "another text under the same number", "c"),
        (None, near + "last", "d"), (None, "one without a number, twice there", "e"), (None, "one without a number, twice there", "e"),
        (9, "", "f"), (9, "", "f"), (None, None, "g"), (11, "quite alone here, as it should be", "h"), (12, "One Without a number, twice there", "i"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS row", "2 AS stays", "3 AS hash", "4 AS open")
    kept = cp.one_of_each(spark, df.repartition(3), SMALL)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), r["source"]) for r in kept.collect()) == sorted([
        ("5", "a"), ("5", "c"), ("12", "i"), ("9", "f"), ("9", "f"), ("None", "g"), ("11", "h"),
    ])
    nameless = spark.createDataFrame([(None, near, "a"), (None, near, "b"), (None, near, "a")], "doc_id long, text string, source string")
    assert cp.one_of_each(spark, nameless, SMALL).count() == 1


def test_pieces_are_those_of_the_kept_documents(spark, docs):
    out = cp.run(spark, SMALL).collect()
    enc = bpe.encoder(bpe.vocabulary_file())
    rows = docs
    for _, function in cp.STAGES[:-1]:
        rows = cp.stage(function(spark, rows, SMALL), "test-run")
    want = {r["doc_id"]: [*enc.whole(r["text"]).tolist(), 1] for r in rows.collect()}
    got = defaultdict(dict)
    for r in out:
        got[r["doc_id"]][r["start"]] = r
    assert set(got) == set(want)
    for k, parts in got.items():
        at = 0
        for start in sorted(parts):
            assert start == at
            r = parts[start]
            data = b"".join(i.to_bytes(4, "little") for i in want[k][start : start + r["length"]])
            assert zlib.crc32(data) == r["ids_crc32"]
            at += r["length"]
        assert at == len(want[k])


def test_empty_documents(spark, docs):
    rows = docs.limit(0)
    for _, function in cp.STAGES:
        out = function(spark, rows, SMALL)
        assert out.count() == 0
        rows = rows if function is cp.packed else cp.stage(out, "test-empty")


@pytest.mark.parametrize("name", sorted(
    set(QUERIES) - {"pipeline", "op1_vector_search", "op4_jaccard_join", "op11_ranked_search", "op13_whitening"}
))
def test_queries_give_a_row_per_input_row(spark, name):
    table = "pages" if name.startswith("op8") else "documents"
    found = QUERIES[name](spark, SMALL)
    key = "page_id" if table == "pages" else "doc_id"
    ids = [r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()]
    assert sorted({r[0] for r in found.select(key).collect()}) == sorted(ids)
    if name != "op10_packing":
        assert found.count() == len(ids)
