import pytest
from awkward import documents, rows
from pyspark.sql import functions as F

from goldleaf.llm import line_dedup as L
from goldleaf.plans.compare import connect, spark_rows, twin_rows

SF = "/root/testdata/sf0.001"


def digest(df):
    return df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def test_equals_sql(spark):
    got = spark_rows(digest(L.drop_shared_lines(spark.read.parquet(f"{SF}/documents.parquet"))))
    assert got == twin_rows(connect(SF), L.SQL)
    assert sum(float(r[got[0].index("n_dropped")]) for r in got[1]) > 50


def texts(spark, data, **more):
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in L.drop_shared_lines(df, **more).collect()}


LINE = "a line of twenty chars"


def test_the_largest_document_keeps_all_its_copies(spark):
    got = texts(spark, [(1, f"x\n{LINE}\ny"), (2, f"\t{LINE.upper()} \r\n{LINE}"), (3, f"{LINE}\nz\n{LINE}\n")])
    assert got == {1: ("x\ny", 3, 1), 2: ("", 2, 2), 3: (f"{LINE}\nz\n{LINE}\n", 4, 0)}


def test_a_document_counts_once(spark):
    got = texts(spark, [(1, f"{LINE}\n{LINE}\n{LINE}"), (2, LINE), (2, f"{LINE}\nq")])
    assert {r[2] for r in got.values()} == {0}


@pytest.mark.parametrize("key,dropped", [("x" * 19, 0), ("x" * 20, 1), ("É" * 20, 1), ("é" * 10 + "É" * 9, 0)])
def test_length_is_in_code_points(spark, key, dropped):
    got = texts(spark, [(i, f"  {key}\x0b") for i in range(3)])
    assert [got[i][2] for i in range(3)] == [dropped, dropped, 0]


def test_only_ascii_letters_are_folded(spark):
    got = texts(spark, [(1, "É" * 30), (2, "é" * 30), (3, "É" * 29 + "E"), (4, "É" * 29 + "e"), (5, "É" * 29 + "E")])
    assert [got[i][2] for i in range(1, 6)] == [0, 0, 1, 1, 0]


def test_awkward_rows(spark):
    docs = documents(spark)
    got = L.drop_shared_lines(docs).collect()
    assert len(got) == len(rows())
    assert set(docs.columns) < set(got[0].asDict())
    left = sorted((r.doc_id or 0, r.n_dropped, r.text) for r in got)
    one = rows()[4][1]
    # document 5 stands twice and one copy has no doc_id: three documents, the largest is 6
    assert [r for r in left if r[0] in (5, 6)] == [(5, 1, ""), (5, 1, ""), (6, 0, one)]
    assert [r[1] for r in left if r[0] == 0 and r[2] == ""] == [0, 1]
    assert {r.text for r in got if r.doc_id == 12} == {"a\n" * 300}
    assert L.drop_shared_lines(documents(spark, False)).count() == 0


def test_a_line_in_a_third_of_all_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit(LINE + "\n"), F.col("id").cast("string"))).otherwise("own " * 8).alias("text"),
    )
    got = L.drop_shared_lines(docs.repartition(8))
    assert got.agg(F.sum("n_dropped")).first()[0] == 999 + 1999
    assert got.where("text = '' OR text RLIKE '^[0-9]+$'").count() == 999 + 1999
