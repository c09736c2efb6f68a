import pytest
from awkward import documents, rows
from pyspark.sql import functions as F

from goldleaf.llm import exact_dedup as X
from goldleaf.plans.compare import connect, spark_rows, twin_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("capacity", [X.CAPACITY, 7])
def test_equals_sql(spark, capacity):
    got = spark_rows(X.exact_duplicates(spark.read.parquet(f"{SF}/documents.parquet"), capacity))
    assert got == twin_rows(connect(SF), X.SQL)


def test_overfull_buckets_split_and_others_stay(spark):
    """Most hashes share their first bits, so the directory doubles for their bucket alone."""
    hashes = [(k << 50) for k in range(64)] + [-(1 << 62)]
    depth, cells = X.directory(spark.createDataFrame([(h,) for h in hashes], "hash bigint"), 8)
    cells = cells.collect()
    assert depth == 11
    own = {r.cell: (r.depth, r.bucket) for r in cells}
    assert own[0b11 << 9][0] == 1  # the lone hash keeps a shallow bucket
    assert {d for c, (d, _) in own.items() if c < 1 << 9} == {11}


def test_equal_hashes_end_the_doubling(spark, monkeypatch):
    monkeypatch.setattr(X, "MOST_DOUBLINGS", 4)
    depth, cells = X.directory(spark.createDataFrame([(5,)] * 20, "hash bigint"), 8)
    assert depth == 4 and cells.count() == 1


def test_rows_find_their_entries_through_a_doubled_directory(spark):
    """The query's own path: buckets split until they fit, and a changed directory would lose rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    prints = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_sha256"))
    depth, cells, index = X.build_index(docs.fillna({"text": ""}), prints, 7)
    fill = index.groupBy("bucket", "depth").agg(F.countDistinct("hash").alias("n")).collect()
    assert depth > 3 and len(fill) > 8 and max(r.n for r in fill) <= 7 and len({r.depth for r in fill}) > 1
    assert cells.count() <= 2**depth and cells.select("bucket").distinct().count() == len(fill)
    assert index.agg(F.sum("group_size")).first()[0] == docs.count()


def test_copies_in_all_parts_are_one_entry(spark):
    docs = spark.createDataFrame([(k, f"text {k % 3}") for k in range(600)], "doc_id bigint, text string")
    got = X.exact_duplicates(docs, 1).collect()
    assert {(r.doc_id % 3, r.keep_id, r.group_size) for r in got} == {(0, 597, 200), (1, 598, 200), (2, 599, 200)}
    assert sorted(r.doc_id for r in got if r.kept) == [597, 598, 599]


def test_colliding_texts_are_chained(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id bigint, text string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(X.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
        got = {r.doc_id: (r.keep_id, r.group_size) for r in X.exact_duplicates(docs).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


def test_awkward_rows(spark):
    got = X.exact_duplicates(documents(spark)).collect()
    assert len(got) == len(rows())
    kept = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if r.doc_id in (1, 2, 5, 6)}
    assert kept == {(1, 2, 3, False), (2, 2, 3, True), (5, 6, 4, False), (6, 6, 4, True)}
    alone = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id bigint, text string")
    assert [(r.keep_id, r.kept) for r in X.exact_duplicates(alone).collect()] == [(None, True)] * 2
    assert X.exact_duplicates(documents(spark, False)).count() == 0
