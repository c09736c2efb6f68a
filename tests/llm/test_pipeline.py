import hashlib

import corpus_pipeline
from awkward import documents, prose
from pyspark.sql import functions as F

from goldleaf.llm.queries import ORACLES, QUERIES
from goldleaf.sources.tables import materialize

SF = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, kept, SF), name)
        assert kept.dtypes == docs.dtypes
        sizes.append(kept.count())
    assert docs.count() > sizes[0] > sizes[1] >= sizes[2] == sizes[3] > 0
    texts = [r.text for r in kept.collect()]
    assert len({hashlib.sha256(t.encode()).digest() for t in texts if t}) == sum(bool(t) for t in texts)
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_stages_take_awkward_rows(spark):
    kept = documents(spark)
    names = kept.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, kept, SF), name)
        assert kept.columns == names
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF).count() >= kept.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, False), SF).count() == 0


def test_one_whole_copy_is_left(spark):
    one, other, near = prose(1), prose(2), prose(2).replace(" ", " x ", 1)
    data = [
        (7, one), (7, one), (7, one), (None, one), (None, one),
        (None, prose(3)), (None, prose(3)),
        (8, other), (None, near), (8, near.replace(" ", " y ", 1)),
        (9, None), (9, ""),
    ]
    kept = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    kept = kept.withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("bigint"))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = materialize(stage(spark, kept, SF), name)
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [x for x in left if x[0] in (7, None)] == [(7, one), (None, prose(3))]
    assert [i for i, _ in left] == [7, 8, 9, None] and all(t for i, t in left if i != 9)


def test_rows_without_doc_id_can_be_rejected(spark):
    docs = spark.createDataFrame([(None, None), (None, prose(1)), (1, "")], "doc_id bigint, text string")
    docs = docs.withColumn("lang", F.lit("xx"))
    left = corpus_pipeline.quality(spark, docs, SF)
    assert left.where("coalesce(text, '') = ''").count() == 0 and left.columns == docs.columns


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
