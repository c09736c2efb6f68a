import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from goldleaf.llm import vector_codes as V
from goldleaf.plans.compare import connect, spark_rows, twin_rows

SF = "/root/testdata/sf0.001"


def test_equals_sql(spark):
    got = spark_rows(V.compress(spark.read.parquet(f"{SF}/embeddings.parquet")))
    assert got == twin_rows(connect(SF), V.SQL)


@pytest.mark.parametrize("width", [1, 2, 8, 32])
def test_sequency_order(width):
    rows = V.transformed(np.eye(width, dtype=np.int64)).T
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(width))
    assert (rows @ rows.T == width * np.eye(width)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest_is_brute_force(kind):
    r = np.random.default_rng(3)
    for m in (1, 3, 8, 13):
        parts, entries = r.integers(-4, 5, (300, m)), r.integers(-4, 5, (16, m))
        entries[9] = entries[2]
        d = ((parts[:, None] - entries[None]) ** 2).sum(-1)
        codes, far = V.nearest(V.transformed(parts.astype(kind)), V.transformed(entries.astype(kind)))
        assert (codes == d.argmin(1)).all() and (far == d.min(1)).all()


def test_limbs_of_any_size():
    for x in (0, 1, -1, 2**30 - 1, 2**30, -(2**30), 10**40, -(10**40)):
        assert sum(v << (V.LIMB * i) for i, v in enumerate(V.limbs(x))) == x


def brute(rows, rounds=V.ROUNDS):
    """vec_id, code, error of (vec_id, vector) rows, with Python's numbers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max([1, *(len(v) for _, v in rows)]) // 8) * 8
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(int(x) * 4096 if abs(x) > 1e300 else x * 4096) for x in [*v, *[0.0] * (width - len(v))]] for _, v in rows]
    m = width // 8
    cut = [[v[p * m : p * m + m] for p in range(8)] for v in ints]
    book = [[list(v[p]) for v in cut[:16]] for p in range(8)]

    def assign():
        far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        return [[min((far(v[p], e), k) for k, e in enumerate(book[p])) for p in range(8)] for v in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(8):
            for k in range(len(book[p])):
                own = [v[p] for v, f in zip(cut, found) if f[p][1] == k]
                if own:
                    book[p][k] = [sum(xs) // len(own) for xs in zip(*own)]
    return sorted(
        ((i is None, i or 0), "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)) for (i, _), f in zip(rows, assign())
    )


SCHEMA = "vec_id bigint, embedding array<double>, label string, code string, part int, error string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "x", 1, "y") for i, v in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e18, 1e307])
def test_awkward_vectors_equal_brute_force(spark, scale):
    r = random.Random(5)
    rows = [(i, [r.uniform(-scale, scale) for _ in range(20)]) for i in range(60)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (70, None), (71, []), (72, [1.0, None]), (73, [float("nan")])]
    rows += [(74, [float("inf")] * 20), (75, [float("-inf")] * 20), (76, [0.5] * 3), (77, [-0.0] * 20)]
    got = V.compress(frame(spark, rows), rounds=3).collect()
    wanted = brute(rows, 3)
    assert sorted(((x.vec_id is None, x.vec_id or 0), x.code) for x in got) == [w[:2] for w in wanted]
    if all(w[2] < 2**63 for w in wanted):
        assert sorted(x.error for x in got) == sorted(w[2] for w in wanted)
    else:
        assert any(x.error is None for x in got)


def test_few_rows_and_none(spark):
    one = V.compress(frame(spark, [(1, [0.1] * 8)])).first()
    assert (one.code, one.error, one.label_error) == ("00" * 8, 0, 0)
    assert V.compress(frame(spark, [(1, None)])).count() == 0


def test_errors_are_added_per_label_nulls_together(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").withColumn("label", F.when(F.col("label") % 2 == 1, F.col("label")))
    got = V.compress(df, rounds=1)
    sums = {r.label: r.s for r in got.join(df.select("vec_id", "label"), "vec_id").groupBy("label").agg(F.sum("error").alias("s")).collect()}
    told = {r.label: r.e for r in got.join(df.select("vec_id", "label"), "vec_id").select("label", F.col("label_error").alias("e")).distinct().collect()}
    assert sums == told and None in sums


def test_numbers_of_python_where_64_bits_do_not_hold():
    assert V.integers(pa.array([[0.1] * 8]), 8).dtype == np.int64
    assert V.integers(pa.array([[1e9] * 8]), 8).dtype == object
    assert V.integers(pa.array([[0.1] * 8]), 8, book_most=1 << 40).dtype == object
