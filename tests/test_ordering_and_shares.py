import pytest
from pyspark.sql import functions as F

from goldleaf.operators import dashboards as D
from goldleaf.operators import planner as L
from goldleaf.operators.ordering import joined_text, numbered
from goldleaf.sources.tables import drop_versions, profile_tables, publish, quoted, read_share, with_samples


def test_numbered_over_many_ranges(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("v"), "id").repartition(7)
    got = numbered(rows, "g", ["v", "id"]).collect()
    for g in (0, 1):
        mine = sorted((r.v, r.id, r.place) for r in got if r.g == g)
        assert [p for _, _, p in mine] == list(range(1, 501))
    assert numbered(rows.limit(0), "g", ["v"]).count() == 0


def test_joined_text_keeps_order_leaves_out_nulls(spark):
    rows = spark.range(50).select(F.lit("k").alias("k"), "id", F.floor(F.col("id") / 7).alias("b"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("t"))
    (got,) = joined_text(rows.repartition(5), ["k"], "b", ["id"], "t", ",").collect()
    assert got.t == ",".join(str(i) for i in range(50) if i % 5)


def test_list_texts_over_many_ranges(spark):
    places = spark.range(300).select(
        F.col("id").alias("destination_id"),
        F.when(F.col("id") != 7, F.concat(F.lit("p"), (F.col("id") * 7919 % 300).cast("string"))).alias("destination"),
        F.when(F.col("id") % 3 == 0, "One").when(F.col("id") % 3 == 1, "Two").alias("country"),
    )
    got = {r.list_key: r.names for r in L.list_texts(places.repartition(6)).collect()}
    data = [(r.destination_id, r.destination, r.country) for r in places.collect() if r.destination]
    assert got == {
        "": ", ".join(sorted(d for _, d, _ in data)),
        "one": ", ".join(d for _, d, c in sorted(data) if c == "One"),
        "two": ", ".join(d for _, d, c in sorted(data) if c == "Two"),
    }


def test_sized_texts(spark):
    lines = spark.createDataFrame(
        [("top_destinations", i, f"d{i}") for i in range(1, 2501)] + [("monthly_trend", i, f"m{i}") for i in range(1, 9)],
        "tool string, place int, line string",
    )
    choices = spark.createDataFrame(
        [("q1", "top_destinations", 10**9), ("q2", "top_destinations", 2), ("q3", "monthly_trend", 0), ("q4", "nothing", 4), ("q5", "monthly_trend", None)],
        "question_id string, tool string, rows_wanted int",
    )
    got = {(r.tool, r.rows_wanted): r.tool_text.split("\n")[1:] for r in D.sized_texts(lines, choices).collect()}
    assert got[("top_destinations", 10**9)] == [f"d{i}" for i in range(1, 2501)]
    assert got[("top_destinations", 2)] == ["d1", "d2"] and got[("top_destinations", None)] == [f"d{i}" for i in range(1, 6)]
    assert got[("monthly_trend", None)] == [f"m{i}" for i in range(6, 0, -1)] and got[("monthly_trend", 0)] == [""]
    assert got[("payment_methods", None)] == [""] and len(got) == 7


def test_contained_is_brute_force_and_grows_with_length(spark):
    texts = ["", "a", "ab", "abc", "abca", "bca", "xabcay", "new york", "york", "newark", "é", "aéa", "zzzz", "new"]
    frame = lambda name: spark.createDataFrame([(t,) for t in texts], f"{name} string")
    got = sorted(map(tuple, L.contained(frame("part"), frame("whole")).collect()))
    assert got == sorted((p, w) for p in texts for w in texts if p in w)
    long = spark.createDataFrame([("".join(chr(97 + i * i % 26) + chr(97 + i % 25) for i in range(2000)),)], "whole string")
    grams = long.select(F.size(L._grams(F.col("whole"), F.sequence(F.lit(0), F.lit(L.GRAM))))).first()[0]
    assert grams <= 4 * 4000


def test_samples_are_the_first_rows_in_order(spark):
    df = spark.createDataFrame([(i, None if i == 2 else "x" * 100, [i], i / 3) for i in range(20)], "k int, `a b` string, v array<int>, f double")
    got = {r.column_name: r for r in with_samples(df.repartition(4), "t").collect()}
    assert got["k"].sample == "0 | 1 | 2 | 3 | 4" and got["a b"].sample == " | ".join(["NULL", *["x" * 40] * 4])
    assert got["v"].sample == " | ".join(["list of 1"] * 5) and got["f"].sample.startswith("0.000000 | 0.333333")
    assert (got["k"].n_rows, got["a b"].n_null, got["f"].column_type, got["k"].error) == (20, 1, "double", None)
    empty = with_samples(df.limit(0), "t").collect()
    assert len(empty) == 4 and {r.sample for r in empty} == {""}


def test_unreadable_tables_alone(spark):
    (row,) = profile_tables(spark, {"gone": lambda: spark.table("no_such_table")}, with_samples).collect()
    assert row.table_name == "gone" and row.n_rows is None and "TABLE_OR_VIEW_NOT_FOUND" in row.error
    assert profile_tables(spark, {}).count() == 0


def test_a_share_is_read_as_declared(spark):
    name = "their share-1 `x`.t"
    spark.createDataFrame([("7", "1.5", "z"), ("no", None, "z")], "`k` string, amount string, more string").createOrReplaceTempView(quoted(name))
    got = read_share(spark, name, "amount double, k int")
    assert got.columns == ["amount", "k"] and sorted(map(tuple, got.collect()), key=str) == [(1.5, 7), (None, None)]
    with pytest.raises(ValueError, match="absent"):
        read_share(spark, name, "k int, absent string")


def test_readers_find_a_table_at_any_time(spark, tmp_path):
    name, folder = "all my rows", str(tmp_path)
    first = publish(spark.range(3), name, folder)
    before = spark.table(quoted(name))
    second = publish(before.withColumn("id", F.col("id") + 10), name, folder)
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    assert sorted(r.id for r in spark.table(quoted(name)).collect()) == [10, 11, 12]
    drop_versions(spark, folder, second)
    assert sorted(r.id for r in spark.table(quoted(name)).collect()) == [10, 11, 12]
    assert [p.name for p in tmp_path.iterdir()] == [second.rsplit("/", 1)[-1]] and first != second
