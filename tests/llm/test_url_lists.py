import random

from pyspark.sql import functions as F

from goldleaf.llm import url_lists as U
from goldleaf.llm.queries import MORE_ORACLES, MORE_QUERIES, ORACLES, QUERIES
from goldleaf.plans.compare import connect, spark_rows, twin_rows

SF = "/root/testdata/sf0.001"
LINES = "line_id bigint, kind string, pattern string, at bigint, listed boolean"
CAPTURES = "page_id bigint, url string, fetched_at bigint"


def test_equals_sql(spark):
    name = "op9_temporal_url_lists"
    assert spark_rows(QUERIES[name](spark, SF)) == twin_rows(connect(SF), ORACLES[name])


def brute(captures, lines):
    out = set()
    for page, url, at in captures:
        host = url.split("//")[1].split("/")[0]
        asked = {"host": host, "domain": ".".join(host.split(".")[-2:]), "prefix": host + "/" + url.split("/")[3]}
        found = []
        for kind in U.KINDS:
            state, since = False, None
            for line in sorted((x for x in lines if (x[1], x[2]) == (kind, asked[kind]) and x[3] <= at), key=lambda x: (x[3], x[0])):
                # Of lines at one time the last decides.
                if line[4] and not state:
                    since = line[3]
                same = [x for x in lines if (x[1], x[2], x[3]) == (kind, asked[kind], line[3])]
                if line is max(same):
                    if line[4] and not state:
                        state, since = True, line[3]
                    elif not line[4]:
                        state = False
            if state:
                found.append((kind, asked[kind], since))
        out.add((page, at, len(found), *(found[0] if found else (None, None, None)), bool(found)))
    return out


def test_equals_brute_force_over_many_buckets(spark):
    r = random.Random(8)
    hosts = ["a.x.org", "b.x.org", "y.com"]
    lines = []
    for k in range(300):
        kind = r.choice(U.KINDS)
        pattern = {"host": r.choice(hosts), "domain": r.choice(["x.org", "y.com"]), "prefix": r.choice(hosts) + "/" + r.choice("pq")}[kind]
        lines.append((k, kind, pattern, r.randrange(0, 500), r.random() < 0.5))
    captures = [(k, f"http://{r.choice(hosts)}/{r.choice('pqr')}/z", r.randrange(0, 600)) for k in range(400)]
    got = U.evaluate(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(lines, LINES), bucket=40)
    assert {tuple(x) for x in got.collect()} == brute(captures, lines)


def test_awkward_rows(spark):
    lines = [(1, "host", "y.com", 5, True), (None, "host", "y.com", 9, False), (2, "host", None, 1, True), (3, None, "y.com", 1, True), (4, "host", "y.com", None, True), (5, "host", "z.com", 1, None)]
    captures = [(1, "HTTP://Y.com", 6), (1, "HTTP://Y.com", 6), (2, None, 6), (3, "http://y.com/", None), (None, "http://y.com/", 9), (4, "no url", 6), (5, "http://y.com/", 4)]
    df = spark.createDataFrame(captures, CAPTURES).withColumn("pattern", F.lit("other")).withColumn("bucket", F.lit(1))
    got = {r.page_id: (r.n_active, r.blocked, r.listed_since) for r in U.evaluate(df, spark.createDataFrame(lines, LINES)).collect()}
    assert got == {1: (1, True, 5), 2: (0, False, None), 3: (0, False, None), None: (0, False, None), 4: (0, False, None), 5: (0, False, None)}
    assert U.evaluate(df.limit(0), spark.createDataFrame(lines, LINES)).count() == 0
    assert U.evaluate(df, spark.createDataFrame([], LINES)).where("blocked").count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op9_temporal_url_lists"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_every_event_is_a_line(spark):
    events, pages = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("events", "pages"))
    lines = U.all_list_lines(events, pages)
    assert lines.count() == events.count() > U.list_lines(events, pages).count()
    days = F.countDistinct(F.floor(F.col("at") / U.DAY))
    dated = lines.agg(days).first()[0], U.list_lines(events, pages).agg(days).first()[0]
    assert dated[0] == 30 > dated[1]
    # Patterns are added and taken off again, so a list goes on changing.
    intervals = U.validity_intervals(lines)
    assert intervals.where("until IS NOT NULL").count() > 0
    assert intervals.groupBy("kind", "pattern").count().where("count > 1").count() > 0


def test_every_event_equals_sql(spark):
    for name in ("op9_temporal_url_lists", "temporal_url_lists_all_events"):
        got = spark_rows({**QUERIES, **MORE_QUERIES}[name](spark, SF))
        assert got == twin_rows(connect(SF), {**ORACLES, **MORE_ORACLES}[name])
        blocked = [r[got[0].index("blocked")] for r in got[1]]
        assert 0 < blocked.count("True") < len(blocked)


def test_no_pages(spark):
    events, pages = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("events", "pages"))
    none = pages.limit(0)
    assert U.evaluate(U.page_captures(none), U.all_list_lines(events, none)).count() == 0
    assert U.evaluate(U.page_captures(pages), U.all_list_lines(events.limit(0), pages)).where("blocked").count() == 0
