import shutil
from concurrent.futures import ThreadPoolExecutor

from goldleaf.plans import gold as G
from goldleaf.sources.stored import exists
from goldleaf.sources.testbed import TABLES, Testbed

SF_DIR = "/root/testdata/sf0.001"


def copied(tmp_path):
    for name in TABLES:
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path / f"{name}.parquet")
    return str(tmp_path)


def test_a_table_is_built_once_and_shared(spark, tmp_path, monkeypatch):
    folder = copied(tmp_path)
    built = []
    whole = G.Gold.builders.fget
    monkeypatch.setattr(
        G.Gold, "builders", property(lambda self: {k: (lambda k=k, f=f: (built.append(k), f())[1]) for k, f in whole(self).items()})
    )
    with ThreadPoolExecutor(3) as pool:
        counts = list(pool.map(lambda _: G.Gold(Testbed(spark, folder)).table("tool_texts").count(), range(3)))
    assert counts == [4, 4, 4]
    assert sorted(built) == sorted({"tool_texts", "tool_lines", "silver_bookings", *G.D.TOOL_TABLES})


def test_changed_inputs_give_new_tables(spark, tmp_path):
    folder = copied(tmp_path)
    before = G.Gold(Testbed(spark, folder))
    n = before.table("gold_monthly_cashflow").count()
    spark.read.parquet(f"{SF_DIR}/orders.parquet").limit(10).coalesce(1).write.parquet(f"{folder}/fewer")
    shutil.copy(next((tmp_path / "fewer").glob("part-*.parquet")), tmp_path / "orders.parquet")
    after = G.Gold(Testbed(spark, folder))
    assert after.folder != before.folder and not exists(spark, f"{after.folder}/gold_monthly_cashflow")
    assert after.table("gold_monthly_cashflow").count() < n
