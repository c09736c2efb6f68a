"""Gold tables that the answering queries of a run share.

The tools answer from stored gold, by the name of a table.  The first query that
asks for a name builds the table from the layers below it, which are stored as
well; all later ones of the run read it.  A run's tables go with its folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cached_property
from threading import RLock

from pyspark.sql import DataFrame

from goldleaf.operators import dashboards as D
from goldleaf.operators import finance as N
from goldleaf.operators import planner as L
from goldleaf.operators import travel as V
from goldleaf.session import run_dir
from goldleaf.sources.stored import exists
from goldleaf.sources.testbed import TABLES, Testbed

# One build at a time: a run has one driver, whose threads may ask for the same table.
_building = RLock()


class Gold:
    """The stored tables over one directory of inputs."""

    def __init__(self, testbed: Testbed) -> None:
        self.testbed, self.spark = testbed, testbed.spark

    @cached_property
    def folder(self) -> str:
        """Named by the inputs and their state, so that changed files give new tables."""
        said = [self.testbed.sf_dir]
        for name in TABLES:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.testbed.sf_dir}/{name}.parquet")
            files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if files.exists(at):
                there = files.getContentSummary(at)
                said += [name, there.getLength(), there.getFileCount(), files.getFileStatus(at).getModificationTime()]
        return f"{run_dir(self.spark)}/gold-{hashlib.sha256(repr(said).encode()).hexdigest()[:16]}"

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with _building:
            if not exists(self.spark, f"{path}/_SUCCESS"):
                self.builders[name]().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @property
    def builders(self) -> dict[str, Callable[[], DataFrame]]:
        t = self.testbed
        return {
            "silver_bookings": lambda: V.silver_bookings(t.bookings, t.properties, t.places).select(
                "booking_id", "destination", "country", "booking_month", "property_type", "nights", "total_amount"
            ),
            "gold_revenue_by_destination": lambda: V.gold_revenue_by_destination(self.table("silver_bookings")),
            "gold_monthly_revenue": lambda: V.gold_monthly_revenue(self.table("silver_bookings")),
            "gold_revenue_by_property_type": lambda: V.gold_revenue_by_property_type(self.table("silver_bookings")),
            "gold_payment_methods": lambda: V.gold_payment_methods(t.payments, self.table("silver_bookings")),
            "gold_vendor_performance": lambda: N.gold_vendor_performance(t.vendor_lines),
            "gold_monthly_cashflow": lambda: N.gold_monthly_cashflow(t.cashflow),
            "destination_cards": lambda: L.destination_cards(t.places, t.properties, guides=t.destination_guides),
            "list_texts": lambda: L.list_texts(t.places),
            "tool_lines": lambda: D.tool_lines(*[self.table(name) for name in D.TOOL_TABLES]),
            "tool_texts": lambda: D.sized_texts(self.table("tool_lines")),
        }
