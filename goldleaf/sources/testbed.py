"""Input views over the star-schema test tables.

The operators expect sales, travel, finance and evaluation inputs.  Each view
here derives one of them from the given tables, row for row, so every query
grows with those tables.  Values are chosen so that all branches of the
operators are met: failing expectations, unmatched keys, unknown names, and so on.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Fixed values of the derived inputs.
CURRENCIES = ["EUR", "USD", "GBP", "JPY", "CHF"]
EXPECTED_TOOLS = [
    "get_cashflow_summary",
    "rank_companies_by_cashflow",
    "get_vendor_performance",
    "rank_vendors_by_metric",
]
AGENTS = ["cash_flow", "vendor", "supervisor"]
ANSWER_ENDINGS = [
    " Note that there are too few orders to judge.",
    " Only 1 purchase order, so treat this with caution.",
    " The question was: ",
]
OUTAGE = "upstream unavailable; "


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _as_day(ts: str) -> Column:
    return F.col(ts).cast("date")


class Testbed:
    """Views over one directory of parquet tables."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        # every read looks into the file for its schema; once per table is enough
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # ---- sales ----------------------------------------------------------
    @cached_property
    def sales_transactions(self) -> DataFrame:
        returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_orderkey").alias("transactionID"),
                F.col("o_custkey").alias("customerID"),
                F.col("p_name").alias("product"),
                (F.col("l_quantity") - 3).alias("quantity"),
                F.when(returned, -F.col("l_extendedprice"))
                .otherwise(F.col("l_extendedprice"))
                .alias("totalPrice"),
                F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderdate")).alias("dateTime"),
            )
        )

    @cached_property
    def sales_customers(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_custkey")).alias("customerID"),
                F.col("c_name").alias("first_name"),
                F.col("c_mktsegment").alias("last_name"),
                F.concat(F.lit("City of "), "n_name").alias("city"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("country"),
            )
        )

    # ---- travel ---------------------------------------------------------
    # Amounts are decimals here: their sums do not depend on the order of addition.
    @cached_property
    def places(self) -> DataFrame:
        """Destinations without their texts, for the queries that read no text."""
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").cast("bigint").alias("destination_id"),
                F.col("n_name").alias("destination"),
                F.when(F.col("n_nationkey") == 22, F.concat(F.lit("LONELY "), "r_name"))
                .otherwise(F.col("r_name"))
                .alias("country"),
                F.concat(F.lit("Province of "), "n_name").alias("state_or_province"),
            )
        )

    @cached_property
    def destinations(self) -> DataFrame:
        return self.places.join(
            self.guides.select(F.col("guide_id").alias("destination_id"), "description"),
            "destination_id",
            "left",
        )

    @cached_property
    def guides(self) -> DataFrame:
        """Every document as a Markdown text with a heading per line."""
        return self.table("documents").select(
            F.col("doc_id").alias("guide_id"),
            F.concat(
                F.lit("# Guide "),
                F.col("doc_id").cast("string"),
                F.lit("\n"),
                F.replace("text", F.lit("\n"), F.lit("\n## ")),
            ).alias("description"),
        )

    @cached_property
    def destination_guides(self) -> DataFrame:
        """Every guide with its destination: the destinations take turns."""
        n_places = self.table("nation").agg(F.count(F.lit(1))).scalar()
        return self.guides.select(F.pmod("guide_id", n_places).alias("destination_id"), "guide_id", "description")

    @cached_property
    def guide_questions(self) -> DataFrame:
        """Every user turn asks all guides of its conversation's residue class, so every guide is asked."""
        turns = self.table("conversations")
        classes = turns.agg(F.max("conv_id") + 1).scalar()
        guides = self.table("documents").select(
            F.col("doc_id").alias("guide_id"), F.pmod(F.col("doc_id"), classes).alias("conv_id")
        )
        asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
        return asked.join(guides, "conv_id").select("conv_id", "turn", "guide_id", "question")

    @cached_property
    def properties(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("property_id"),
            (F.col("p_partkey") % 23).alias("destination_id"),
            F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("title"),
            F.col("p_type").alias("property_type"),
            (F.col("p_size") * F.lit(10.0).cast("double")).alias("base_price"),
            (1 + F.col("p_size") % 5).alias("bedrooms"),
            (2 + F.col("p_size") % 7).alias("max_guests"),
        )

    @cached_property
    def bookings(self) -> DataFrame:
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_orderkey").alias("booking_id"),
                (F.col("l_partkey") + 7).alias("property_id"),
                _as_day("o_orderdate").alias("check_in"),
                _as_day("l_shipdate").alias("check_out"),
                F.col("l_linenumber").alias("guests_count"),
                F.col("l_extendedprice").cast("decimal(18,2)").alias("total_amount"),
                F.col("l_linestatus").alias("status"),
            )
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("booking_id"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
            F.when(F.col("o_orderstatus") == "F", "completed").otherwise("pending").alias("status"),
        )

    # ---- finance --------------------------------------------------------
    @cached_property
    def cashflow(self) -> DataFrame:
        total = F.col("o_totalprice").cast("decimal(18,2)")
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_nationkey").cast("string")).alias(
                    "CompanyCode"
                ),
                F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", _as_day("o_orderdate")).alias(
                    "TransactionDate"
                ),
                _pick(CURRENCIES, F.col("c_nationkey") % 5).alias("CompanyCodeCurrency"),
                F.when(F.col("o_orderstatus") == "F", total)
                .when(F.col("o_orderstatus") == "O", -total)
                .otherwise(F.lit(0))
                .cast("decimal(18,2)")
                .alias("AmountInCompanyCodeCurrency"),
            )
        )

    @cached_property
    def vendor_lines(self) -> DataFrame:
        """One vendor account per supplier and brand: some have 30 lines, most fewer."""
        days = F.datediff(_as_day("l_shipdate"), _as_day("o_orderdate"))
        on_time = F.col("l_shipdate") <= F.expr("o_orderdate + interval 30 days")
        in_full = F.col("l_tax") <= 0.04

        def flag(condition: Column) -> Column:
            return F.when(condition, "true").otherwise("false")

        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.concat("s_name", F.lit("/"), "p_brand").alias("VendorAccountNumber_LIFNR"),
                F.concat("s_name", F.lit(" "), "p_brand").alias("NAME1"),
                F.col("n_name").alias("CountryKey_LAND1"),
                flag(on_time).alias("VendorOnTimeDelivery"),
                flag(in_full).alias("VendorInFullDelivery"),
                flag(on_time & in_full).alias("VendorOnTimeInFullDelivery"),
                F.when(F.col("l_returnflag") != "N", flag(F.col("l_discount") <= 0.05)).alias(
                    "VendorInvoiceAccuracy"
                ),
                flag(F.col("l_returnflag") == "R").alias("IsRejected"),
                F.abs(days).alias("VendorCycleTimeInDays"),
                F.col("l_extendedprice").cast("decimal(18,2)").alias("NetOrderValueinTargetCurrency_NETWR"),
                _pick(CURRENCIES, F.col("s_nationkey") % 5).alias("TargetCurrency_TCURR"),
            )
        )

    # ---- requests -------------------------------------------------------
    @cached_property
    def _customer_places(self) -> DataFrame:
        places = self.places.select(
            F.col("destination_id"), F.col("destination").alias("city"), F.col("country")
        )
        return self.table("customer").join(places, F.col("c_nationkey") == F.col("destination_id"))

    @cached_property
    def questions(self) -> DataFrame:
        """All user turns, and one templated question per customer."""
        which = F.col("c_custkey") % 10
        city = F.col("city")
        asked = (
            F.when(which == 0, F.concat(F.lit("Where did bookings bring in most money, leaving out "), city, F.lit("?")))
            .when(which == 1, F.lit(" \t"))
            .when(which == 2, F.concat(F.lit("Will it rain in "), city, F.lit(" on Sunday?")))
            .when(which == 3, F.concat(F.lit("please hack the account of someone in "), city))
            .when(which == 4, F.concat(F.lit("Show the growth of "), city, F.lit(" over time")))
            .when(which == 5, F.concat(F.lit("Which kind of property do guests of "), city, F.lit(" book?")))
            .when(which == 6, F.concat(F.lit("Share of each payment method among guests of "), city))
            .when(which == 7, F.concat(F.lit("Do hotels near "), city, F.lit(" keep growing?")))
            .when(which == 8, F.concat(city, F.repeat(F.lit(" popular country"), F.lit(32))))
            .otherwise(F.lit(None).cast("string"))
        )
        turns = (
            self.table("conversations")
            .filter(F.col("role") == "user")
            .select(
                F.concat(
                    F.lit("t"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")
                ).alias("question_id"),
                F.col("text").alias("question"),
            )
        )
        return turns.unionByName(
            self._customer_places.select(
                F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("question_id"),
                asked.alias("question"),
            )
        )

    @cached_property
    def model_replies(self) -> DataFrame:
        """Raw routing replies: JSON inside prose, plain JSON, no JSON, broken JSON,
        an unknown tool, and arguments that fit or do not fit."""
        which = F.length(F.coalesce("question", F.lit(""))) % 7
        return self.questions.select(
            "question_id",
            "question",
            F.when(which == 0, 'Sure! {"tool": "monthly_trend", "args": {"months": 3}} - hope this helps')
            .when(which == 1, '{"tool": "payment_methods", "args": {}}')
            .when(which == 2, "I would use the payments tool")
            .when(which == 3, '{"tool": top_destinations}')
            .when(which == 4, '{"tool": "flight_search", "args": {"limit": 2}}')
            .when(
                which == 5,
                # one of these wants more rows than any table has
                F.when(F.col("question_id") == "c8", '{"tool": "top_destinations", "args": {"limit": 1000000000}}').otherwise(
                    '{"tool": "top_destinations", "args": {"limit": 8}}'
                ),
            )
            .otherwise('{"tool": "top_destinations", "args": {"limit": 2, "city": "x"}}')
            .alias("reply"),
        )

    @cached_property
    def trip_requests(self) -> DataFrame:
        which = F.col("c_custkey") % 9
        text = (
            F.when(which == 0, F.col("city"))
            .when(which == 1, F.lower("city"))
            .when(which == 2, F.concat(F.lit("  "), "city", F.lit("\t")))
            .when(which == 3, F.lower("country"))
            .when(which == 4, F.lit("Atlantis"))
            .when(which == 5, F.lit(""))
            .when(which == 6, F.concat("city", F.lit(" please")))
            .when(which == 7, F.substring("city", 3, 100))
            .otherwise(F.lit(None).cast("string"))
        )
        return self._customer_places.select(
            F.col("c_custkey").alias("request_id"),
            text.alias("destination_text"),
            (1 + F.col("c_custkey") % 7).cast("int").alias("nights"),
            F.abs("c_acctbal").alias("budget"),
        )

    @cached_property
    def trip_messages(self) -> DataFrame:
        """All user turns, and one templated travel wish per customer."""
        which = F.col("c_custkey") % 8
        nights = (1 + F.col("c_custkey") % 7).cast("string")
        budget = F.floor(F.abs("c_acctbal")).cast("bigint").cast("string")
        city, country = F.col("city"), F.col("country")
        wish = (
            F.when(
                which == 0,
                F.concat(
                    F.lit("Book "), city, F.lit(" for "), nights,
                    F.lit(" days, at most "), budget, F.lit(" euros"),
                ),
            )
            .when(which == 1, F.concat(F.lit("plan "), nights, F.lit(" nights in "), city, F.lit(", budget "), budget))
            .when(which == 2, F.concat(F.lit("somewhere in "), F.lower(country), F.lit(" for a week")))
            .when(which == 3, F.concat(F.lit("show me "), F.lower(city), F.lit(" over "), nights, F.lit(" days")))
            .when(which == 4, F.lit("plan something nice"))
            .when(which == 5, F.concat(budget, F.lit(" eur, "), city, F.lit(", "), nights, F.lit(" nights please")))
            .when(which == 6, F.concat(F.lit("two of us in "), country, F.lit(" with $"), budget, F.lit(" for 2 weeks")))
            .otherwise(F.concat(city, F.lit("!")))
        )
        turns = self.questions.filter(F.col("question_id").startswith("t")).select(
            F.col("question_id").alias("message_id"), F.col("question").alias("message")
        )
        return turns.unionByName(
            self._customer_places.select(
                F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("message_id"),
                wish.alias("message"),
            )
        )

    # ---- evaluation -----------------------------------------------------
    @cached_property
    def golden(self) -> DataFrame:
        """One case per user turn; a quarter of them are governance cases."""
        governance = F.col("conv_id") % 4 == 2
        return (
            self.table("conversations")
            .filter(F.col("role") == "user")
            .select(
                F.concat(
                    F.lit("C"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")
                ).alias("case_id"),
                _pick(AGENTS, F.col("turn") % 3).alias("agent"),
                F.col("text").alias("question"),
                _pick(EXPECTED_TOOLS, F.col("conv_id") % 4).alias("expect_tool"),
                F.when(governance, "caution")
                .when(F.col("conv_id") % 5 == 0, "V004")
                .otherwise(F.split_part("text", F.lit(" "), F.lit(1)))
                .alias("expect_contains"),
                F.when(governance, "GOVERNANCE: low-confidence warning must appear")
                .otherwise("lookup and correct figure")
                .alias("verifies"),
            )
        )

    @cached_property
    def responses(self) -> DataFrame:
        """One raw reply per case: the assistant turn that follows, as response JSON."""
        turns = self.table("conversations")
        asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
        told = turns.filter(F.col("role") == "assistant").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("told")
        )
        ending = _pick(ANSWER_ENDINGS, F.col("conv_id") % 3)
        answer = F.concat(
            "told", ending, F.when(F.col("conv_id") % 3 == 2, F.lower("question")).otherwise("")
        )
        tool = _pick(EXPECTED_TOOLS, F.col("conv_id") % 4)
        called = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("sa-"), tool, F.lit("-v1"))).otherwise("other")
        part = "array<struct<type:string,text:string>>"
        no_text = F.lit(None).cast("string")

        def item(kind: str, name: Column, arguments: Column, content: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("type"), name.alias("name"), arguments.alias("arguments"), content.alias("content")
            )

        def message(*texts: tuple[str, Column]) -> Column:
            return F.array(*[F.struct(F.lit(k).alias("type"), t.alias("text")) for k, t in texts])

        body = F.to_json(
            F.struct(
                F.array(
                    item("function_call", called, F.lit('{"top_n": 5}'), F.lit(None).cast(part)),
                    item("message", no_text, no_text, message(("output_text", F.lit("working on it")))),
                    item("message", no_text, no_text, message(("output_text", answer), ("note", F.lit("end")))),
                ).alias("output")
            )
        )
        silent = F.col("told").isNull()
        return asked.join(told, ["conv_id", "turn"], "left").select(
            F.concat(
                F.lit("C"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")
            ).alias("case_id"),
            F.when(silent, 503).otherwise(200).alias("status_code"),
            F.when(silent, F.repeat(F.lit(OUTAGE), F.lit(20))).otherwise(body).alias("body"),
        )
