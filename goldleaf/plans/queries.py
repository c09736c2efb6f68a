"""The registered queries: operators applied to the test tables.

Each query reads whole tables.  Steps that several passes read are written to the
run's folder in shared storage while a query is built (``materialize``), so some
queries run jobs before their first action; none writes anywhere else.  Decimals become
doubles and months become dates at this edge only, so that another engine can
compare the values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators import dashboards as D
from goldleaf.operators import evaluation as E
from goldleaf.operators import features as X
from goldleaf.operators import finance as N
from goldleaf.operators import modelling as M
from goldleaf.operators import planner as L
from goldleaf.operators import questions as Q
from goldleaf.operators import retrieval as R
from goldleaf.operators import sales as S
from goldleaf.operators import table_functions as TF
from goldleaf.operators import travel as V
from goldleaf.operators.expectations import expectation_counts
from goldleaf.plans.gold import Gold
from goldleaf.plans.retraining import ModelRuns
from goldleaf.session import run_dir
from goldleaf.sources.stored import PartitionedTable
from goldleaf.sources.tables import (
    bronze,
    conditional_update,
    layer_counts,
    materialize,
    profile_tables,
    publish,
    quoted,
    read_share,
    with_samples,
)
from goldleaf.sources.testbed import AGENTS, TABLES, Testbed
from goldleaf.streaming.refresh import SALES, SalesLayers

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Fixed run parameters instead of the clock.
AS_OF = "2002-01-01"
RUN_TIMES = {"base0001": "2024-01-01 00:00:00", "tuned002": "2024-02-01 00:00:00"}


def query(build: Callable[[Testbed], DataFrame], name: str | None = None) -> Callable[[Testbed], DataFrame]:
    """Register a query that is built from the test views."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Testbed(spark, sf_dir)))

    REGISTRY[name or build.__name__] = run
    return build


def plain(df: DataFrame) -> DataFrame:
    def edge(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return column.cast("date").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[edge(f) for f in df.schema.fields])


def rounded(df: DataFrame, *names: str, to: int = 2) -> DataFrame:
    """Sums of doubles depend on the order of addition; compare them rounded."""
    return df.withColumns({n: F.round(n, to) for n in names})


def own_folder(t: Testbed, name: str) -> str:
    """A new folder of this run, for queries whose operator stores tables."""
    return f"{run_dir(t.spark)}/{name}-{uuid4().hex}"


# ---- shared steps -----------------------------------------------------------
def silver_travel(t: Testbed) -> DataFrame:
    return V.silver_bookings(t.bookings, t.properties, t.places)


def vendor_gold(t: Testbed) -> DataFrame:
    return N.gold_vendor_performance(t.vendor_lines)


def cash_gold(t: Testbed) -> DataFrame:
    return N.gold_monthly_cashflow(t.cashflow)


def sized(t: Testbed, choices: DataFrame | None = None) -> DataFrame:
    """The stored tool texts that a batch of questions needs; those of the default size are gold."""
    if choices is None:
        return Gold(t).table("tool_texts")
    return materialize(D.sized_texts(Gold(t).table("tool_lines"), choices), "tool-texts")


def planning(t: Testbed) -> dict[str, DataFrame]:
    """The stored tables that plans are made from."""
    gold = Gold(t)
    return {"cards": gold.table("destination_cards"), "lists": gold.table("list_texts")}


def features(t: Testbed) -> DataFrame:
    """Spend is rounded to cents, so that tiers do not hang on the order of addition."""
    built = X.customer_features(S.silver_sales(t.sales_transactions), F.lit(AS_OF).cast("date"))
    return rounded(built, "total_spend")


def tiers(t: Testbed) -> DataFrame:
    """The stored feature table, labelled: cuts and labels are separate passes over it."""
    built = materialize(features(t), "customer_features")
    return X.with_spend_tier(built, X.exact_cuts(built))


def split(t: Testbed) -> DataFrame:
    return X.stratified_split(tiers(t), "spend_tier", "customerID")


# ---- travel -----------------------------------------------------------------
@query
def silver_bookings(t: Testbed) -> DataFrame:
    return silver_travel(t)


@query
def gold_revenue_by_destination(t: Testbed) -> DataFrame:
    return V.gold_revenue_by_destination(silver_travel(t))


@query
def bronze_ingest(t: Testbed) -> DataFrame:
    return bronze(t.bookings).withColumn("_ingested_at", F.col("_ingested_at").isNotNull())


@query
def bronze_tables(t: Testbed) -> DataFrame:
    sources = {
        "bronze_bookings": t.bookings,
        "bronze_properties": t.properties,
        "bronze_destinations": t.destinations,
        "bronze_payments": t.payments,
        "bronze_sales_transactions": t.sales_transactions,
        "bronze_sales_customers": t.sales_customers,
    }
    return layer_counts({name: bronze(df) for name, df in sources.items()})


@query
def gold_monthly_revenue(t: Testbed) -> DataFrame:
    return V.gold_monthly_revenue(silver_travel(t))


@query
def gold_revenue_by_property_type(t: Testbed) -> DataFrame:
    return V.gold_revenue_by_property_type(silver_travel(t))


@query
def gold_payment_methods(t: Testbed) -> DataFrame:
    return V.gold_payment_methods(t.payments, silver_travel(t))


@query
def destinations_per_country(t: Testbed) -> DataFrame:
    return V.destinations_per_country(t.places)


@query
def destination_price_stats(t: Testbed) -> DataFrame:
    return V.destination_price_stats(t.places, t.properties)


@query
def travel_layer_counts(t: Testbed) -> DataFrame:
    return V.travel_layer_counts(t.bookings, t.properties, t.places)


# ---- dashboards and reports -------------------------------------------------
@query
def dash_daily_revenue(t: Testbed) -> DataFrame:
    daily = S.gold_daily_revenue(S.silver_sales(t.sales_transactions))
    return rounded(D.daily_revenue_chart(daily, fill_gaps=True), "daily_revenue")


@query
def dash_top_destinations(t: Testbed) -> DataFrame:
    return rounded(D.top_destinations_chart(V.gold_revenue_by_destination(silver_travel(t))), "total_revenue")


@query
def dash_monthly_travel(t: Testbed) -> DataFrame:
    return rounded(D.monthly_travel_chart(V.gold_monthly_revenue(silver_travel(t))), "total_revenue")


@query
def top_destinations(t: Testbed) -> DataFrame:
    return D.top_destinations(Gold(t).table("gold_revenue_by_destination"))


@query
def monthly_trend(t: Testbed) -> DataFrame:
    return D.monthly_trend(Gold(t).table("gold_monthly_revenue"))


@query
def property_type_report(t: Testbed) -> DataFrame:
    return D.property_type_report(Gold(t).table("gold_revenue_by_property_type"))


@query
def payment_report(t: Testbed) -> DataFrame:
    return D.payment_report(Gold(t).table("gold_payment_methods"))


@query
def tool_texts(t: Testbed) -> DataFrame:
    gold = Gold(t)
    return D.tool_texts(*[gold.table(name) for name in D.TOOL_TABLES]).select("tool", "tool_text")


# ---- sales ------------------------------------------------------------------
@query
def silver_sales(t: Testbed) -> DataFrame:
    return S.silver_sales(t.sales_transactions)


@query
def silver_customers(t: Testbed) -> DataFrame:
    return S.silver_customers(t.sales_customers)


@partial(query, name="expectation_counts")
def count_expectations(t: Testbed) -> DataFrame:
    sales = expectation_counts(
        S.typed_sales(t.sales_transactions), S.sales_constraints(), "silver_sales_transactions"
    )
    customers = expectation_counts(
        S.customer_columns(t.sales_customers), S.customer_constraints(), "silver_sales_customers"
    )
    return sales.unionByName(customers)


@query
def gold_daily_revenue(t: Testbed) -> DataFrame:
    return rounded(S.gold_daily_revenue(S.silver_sales(t.sales_transactions)), "daily_revenue")


@query
def gold_revenue_by_state(t: Testbed) -> DataFrame:
    gold = S.gold_revenue_by_state(
        S.silver_sales(t.sales_transactions), S.silver_customers(t.sales_customers)
    )
    return rounded(gold, "state_revenue")


def refreshed(t: Testbed) -> SalesLayers:
    """Layers after two arrivals of files, the second one's batch once more, and a refresh without news."""
    folder = own_folder(t, "refresh")
    layers = SalesLayers(t.spark, f"{folder}/layers", buckets=8)
    sales = t.sales_transactions.withColumn("arrival", F.pmod(F.xxhash64("transactionID"), F.lit(2)))
    sales.write.partitionBy("arrival").parquet(f"{folder}/sales")
    source = t.spark.read.schema(SALES)
    for arrival in (0, 1):
        source.parquet(f"{folder}/sales/arrival={arrival}").write.mode("append").parquet(f"{folder}/source")
        layers.refresh(f"{folder}/source", f"{folder}/checkpoint")
    layers.load(source.parquet(f"{folder}/sales/arrival=1"), 1)
    layers.refresh(f"{folder}/source", f"{folder}/checkpoint")
    return layers


@query
def refreshed_daily_revenue(t: Testbed) -> DataFrame:
    return rounded(refreshed(t).daily.read(), "daily_revenue")


@query
def refreshed_revenue_by_state(t: Testbed) -> DataFrame:
    return rounded(refreshed(t).revenue_by_state(S.silver_customers(t.sales_customers)), "state_revenue")


@partial(query, name="layer_counts")
def sales_layer_counts(t: Testbed) -> DataFrame:
    return layer_counts(
        {
            "bronze_sales_transactions": t.sales_transactions,
            "silver_sales_transactions": S.silver_sales(t.sales_transactions),
            "bronze_sales_customers": t.sales_customers,
            "silver_sales_customers": S.silver_customers(t.sales_customers),
        }
    )


# ---- finance ----------------------------------------------------------------
@query
def gold_vendor_performance(t: Testbed) -> DataFrame:
    return vendor_gold(t)


@query
def vendor_profile(t: Testbed) -> DataFrame:
    return N.vendor_profiles(vendor_gold(t))


@query
def vendor_profile_function(t: Testbed) -> DataFrame:
    """The SQL table function, called for the busiest vendor of every country."""
    spark = TF.register_vendor_functions(Gold(t).table("gold_vendor_performance"))
    return spark.sql(
        """
        SELECT p.*
        FROM (
            SELECT country, MAX_BY(vendor_id, STRUCT(total_po_lines, vendor_id)) AS vendor_id
            FROM gold_vendor_performance GROUP BY country
        ) busiest, LATERAL get_vendor_performance(busiest.vendor_id) p
        """
    )


def _rank_query(metric: str, top_n: int, worst_first: str) -> Callable[[Testbed], DataFrame]:
    def build(t: Testbed) -> DataFrame:
        return N.rank_vendors(vendor_gold(t), metric, top_n, worst_first)

    return build


RANKINGS = {
    "rank_vendors_otif_best": ("otif", 5, "no"),
    "rank_vendors_otif_worst": ("otif", 5, "yes"),
    "rank_vendors_on_time_best": ("on_time", 5, "no"),
    "rank_vendors_on_time_worst": ("on_time", 5, "yes"),
    "rank_vendors_rejection_best": ("rejection", 5, "no"),
    "rank_vendors_rejection_worst": ("rejection", 5, "yes"),
    "rank_vendors_cycle_time_best": ("cycle_time", 3, "no"),
    "rank_vendors_cycle_time_worst": ("cycle_time", 3, "yes"),
    "rank_vendors_unknown_metric": ("quality", 5, "yes"),
}
for _name, _arguments in RANKINGS.items():
    query(_rank_query(*_arguments), _name)


@query
def rank_vendors_function(t: Testbed) -> DataFrame:
    """The SQL table function with two argument sets."""
    spark = TF.register_vendor_functions(Gold(t).table("gold_vendor_performance"))
    return spark.sql(
        """
        SELECT 'otif worst' AS ranking, * FROM rank_vendors_by_metric('otif', 5, 'yes')
        UNION ALL
        SELECT 'cycle_time best' AS ranking, * FROM rank_vendors_by_metric('cycle_time', 3, 'no')
        """
    )


@query
def gold_monthly_cashflow(t: Testbed) -> DataFrame:
    return cash_gold(t)


@query
def cashflow_profile(t: Testbed) -> DataFrame:
    return N.cashflow_profile(cash_gold(t))


@query
def cashflow_by_company(t: Testbed) -> DataFrame:
    return N.cashflow_by_company(cash_gold(t))


@query
def cashflow_summary(t: Testbed) -> DataFrame:
    return N.cashflow_summary(cash_gold(t))


@query
def rank_companies(t: Testbed) -> DataFrame:
    return N.rank_companies(cash_gold(t))


@query
def cashflow_functions(t: Testbed) -> DataFrame:
    """Both SQL table functions: the summary of every ranked company."""
    spark = TF.register_cashflow_functions(Gold(t).table("gold_monthly_cashflow"))
    return spark.sql(
        """
        SELECT r.rank_position, s.*
        FROM rank_companies_by_cashflow(5, 'yes') r, LATERAL get_cashflow_summary(r.company_code) s
        """
    )


@query
def key_overlap(t: Testbed) -> DataFrame:
    vendors = N.key_overlap(t.vendor_lines, "VendorAccountNumber_LIFNR", t.table("supplier"), "s_suppkey")
    buyers = N.key_overlap(t.sales_transactions, "customerID", t.sales_customers, "customerID")
    return vendors.withColumn("pair", F.lit("vendor lines / suppliers")).unionByName(
        buyers.withColumn("pair", F.lit("sales / customers"))
    )


# ---- table helpers ----------------------------------------------------------
GOVERNANCE = {"expect_contains": "GOVERNANCE"}


def _governance_cases() -> Column:
    return F.col("verifies").startswith("GOVERNANCE") & F.col("expect_contains").isin("caution")


def _governed(t: Testbed) -> DataFrame:
    return conditional_update(t.golden, GOVERNANCE, _governance_cases())


@partial(query, name="conditional_update")
def update_golden(t: Testbed) -> DataFrame:
    return _governed(t)


@query
def partition_update(t: Testbed) -> DataFrame:
    """The same update on a stored table, of which a quarter of the partitions is touched."""
    keys = ["expect_tool", "agent"]
    columns = [f for f in t.golden.schema.fields if f.name not in keys]
    stored = PartitionedTable(
        t.spark, own_folder(t, "golden"), T.StructType([*columns, *[t.golden.schema[k] for k in keys]]), keys
    )
    stored.replace(t.golden)
    stored.update("governance", GOVERNANCE, _governance_cases())
    return stored.read().select(*t.golden.columns)


@query
def table_profile(t: Testbed) -> DataFrame:
    """All tables, and one that is not there."""
    readers = {name: partial(t.table, name) for name in (*TABLES, "no_such_table")}
    profile = profile_tables(t.spark, readers, with_samples)
    problem = F.regexp_extract("error", r"^\[(\w+)", 1)  # without the path
    return profile.withColumn("error", F.when(F.col("error").isNotNull(), problem))


VENDOR_LINES = """
    VendorAccountNumber_LIFNR string, NAME1 string, CountryKey_LAND1 string, VendorOnTimeDelivery string,
    VendorInFullDelivery string, VendorOnTimeInFullDelivery string, VendorInvoiceAccuracy string, IsRejected string,
    VendorCycleTimeInDays int, NetOrderValueinTargetCurrency_NETWR decimal(18,2), TargetCurrency_TCURR string
"""


@query
def received_share(t: Testbed) -> DataFrame:
    """Vendor gold over a share under a quoted name, with its columns in another order, one more, and numbers as text."""
    name = f"procurement share-1 `{uuid4().hex}`.lines"
    lines = t.vendor_lines
    lines.select(
        F.lit("x").alias("load note"),
        *[F.col(c).cast("string").alias(c) for c in reversed(lines.columns)],
    ).createOrReplaceTempView(quoted(name))
    return N.gold_vendor_performance(read_share(t.spark, name, VENDOR_LINES))


@query
def switched_table(t: Testbed) -> DataFrame:
    """A table replaced by rows made from itself, seen by a reader from before and by one from after."""
    name, folder = f"payments {uuid4().hex}", own_folder(t, "payments")
    publish(t.payments, name, folder)
    before = t.spark.table(quoted(name))
    publish(before.where(F.col("status") == "completed"), name, folder)
    after = t.spark.table(quoted(name))
    seen = before.withColumn("reader", F.lit("before")).unionByName(after.withColumn("reader", F.lit("after")))
    return seen.groupBy("reader").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"))


# ---- planner ----------------------------------------------------------------
@query
def resolve_destination(t: Testbed) -> DataFrame:
    return L.resolve_destination(t.trip_requests, t.places)


@query
def find_properties(t: Testbed) -> DataFrame:
    requests = t.table("customer").select(
        F.col("c_custkey").alias("request_id"),
        F.col("c_nationkey").cast("bigint").alias("destination_id"),
        L.nightly_ceiling(F.abs("c_acctbal"), 1 + F.col("c_custkey") % 7).alias("max_nightly_price"),
    )
    return L.find_properties(requests, t.properties)


@query
def budget_check(t: Testbed) -> DataFrame:
    """Every valid stay at the price of its property; a booking without a property has no price."""
    prices = t.properties.select("property_id", "base_price")
    stays = t.bookings.filter(V.valid_booking()).join(prices, "property_id", "left").select(
        "booking_id",
        "guests_count",
        F.datediff("check_out", "check_in").alias("nights"),
        "base_price",
        F.col("total_amount").alias("budget"),
    )
    return L.budget_check(stays)


@query
def plan_trips(t: Testbed) -> DataFrame:
    """Plans with the context that all guides of the destination give."""
    return L.plan_trips(t.trip_requests, t.places, t.properties, cards=planning(t)["cards"])


@query
def plan_texts(t: Testbed) -> DataFrame:
    return L.plan_texts(t.trip_requests, t.places, t.properties, **planning(t))


@query
def request_slots(t: Testbed) -> DataFrame:
    return L.missing_slots(L.request_slots(t.trip_messages, t.places))


@query
def plan_texts_worded(t: Testbed) -> DataFrame:
    """Every second plan comes with a text written elsewhere."""
    written = F.when(F.col("request_id") % 2 == 0, F.lit("  Take the first one, it is the cheapest.\n"))
    return L.plan_texts(t.trip_requests.withColumn("written", written), t.places, t.properties, **planning(t))


@query
def place_lists(t: Testbed) -> DataFrame:
    return L.place_lists(t.places)


@query
def chat_replies(t: Testbed) -> DataFrame:
    return L.chat_replies(t.trip_messages, t.places, t.properties, **planning(t))


def slot_replies(t: Testbed) -> DataFrame:
    """Extraction replies made from every trip request; a part of them is unreadable."""
    slots = F.to_json(
        F.struct(F.col("destination_text").alias("destination"), "nights", F.col("budget").alias("budget"))
    )
    which = F.col("request_id") % 4
    return t.trip_requests.select(
        F.col("request_id").alias("message_id"),
        F.when(which == 0, slots)
        .when(which == 1, F.concat(F.lit("Here you go:\n"), slots, F.lit("\nAnything else?")))
        .when(which == 2, F.concat(F.lit("{oops "), slots))
        .otherwise("no idea")
        .alias("reply"),
    )


@query
def parse_slot_replies(t: Testbed) -> DataFrame:
    return L.parse_slot_replies(slot_replies(t))


@query
def chat_replies_from_replies(t: Testbed) -> DataFrame:
    return L.chat_replies_from_replies(slot_replies(t), t.places, t.properties, **planning(t))


# ---- texts ------------------------------------------------------------------
@query
def doc_lengths(t: Testbed) -> DataFrame:
    return R.document_lengths(t.guides)


@query
def doc_length_summary(t: Testbed) -> DataFrame:
    return R.document_length_summary(t.guides)


@query
def chunk_documents(t: Testbed) -> DataFrame:
    return R.chunk_documents(t.guides)


@query
def retrieve_chunks(t: Testbed) -> DataFrame:
    return R.retrieve_chunks(t.guide_questions, t.guides).select("conv_id", "turn", "guide_id", "context")


@query
def route_questions(t: Testbed) -> DataFrame:
    return Q.route_questions(t.questions)


@query
def input_guardrail(t: Testbed) -> DataFrame:
    return Q.input_guardrail(t.questions)


@query
def output_guardrail(t: Testbed) -> DataFrame:
    """Every user turn is checked as data for the assistant turn that follows."""
    turns = t.table("conversations")
    data = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("tool_text"))
    told = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    answers = data.join(told, ["conv_id", "turn"], "left").select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("answer_id"),
        "answer",
        "tool_text",
    )
    return Q.output_guardrail(answers)


@query
def agent_answers(t: Testbed) -> DataFrame:
    return Q.agent_answers(t.questions, sized(t))


def worded_questions(t: Testbed) -> DataFrame:
    """Questions with an answer worded elsewhere; a third have none."""
    which = F.pmod(F.length("question_id"), F.lit(3))
    return t.questions.withColumn(
        "answer",
        F.when(which == 1, F.concat(F.lit("  The data name these: "), F.substring("question", 1, 60), F.lit(" ")))
        .when(which == 2, F.lit("Revenue by destination (total, bookings, average).")),
    )


@query
def agent_answers_worded(t: Testbed) -> DataFrame:
    return Q.agent_answers(worded_questions(t), sized(t))


@query
def agent_answers_from_replies(t: Testbed) -> DataFrame:
    choices = materialize(Q.parse_tool_choices(t.model_replies), "tool-choices")
    return Q.agent_answers(t.questions, sized(t, choices), choices)


@query
def guarded_answers(t: Testbed) -> DataFrame:
    return Q.guarded_answers(t.questions, sized(t))


@query
def guarded_answers_worded(t: Testbed) -> DataFrame:
    return Q.guarded_answers(worded_questions(t), sized(t))


@query
def guarded_answers_from_replies(t: Testbed) -> DataFrame:
    choices = materialize(Q.parse_tool_choices(t.model_replies, guarded=True), "tool-choices")
    return Q.guarded_answers(t.questions, sized(t, choices), choices)


@query
def parse_tool_choices(t: Testbed) -> DataFrame:
    return Q.parse_tool_choices(t.model_replies)


# ---- evaluation -------------------------------------------------------------
@query
def parse_responses(t: Testbed) -> DataFrame:
    return E.parse_responses(t.responses).select(
        "case_id",
        "ok",
        "error",
        "answer",
        F.array_join("tools_called", "|").alias("tools_called"),
        F.array_join("tool_args", "|").alias("tool_args"),
    )


@query
def eval_scores(t: Testbed) -> DataFrame:
    return E.score_cases(_governed(t), E.parse_responses(t.responses)).drop("scores")


@query
def eval_scores_v1(t: Testbed) -> DataFrame:
    return E.score_cases(_governed(t), E.parse_responses(t.responses), strict=True).drop("scores")


@query
def eval_details(t: Testbed) -> DataFrame:
    scored = E.score_cases(_governed(t), E.parse_responses(t.responses))
    return scored.select("case_id", F.inline("scores")).select(
        "case_id", "dimension", F.col("pass").alias("passed"), "detail"
    )


def _history(t: Testbed) -> DataFrame:
    """First run with the old golden set and scorer, then the tuned run appended."""
    replies = E.parse_responses(t.responses)
    base, tuned = (
        (name, F.lit(when).cast("timestamp_ntz")) for name, when in RUN_TIMES.items()
    )
    first = E.evaluation_run(t.golden, replies, *base, strict=True)
    return first.unionByName(E.evaluation_run(_governed(t), replies, *tuned))


@query
def eval_history(t: Testbed) -> DataFrame:
    return _history(t)


@query
def stored_history(t: Testbed) -> DataFrame:
    """The same history stored run by run; the second run fails half-way at first and is retried."""
    replies = E.parse_responses(t.responses)
    base, tuned = ((name, F.lit(when).cast("timestamp_ntz")) for name, when in RUN_TIMES.items())
    runs = [
        E.evaluation_run(t.golden, replies, *base, strict=True),
        E.evaluation_run(_governed(t), replies, *tuned).where(F.col("agent") == AGENTS[0]),
        E.evaluation_run(_governed(t), replies, *tuned),
    ]
    columns = [f for f in runs[0].schema.fields if f.name != "run_id"]
    history = PartitionedTable(
        t.spark, own_folder(t, "history"), T.StructType([*columns, runs[0].schema["run_id"]]), ["run_id"]
    )
    for one in runs:
        history.replace(one)
    return history.read()


@query
def eval_summary(t: Testbed) -> DataFrame:
    return E.evaluation_summary(_history(t))


# ---- customer features and model -------------------------------------------
@query
def customer_features(t: Testbed) -> DataFrame:
    return features(t)


@query
def spend_tier_cuts(t: Testbed) -> DataFrame:
    return X.exact_cuts(materialize(features(t), "customer_features"))


@query
def spend_tier_sketch(t: Testbed) -> DataFrame:
    """The approximate cuts: how far their ranks are off, against the stated error."""
    built = materialize(features(t), "customer_features")
    cuts = X.approximate_cuts(built).select(F.struct("low_cut", "high_cut")).scalar()
    n, spend = F.count(F.lit(1)), F.col("total_spend")

    def within(cut: Column, p: float) -> Column:
        off = F.count_if(spend <= cut) - p * n
        return F.abs(off) <= 0.01 * n + 1

    return built.withColumn("cuts", cuts).agg(
        n.alias("n_customers"),
        within(F.col("cuts.low_cut"), X.TIER_CUTS[0]).alias("low_within_error"),
        within(F.col("cuts.high_cut"), X.TIER_CUTS[1]).alias("high_within_error"),
    )


@query
def spend_tier(t: Testbed) -> DataFrame:
    return tiers(t)


@query
def train_test_split(t: Testbed) -> DataFrame:
    return split(t).select("customerID", "spend_tier", "split")


def _rule_predictions(t: Testbed) -> DataFrame:
    """Tiers predicted by three single-feature rules, as runs to be compared."""
    built = split(t)
    rules = {
        "by_transactions": F.when(F.col("transaction_count") <= 20, 0)
        .when(F.col("transaction_count") <= 35, 1)
        .otherwise(2),
        "by_products": F.when(F.col("distinct_products") <= 15, 0)
        .when(F.col("distinct_products") <= 25, 1)
        .otherwise(2),
        "by_recency": F.when(F.col("days_since_last_purchase") > 400, 0)
        .when(F.col("days_since_last_purchase") > 250, 1)
        .otherwise(2),
    }
    runs = F.array(
        *[F.struct(F.lit(name).alias("run_id"), rule.alias("predicted")) for name, rule in rules.items()]
    )
    return built.filter(F.col("split") == "test").select("customerID", "spend_tier", F.inline(runs))


def _rule_runs(t: Testbed) -> DataFrame:
    metrics = M.classification_metrics(_rule_predictions(t), "spend_tier", "predicted", by=["run_id"])
    return rounded(metrics, "accuracy", "f1", to=9)


@query
def classification_metrics(t: Testbed) -> DataFrame:
    return _rule_runs(t)


@query
def best_run(t: Testbed) -> DataFrame:
    return M.best_run(_rule_runs(t))


@query
def promotion_gate(t: Testbed) -> DataFrame:
    runs = materialize(_rule_runs(t), "model_runs")
    champion = runs.filter(F.col("run_id") == "by_products")
    return M.promotion_gate(runs.filter(F.col("run_id") != "by_products"), champion)


def fitted(t: Testbed, trees: int, depth: int) -> tuple[PipelineModel, DataFrame]:
    """A forest fitted on the train part, stored and loaded again, and the stored split."""
    built = materialize(split(t), "customer_split")
    model = M.fit_tier_model(built.filter(F.col("split") == "train"), trees, depth)
    return M.round_trip(model, own_folder(t, "forest")), built


@query
def spend_tier_model(t: Testbed) -> DataFrame:
    """Both forest configurations as stored and loaded again, checked on the test part.

    What a fit gives has no SQL form; these are the things that hold of any good one.
    """
    runs = None
    for trees, depth in M.CONFIGURATIONS:
        model, built = fitted(t, trees, depth)
        scored = M.batch_score(model, built.filter(F.col("split") == "test"))
        row = M.scoring_check(model, scored).withColumn("run_id", F.lit(f"forest_{trees}_{depth}"))
        runs = row if runs is None else runs.unionByName(row)
    return runs


@query
def batch_score(t: Testbed) -> DataFrame:
    """Every customer scored by the smaller forest, as stored and loaded again; the tier itself has no SQL form."""
    model, built = fitted(t, *M.CONFIGURATIONS[0])
    scored = M.batch_score(model, built)
    return scored.select("customerID", "spend_tier", F.col("predicted_tier").isin(0, 1, 2).alias("has_tier"))


RETRAINED = [("r1", (5, 2)), ("r2", (5, 2)), ("r2", (5, 2)), ("r3", (20, 6))]  # r2 is repeated


@query
def retrain_runs(t: Testbed) -> DataFrame:
    """The log of four retrainings with one champion, and what must hold of both."""
    runs = ModelRuns(t.spark, own_folder(t, "retraining"))
    built = materialize(split(t), "customer_split")
    for run_id, configuration in RETRAINED:
        runs.fit(built, run_id, configuration)
    log, champion = runs.log.read(), runs.champion()
    best = M.best_run(log).select("run_id").scalar()  # equal runs: the first stays champion
    return log.select(
        "run_id",
        "trees",
        "depth",
        "n",
        (champion.agg(F.count(F.lit(1))).scalar() == 1).alias("one_champion"),
        (champion.select("run_id").scalar() == best).alias("champion_is_best"),
        (F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)).alias("has_metrics"),
    )
