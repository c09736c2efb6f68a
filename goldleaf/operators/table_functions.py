"""SQL table functions over the finance gold tables.

They are temporary SQL functions: Spark inlines the body into the calling query,
so filters, literal arguments and LATERAL calls are optimised with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldleaf.functions.phrases import ENOUGH_EVIDENCE, LOW_EVIDENCE, MIN_EVIDENCE_LINES

VENDOR_VIEW = "gold_vendor_performance"
CASHFLOW_VIEW = "gold_monthly_cashflow"

VENDOR_PROFILE = f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_vendor_performance(
    p_vendor_id STRING COMMENT 'Vendor account to look up'
)
RETURNS TABLE (
    vendor_id STRING, vendor_name STRING, country STRING, total_po_lines BIGINT,
    otif_rate DECIMAL(6,4), on_time_rate DECIMAL(6,4), in_full_rate DECIMAL(6,4),
    rejection_rate DECIMAL(6,4), avg_cycle_time_days DECIMAL(18,2),
    total_order_value DECIMAL(22,2), currency STRING, data_confidence STRING
)
COMMENT 'Profile of one vendor with a warning when it rests on few order lines'
RETURN
    SELECT g.vendor_id, g.vendor_name, g.country, g.total_po_lines, g.otif_rate, g.on_time_rate,
           g.in_full_rate, g.rejection_rate, CAST(g.avg_cycle_time_days AS DECIMAL(18,2)),
           CAST(g.total_order_value AS DECIMAL(22,2)), g.currency,
           IF(g.total_po_lines < {MIN_EVIDENCE_LINES}, '{LOW_EVIDENCE}', '{ENOUGH_EVIDENCE}')
    FROM {VENDOR_VIEW} g
    WHERE g.vendor_id = get_vendor_performance.p_vendor_id
"""

# The score is the metric with a sign, so that the lowest score ranks first.
VENDOR_RANKS = f"""
CREATE OR REPLACE TEMPORARY FUNCTION rank_vendors_by_metric(
    p_metric STRING COMMENT 'otif, on_time, rejection or cycle_time; anything else ranks by otif',
    p_top_n INT COMMENT 'Number of vendors to return',
    p_worst_first STRING COMMENT 'yes for the worst vendors first, anything else for the best'
)
RETURNS TABLE (
    rank_position INT, vendor_id STRING, vendor_name STRING, total_po_lines BIGINT,
    otif_rate DECIMAL(6,4), on_time_rate DECIMAL(6,4), rejection_rate DECIMAL(6,4),
    avg_cycle_time_days DECIMAL(18,2)
)
COMMENT 'Vendors with at least {MIN_EVIDENCE_LINES} order lines, ranked by a metric'
RETURN
    WITH scored AS (
        SELECT v.*,
               IF(p_worst_first = 'yes', -1, 1) * CASE p_metric
                   WHEN 'on_time' THEN -v.on_time_rate
                   WHEN 'rejection' THEN v.rejection_rate
                   WHEN 'cycle_time' THEN CAST(v.avg_cycle_time_days AS DECIMAL(18,2))
                   WHEN 'otif' THEN -v.otif_rate
                   ELSE IF(p_worst_first = 'yes', v.otif_rate, -v.otif_rate)
               END AS score
        FROM {VENDOR_VIEW} v
        WHERE v.total_po_lines >= {MIN_EVIDENCE_LINES}
    ), numbered AS (
        SELECT s.*, ROW_NUMBER() OVER (ORDER BY s.score ASC NULLS FIRST, s.vendor_id) AS place
        FROM scored s
    )
    SELECT n.place, n.vendor_id, n.vendor_name, n.total_po_lines, n.otif_rate, n.on_time_rate,
           n.rejection_rate, CAST(n.avg_cycle_time_days AS DECIMAL(18,2))
    FROM numbered n
    WHERE n.place <= p_top_n
"""

CASHFLOW_SUMMARY = f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_cashflow_summary(
    p_company_code STRING COMMENT 'Company code to look up'
)
RETURNS TABLE (
    company_code STRING, currency STRING, months BIGINT, transaction_count BIGINT,
    total_inflow DECIMAL(38,2), total_outflow DECIMAL(38,2), net_cashflow DECIMAL(38,2)
)
COMMENT 'Cash flow totals of one company over all months'
RETURN
    SELECT c.company_code, c.currency, COUNT(*), SUM(c.transaction_count),
           SUM(c.total_inflow), SUM(c.total_outflow), SUM(c.net_cashflow)
    FROM {CASHFLOW_VIEW} c
    WHERE c.company_code = get_cashflow_summary.p_company_code
    GROUP BY c.company_code, c.currency
"""

COMPANY_RANKS = f"""
CREATE OR REPLACE TEMPORARY FUNCTION rank_companies_by_cashflow(
    p_top_n INT COMMENT 'Number of companies to return',
    p_lowest_first STRING COMMENT 'yes for the lowest net first, anything else for the highest'
)
RETURNS TABLE (
    rank_position INT, company_code STRING, currency STRING, months BIGINT, net_cashflow DECIMAL(38,2)
)
COMMENT 'Companies ranked by total net cash flow'
RETURN
    WITH totals AS (
        SELECT c.company_code, c.currency, COUNT(*) AS months, SUM(c.net_cashflow) AS net
        FROM {CASHFLOW_VIEW} c
        GROUP BY c.company_code, c.currency
    ), numbered AS (
        SELECT t.*, ROW_NUMBER() OVER (
            ORDER BY IF(p_lowest_first = 'yes', t.net, -t.net) NULLS FIRST, t.company_code, t.currency
        ) AS place
        FROM totals t
    )
    SELECT n.place, n.company_code, n.currency, n.months, n.net FROM numbered n WHERE n.place <= p_top_n
"""


def register_vendor_functions(gold: DataFrame) -> SparkSession:
    """Make the two vendor functions callable over the given gold table."""
    gold.createOrReplaceTempView(VENDOR_VIEW)
    spark = gold.sparkSession
    spark.sql(VENDOR_PROFILE)
    spark.sql(VENDOR_RANKS)
    return spark


def register_cashflow_functions(gold: DataFrame) -> SparkSession:
    """Make the two cash flow functions callable over the given gold table."""
    gold.createOrReplaceTempView(CASHFLOW_VIEW)
    spark = gold.sparkSession
    spark.sql(CASHFLOW_SUMMARY)
    spark.sql(COMPANY_RANKS)
    return spark
