"""SQL twins of the registered queries, for a second engine.

Each twin states the result independently of the Spark plan: plain joins where
Spark combines early, brute-force containment where Spark looks up substrings,
word pairs where Spark intersects arrays.  ``VIEWS`` derives the same inputs from
the test tables as the test views do.
"""

from __future__ import annotations

import re

from goldleaf.functions import phrases as P
from goldleaf.operators.planner import (
    ASK_BUDGET,
    ASK_DESTINATION,
    ASK_EXAMPLE,
    ASK_NIGHTS,
    ASK_PREFIX,
    CHAT_FLIGHT_NOTE,
    CONTEXT_QUESTION,
    WORDING,
)
from goldleaf.sources.testbed import AGENTS, ANSWER_ENDINGS, CURRENCIES, EXPECTED_TOOLS, OUTAGE

TWINS: dict[str, str] = {}


def text(value: str) -> str:
    """A SQL string literal."""
    quoted = "'" + value.replace("'", "''") + "'"
    return quoted if "\n" not in value else "replace(" + quoted.replace("\n", "~~") + ", '~~', chr(10))"


def pick(values: list[str], index: str) -> str:
    return "[" + ", ".join(text(v) for v in values) + f"][CAST({index} AS INTEGER) + 1]"


def any_of(column: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {text(p)})" for p in phrases) + ")"


def strip(column: str) -> str:
    return rf"regexp_replace(coalesce({column}, ''), '^\s+|\s+$', '', 'g')"


VIEWS = {
    "sales_transactions": """
        SELECT l_orderkey AS "transactionID", o_custkey AS "customerID", p_name AS product,
               l_quantity - 3 AS quantity,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END AS "totalPrice",
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate END AS "dateTime"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "sales_customers": """
        SELECT CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey END AS "customerID", c_name AS first_name,
               c_mktsegment AS last_name, 'City of ' || n_name AS city, n_name AS state, r_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "guides": """
        SELECT doc_id AS guide_id,
               '# Guide ' || doc_id || chr(10) || replace(text, chr(10), chr(10) || '## ') AS description
        FROM documents""",
    "places": """
        SELECT CAST(n_nationkey AS BIGINT) AS destination_id, n_name AS destination,
               CASE WHEN n_nationkey = 22 THEN 'LONELY ' || r_name ELSE r_name END AS country,
               'Province of ' || n_name AS state_or_province
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "destinations": "SELECT p.*, description FROM @places p LEFT JOIN @guides ON guide_id = destination_id",
    "properties": """
        SELECT p_partkey AS property_id, p_partkey % 23 AS destination_id, p_name || ' #' || p_partkey AS title,
               p_type AS property_type, CAST(p_size * 10 AS DOUBLE) AS base_price, 1 + p_size % 5 AS bedrooms, 2 + p_size % 7 AS max_guests
        FROM part""",
    "bookings": """
        SELECT l_orderkey AS booking_id, l_partkey + 7 AS property_id, CAST(o_orderdate AS DATE) AS check_in,
               CAST(l_shipdate AS DATE) AS check_out, l_linenumber AS guests_count,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount, l_linestatus AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "payments": """
        SELECT o_orderkey AS booking_id, o_orderpriority AS payment_method, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'pending' END AS status
        FROM orders""",
    "cashflow": f"""
        SELECT CASE WHEN c_mktsegment <> 'FURNITURE' THEN CAST(c_nationkey AS VARCHAR) END AS company_code,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderdate AS DATE) END AS day,
               {pick(CURRENCIES, 'c_nationkey % 5')} AS currency,
               CAST(CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN -o_totalprice ELSE 0 END AS DECIMAL(18,2)) AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "vendor_lines": f"""
        SELECT s_name || '/' || p_brand AS vendor_id, s_name || ' ' || p_brand AS vendor_name, n_name AS country,
               l_shipdate <= o_orderdate + INTERVAL 30 DAY AS on_time, l_tax <= 0.04 AS in_full,
               CASE WHEN l_returnflag <> 'N' THEN l_discount <= 0.05 END AS accurate,
               l_returnflag = 'R' AS rejected,
               abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS days,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
               {pick(CURRENCIES, 's_nationkey % 5')} AS currency
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "customer_places": """
        SELECT c_custkey, c_acctbal, destination AS city, country
        FROM customer JOIN @places ON c_nationkey = destination_id""",
    "questions": """
        SELECT 't' || conv_id || '-' || turn AS question_id, text AS question FROM conversations WHERE role = 'user'
        UNION ALL
        SELECT 'c' || c_custkey, CASE c_custkey % 10
            WHEN 0 THEN 'Where did bookings bring in most money, leaving out ' || city || '?'
            WHEN 1 THEN ' ' || chr(9)
            WHEN 2 THEN 'Will it rain in ' || city || ' on Sunday?'
            WHEN 3 THEN 'please hack the account of someone in ' || city
            WHEN 4 THEN 'Show the growth of ' || city || ' over time'
            WHEN 5 THEN 'Which kind of property do guests of ' || city || ' book?'
            WHEN 6 THEN 'Share of each payment method among guests of ' || city
            WHEN 7 THEN 'Do hotels near ' || city || ' keep growing?'
            WHEN 8 THEN city || repeat(' popular country', 32) END
        FROM @customer_places""",
    "model_replies": """
        SELECT question_id, question, CASE length(coalesce(question, '')) % 7
            WHEN 0 THEN 'Sure! {"tool": "monthly_trend", "args": {"months": 3}} - hope this helps'
            WHEN 1 THEN '{"tool": "payment_methods", "args": {}}'
            WHEN 2 THEN 'I would use the payments tool'
            WHEN 3 THEN '{"tool": top_destinations}'
            WHEN 4 THEN '{"tool": "flight_search", "args": {"limit": 2}}'
            WHEN 5 THEN CASE question_id WHEN 'c8' THEN '{"tool": "top_destinations", "args": {"limit": 1000000000}}'
                                         ELSE '{"tool": "top_destinations", "args": {"limit": 8}}' END
            ELSE '{"tool": "top_destinations", "args": {"limit": 2, "city": "x"}}' END AS reply
        FROM @questions""",
    "trip_requests": """
        SELECT c_custkey AS request_id, CASE c_custkey % 9
            WHEN 0 THEN city WHEN 1 THEN lower(city) WHEN 2 THEN '  ' || city || chr(9) WHEN 3 THEN lower(country)
            WHEN 4 THEN 'Atlantis' WHEN 5 THEN '' WHEN 6 THEN city || ' please' WHEN 7 THEN substring(city, 3, 100)
            END AS destination_text,
            1 + c_custkey % 7 AS nights, abs(c_acctbal) AS budget
        FROM @customer_places""",
    "trip_messages": """
        SELECT question_id AS message_id, question AS message FROM @questions WHERE question_id LIKE 't%'
        UNION ALL
        SELECT 'c' || c_custkey, CASE c_custkey % 8
            WHEN 0 THEN 'Book ' || city || ' for ' || nights || ' days, at most ' || budget || ' euros'
            WHEN 1 THEN 'plan ' || nights || ' nights in ' || city || ', budget ' || budget
            WHEN 2 THEN 'somewhere in ' || lower(country) || ' for a week'
            WHEN 3 THEN 'show me ' || lower(city) || ' over ' || nights || ' days'
            WHEN 4 THEN 'plan something nice'
            WHEN 5 THEN budget || ' eur, ' || city || ', ' || nights || ' nights please'
            WHEN 6 THEN 'two of us in ' || country || ' with $' || budget || ' for 2 weeks'
            ELSE city || '!' END
        FROM (SELECT *, 1 + c_custkey % 7 AS nights, CAST(floor(abs(c_acctbal)) AS BIGINT) AS budget FROM @customer_places)""",
    "golden": f"""
        SELECT 'C' || conv_id || '-' || turn AS case_id, {pick(AGENTS, 'turn % 3')} AS agent, text AS question,
               {pick(EXPECTED_TOOLS, 'conv_id % 4')} AS expect_tool,
               CASE WHEN conv_id % 4 = 2 THEN 'caution' WHEN conv_id % 5 = 0 THEN 'V004'
                    ELSE split_part(text, ' ', 1) END AS expect_contains,
               CASE WHEN conv_id % 4 = 2 THEN 'GOVERNANCE: low-confidence warning must appear'
                    ELSE 'lookup and correct figure' END AS verifies
        FROM conversations WHERE role = 'user'""",
    "governed": """
        SELECT * REPLACE (CASE WHEN verifies LIKE 'GOVERNANCE%' AND expect_contains = 'caution'
                               THEN 'GOVERNANCE' ELSE expect_contains END AS expect_contains)
        FROM @golden""",
    "replies": f"""
        SELECT 'C' || q.conv_id || '-' || q.turn AS case_id, a.text IS NOT NULL AS ok,
               CASE WHEN a.text IS NULL THEN 'HTTP 503: ' || substring(repeat({text(OUTAGE)}, 20), 1, 300) END AS error,
               CASE WHEN a.text IS NULL THEN ''
                    ELSE a.text || {pick(ANSWER_ENDINGS, 'q.conv_id % 3')} || CASE WHEN q.conv_id % 3 = 2 THEN lower(q.text) ELSE '' END
                    END AS answer,
               CASE WHEN a.text IS NULL THEN '' WHEN q.turn % 4 = 0
                    THEN 'sa-' || {pick(EXPECTED_TOOLS, 'q.conv_id % 4')} || '-v1' ELSE 'other' END AS tool,
               CASE WHEN a.text IS NULL THEN '' ELSE '{{"top_n": 5}}' END AS tool_args
        FROM conversations q
        LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
        WHERE q.role = 'user'""",
    # ---- layers that several twins start from ---------------------------------
    "typed_sales": """
        SELECT "transactionID", "customerID", product, CAST(trunc(quantity) AS BIGINT) AS quantity,
               "totalPrice" AS total_price, CAST("dateTime" AS DATE) AS transaction_date
        FROM @sales_transactions""",
    "silver_sales": """
        SELECT * FROM @typed_sales WHERE quantity > 0 AND total_price > 0 AND transaction_date IS NOT NULL""",
    "daily": """
        SELECT transaction_date, SUM(total_price) AS daily_revenue, COUNT("transactionID") AS transaction_count
        FROM @silver_sales GROUP BY transaction_date""",
    "silver_bookings": """
        SELECT booking_id, property_id, destination_id, title AS property_title, property_type, destination, country,
               state_or_province, check_in, check_out, date_diff('day', check_in, check_out) AS nights,
               CAST(guests_count AS BIGINT) AS guests_count, total_amount, status,
               CAST(date_trunc('month', check_in) AS DATE) AS booking_month
        FROM @bookings JOIN @properties USING (property_id) JOIN @places USING (destination_id)
        WHERE total_amount > 0 AND check_out > check_in""",
    "by_destination": """
        SELECT destination, country, COUNT(*) AS total_bookings, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue,
               ROUND(AVG(total_amount), 2) AS avg_booking_value, ROUND(AVG(nights), 1) AS avg_nights
        FROM @silver_bookings GROUP BY destination, country""",
    "by_month": """
        SELECT booking_month, COUNT(*) AS total_bookings, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue,
               ROUND(AVG(total_amount), 2) AS avg_booking_value
        FROM @silver_bookings GROUP BY booking_month""",
    "by_type": """
        SELECT property_type, COUNT(*) AS total_bookings, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue,
               ROUND(AVG(total_amount), 2) AS avg_booking_value
        FROM @silver_bookings GROUP BY property_type""",
    "by_method": """
        SELECT payment_method, COUNT(*) AS payment_count, CAST(SUM(amount) AS DOUBLE) AS total_paid
        FROM @payments p JOIN @silver_bookings s USING (booking_id)
        WHERE p.status = 'completed' GROUP BY payment_method""",
    "all_destination_lines": """
        SELECT *, destination || ' (' || country || '): revenue $' || format('{:,.0f}', total_revenue) || ', '
               || format('{:,}', total_bookings) || ' bookings, avg $' || format('{:,.0f}', avg_booking_value) AS line
        FROM @by_destination""",
    "destination_lines": "SELECT * FROM @all_destination_lines ORDER BY total_revenue DESC, destination, country LIMIT 5",
    "month_lines": "SELECT * FROM @all_month_lines ORDER BY booking_month DESC LIMIT 6",
    "all_month_lines": """
        SELECT booking_month, total_bookings, total_revenue,
               strftime(booking_month, '%Y-%m') || ': $' || format('{:,.0f}', total_revenue) || ' from '
               || format('{:,}', total_bookings) || ' bookings' AS line
        FROM @by_month""",
    "type_lines": """
        SELECT *, property_type || ': revenue $' || format('{:,.0f}', total_revenue) || ', '
               || format('{:,}', total_bookings) || ' bookings, avg $' || format('{:,.0f}', avg_booking_value) AS line
        FROM @by_type""",
    "method_lines": """
        SELECT *, payment_method || ': $' || format('{:,.0f}', total_paid) || ' across '
               || format('{:,}', payment_count) || ' payments' AS line
        FROM @by_method""",
    "tool_texts": f"""
        SELECT 'top_destinations' AS tool, {text(P.TOOL_HEADINGS['top_destinations'])} || chr(10)
               || string_agg(line, chr(10) ORDER BY total_revenue DESC, destination, country) AS tool_text FROM @destination_lines
        UNION ALL
        SELECT 'monthly_trend', {text(P.TOOL_HEADINGS['monthly_trend'])} || chr(10)
               || string_agg(line, chr(10) ORDER BY booking_month) FROM @month_lines
        UNION ALL
        SELECT 'revenue_by_property_type', {text(P.TOOL_HEADINGS['revenue_by_property_type'])} || chr(10)
               || string_agg(line, chr(10) ORDER BY total_revenue DESC, property_type) FROM @type_lines
        UNION ALL
        SELECT 'payment_methods', {text(P.TOOL_HEADINGS['payment_methods'])} || chr(10)
               || string_agg(line, chr(10) ORDER BY total_paid DESC, payment_method) FROM @method_lines""",
    "vendor_gold": f"""
        SELECT vendor_id, MAX(vendor_name) AS vendor_name, MAX(country) AS country, COUNT(*) AS total_po_lines,
               {', '.join(
                   f"CAST(ROUND(CAST(AVG(CASE WHEN {flag} THEN 1.0 ELSE 0.0 END) AS DECIMAL(6,5)), 4) AS DOUBLE) AS {name}"
                   for flag, name in [
                       ('on_time', 'on_time_rate'), ('in_full', 'in_full_rate'), ('on_time AND in_full', 'otif_rate'),
                       ('accurate', 'invoice_accuracy_rate'), ('rejected', 'rejection_rate'),
                   ])},
               ROUND(AVG(days), 2) AS avg_cycle_time_days, MAX(days) AS max_cycle_time_days,
               CAST(SUM(CASE WHEN NOT (on_time AND in_full) THEN 1 ELSE 0 END) AS BIGINT) AS otif_fail_count,
               CAST(SUM(amount) AS DOUBLE) AS total_order_value, MAX(currency) AS currency
        FROM @vendor_lines GROUP BY vendor_id""",
    "vendor_profiles": f"""
        SELECT vendor_id, vendor_name, country, total_po_lines, otif_rate, on_time_rate, in_full_rate, rejection_rate,
               avg_cycle_time_days, total_order_value, currency,
               CASE WHEN total_po_lines < 30 THEN {text(P.LOW_EVIDENCE)} ELSE 'OK' END AS data_confidence
        FROM @vendor_gold""",
    "cash_gold": """
        SELECT company_code, CAST(date_trunc('month', day) AS DATE) AS cashflow_month, currency,
               COUNT(*) AS transaction_count, CAST(SUM(amount) AS DECIMAL(38,2)) AS net_cashflow,
               CAST(SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS total_inflow,
               CAST(SUM(CASE WHEN amount < 0 THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS total_outflow
        FROM @cashflow WHERE day IS NOT NULL AND company_code IS NOT NULL
        GROUP BY company_code, date_trunc('month', day), currency""",
    "company_totals": """
        SELECT company_code, currency, COUNT(*) AS months, CAST(SUM(transaction_count) AS BIGINT) AS transaction_count,
               CAST(SUM(total_inflow) AS DOUBLE) AS total_inflow, CAST(SUM(total_outflow) AS DOUBLE) AS total_outflow,
               CAST(SUM(net_cashflow) AS DOUBLE) AS net_cashflow
        FROM @cash_gold GROUP BY company_code, currency""",
    "resolved": f"""
        SELECT r.request_id, r.destination_text, r.nights, r.budget, k.status, k.destination_id, k.n_cities
        FROM @trip_requests r JOIN (
            SELECT key,
                   CASE WHEN key = '' THEN 'unknown' WHEN city IS NOT NULL THEN 'city' WHEN n > 0 THEN 'country'
                        WHEN loose IS NOT NULL THEN 'city' ELSE 'unknown' END AS status,
                   CASE WHEN key = '' THEN NULL WHEN city IS NOT NULL THEN city WHEN n > 0 THEN CASE WHEN n = 1 THEN only_id END
                        ELSE loose END AS destination_id,
                   CASE WHEN key <> '' AND city IS NULL AND n > 0 THEN n END AS n_cities
            FROM (
                SELECT key, MAX(CASE WHEN lower(destination) = key THEN destination_id END) AS city,
                       SUM(CASE WHEN lower(country) = key THEN 1 ELSE 0 END)::BIGINT AS n,
                       MIN(CASE WHEN lower(country) = key THEN destination_id END) AS only_id,
                       MIN(CASE WHEN contains(lower(destination), key) OR contains(key, lower(destination)) THEN destination_id END) AS loose
                FROM (SELECT DISTINCT lower({strip('destination_text')}) AS key FROM @trip_requests) CROSS JOIN @places
                GROUP BY key)
        ) k ON k.key = lower({strip('r.destination_text')})""",
    "chunks": r"""
        SELECT guide_id, row_number() OVER (PARTITION BY guide_id ORDER BY place) - 1 AS chunk_no, chunk FROM (
            SELECT guide_id, generate_subscripts(parts, 1) AS place, regexp_replace(unnest(parts), '^\s+|\s+$', '', 'g') AS chunk
            FROM (SELECT guide_id, string_split(regexp_replace(description, '\n(#+ )', chr(1) || '\1', 'g'), chr(1)) AS parts FROM @guides))
        WHERE length(chunk) > 40""",
    "guide_cards": rf"""
        WITH own AS (SELECT guide_id % (SELECT COUNT(*) FROM nation) AS destination_id, * FROM @chunks),
        hits AS (
            SELECT destination_id, guide_id, chunk_no, COUNT(*) AS hits
            FROM (SELECT DISTINCT destination_id, unnest(string_split_regex(lower('{CONTEXT_QUESTION}' || destination), '\s+')) AS word FROM @places)
            JOIN (SELECT DISTINCT destination_id, guide_id, chunk_no, unnest(string_split_regex(lower(chunk), '\s+')) AS word FROM own)
                 USING (destination_id, word)
            WHERE length(word) > 3 GROUP BY ALL),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY destination_id ORDER BY coalesce(hits, 0) DESC, guide_id, chunk_no) AS rn
            FROM own LEFT JOIN hits USING (destination_id, guide_id, chunk_no))
        SELECT d.destination_id, d.destination, d.country AS destination_country,
               CASE WHEN NOT EXISTS (SELECT 1 FROM @guides g WHERE g.guide_id % (SELECT COUNT(*) FROM nation) = d.destination_id)
                    THEN '(No description text available for ' || d.destination || '.)'
                    ELSE coalesce(substring(context, 1, 1800), '') END AS context
        FROM @places d LEFT JOIN (
            SELECT destination_id, string_agg(chunk, chr(10) || chr(10) ORDER BY rn) AS context
            FROM placed WHERE rn <= 2 AND (hits > 0 OR rn = 1) GROUP BY destination_id) USING (destination_id)""",
    "cards": rf"""
        SELECT d.destination_id, d.destination, d.country AS destination_country,
               CASE WHEN coalesce(d.description, '') = '' THEN '(No description text available for ' || d.destination || '.)'
                    ELSE coalesce(substring(coalesce(best.context, opening.chunk), 1, 1800), '') END AS context
        FROM @destinations d
        LEFT JOIN @chunks opening ON opening.guide_id = d.destination_id AND opening.chunk_no = 0
        LEFT JOIN (
            SELECT destination_id, string_agg(chunk, chr(10) || chr(10) ORDER BY hits DESC, chunk_no) AS context
            FROM (
                SELECT *, row_number() OVER (PARTITION BY destination_id ORDER BY hits DESC, chunk_no) AS rn
                FROM (
                    SELECT destination_id, chunk_no, any_value(chunk) AS chunk, COUNT(DISTINCT q.word) AS hits
                    FROM (SELECT destination_id, unnest(string_split_regex(lower('{CONTEXT_QUESTION}' || destination), '\s+')) AS word FROM @destinations) q
                    JOIN (SELECT guide_id, chunk_no, chunk, unnest(string_split_regex(lower(chunk), '\s+')) AS word FROM @chunks) c
                         ON q.destination_id = c.guide_id AND q.word = c.word
                    WHERE length(q.word) > 3 GROUP BY destination_id, chunk_no))
            WHERE rn <= 2 GROUP BY destination_id
        ) best ON best.destination_id = d.destination_id""",
    "candidates": """
        SELECT r.request_id, r.nights, r.budget, p.*,
               row_number() OVER (PARTITION BY r.request_id ORDER BY p.base_price, p.property_id) AS rank
        FROM @resolved r JOIN @properties p ON p.destination_id = r.destination_id AND p.base_price <= r.budget / r.nights
        WHERE r.status = 'city' OR r.n_cities = 1""",
    "plan_status": """
        SELECT r.*, CASE WHEN status = 'unknown' THEN 'unknown' WHEN status = 'country' AND n_cities > 1 THEN 'ask_city'
                         WHEN EXISTS (SELECT 1 FROM @candidates c WHERE c.request_id = r.request_id) THEN 'planned'
                         ELSE 'no_properties' END AS plan_status
        FROM @resolved r""",
    "mentions": r"""
        SELECT message_id, first(name ORDER BY kind, start, -length(padded)) AS destination
        FROM (
            SELECT m.message_id, n.kind, n.name, n.padded, strpos(m.padded, n.padded) AS start
            FROM (SELECT message_id, ' ' || regexp_replace(lower(message), '[^\p{L}\p{N}_''-]+', ' ', 'g') || ' ' AS padded FROM @trip_messages) m
            JOIN (SELECT DISTINCT kind, name, ' ' || regexp_replace(lower(name), '[^\p{L}\p{N}_''-]+', ' ', 'g') || ' ' AS padded
                  FROM (SELECT 0 AS kind, destination AS name FROM @places UNION ALL SELECT 1, country FROM @places)) n
                 ON contains(m.padded, n.padded))
        GROUP BY message_id""",
    "slots": r"""
        SELECT m.message_id, d.destination,
               CASE WHEN regexp_matches(low, '\d+ ?-?(nights?|days?)\b') THEN TRY_CAST(regexp_extract(low, '(\d+) ?-?(nights?|days?)\b', 1) AS BIGINT)
                    WHEN regexp_matches(low, '\d+ ?-?weeks?\b') THEN 7 * TRY_CAST(regexp_extract(low, '(\d+) ?-?weeks?\b', 1) AS BIGINT)
                    WHEN regexp_matches(low, '\b(a|one) week\b') THEN 7 END AS nights,
               CAST(replace(coalesce(nullif(regexp_extract(low, '([0-9,]*\d(\.\d+)?) ?(euros?|eur|dollars?|usd|pounds?|gbp|€|\$|£)', 1), ''),
                             nullif(regexp_extract(low, '[€$£] ?(\d[0-9,]*(\.\d+)?)', 1), ''),
                             nullif(regexp_extract(low, '\bbudget( of)?( about| around)? ?:? ?(\d[0-9,]*(\.\d+)?)', 3), '')), ',', '') AS DOUBLE) AS budget
        FROM (SELECT message_id, lower(message) AS low FROM @trip_messages) m LEFT JOIN @mentions d USING (message_id)""",
    "customer_features": """
        SELECT "customerID", ROUND(SUM(total_price), 2) AS total_spend, COUNT("transactionID") AS transaction_count,
               COUNT(DISTINCT product) AS distinct_products,
               date_diff('day', MAX(transaction_date), DATE '2002-01-01') AS days_since_last_purchase
        FROM @silver_sales GROUP BY "customerID" """,
    "cuts": """
        SELECT MIN(total_spend) FILTER (rn >= greatest(ceil(0.33 * n), 1)) AS low_cut,
               MIN(total_spend) FILTER (rn >= greatest(ceil(0.66 * n), 1)) AS high_cut
        FROM (SELECT total_spend, row_number() OVER (ORDER BY total_spend) AS rn, COUNT(*) OVER () AS n FROM @customer_features)""",
    "tiers": """
        SELECT f.*, CAST(CASE WHEN total_spend <= low_cut THEN 0 WHEN total_spend <= high_cut THEN 1 ELSE 2 END AS BIGINT) AS spend_tier
        FROM @customer_features f, @cuts""",
    "split": """
        SELECT * EXCLUDE (rn, n), CASE WHEN rn <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY spend_tier ORDER BY md5("customerID" || ':42'), "customerID") AS rn,
                     COUNT(*) OVER (PARTITION BY spend_tier) AS n FROM @tiers)""",
    "rules": """
        SELECT 'by_transactions' AS run_id, spend_tier, CASE WHEN transaction_count <= 20 THEN 0 WHEN transaction_count <= 35 THEN 1 ELSE 2 END AS predicted
        FROM @split WHERE split = 'test'
        UNION ALL
        SELECT 'by_products', spend_tier, CASE WHEN distinct_products <= 15 THEN 0 WHEN distinct_products <= 25 THEN 1 ELSE 2 END
        FROM @split WHERE split = 'test'
        UNION ALL
        SELECT 'by_recency', spend_tier, CASE WHEN days_since_last_purchase > 400 THEN 0 WHEN days_since_last_purchase > 250 THEN 1 ELSE 2 END
        FROM @split WHERE split = 'test'""",
    "runs": """
        SELECT run_id, CAST(SUM(support) AS BIGINT) AS n, ROUND(SUM(hits) / SUM(support), 9) AS accuracy,
               ROUND(SUM(support * 2.0 * hits / (2 * hits + misses + false_calls)) / SUM(support), 9) AS f1
        FROM (
            SELECT run_id, tier, COUNT(*) FILTER (spend_tier = tier) AS support,
                   CAST(COUNT(*) FILTER (spend_tier = tier AND predicted = tier) AS DOUBLE) AS hits,
                   COUNT(*) FILTER (spend_tier = tier AND predicted <> tier) AS misses,
                   COUNT(*) FILTER (spend_tier <> tier AND predicted = tier) AS false_calls
            FROM @rules, (SELECT unnest([0, 1, 2]) AS tier) GROUP BY run_id, tier)
        WHERE support > 0 OR false_calls > 0
        GROUP BY run_id""",
}
VIEWS["chat_requests"] = """
        SELECT message_id AS request_id, destination AS destination_text, nights, budget FROM @slots
        WHERE coalesce(destination, '') <> '' AND coalesce(nights, 0) <> 0 AND coalesce(budget, 0) <> 0"""


def low_answer_scores(strict: bool) -> str:
    low = "lower(answer)"
    if strict:
        marked = f"({any_of(low, P.LOW_DATA_SIGNALS)} AND {any_of(low, P.CAUTION_SIGNALS)})"
    else:
        marked = any_of(low, P.GOVERNANCE_PHRASES)
    return f"CASE WHEN expect_contains = 'GOVERNANCE' THEN {marked} ELSE contains(lower(answer), lower(expect_contains)) END"


def scores(golden: str, strict: bool) -> str:
    return f"""
        SELECT case_id, agent, verifies, responded, routing, correctness,
               responded AND routing AND correctness AS overall_pass, answer_snippet
        FROM (
            SELECT g.case_id, agent, verifies, ok AND {strip('answer')} <> '' AS responded,
                   contains(tool, expect_tool) AS routing, {low_answer_scores(strict)} AS correctness,
                   substring(answer, 1, 300) AS answer_snippet
            FROM @{golden} g JOIN @replies USING (case_id))"""


VIEWS["scores_v1_base"] = scores("golden", True)
VIEWS["scores_v1"] = scores("governed", True)
VIEWS["scores_v2"] = scores("governed", False)
VIEWS["history"] = """
        SELECT 'base0001' AS run_id, DATE '2024-01-01' AS run_ts, * FROM @scores_v1_base
        UNION ALL SELECT 'tuned002', DATE '2024-02-01', * FROM @scores_v2"""


def twin(name: str, body: str, **replaced: str) -> None:
    """Store a twin: its body after the views it needs, directly or through others.

    A view is referred to as @name.  ``replaced`` puts other SQL in place of views.
    """
    views = {**VIEWS, **replaced}
    ordered: list[str] = []

    def need(sql: str) -> None:
        for view in re.findall(r"@(\w+)", sql):
            if view not in ordered:
                need(views[view])
                ordered.append(view)

    need(body)
    heads = ",\n".join(f"@{view} AS ({views[view]})" for view in ordered)
    sql = (f"WITH {heads}\n" if heads else "") + body
    TWINS[name] = re.sub(r"@(\w+)", r"v_\1", sql)


def whole_view(name: str, view: str | None = None, columns: str = "*") -> None:
    twin(name, f"SELECT {columns} FROM @{view or name}")


# ---- travel -------------------------------------------------------------------
whole_view("silver_bookings", columns="* REPLACE (CAST(total_amount AS DOUBLE) AS total_amount)")
whole_view("gold_revenue_by_destination", "by_destination")
whole_view("gold_monthly_revenue", "by_month")
whole_view("gold_revenue_by_property_type", "by_type")
whole_view("gold_payment_methods", "by_method")
twin(
    "bronze_ingest",
    """SELECT * REPLACE (CAST(guests_count AS BIGINT) AS guests_count, CAST(total_amount AS DOUBLE) AS total_amount),
              true AS _ingested_at FROM @bookings""",
)
twin(
    "bronze_tables",
    """SELECT 'bronze_bookings' AS layer, COUNT(*) AS n_rows FROM @bookings
       UNION ALL SELECT 'bronze_properties', COUNT(*) FROM @properties
       UNION ALL SELECT 'bronze_destinations', COUNT(*) FROM @destinations
       UNION ALL SELECT 'bronze_payments', COUNT(*) FROM @payments
       UNION ALL SELECT 'bronze_sales_transactions', COUNT(*) FROM @sales_transactions
       UNION ALL SELECT 'bronze_sales_customers', COUNT(*) FROM @sales_customers""",
)
twin(
    "destinations_per_country",
    """SELECT country, COUNT(*) AS destination_count, string_agg(destination, ', ' ORDER BY destination) AS destinations
       FROM @places GROUP BY country""",
)
twin(
    "destination_price_stats",
    """SELECT d.destination, d.country, COUNT(p.property_id) AS property_count, ROUND(MIN(base_price), 0) AS min_price,
              ROUND(AVG(base_price), 0) AS avg_price, ROUND(MAX(base_price), 0) AS max_price
       FROM @places d LEFT JOIN @properties p USING (destination_id) GROUP BY d.destination, d.country""",
)
twin(
    "travel_layer_counts",
    """SELECT 'bronze_bookings' AS layer, COUNT(*) AS n_rows FROM @bookings
       UNION ALL SELECT 'lost_invalid', COUNT(*) FROM @bookings
           WHERE NOT coalesce(total_amount > 0 AND check_out > check_in, false)
       UNION ALL SELECT 'lost_unmatched', COUNT(*) FROM @bookings b
           WHERE total_amount > 0 AND check_out > check_in AND NOT EXISTS (
               SELECT 1 FROM @properties p JOIN @places d USING (destination_id) WHERE p.property_id = b.property_id)
       UNION ALL SELECT 'silver_bookings', COUNT(*) FROM @silver_bookings""",
)

# ---- dashboards and reports -----------------------------------------------------
twin(
    "dash_daily_revenue",
    """SELECT CAST(day AS DATE) AS transaction_date, ROUND(coalesce(daily_revenue, 0), 2) AS daily_revenue,
              coalesce(transaction_count, 0) AS transaction_count
       FROM (SELECT unnest(generate_series(MIN(transaction_date), MAX(transaction_date), INTERVAL 1 DAY)) AS day FROM @daily)
       LEFT JOIN @daily ON transaction_date = day""",
)
twin(
    "dash_top_destinations",
    """SELECT destination, ROUND(SUM(total_revenue), 2) AS total_revenue
       FROM (SELECT * FROM @by_destination ORDER BY total_revenue DESC, destination, country LIMIT 10) GROUP BY destination""",
)
twin(
    "dash_monthly_travel",
    """SELECT booking_month, ROUND(SUM(total_revenue), 2) AS total_revenue, CAST(SUM(total_bookings) AS BIGINT) AS total_bookings
       FROM @by_month GROUP BY booking_month""",
)
whole_view("top_destinations", "destination_lines", "* EXCLUDE (avg_nights)")
whole_view("monthly_trend", "month_lines")
whole_view("property_type_report", "type_lines")
whole_view("payment_report", "method_lines")
whole_view("tool_texts")

# ---- sales ----------------------------------------------------------------------
whole_view("silver_sales")
twin("silver_customers", """SELECT * FROM @sales_customers WHERE "customerID" IS NOT NULL""")
twin(
    "expectation_counts",
    """SELECT 'silver_sales_transactions' AS dataset, unnest(['valid_quantity', 'valid_amount', 'has_transaction_date']) AS constraint_name,
              unnest([q, a, d]) AS failed_rows, dropped_rows, checked_rows
       FROM (SELECT COUNT(*) FILTER (NOT quantity > 0) AS q, COUNT(*) FILTER (NOT total_price > 0) AS a,
                    COUNT(*) FILTER (transaction_date IS NULL) AS d, COUNT(*) AS checked_rows,
                    COUNT(*) - (SELECT COUNT(*) FROM @silver_sales) AS dropped_rows FROM @typed_sales)
       UNION ALL
       SELECT 'silver_sales_customers', 'has_customer_id', COUNT(*) - COUNT("customerID"), COUNT(*) - COUNT("customerID"), COUNT(*)
       FROM @sales_customers""",
)
DAILY_REVENUE = """SELECT transaction_date, ROUND(daily_revenue, 2) AS daily_revenue, transaction_count,
              year(transaction_date) AS year, month(transaction_date) AS month FROM @daily"""
twin("gold_daily_revenue", DAILY_REVENUE)
twin("refreshed_daily_revenue", DAILY_REVENUE)
STATE_REVENUE = """SELECT state, ROUND(SUM(total_price), 2) AS state_revenue, COUNT("transactionID") AS transaction_count
       FROM @silver_sales JOIN @sales_customers USING ("customerID") GROUP BY state"""
twin("gold_revenue_by_state", STATE_REVENUE)
twin("refreshed_revenue_by_state", STATE_REVENUE)
twin(
    "layer_counts",
    """SELECT 'bronze_sales_transactions' AS layer, COUNT(*) AS n_rows FROM @sales_transactions
       UNION ALL SELECT 'silver_sales_transactions', COUNT(*) FROM @silver_sales
       UNION ALL SELECT 'bronze_sales_customers', COUNT(*) FROM @sales_customers
       UNION ALL SELECT 'silver_sales_customers', COUNT("customerID") FROM @sales_customers""",
)

# ---- finance --------------------------------------------------------------------
whole_view("gold_vendor_performance", "vendor_gold")
whole_view("vendor_profile", "vendor_profiles")
twin(
    "vendor_profile_function",
    """SELECT * EXCLUDE (place) FROM (
           SELECT *, row_number() OVER (PARTITION BY country ORDER BY total_po_lines DESC, vendor_id DESC) AS place FROM @vendor_profiles)
       WHERE place = 1""",
)


def ranked(metric: str, direction: str, top_n: int) -> str:
    # NULL metrics rank first in both directions
    return f"""
        SELECT row_number() OVER (ORDER BY {metric} {direction} NULLS FIRST, vendor_id) AS rank_position, vendor_id, vendor_name,
               total_po_lines, otif_rate, on_time_rate, rejection_rate, avg_cycle_time_days
        FROM @vendor_gold WHERE total_po_lines >= 30
        QUALIFY rank_position <= {top_n}"""


for _name, _ranked in {
    "rank_vendors_otif_best": ("otif_rate", "DESC", 5),
    "rank_vendors_otif_worst": ("otif_rate", "ASC", 5),
    "rank_vendors_on_time_best": ("on_time_rate", "DESC", 5),
    "rank_vendors_on_time_worst": ("on_time_rate", "ASC", 5),
    "rank_vendors_rejection_best": ("rejection_rate", "ASC", 5),
    "rank_vendors_rejection_worst": ("rejection_rate", "DESC", 5),
    "rank_vendors_cycle_time_best": ("avg_cycle_time_days", "ASC", 3),
    "rank_vendors_cycle_time_worst": ("avg_cycle_time_days", "DESC", 3),
    "rank_vendors_unknown_metric": ("otif_rate", "DESC", 5),
}.items():
    twin(_name, ranked(*_ranked))
twin(
    "rank_vendors_function",
    f"""SELECT 'otif worst' AS ranking, * FROM ({ranked("otif_rate", "ASC", 5)})
        UNION ALL SELECT 'cycle_time best', * FROM ({ranked("avg_cycle_time_days", "ASC", 3)})""",
)
whole_view(
    "gold_monthly_cashflow",
    "cash_gold",
    """* REPLACE (CAST(net_cashflow AS DOUBLE) AS net_cashflow, CAST(total_inflow AS DOUBLE) AS total_inflow,
                  CAST(total_outflow AS DOUBLE) AS total_outflow)""",
)
twin(
    "cashflow_profile",
    """SELECT COUNT(DISTINCT company_code) AS n_company_codes, COUNT(DISTINCT currency) AS n_currencies,
              MIN(cashflow_month) AS earliest_month, MAX(cashflow_month) AS latest_month, COUNT(*) AS total_rows FROM @cash_gold""",
)
twin(
    "cashflow_by_company",
    """SELECT company_code, currency, COUNT(*) AS months, CAST(ROUND(SUM(net_cashflow), 0) AS DOUBLE) AS total_net
       FROM @cash_gold GROUP BY company_code, currency""",
)
whole_view("cashflow_summary", "company_totals")
twin(
    "rank_companies",
    """SELECT row_number() OVER (ORDER BY net_cashflow DESC, company_code, currency) AS rank_position, company_code, currency,
              months, net_cashflow
       FROM @company_totals QUALIFY rank_position <= 5""",
)
twin(
    "cashflow_functions",
    """SELECT rank_position, t.* FROM @company_totals t JOIN (
           SELECT company_code, row_number() OVER (ORDER BY net_cashflow, company_code, currency) AS rank_position
           FROM @company_totals QUALIFY rank_position <= 5) USING (company_code)""",
)
twin(
    "key_overlap",
    """SELECT *, shared_keys > 0 AS joinable FROM (
           SELECT 'vendor lines / suppliers' AS pair,
                  (SELECT COUNT(DISTINCT vendor_id) FROM @vendor_lines) AS left_keys,
                  (SELECT COUNT(DISTINCT s_suppkey) FROM supplier) AS right_keys,
                  (SELECT COUNT(DISTINCT s_suppkey) FROM supplier
                   WHERE CAST(s_suppkey AS VARCHAR) IN (SELECT vendor_id FROM @vendor_lines)) AS shared_keys,
                  (SELECT COUNT(*) FROM @vendor_lines
                   WHERE vendor_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)) AS left_rows_matched,
                  (SELECT COUNT(*) FROM supplier
                   WHERE CAST(s_suppkey AS VARCHAR) IN (SELECT vendor_id FROM @vendor_lines)) AS right_rows_matched
           UNION ALL
           SELECT 'sales / customers',
                  (SELECT COUNT(DISTINCT "customerID") FROM @sales_transactions),
                  (SELECT COUNT(DISTINCT "customerID") FROM @sales_customers),
                  (SELECT COUNT(*) FROM (SELECT "customerID" FROM @sales_transactions
                   INTERSECT SELECT "customerID" FROM @sales_customers WHERE "customerID" IS NOT NULL)),
                  (SELECT COUNT(*) FROM @sales_transactions
                   WHERE "customerID" IN (SELECT "customerID" FROM @sales_customers WHERE "customerID" IS NOT NULL)),
                  (SELECT COUNT(*) FROM @sales_customers
                   WHERE "customerID" IN (SELECT "customerID" FROM @sales_transactions)))""",
)

# ---- table helpers --------------------------------------------------------------
whole_view("conditional_update", "governed")
whole_view("partition_update", "governed")


# Fixed value: the columns of the test tables and their types.
TEST_COLUMNS = {
    "region": "r_regionkey:int r_name:string",
    "nation": "n_nationkey:int n_name:string n_regionkey:int",
    "customer": "c_custkey:bigint c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string",
    "supplier": "s_suppkey:bigint s_name:string s_nationkey:int s_acctbal:double",
    "part": "p_partkey:bigint p_name:string p_brand:string p_type:string p_size:int p_retailprice:double",
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus:string "
    "o_totalprice:double o_orderdate:timestamp_ntz o_orderpriority:string",
    "lineitem": "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double "
    "l_extendedprice:double l_discount:double l_tax:double l_returnflag:string l_linestatus:string l_shipdate:timestamp_ntz",
    "events": "event_id:bigint ts:timestamp_ntz user_id:bigint event_type:string value:double props:string",
    "documents": "doc_id:bigint text:string lang:string source:string n_chars:bigint",
    "embeddings": "vec_id:bigint embedding:array<float> label:int",
    "pages": "page_id:bigint url:string html:string",
    "benchmark": "item_id:bigint text:string",
    "labels": "doc_id:bigint quality:int toxic:int",
    "conversations": "conv_id:bigint turn:bigint role:string text:string",
}


def shown(column: str, kind: str) -> str:
    if kind == "string":
        return f"substring({column}, 1, 40)"
    if kind == "double":
        return f"CAST(CAST({column} AS DECIMAL(30,6)) AS VARCHAR)"
    if kind == "timestamp_ntz":
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    if kind.startswith("array"):
        return f"'list of ' || len({column})"
    return f"CAST({column} AS VARCHAR)"


def profile_twin() -> str:
    told = []
    for table, said in TEST_COLUMNS.items():
        columns = [c.split(":") for c in said.split()]
        first = f"SELECT * FROM {table} ORDER BY {', '.join(f'{c} NULLS FIRST' for c, _ in columns)} LIMIT 5"
        told += [
            f"""SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS column_type,
                       (SELECT COUNT(*) FROM {table}) AS n_rows, (SELECT COUNT(*) - COUNT({c}) FROM {table}) AS n_null, NULL AS error,
                       (SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT coalesce({shown(c, kind)}, 'NULL') AS v FROM ({first}))) AS sample"""
            for c, kind in columns
        ]
    return " UNION ALL ".join(told) + " UNION ALL SELECT 'no_such_table', NULL, NULL, NULL, NULL, 'PATH_NOT_FOUND', NULL"


twin("table_profile", profile_twin())
whole_view("received_share", "vendor_gold")
twin(
    "switched_table",
    """SELECT 'before' AS reader, COUNT(*) AS n_rows, CAST(SUM(amount) AS DOUBLE) AS amount FROM @payments
       UNION ALL SELECT 'after', COUNT(*), CAST(SUM(amount) AS DOUBLE) FROM @payments WHERE status = 'completed'""",
)

# ---- planner --------------------------------------------------------------------
whole_view("resolve_destination", "resolved")
twin(
    "find_properties",
    """SELECT request_id, rank, property_id, title, property_type, base_price, bedrooms, max_guests FROM (
           SELECT c_custkey AS request_id, p.*,
                  row_number() OVER (PARTITION BY c_custkey ORDER BY base_price, property_id) AS rank
           FROM customer JOIN @properties p ON destination_id = c_nationkey AND base_price <= abs(c_acctbal) / (1 + c_custkey % 7))
       WHERE rank <= 6""",
)
twin(
    "budget_check",
    """SELECT *, CAST(base_price AS DOUBLE) AS nightly_price, CAST(base_price * nights AS DOUBLE) AS estimated_accommodation,
              base_price * nights <= budget AS within_budget, ROUND(budget - base_price * nights, 2) AS remaining
       FROM (SELECT booking_id, CAST(guests_count AS BIGINT) AS guests_count, date_diff('day', check_in, check_out) AS nights,
                    base_price, CAST(total_amount AS DOUBLE) AS budget
             FROM @bookings LEFT JOIN @properties USING (property_id) WHERE total_amount > 0 AND check_out > check_in)""",
)
twin(
    "plan_trips",
    """SELECT s.request_id, s.plan_status, k.destination, c.rank, c.property_id, c.title, c.base_price AS nightly_price,
              ROUND(c.base_price * c.nights, 2) AS estimated_accommodation, ROUND(c.budget - c.base_price * c.nights, 2) AS remaining,
              c.base_price * c.nights <= c.budget AS within_budget,
              CASE WHEN s.plan_status = 'planned' THEN k.context END AS context
       FROM @plan_status s LEFT JOIN @guide_cards k USING (destination_id)
       LEFT JOIN @candidates c ON c.request_id = s.request_id AND c.rank <= 6""",
)


def plan_replies(wording: str, written: str | None = None) -> str:
    say = {k: text(v) for k, v in WORDING[wording].items()}
    if written:
        say["end"] = f"CASE WHEN s.request_id % 2 = 0 THEN {written} ELSE {say['end']} END"
    return f"""
        SELECT s.request_id, s.plan_status, CASE s.plan_status
            WHEN 'unknown' THEN 'I can only plan for these ' || (SELECT COUNT(*) FROM @destinations) || {say['unknown_1']}
                || (SELECT string_agg(destination, ', ' ORDER BY destination) FROM @destinations) || {say['unknown_2']}
                || coalesce(s.destination_text, '') || ''' is not one of them.'
            WHEN 'ask_city' THEN array_to_string(list_transform(range(1, length(s.destination_text) + 1), lambda i:
                CASE WHEN i = 1 OR NOT regexp_matches(s.destination_text[i - 1], '\\p{{L}}')
                     THEN upper(s.destination_text[i]) ELSE lower(s.destination_text[i]) END), '')
                || {say['several']} || (SELECT string_agg(destination, ', ' ORDER BY d.destination_id) FROM @destinations d
                WHERE lower(d.country) = lower({strip('s.destination_text')})) || '. Please ask for one of them.'
            WHEN 'no_properties' THEN 'For ' || k.destination || {say['nothing_1']} || format('{{:.0f}}', s.budget) || ' over '
                || s.nights || {say['nothing_2']} || format('{{:.0f}}', s.budget / s.nights) || {say['nothing_3']}
            ELSE 'TRIP PLAN — ' || k.destination || ', ' || k.destination_country || chr(10) || s.nights || ' nights, budget '
                || format('{{:.0f}}', s.budget) || chr(10) || chr(10) || 'Accommodation options within budget:' || chr(10)
                || o.lines || {say['end']} END AS reply
        FROM @plan_status s LEFT JOIN @cards k USING (destination_id)
        LEFT JOIN (
            SELECT request_id, string_agg('  [' || CASE WHEN base_price * nights <= budget THEN 'OK' ELSE 'OVER' END || '] '
                || title || {say['before_type']} || property_type || ', ' || bedrooms || ' bed) — ' || format('{{:.0f}}', base_price)
                || '/night x ' || nights || ' = ' || format('{{:.0f}}', base_price * nights) || ', leaves '
                || format('{{:.0f}}', ROUND(budget - base_price * nights, 2)), chr(10) ORDER BY rank) AS lines
            FROM @candidates WHERE rank <= 6 GROUP BY request_id
        ) o USING (request_id)"""


twin("plan_texts", plan_replies("planner"))
MISSING = f"""list_filter([CASE WHEN coalesce(destination, '') = '' THEN {text(ASK_DESTINATION)} END,
              CASE WHEN coalesce(nights, 0) = 0 THEN {text(ASK_NIGHTS)} END,
              CASE WHEN coalesce(budget, 0) = 0 THEN {text(ASK_BUDGET)} END], lambda m: m IS NOT NULL)"""
VIEWS["asked_slots"] = f"""
        SELECT *, coalesce(array_to_string({MISSING}, ', and '), '') AS missing FROM @slots"""
ASK_BACK = f"{text(ASK_PREFIX)} || missing || {text(ASK_EXAMPLE)}"
twin("request_slots", f"SELECT *, CASE WHEN missing <> '' THEN {ASK_BACK} END AS question_back FROM @asked_slots")
twin(
    "chat_replies",
    f"""SELECT message_id, {ASK_BACK} AS reply FROM @asked_slots WHERE missing <> ''
        UNION ALL
        SELECT request_id, 'ASSISTANT:' || chr(10) || reply || {text(CHAT_FLIGHT_NOTE)} FROM ({plan_replies("chat")})""",
    trip_requests="SELECT * FROM @chat_requests",
)
twin(
    "plan_texts_worded",
    plan_replies(
        "planner",
        """chr(10) || chr(10) || repeat('-', 60) || chr(10) || 'PLANNER:' || chr(10) || 'Take the first one, it is the cheapest.'
           || chr(10) || chr(10) || '(Note: flights are not included — no flight data on this tier.)'""",
    ),
)
twin(
    "place_lists",
    """SELECT '' AS list_key, destination_id, destination FROM @places
       UNION ALL SELECT lower(country), destination_id, destination FROM @places WHERE country <> ''""",
)
REPLY_SLOTS = """SELECT request_id AS message_id, request_id % 4 < 2 AS readable, destination_text AS destination, nights, budget
       FROM @trip_requests"""
twin(
    "chat_replies_from_replies",
    f"""SELECT message_id, CASE WHEN readable THEN {text(ASK_PREFIX)} || missing || {text(ASK_EXAMPLE)} ELSE
              'ASSISTANT: Sorry, I couldn''t understand that (no readable details). Try e.g. ''4 days in Paris with a budget of 2000 euros''.' END AS reply
        FROM (SELECT *, coalesce(array_to_string({MISSING}, ', and '), '') AS missing FROM ({REPLY_SLOTS})) WHERE NOT readable OR missing <> ''
        UNION ALL
        SELECT request_id, 'ASSISTANT:' || chr(10) || reply || {text(CHAT_FLIGHT_NOTE)} FROM ({plan_replies("chat")})
        WHERE request_id IN (SELECT message_id FROM (SELECT *, coalesce(array_to_string({MISSING}, ', and '), '') AS missing FROM ({REPLY_SLOTS}))
                             WHERE readable AND missing = '')""",
)
twin(
    "parse_slot_replies",
    """SELECT request_id AS message_id, request_id % 4 < 2 AS readable,
              CASE WHEN request_id % 4 < 2 THEN destination_text END AS destination,
              CASE WHEN request_id % 4 < 2 THEN nights END AS nights, CASE WHEN request_id % 4 < 2 THEN budget END AS budget
       FROM @trip_requests""",
)

# ---- texts ----------------------------------------------------------------------
twin("doc_lengths", "SELECT guide_id, length(description) AS n_chars, substring(description, 1, 1200) AS preview FROM @guides")
twin("doc_length_summary", "SELECT COUNT(*) AS n_texts, MAX(length(description)) AS longest FROM @guides")
whole_view("chunk_documents", "chunks")
VIEWS["guide_turns"] = """
        SELECT conv_id, turn, doc_id AS guide_id, c.text FROM conversations c
        JOIN documents ON doc_id % (SELECT MAX(conv_id) + 1 FROM conversations) = conv_id WHERE role = 'user'"""
twin(
    "retrieve_chunks",
    r"""SELECT q.conv_id, q.turn, q.guide_id, coalesce(substring(coalesce(b.context, o.chunk), 1, 1800), '') AS context
        FROM @guide_turns q
        LEFT JOIN @chunks o ON o.guide_id = q.guide_id AND o.chunk_no = 0
        LEFT JOIN (
            SELECT guide_id, turn, string_agg(chunk, chr(10) || chr(10) ORDER BY hits DESC, chunk_no) AS context
            FROM (
                SELECT *, row_number() OVER (PARTITION BY guide_id, turn ORDER BY hits DESC, chunk_no) AS rn
                FROM (
                    SELECT guide_id, turn, chunk_no, COUNT(*) AS hits
                    FROM (SELECT DISTINCT conv_id, turn, unnest(string_split_regex(lower(text), '\s+')) AS word
                          FROM conversations WHERE role = 'user') w
                    JOIN (SELECT DISTINCT guide_id % (SELECT MAX(conv_id) + 1 FROM conversations) AS conv_id, guide_id, chunk_no, word
                          FROM (SELECT guide_id, chunk_no, unnest(string_split_regex(lower(chunk), '\s+')) AS word FROM @chunks)
                          WHERE length(word) > 3) c USING (conv_id, word)
                    GROUP BY guide_id, turn, chunk_no)) JOIN @chunks USING (guide_id, chunk_no)
            WHERE rn <= 2 GROUP BY guide_id, turn
        ) b ON b.guide_id = q.guide_id AND b.turn = q.turn""",
)


def routed(column: str, property_words: list[str]) -> str:
    low = f"lower(coalesce({column}, ''))"
    return f"""CASE WHEN {any_of(low, P.TREND_WORDS)} THEN 'monthly_trend'
                    WHEN {any_of(low, property_words)} THEN 'revenue_by_property_type'
                    WHEN {any_of(low, P.PAYMENT_WORDS)} THEN 'payment_methods' ELSE 'top_destinations' END"""


OPEN_ROUTE, GUARDED_ROUTE = routed("question", P.PROPERTY_WORDS), routed("question", P.PROPERTY_WORDS_GUARDED)
VIEWS["screened"] = f"""
        SELECT question_id, question, CASE WHEN q = '' THEN {text(P.REASON_EMPTY_QUESTION)}
               WHEN length(q) > 500 THEN {text(P.REASON_TOO_LONG)}
               WHEN {any_of("lower(q)", P.BLOCKED_WORDS)} THEN {text(P.REASON_BLOCKED)}
               WHEN NOT {any_of("lower(q)", P.TOPIC_WORDS)} THEN {text(P.REASON_OFF_TOPIC)} ELSE 'ok' END AS reason
        FROM (SELECT *, {strip("question")} AS q FROM @questions)"""
def choices(fallback: str) -> str:
    return rf"""
        SELECT question_id, ok AS from_reply, CASE WHEN ok THEN body->>'$.tool' ELSE {fallback} END AS tool,
               CASE WHEN ok AND json_keys(body->'$.args') = CASE body->>'$.tool' WHEN 'top_destinations' THEN ['limit']
                                                                 WHEN 'monthly_trend' THEN ['months'] END
                    THEN TRY_CAST(coalesce(body->>'$.args.limit', body->>'$.args.months') AS BIGINT) END AS rows_wanted
        FROM (SELECT *, CASE WHEN json_valid(cut) THEN CAST(cut AS JSON) END AS body, json_valid(cut) AND cut <> '' AS ok
              FROM (SELECT *, regexp_extract(reply, '(?s)\{{.*\}}') AS cut FROM @model_replies))"""


VIEWS["choices"], VIEWS["guarded_choices"] = choices(OPEN_ROUTE), choices(GUARDED_ROUTE)
# tool texts per wanted number of rows (NULL for the default)
VIEWS["sized_texts"] = f"""
        SELECT tool, NULL AS rows_wanted, tool_text FROM @tool_texts
        UNION ALL
        SELECT tool, n, heading || chr(10) || string_agg(line, chr(10) ORDER BY shown)
        FROM (SELECT 'top_destinations' AS tool, {text(P.TOOL_HEADINGS['top_destinations'])} AS heading, line, place, place AS shown
              FROM (SELECT line, row_number() OVER (ORDER BY total_revenue DESC, destination, country) AS place FROM @all_destination_lines)
              UNION ALL
              SELECT 'monthly_trend', {text(P.TOOL_HEADINGS['monthly_trend'])}, line, place, -place
              FROM (SELECT line, row_number() OVER (ORDER BY booking_month DESC) AS place FROM @all_month_lines))
        JOIN (SELECT unnest([2, 3, 8, 1000000000]) AS n) ON place <= n
        GROUP BY tool, heading, n"""
OPEN_REPLY = f"""CASE WHEN tool_text IS NULL THEN {text(P.NO_TOOL_OPEN)} ELSE 'AGENT (raw tool data):' || chr(10) || tool_text END"""
twin("route_questions", f"SELECT question_id, {OPEN_ROUTE} AS tool, {GUARDED_ROUTE} AS guarded_tool FROM @questions")
twin("input_guardrail", "SELECT question_id, reason = 'ok' AS allowed, reason FROM @screened")
twin(
    "parse_tool_choices",
    """SELECT *, tool IN ('top_destinations', 'monthly_trend', 'revenue_by_property_type', 'payment_methods') AS known FROM @choices""",
)
twin(
    "agent_answers",
    f"""SELECT question_id, tool, {OPEN_REPLY} AS answer
        FROM (SELECT question_id, {OPEN_ROUTE} AS tool FROM @questions) LEFT JOIN @tool_texts USING (tool)""",
)
twin(
    "agent_answers_worded",
    f"""SELECT question_id, tool, CASE WHEN tool_text IS NULL THEN {text(P.NO_TOOL_OPEN)}
               WHEN length(question_id) % 3 = 1 AND question IS NOT NULL
                    THEN 'AGENT: ' || {strip("'  The data name these: ' || substring(question, 1, 60) || ' '")}
               WHEN length(question_id) % 3 = 2 THEN 'AGENT: Revenue by destination (total, bookings, average).'
               ELSE 'AGENT (raw tool data):' || chr(10) || tool_text END AS answer
        FROM (SELECT question_id, question, {OPEN_ROUTE} AS tool FROM @questions) LEFT JOIN @tool_texts USING (tool)""",
)
twin(
    "agent_answers_from_replies",
    f"""SELECT question_id, c.tool, {OPEN_REPLY} AS answer FROM @choices c
        LEFT JOIN @sized_texts s ON s.tool = c.tool AND s.rows_wanted IS NOT DISTINCT FROM c.rows_wanted""",
)
twin(
    "guarded_answers_from_replies",
    f"""SELECT q.question_id, reason = 'ok' AS allowed, CASE WHEN reason = 'ok' THEN c.tool END AS tool,
               CASE WHEN reason <> 'ok' THEN {text(P.REFUSED_PREFIX)} || reason
                    WHEN tool_text IS NULL THEN {text(P.NO_TOOL_GUARDED)} ELSE 'AGENT: ' || tool_text END AS reply
        FROM @screened q JOIN @guarded_choices c USING (question_id)
        LEFT JOIN @sized_texts s ON s.tool = c.tool AND s.rows_wanted IS NOT DISTINCT FROM c.rows_wanted""",
)
twin(
    "guarded_answers",
    f"""SELECT question_id, reason = 'ok' AS allowed, tool,
               CASE WHEN reason <> 'ok' THEN {text(P.REFUSED_PREFIX)} || reason ELSE 'AGENT: ' || tool_text END AS reply
        FROM (SELECT *, CASE WHEN reason = 'ok' THEN {GUARDED_ROUTE} END AS tool FROM @screened) LEFT JOIN @tool_texts USING (tool)""",
)
twin(
    "guarded_answers_worded",
    rf"""SELECT question_id, reason = 'ok' AS allowed, tool,
                CASE WHEN reason <> 'ok' THEN {text(P.REFUSED_PREFIX)} || reason
                     WHEN NOT EXISTS (
                         SELECT 1 FROM (SELECT unnest(string_split_regex(ans, '\s+')) AS w) a,
                                       (SELECT unnest(string_split_regex(tool_text, '\s+')) AS w) d
                         WHERE length(a.w) > 4 AND length(d.w) > 4 AND lower(trim(a.w, '.,:%$()')) = lower(trim(d.w, '.,:%$()')))
                     THEN {text(P.NO_RELIABLE_ANSWER)} ELSE 'AGENT: ' || ans END AS reply
         FROM (SELECT *, coalesce(CASE length(question_id) % 3 WHEN 1 THEN '  The data name these: ' || substring(question, 1, 60) || ' '
                                       WHEN 2 THEN 'Revenue by destination (total, bookings, average).' END, tool_text) AS ans
               FROM (SELECT *, CASE WHEN reason = 'ok' THEN {GUARDED_ROUTE} END AS tool FROM @screened) LEFT JOIN @tool_texts USING (tool))""",
)
twin(
    "output_guardrail",
    rf"""SELECT answer_id, reason = 'ok' AS allowed, reason FROM (
             SELECT answer_id, CASE WHEN {strip("answer")} = '' THEN {text(P.REASON_EMPTY_ANSWER)}
                    WHEN NOT EXISTS (
                        SELECT 1 FROM (SELECT unnest(string_split_regex(answer, '\s+')) AS w) a,
                                      (SELECT unnest(string_split_regex(tool_text, '\s+')) AS w) d
                        WHERE length(a.w) > 4 AND length(d.w) > 4 AND lower(trim(a.w, '.,:%$()')) = lower(trim(d.w, '.,:%$()')))
                    THEN {text(P.REASON_NOT_GROUNDED)} ELSE 'ok' END AS reason
             FROM (SELECT q.conv_id || '-' || q.turn AS answer_id, a.text AS answer, q.text AS tool_text
                   FROM conversations q LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
                   WHERE q.role = 'user'))""",
)

# ---- evaluation -----------------------------------------------------------------
twin("parse_responses", "SELECT case_id, ok, error, answer, tool AS tools_called, tool_args FROM @replies")
whole_view("eval_scores", "scores_v2")
whole_view("eval_scores_v1", "scores_v1")
PHRASE_LIST = "[" + ", ".join(f"'{p}'" for p in P.GOVERNANCE_PHRASES) + "]"
twin(
    "eval_details",
    f"""SELECT case_id, 'responded' AS dimension, responded AS passed, coalesce(error, 'non-empty answer returned') AS detail
        FROM @scores_v2 JOIN @replies USING (case_id)
        UNION ALL
        SELECT case_id, 'routing', routing, 'expected ''' || expect_tool || ''' in [' || CASE WHEN tool = '' THEN '' ELSE '''' || tool || '''' END || ']'
        FROM @scores_v2 JOIN @replies USING (case_id) JOIN @governed USING (case_id)
        UNION ALL
        SELECT case_id, 'correctness', correctness, CASE WHEN expect_contains = 'GOVERNANCE'
               THEN {text(f"governance warning present (any of {PHRASE_LIST})")}
               ELSE 'expected answer to contain ''' || expect_contains || '''' END
        FROM @scores_v2 JOIN @governed USING (case_id)""",
)
whole_view("eval_history", "history")
whole_view("stored_history", "history")
twin(
    "eval_summary",
    """SELECT run_id, COUNT(*) AS n_total, COUNT(*) FILTER (overall_pass) AS n_passed,
              ROUND(100.0 * COUNT(*) FILTER (overall_pass) / COUNT(*), 0) AS pct FROM @history GROUP BY run_id""",
)

# ---- customer features and model -------------------------------------------------
whole_view("customer_features")
whole_view("spend_tier_cuts", "cuts")
whole_view("spend_tier", "tiers")
twin(
    "spend_tier_sketch",
    "SELECT COUNT(*) AS n_customers, true AS low_within_error, true AS high_within_error FROM @customer_features",
)
whole_view("train_test_split", "split", '"customerID", spend_tier, split')
whole_view("classification_metrics", "runs")
twin("best_run", "SELECT * FROM @runs ORDER BY f1 DESC, run_id LIMIT 1")
twin(
    "promotion_gate",
    """SELECT r.*, c.f1 AS champion_f1, r.f1 > c.f1 AS promote
       FROM @runs r, (SELECT f1 FROM @runs WHERE run_id = 'by_products') c WHERE r.run_id <> 'by_products'""",
)
# Facts that hold of any good fit, not the fit.
TEST_ROWS = "(SELECT COUNT(*) FROM @split WHERE split = 'test')"
twin(
    "spend_tier_model",
    f"""SELECT 'forest_' || trees || '_' || depth AS run_id, {TEST_ROWS} AS n, trees, depth,
              (SELECT COUNT(DISTINCT spend_tier) FROM @split) AS n_classes, true AS known_classes, true AS beats_largest_class
       FROM (VALUES (50, 4), (200, 8)) AS v(trees, depth)""",
)
twin("batch_score", """SELECT "customerID", spend_tier, true AS has_tier FROM @tiers""")
twin(
    "retrain_runs",
    f"""SELECT run_id, trees, depth, {TEST_ROWS} AS n, true AS one_champion, true AS champion_is_best, true AS has_metrics
       FROM (VALUES ('r1', 5, 2), ('r2', 5, 2), ('r3', 20, 6)) AS v(run_id, trees, depth)""",
)
