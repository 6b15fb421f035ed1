"""The same derivations in ANSI SQL, for value checks in another engine.

STEPS are named common table expressions over the supplied tables; `compose` puts the
ones a query mentions in front of it.
"""

from __future__ import annotations

import re

from plazaflow.plans.bindings import CONFIG, END, START, VISIT_SHIFT_DAYS


def _ramadan() -> str:
    return " OR ".join(
        f"full_date BETWEEN DATE '{p['start']}' AND DATE '{p['end']}'" for p in CONFIG["calendar"]["ramadan_periods"]
    )


def _sql_map(pairs: dict[str, str], names: str) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())
    return f"SELECT * FROM (VALUES {rows}) t({names})"


def pct(num: str, den: str, scale: int = 1) -> str:
    """100 * num / den half up at `scale` decimals in whole-number arithmetic (thousandths of both sides)."""
    n, d = f"CAST(round(1000 * ({num})) AS HUGEINT)", f"CAST(round(1000 * ({den})) AS HUGEINT)"
    up = 10**scale
    return (
        f"(CASE WHEN {den} <> 0 THEN sign({num}) * ((200 * {up} * abs({n}) + {d}) // (2 * {d})) / {float(up)} END)"
    )


STEPS: dict[str, str] = {
    "cal": f"""
        SELECT full_date, CAST(year(full_date)*10000 + month(full_date)*100 + day(full_date) AS BIGINT) AS date_key,
          CAST(date_trunc('month', full_date) AS DATE) AS month_start,
          CAST(year(full_date)*100 + month(full_date) AS BIGINT) AS month_key,
          dayname(full_date) IN ('Friday', 'Saturday') AS is_weekend,
          ({_ramadan()}) AS is_ramadan,
          CASE WHEN month(full_date) = 2 AND day(full_date) = 25 THEN 'National Day'
               WHEN month(full_date) = 2 AND day(full_date) = 26 THEN 'Liberation Day' END AS holiday_name,
          CASE WHEN month(full_date)*100 + day(full_date) >= 1015 OR month(full_date)*100 + day(full_date) <= 331
               THEN 'winter_peak'
               WHEN month(full_date)*100 + day(full_date) BETWEEN 601 AND 831 THEN 'summer_trough'
               ELSE 'shoulder' END AS season
        FROM (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS full_date)""",
    "d_venue": """
        SELECT 'V0' || (r_regionkey + 1) AS venue_id, r_name AS venue_name, 'own' AS venue_type,
          CASE r_regionkey WHEN 0 THEN 'south_east' WHEN 1 THEN 'west_strip_south' WHEN 2 THEN 'north_centre'
               WHEN 3 THEN 'north_east' END AS zone,
          CASE WHEN r_regionkey < 3 THEN 'Main Gate' WHEN r_regionkey = 3 THEN 'Equestrian Gate' END AS gate_proximity
        FROM region""",
    "d_gate": """
        SELECT 'G0' || (r_regionkey + 1) AS gate_id, 'Gate ' || (r_regionkey + 1) AS gate_name,
          CASE WHEN r_regionkey < 2 THEN 'Main Gate' WHEN r_regionkey < 4 THEN 'Equestrian Gate' END AS gate_label,
          CASE WHEN r_regionkey < 2 THEN 'west_strip' WHEN r_regionkey < 4 THEN 'north_east' END AS zone,
          CASE WHEN r_regionkey IN (2, 3) THEN 'V04' END AS primary_venue_served
        FROM region""",
    "d_product": """
        SELECT 'P' || p_partkey AS product_id, 'sku_' || p_partkey AS product_code,
          p_name || ' ' || p_partkey AS product_name,
          CASE WHEN p_partkey % 10 <> 9 THEN 'V0' || (1 + p_partkey % 5) END AS venue_id,
          CASE WHEN p_partkey % 4 = 0 THEN 'ticket' ELSE lower(p_type) END AS category,
          CAST(p_retailprice AS DECIMAL(12,3)) AS unit_price_kwd
        FROM part""",
    "d_tenant": """
        SELECT 'T' || s_suppkey AS tenant_id, s_name AS tenant_name, 'cat_' || ((s_nationkey + v - 1) % 5) AS category,
          'U-' || s_suppkey AS unit_no,
          CAST(CASE WHEN s_suppkey % 33 = 32 THEN 0 ELSE 40 + s_suppkey % 160 END AS DECIMAL(8,2)) AS unit_sqm,
          CAST(500 + s_suppkey % 20 * 50 AS DECIMAL(12,3)) AS base_rent_kwd,
          CAST(5 + s_suppkey % 6 AS DECIMAL(5,2)) AS turnover_rent_pct,
          CAST(300000 + s_suppkey % 10 * 20000 AS DECIMAL(12,3)) AS turnover_threshold_kwd, 'active' AS status,
          CASE WHEN v = 2 THEN DATE '1998-06-01' WHEN s_suppkey % 25 = 7 THEN DATE '1996-01-01'
               ELSE DATE '1994-01-01' END AS valid_from,
          CASE WHEN s_suppkey % 10 = 0 AND v = 1 THEN DATE '1998-05-31' END AS valid_to
        FROM supplier, (VALUES (1), (2)) t(v) WHERE v = 1 OR s_suppkey % 10 = 0""",
    "s_pos": """
        WITH once AS (
          SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'RF' ELSE 'INV' END || l_orderkey AS invoice_id,
            'S' || l_orderkey AS sales_id,
            CAST(CASE WHEN l_returnflag = 'R' THEN l_shipdate ELSE o_orderdate END AS DATE) AS invoice_date,
            'P' || l_partkey AS item_id, 'Item ' || l_partkey AS item_name,
            CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(10,2)) AS qty,
            CAST(l_extendedprice AS DECIMAL(12,3)) AS sales_price_kwd,
            CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(12,3))
              AS line_amount_kwd,
            'V0' || (1 + l_suppkey % 4) AS venue_id,
            CASE WHEN l_linenumber % 2 = 1 THEN 'C' || o_custkey END AS cust_account,
            CASE WHEN l_linestatus = 'O' THEN 'card' ELSE 'cash' END AS payment_mode, l_linenumber AS minute
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        landed AS (
          SELECT once.*, 'd365_salesline_' || strftime(invoice_date, '%Y%m%d') || suffix || '.csv' AS source_file
          FROM once, (VALUES (''), ('_again')) c(suffix) WHERE suffix = '' OR l_orderkey % 50 = 0)
        SELECT *, qty < 0 AS is_refund,
          row_number() OVER (PARTITION BY invoice_id, sales_id, invoice_date, item_id, qty, sales_price_kwd,
            line_amount_kwd, minute, payment_mode, cust_account ORDER BY source_file, item_name, venue_id) > 1
            AS is_duplicate
        FROM landed""",
    "f_pos": """
        SELECT p.*, date_key FROM s_pos p JOIN cal ON invoice_date = full_date WHERE NOT is_duplicate""",
    "s_foot0": """
        SELECT gate_id, d AS footfall_date, hour, dayname(d) IN ('Friday', 'Saturday') AS is_weekend,
          CASE WHEN e % 97 <> 13 THEN n * f END AS raw_in, CASE WHEN e % 97 <> 41 THEN (n - k) * f END AS raw_out, e
        FROM (
          SELECT 'G0' || (1 + l_suppkey % 4) AS gate_id, CAST(l_shipdate AS DATE) AS d, 9 + l_partkey % 4 * 3 AS hour,
            CAST(sum(l_quantity) AS BIGINT) AS n, count(*) AS k,
            CASE WHEN l_suppkey % 4 = 3 AND CAST(l_shipdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-14'
                 THEN 2 ELSE 1 END AS f, CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS e
          FROM lineitem GROUP BY ALL)""",
    "s_foot1": """
        SELECT *, coalesce(raw_in, round_even(avg(raw_in) OVER w, 0)) AS fill_in,
          coalesce(raw_out, round_even(avg(raw_out) OVER w, 0)) AS fill_out,
          raw_in IS NULL OR raw_out IS NULL AS is_imputed
        FROM s_foot0
        WINDOW w AS (PARTITION BY gate_id, hour ORDER BY footfall_date ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)""",
    "s_foot": """
        WITH m AS (
          SELECT *, CASE WHEN count(fill_in) OVER w >= 15 THEN median(fill_in) OVER w END AS med_in,
            CASE WHEN count(fill_out) OVER w >= 15 THEN median(fill_out) OVER w END AS med_out
          FROM s_foot1
          WINDOW w AS (PARTITION BY gate_id, hour, is_weekend ORDER BY footfall_date
                       ROWS BETWEEN 30 PRECEDING AND 30 FOLLOWING)),
        o AS (
          SELECT *, coalesce(fill_in / nullif(med_in, 0) > 1.5, false) AS high_in,
            coalesce(fill_out / nullif(med_out, 0) > 1.5, false) AS high_out FROM m)
        SELECT gate_id, footfall_date, hour, is_weekend, e,
          CAST(CASE WHEN high_in THEN round_even(med_in, 0) ELSE fill_in END AS BIGINT) AS count_in,
          CAST(CASE WHEN high_out THEN round_even(med_out, 0) ELSE fill_out END AS BIGINT) AS count_out,
          is_imputed, high_in OR high_out AS is_outlier_corrected
        FROM o""",
    "f_foot": "SELECT s_foot.*, date_key FROM s_foot LEFT JOIN cal ON footfall_date = full_date",
    "r_filing": """
        WITH base AS (
          SELECT l_suppkey AS s, CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
            CASE WHEN day(l_shipdate) <= 15 THEN 1 ELSE 2 END AS half,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS g
          FROM lineitem GROUP BY ALL),
        spread AS (
          SELECT base.*, year(m)*12 + month(m) AS i, v,
            CAST(CASE WHEN v = 2 THEN g * CAST(1.05 AS DECIMAL(3,2)) ELSE g END AS DECIMAL(12,2)) AS gross
          FROM base, (VALUES (1), (2)) t(v) WHERE v = 1 OR (s + year(m)*12 + month(m)) % 10 = 0)
        SELECT 'T' || s AS tenant_id, m AS sales_month, v, half, s, i,
          CASE WHEN s % 3 <> 1 AND (s + i) % 23 <> 0 THEN gross END AS gross_sales,
          CASE WHEN s % 3 <> 0 THEN CAST(gross * CAST(0.9 AS DECIMAL(2,1)) AS DECIMAL(12,2)) END AS net_sales,
          CASE WHEN (s + i) % 29 = 0 THEN NULL
               WHEN s % 3 = 2 THEN m ELSE CAST(m + to_days(CAST(14 * (half - 1) AS INTEGER)) AS DATE) END AS parsed_date,
          CASE WHEN (s + i) % 41 <> 0
               THEN CAST(last_day(m) + to_days(CAST(5 + (s*7 + i) % 36 + 20 * (v - 1) AS INTEGER)) AS DATE) END
            AS submitted_date
        FROM spread""",
    "s_filing": """
        SELECT tenant_id, sales_month, CAST(v AS BIGINT) AS submission_version, v = 2 AS is_restated,
          CAST(sum(gross_sales) AS DECIMAL(12,3)) AS gross_sales_kwd,
          CAST(sum(net_sales) AS DECIMAL(12,3)) AS net_sales_kwd,
          min(submitted_date) AS submitted_date, CAST(min(submitted_date) - last_day(sales_month) AS BIGINT) AS days_late,
          concat_ws(',', CASE WHEN count(*) FILTER (WHERE parsed_date IS NULL) > 0 THEN 'unparsed_date' END,
            CASE WHEN sum(gross_sales) IS NULL AND sum(net_sales) IS NULL THEN 'no_sales_reported' END) AS dq_flags
        FROM r_filing GROUP BY tenant_id, sales_month, v""",
    "f_tenant": """
        SELECT s.*, t.* EXCLUDE (tenant_id), date_key AS month_date_key, full_date AS month_start,
          submission_version = max(submission_version) OVER (PARTITION BY s.tenant_id, sales_month) AS is_current_version
        FROM s_filing s JOIN d_tenant t ON t.tenant_id = s.tenant_id AND valid_from <= sales_month
          AND (valid_to IS NULL OR sales_month <= valid_to)
        LEFT JOIN cal ON full_date = sales_month""",
    "v_rent": """
        SELECT *, coalesce(gross_sales_kwd, net_sales_kwd) AS sales_kwd,
          CAST(greatest(coalesce(gross_sales_kwd, net_sales_kwd) - turnover_threshold_kwd, 0) * turnover_rent_pct / 100
            AS DECIMAL(18,6)) AS turnover_rent_kwd
        FROM f_tenant WHERE is_current_version AND month_date_key IS NOT NULL""",
    "s_contract": """
        SELECT 'K' || o_orderkey AS contract_id, 'M' || o_custkey AS member_id,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'gym_monthly' WHEN '2' THEN 'gym_annual'
            WHEN '3' THEN 'equestrian_club' WHEN '4' THEN 'horse_boarding' ELSE 'day_member' END AS contract_type,
          'V0' || (1 + o_custkey % 4) AS venue_id, CAST(o_orderdate AS DATE) AS start_date,
          CASE WHEN o_orderstatus <> 'O'
               THEN CAST(o_orderdate + to_days(CAST(o_orderkey % 900 AS INTEGER)) AS DATE) END AS end_date,
          CAST(10 + o_orderkey % 40 AS DECIMAL(12,3)) AS monthly_amount_kwd,
          CASE o_orderstatus WHEN 'P' THEN 'cancelled' WHEN 'F' THEN 'expired' ELSE 'active' END AS status,
          CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 50 = 1 THEN CAST(o_orderdate - INTERVAL 5 DAY AS DATE)
               ELSE CAST(o_orderdate + to_days(CAST(o_orderkey % 900 AS INTEGER)) AS DATE) END END AS cancellation_date,
          CASE WHEN substr(o_orderpriority, 1, 1) = '4' THEN 'S' || (o_orderkey % 20) END AS stable_id,
          CASE WHEN o_custkey % 13 <> 0 THEN 'ph' || (o_custkey // 3) END AS phone_number
        FROM orders""",
    "s_member": """
        SELECT *, CASE WHEN phone_number IS NULL THEN member_id
                  ELSE min(member_id) OVER (PARTITION BY phone_number) END AS canonical_member_id
        FROM s_contract""",
    "f_member": f"""
        WITH months AS (SELECT full_date AS month_date, date_key AS month_date_key FROM cal WHERE day(full_date) = 1),
        c AS (SELECT *, CAST(date_trunc('month', start_date) AS DATE) AS start_month,
                CAST(date_trunc('month', end_date) AS DATE) AS true_end_month,
                least(coalesce(CAST(date_trunc('month', end_date) AS DATE), DATE '{END}'), DATE '{END}') AS capped_end
              FROM s_member),
        x AS (SELECT * FROM c JOIN months ON month_date BETWEEN greatest(start_month, DATE '{START}') AND capped_end)
        SELECT *, month_date = start_month AND start_month >= DATE '{START}' AS is_new,
          month_date = capped_end AND coalesce(true_end_month <= DATE '{END}', false)
            AND status IN ('cancelled', 'expired') AS is_churned,
          CASE WHEN month_date = capped_end AND coalesce(true_end_month <= DATE '{END}', false)
            AND status IN ('cancelled', 'expired') THEN status ELSE 'active' END AS month_status
        FROM x""",
    "s_lesson": """
        SELECT 'L' || l_orderkey || '-' || l_linenumber AS lesson_id, CAST(l_shipdate AS DATE) AS lesson_date,
          '1' || l_linenumber || ':00' AS start_time, 'I' || (l_suppkey % 23) AS instructor_id,
          CASE l_partkey % 3 WHEN 0 THEN 'beginner' WHEN 1 THEN 'intermediate' ELSE 'advanced' END AS level,
          CAST(p_size AS BIGINT) AS capacity, CAST(l_quantity AS BIGINT) AS booked,
          CASE WHEN l_returnflag <> 'A' THEN greatest(CAST(l_quantity AS BIGINT) - l_orderkey % 3, 0) END AS attended,
          'H' || l_linenumber || ',H' || (l_suppkey % 8) AS horse_ids, CAST(l_quantity AS BIGINT) > p_size AS is_overbooked
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "d_instructor": "SELECT 'I' || n_nationkey AS instructor_id, n_name AS instructor_name FROM nation",
    "f_lesson": """
        SELECT l.*, instructor_name, date_key, full_date, month_key, month_start
        FROM s_lesson l LEFT JOIN cal ON lesson_date = full_date LEFT JOIN d_instructor USING (instructor_id)""",
    "d_event": """
        WITH b AS (SELECT *, CAST(DATE '1995-02-01' + to_days(CAST(s_suppkey * 37 % 2200 AS INTEGER)) AS DATE) AS start_date
                   FROM supplier)
        SELECT 'EVT' || s_suppkey AS event_id, 'Launch ' || s_name AS event_name,
          CASE WHEN s_suppkey % 2 = 0 THEN 'bazaar' ELSE 'kids' END AS event_type, start_date,
          CASE WHEN s_suppkey % 17 = 5 THEN CAST(start_date - INTERVAL 1 DAY AS DATE) WHEN s_suppkey % 11 = 3 THEN NULL
               ELSE CAST(start_date + to_days(CAST(s_suppkey % 4 AS INTEGER)) AS DATE) END AS end_date,
          CAST(500 + s_suppkey % 9 * 100 AS BIGINT) AS expected_attendance
        FROM b""",
    "s_weather": """
        SELECT CAST(o_orderdate AS DATE) AS weather_date, CAST(20 + count(*) % 15 AS DOUBLE) AS temp_max_c,
          CAST(10 + count(*) % 7 AS DOUBLE) AS temp_min_c, count(*) % 7 = 0 AS dust_storm_flag,
          count(*) % 10 * 5 / 10 AS rain_mm
        FROM orders GROUP BY 1""",
    "visits": f"""
        SELECT *, CAST((CAST(ts AS DATE) - INTERVAL {VISIT_SHIFT_DAYS} DAY) - to_months(CAST(user_id % 24 AS INTEGER)) AS DATE)
          AS visit_date, CASE user_id % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid_social' WHEN 2 THEN 'direct'
          ELSE 'referral' END AS visit_channel
        FROM events""",
    "s_session": """
        SELECT visit_date AS session_date, visit_channel AS channel,
          CASE WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device, count(*) AS sessions,
          count(*) FILTER (WHERE event_type = 'click') AS engaged_sessions, count(DISTINCT user_id) AS users
        FROM visits WHERE event_type IN ('view', 'click') GROUP BY 1, 2, 3""",
    "f_session": "SELECT s.*, date_key, month_key, full_date FROM s_session s LEFT JOIN cal ON session_date = full_date",
    "s_booking": """
        SELECT 'B' || event_id AS booking_id,
          CAST(visit_date + to_days(CASE WHEN event_id % 97 = 0 THEN 300 ELSE 0 END) AS DATE) AS booking_date,
          strftime(ts, '%H:%M:%S') AS booking_time, 'family_' || (user_id % 8) AS product_code,
          CAST(1 + event_id % 4 AS DECIMAL(10,2)) AS qty,
          CAST(CASE WHEN event_id % 25 = 0 THEN -value ELSE value END AS DECIMAL(12,3)) AS amount_kwd,
          CASE WHEN user_id % 20 = 0 THEN NULL WHEN user_id % 20 = 1 THEN 'partner' ELSE visit_channel END AS channel,
          'C' || user_id AS customer_id,
          CAST(CASE WHEN event_id % 25 = 0 THEN -value ELSE value END AS DECIMAL(12,3)) < 0 AS is_cancelled
        FROM visits WHERE event_type = 'purchase'""",
    "crosswalk": _sql_map(CONFIG["booking_product_family"], "family_code, sku_code"),
    "f_booking": """
        SELECT b.*, sku_code, date_key, month_key FROM s_booking b JOIN cal ON booking_date = full_date
        LEFT JOIN crosswalk ON product_code = family_code""",
    # ---- views
    "daily": """
        SELECT date_key, CAST(sum(count_in) AS BIGINT) AS footfall, bool_or(is_imputed) AS has_imputed_hours,
          bool_or(is_outlier_corrected) AS has_corrected_hours FROM f_foot WHERE date_key IS NOT NULL GROUP BY date_key""",
    "w1": """
        WITH d AS (SELECT full_date, season, is_weekend, is_ramadan, daily.* FROM daily JOIN cal USING (date_key))
        SELECT d.*, wk.footfall AS footfall_week_ago, yr.footfall AS footfall_year_ago, temp_max_c, temp_min_c,
          dust_storm_flag, rain_mm
        FROM d LEFT JOIN d wk ON wk.full_date = d.full_date - 7
        LEFT JOIN d yr ON yr.full_date = CAST(d.full_date - INTERVAL 1 YEAR AS DATE)
        LEFT JOIN s_weather ON weather_date = d.full_date""",
    "w2": """
        SELECT date_key, full_date, season, cal.is_weekend, is_ramadan, zone, gate_label, primary_venue_served,
          CAST(sum(count_in) AS BIGINT) AS footfall, bool_or(is_imputed) AS has_imputed_hours,
          bool_or(is_outlier_corrected) AS has_corrected_hours
        FROM f_foot JOIN d_gate USING (gate_id) JOIN cal USING (date_key) GROUP BY ALL""",
    "w3": """
        WITH e AS (SELECT date_key, gate_label, sum(count_in) AS footfall FROM f_foot JOIN d_gate USING (gate_id)
                   GROUP BY ALL),
        s AS (SELECT date_key, venue_id, sum(line_amount_kwd) AS revenue_kwd,
                count(*) FILTER (WHERE NOT is_refund) AS line_count FROM f_pos GROUP BY ALL)
        SELECT s.date_key, full_date, venue_id, venue_name, venue_type, f.footfall,
          CAST(revenue_kwd AS DOUBLE) AS revenue_kwd, line_count,
          CASE WHEN f.footfall > 0 THEN CAST(revenue_kwd AS DOUBLE) / CAST(f.footfall AS DOUBLE) END
            AS revenue_per_visitor_kwd,
          CASE WHEN f.footfall > 0 THEN CAST(line_count AS DOUBLE) / CAST(f.footfall AS DOUBLE) END AS conversion_rate,
          v.zone, gate_proximity, CAST(e.footfall AS BIGINT) AS entrance_footfall,
          CASE WHEN e.footfall > 0 THEN CAST(revenue_kwd AS DOUBLE) / CAST(e.footfall AS DOUBLE) END
            AS revenue_per_entrance_visitor_kwd,
          CASE WHEN e.footfall > 0 THEN CAST(line_count AS DOUBLE) / CAST(e.footfall AS DOUBLE) END
            AS entrance_conversion_rate
        FROM s JOIN d_venue v USING (venue_id) JOIN daily f ON f.date_key = s.date_key
        LEFT JOIN e ON e.date_key = s.date_key AND gate_label = gate_proximity JOIN cal ON cal.date_key = s.date_key""",
    "w4": """
        WITH days AS (SELECT event_id, date_key, full_date FROM d_event JOIN cal
                      ON full_date BETWEEN start_date AND coalesce(end_date, start_date)),
        sales AS (SELECT date_key, sum(line_amount_kwd) AS sales_kwd FROM f_pos WHERE NOT is_refund GROUP BY 1),
        tot AS (SELECT event_id, count(*) AS event_day_count, CAST(sum(footfall) AS BIGINT) AS total_footfall,
                  CAST(sum(sales_kwd) AS DOUBLE) AS total_sales_kwd
                FROM days LEFT JOIN daily USING (date_key) LEFT JOIN sales USING (date_key) GROUP BY 1),
        base AS (SELECT event_id, CAST(sum(footfall) AS DOUBLE) / nullif(count(footfall), 0) AS baseline_avg_footfall,
                   CAST(sum(sales_kwd) AS DOUBLE) / nullif(count(sales_kwd), 0) AS baseline_avg_sales_kwd
                 FROM d_event e JOIN cal d ON d.full_date BETWEEN start_date - 14 AND start_date - 1
                 LEFT JOIN daily USING (date_key) LEFT JOIN sales USING (date_key)
                 WHERE d.full_date NOT IN (SELECT full_date FROM days) GROUP BY 1)
        SELECT e.*, event_day_count, total_footfall, total_sales_kwd, baseline_avg_footfall, baseline_avg_sales_kwd,
          CAST(total_footfall AS DOUBLE) / event_day_count - baseline_avg_footfall AS footfall_uplift_per_day,
          total_sales_kwd / event_day_count - baseline_avg_sales_kwd AS sales_uplift_per_day_kwd
        FROM d_event e LEFT JOIN tot USING (event_id) LEFT JOIN base USING (event_id)""",
    "w5": """
        WITH t AS (SELECT invoice_id, venue_id, sum(line_amount_kwd) AS amount FROM f_pos GROUP BY 1, 2)
        SELECT venue_id, venue_name, venue_type, count(*) FILTER (WHERE amount > 0) AS sale_invoice_count,
          count(*) FILTER (WHERE amount < 0) AS refund_invoice_count,
          CAST(sum(amount) FILTER (WHERE amount > 0) AS DOUBLE) / nullif(count(*) FILTER (WHERE amount > 0), 0)
            AS avg_transaction_value_kwd, CAST(sum(amount) AS DOUBLE) AS net_revenue_kwd
        FROM t JOIN d_venue USING (venue_id) GROUP BY 1, 2, 3""",
    "w7": """
        SELECT tenant_id, tenant_name, category, valid_from, unit_no, CAST(unit_sqm AS DOUBLE) AS unit_sqm, month_date_key,
          month_start, CAST(sales_kwd AS DOUBLE) AS sales_kwd,
          CAST(sales_kwd AS DOUBLE) / nullif(CAST(unit_sqm AS DOUBLE), 0) AS sales_per_sqm_kwd
        FROM v_rent""",
    "w8": f"""
        SELECT tenant_id, tenant_name, category, valid_from, count(*) AS submission_count,
          CAST(sum(days_late) AS DOUBLE) / nullif(count(days_late), 0) AS avg_days_late,
          max(days_late) AS max_days_late, count(*) FILTER (WHERE is_restated) AS restated_count,
          {pct("count(*) FILTER (WHERE is_restated)", "count(*)", 1)} AS restated_pct
        FROM f_tenant WHERE is_current_version GROUP BY 1, 2, 3, 4""",
    "w9": f"""
        WITH o AS (SELECT product_code, sum(qty) AS qty, sum(amount_kwd) AS amt
                   FROM (SELECT sku_code AS product_code, qty, amount_kwd FROM f_booking WHERE NOT is_cancelled)
                   JOIN d_product USING (product_code) GROUP BY 1),
        w AS (SELECT product_code, sum(qty) AS qty, sum(line_amount_kwd) AS amt FROM f_pos
              JOIN d_product ON item_id = product_id WHERE NOT is_refund GROUP BY 1),
        b AS (SELECT coalesce(o.product_code, w.product_code) AS product_code, coalesce(o.qty, 0) AS oq,
                coalesce(o.amt, 0) AS oa, coalesce(w.qty, 0) AS wq, coalesce(w.amt, 0) AS wa
              FROM o FULL OUTER JOIN w ON w.product_code = o.product_code)
        SELECT product_code, product_name, category, CAST(oq AS DOUBLE) AS online_qty, CAST(oa AS DOUBLE) AS online_amount_kwd,
          CAST(wq AS DOUBLE) AS walk_in_qty, CAST(wa AS DOUBLE) AS walk_in_amount_kwd,
          {pct("oq", "(oq + wq)", 1)} AS online_share_pct, coalesce(venue_name, 'Site-wide') AS venue_name
        FROM b JOIN d_product USING (product_code) LEFT JOIN d_venue USING (venue_id)""",
    "w10": f"""
        WITH s AS (SELECT channel, CAST(sum(sessions) AS BIGINT) AS sessions,
                     CAST(sum(engaged_sessions) AS BIGINT) AS engaged_sessions, CAST(sum(users) AS BIGINT) AS users
                   FROM f_session GROUP BY 1),
        b AS (SELECT channel, count(*) FILTER (WHERE NOT is_cancelled) AS n,
                sum(amount_kwd) FILTER (WHERE NOT is_cancelled) AS amt FROM f_booking GROUP BY 1)
        SELECT coalesce(s.channel, 'unknown (attribution loss)') AS channel_name, sessions, engaged_sessions, users,
          coalesce(n, 0) AS booking_count, CAST(coalesce(amt, 0) AS DOUBLE) AS booking_amount_kwd,
          {pct("coalesce(n, 0)", "sessions", 2)} AS conversion_rate_pct, coalesce(s.channel, b.channel) AS channel
        FROM s FULL OUTER JOIN b ON b.channel = s.channel""",
    "w11": f"""
        WITH s AS (SELECT month_key, min(full_date) AS month_start, channel, CAST(sum(sessions) AS BIGINT) AS sessions,
                     CAST(sum(engaged_sessions) AS BIGINT) AS engaged_sessions, CAST(sum(users) AS BIGINT) AS users
                   FROM f_session WHERE month_key IS NOT NULL GROUP BY month_key, channel),
        b AS (SELECT month_key, channel, count(*) FILTER (WHERE NOT is_cancelled) AS n,
                sum(amount_kwd) FILTER (WHERE NOT is_cancelled) AS amt FROM f_booking GROUP BY 1, 2)
        SELECT coalesce(s.month_key, b.month_key) AS month_key, month_start,
          coalesce(s.channel, 'unknown (attribution loss)') AS channel_name, sessions, engaged_sessions, users,
          coalesce(n, 0) AS booking_count, CAST(coalesce(amt, 0) AS DOUBLE) AS booking_amount_kwd,
          {pct("coalesce(n, 0)", "sessions", 2)} AS conversion_rate_pct, coalesce(s.channel, b.channel) AS channel
        FROM s FULL OUTER JOIN b ON b.channel = s.channel AND b.month_key = s.month_key""",
    "w12": f"""
        WITH m AS (SELECT month_date_key, month_date AS month_start, contract_type,
                     count(*) FILTER (WHERE month_status = 'active') AS active_count,
                     count(*) FILTER (WHERE is_new) AS new_count, count(*) FILTER (WHERE is_churned) AS churned_count,
                     CAST(sum(monthly_amount_kwd) FILTER (WHERE month_status = 'active') AS DOUBLE) AS active_mrr_kwd
                   FROM f_member GROUP BY 1, 2, 3),
        l AS (SELECT *, lag(active_count) OVER (PARTITION BY contract_type ORDER BY month_start) AS prev FROM m)
        SELECT * EXCLUDE (prev), {pct("churned_count", "prev", 2)} AS churn_rate_pct FROM l""",
    "w13": """
        WITH p AS (SELECT month_start, sum(line_amount_kwd) AS a FROM f_pos JOIN cal USING (date_key)
                   WHERE NOT is_refund GROUP BY 1),
        r AS (SELECT month_start, sum(base_rent_kwd + turnover_rent_kwd) AS a FROM v_rent GROUP BY 1),
        m AS (SELECT month_date AS month_start, sum(monthly_amount_kwd) FILTER (WHERE month_status = 'active') AS a
              FROM f_member GROUP BY 1)
        SELECT date_key AS month_date_key, full_date AS month_start, CAST(coalesce(p.a, 0) AS DOUBLE) AS own_venue_revenue_kwd,
          CAST(coalesce(r.a, 0) AS DOUBLE) AS rental_revenue_kwd, CAST(coalesce(m.a, 0) AS DOUBLE) AS membership_mrr_kwd,
          CAST(coalesce(p.a, 0) + coalesce(r.a, 0) + coalesce(m.a, 0) AS DOUBLE) AS total_revenue_kwd
        FROM cal LEFT JOIN p ON p.month_start = full_date LEFT JOIN r ON r.month_start = full_date
        LEFT JOIN m ON m.month_start = full_date
        WHERE day(full_date) = 1
          AND full_date IN (SELECT month_start FROM p UNION SELECT month_start FROM r UNION SELECT month_start FROM m)""",
    "w14": f"""
        SELECT level, instructor_id, instructor_name, count(*) AS lesson_count, CAST(sum(capacity) AS BIGINT) AS total_capacity,
          CAST(sum(booked) AS BIGINT) AS total_booked, CAST(sum(attended) AS BIGINT) AS total_attended,
          count(*) FILTER (WHERE attended IS NULL) AS missing_attendance_count,
          count(*) FILTER (WHERE is_overbooked) AS overbooked_count,
          {pct("sum(booked)", "sum(capacity)", 1)} AS utilization_pct,
          {pct("(sum(booked) - sum(attended))", "sum(booked)", 1)} AS no_show_rate_pct
        FROM f_lesson GROUP BY 1, 2, 3""",
    "w15": f"""
        SELECT month_key, min(full_date) AS month_start, level, instructor_id, instructor_name, count(*) AS lesson_count,
          CAST(sum(capacity) AS BIGINT) AS total_capacity, CAST(sum(booked) AS BIGINT) AS total_booked,
          CAST(sum(attended) AS BIGINT) AS total_attended, count(*) FILTER (WHERE attended IS NULL) AS missing_attendance_count,
          count(*) FILTER (WHERE is_overbooked) AS overbooked_count,
          {pct("sum(booked)", "sum(capacity)", 1)} AS utilization_pct,
          {pct("(sum(booked) FILTER (WHERE attended IS NOT NULL) - sum(attended))",
               "sum(booked) FILTER (WHERE attended IS NOT NULL)", 1)} AS no_show_rate_pct
        FROM f_lesson WHERE month_key IS NOT NULL GROUP BY month_key, level, instructor_id, instructor_name""",
    "w19": """
        WITH c AS (SELECT gate_id, month_start, hour, CAST(sum(count_in) AS BIGINT) AS total_count_in, count(count_in) AS n,
                     count(DISTINCT f.date_key) AS day_count, bool_or(is_imputed) AS has_imputed,
                     bool_or(is_outlier_corrected) AS has_corrected
                   FROM f_foot f JOIN cal ON cal.date_key = f.date_key GROUP BY 1, 2, 3)
        SELECT gate_id, gate_name, md.date_key AS month_date_key, c.month_start, CAST(hour AS BIGINT) AS hour,
          ((20 * total_count_in + n) // (2 * n)) / 10.0 AS avg_count_in, total_count_in, day_count, has_imputed, has_corrected
        FROM c JOIN d_gate USING (gate_id) JOIN cal md ON md.full_date = c.month_start""",
    "sqm": """
        SELECT tenant_id, category, valid_from, unit_sqm, count(*) AS month_count,
          CAST(coalesce(sum(CAST(sales_kwd AS DECIMAL(18,3))), 0) AS DOUBLE) AS total_sales,
          CAST(coalesce(sum(CAST(sales_kwd AS DECIMAL(18,3))), 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) / unit_sqm
            AS sales_per_sqm
        FROM w7 WHERE unit_sqm > 0 GROUP BY 1, 2, 3, 4""",
}


def compose(query: str) -> str:
    """The query with the steps it needs, each once, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(STEPS[name])

    visit(query)
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for other in STEPS:
            if other != name and other in needed and re.search(rf"\b{other}\b", STEPS[name]):
                place(other)
        order.append(name)

    for name in STEPS:
        if name in needed:
            place(name)
    parts = ",\n".join(f"{name} AS ({STEPS[name]})" for name in order)
    return f"WITH {parts}\nSELECT * FROM (\n{query}\n) AS answer" if parts else query
