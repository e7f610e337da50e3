"""The domain tables once more, as SQL over the test tables, for the comparison engine."""

from __future__ import annotations

# name -> (tables it reads, SQL)
TABLES: dict[str, tuple[str, str]] = {
    "places": ("", "SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "region_dim": ("", "SELECT r_regionkey AS region_key, r_name AS region_name FROM region"),
    "customer_dim": ("places", """
        SELECT c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS customer_type, n_name AS city,
               r_name AS state, n_regionkey AS region_key
        FROM customer JOIN places ON c_nationkey = n_nationkey"""),
    "product_dim": ("", """
        SELECT p_partkey AS product_key, p_name AS product_name, p_brand AS vertical,
               CASE WHEN p_type IN ('PROMO', 'ECONOMY') AND p_size > 3 THEN p_type || ' PARTS' ELSE p_type END AS category_name,
               CAST(p_retailprice AS DECIMAL(18,2)) AS capex_eur, CAST(p_size AS DECIMAL(18,2)) AS opex_eur_year
        FROM part"""),
    "vendor_dim": ("places", """
        SELECT s_suppkey AS vendor_key, s_name AS vendor_name, n_name AS city, r_name AS state
        FROM supplier JOIN places ON s_nationkey = n_nationkey"""),
    "sales_rep_dim": ("", "SELECT n_nationkey AS sales_rep_key, 'Rep ' || n_name AS rep_name FROM nation"),
    "sales_fact": ("", """
        SELECT l_orderkey AS sale_id, CAST(o_orderdate AS DATE) AS date, o_custkey AS customer_key,
               l_partkey AS product_key, l_suppkey AS vendor_key, l_suppkey % 25 AS sales_rep_key, l_orderkey % 5 AS contract_region,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
                 AS amount, CAST(l_quantity AS BIGINT) AS units
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "contracts": ("", """
        SELECT l_orderkey * 8 + l_linenumber AS sale_id, CAST(o_orderdate AS DATE) AS date, o_custkey AS customer_key,
               l_partkey AS product_key, CASE WHEN o_orderstatus = 'P' THEN 'Inactive' ELSE 'Active' END AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "customer_products": ("contracts product_dim", """
        SELECT customer_key, product_key, category_name, date AS acquisition_date, status
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_key, product_key ORDER BY sale_id) AS rn FROM contracts)
        LEFT JOIN product_dim USING (product_key) WHERE rn = 1"""),
    "registry": ("customer_products product_dim", """
        SELECT customer_key, 'GW-' || lpad(CAST(customer_key AS VARCHAR), greatest(5, length(CAST(customer_key AS VARCHAR)))::INTEGER, '0') AS gateway_id, has_solar,
               has_battery, has_heatpump, enrolled AS is_vpp_enrolled,
               CASE WHEN enrolled THEN CAST(first_acq + INTERVAL 30 DAY AS DATE) END AS enrollment_date
        FROM (SELECT *, has_battery AND CAST('0x' || substr(md5(CAST(customer_key AS VARCHAR)), 1, 8) AS BIGINT) % 100
                     < 90 AS enrolled
              FROM (SELECT c.customer_key, bool_or(c.category_name = 'PROMO') AS has_solar,
                           bool_or(p.product_name LIKE '%red widget%') AS has_battery,
                           bool_or(c.category_name = 'ECONOMY') AS has_heatpump, min(acquisition_date) AS first_acq
                    FROM customer_products c LEFT JOIN product_dim p USING (product_key)
                    WHERE status = 'Active' GROUP BY c.customer_key))
        WHERE has_solar OR has_battery OR has_heatpump"""),
    "devices": ("registry customer_dim", """
        SELECT r.customer_key, customer_name, city, state AS region, customer_type, gateway_id, has_solar, has_battery,
               has_heatpump, is_vpp_enrolled, enrollment_date
        FROM registry r JOIN customer_dim c USING (customer_key)"""),
    "ev": ("", """
        SELECT *, CAST(round(value * 100) AS BIGINT) AS cents,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events"""),
    "telemetry": ("ev", """
        SELECT ts, 'GW-' || lpad(CAST(user_id AS VARCHAR), greatest(5, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS gateway_id, user_id AS customer_key,
               CAST(CASE WHEN hour(ts) BETWEEN 6 AND 20 THEN cents * 4 ELSE 0 END * 0.0001 AS DECIMAL(18,4))
                 AS solar_yield_kw,
               CAST(k AS DECIMAL(18,4)) AS battery_soc_pct,
               CAST(CASE WHEN event_type = 'click' THEN cents ELSE 0 END * 0.0001 AS DECIMAL(18,4))
                 AS heatpump_consumption_kw,
               CAST(CASE WHEN event_type IN ('purchase', 'error') THEN cents * -5 ELSE cents * 5 END * 0.0001
                 AS DECIMAL(18,4)) AS grid_import_export_kw
        FROM ev"""),
    "price_slots": ("ev", """
        SELECT slot AS unix_seconds, make_timestamp(slot * 1000000) AS start_time,
               (mean_cents - CASE WHEN hour(make_timestamp(slot * 1000000)) IN (12, 13) THEN 7000 ELSE 1000 END) / 100.0::DOUBLE
                 AS price_eur_mwh
        FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) // 900 * 900 AS slot,
                     CAST(sum(cents) AS BIGINT) // count(*) AS mean_cents
              FROM ev GROUP BY 1)
        WHERE CAST('0x' || substr(md5(CAST(slot // 3600 AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 5"""),
    "market_prices": ("price_slots", """
        SELECT CAST(start_time AS DATE) AS fetch_date, start_time, start_time + INTERVAL 15 MINUTE AS end_time,
               price_eur_mwh, unix_seconds FROM price_slots"""),
    "every_price": ("ev", """
        SELECT CAST(start_time AS DATE) AS fetch_date, start_time,
               (mean_cents - CASE WHEN hour(start_time) IN (12, 13) THEN 7000 ELSE 1000 END) / 100.0::DOUBLE AS price_eur_mwh
        FROM (SELECT make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) // 900 * 900 * 1000000) AS start_time,
                     CAST(sum(cents) AS BIGINT) // count(*) AS mean_cents
              FROM ev GROUP BY 1)"""),
    "hourly_prices": ("market_prices", """
        SELECT hour, price_eur_mwh,
               CAST(CAST(CAST(price_eur_mwh AS DECIMAL(18,6)) * 0.001 AS DECIMAL(18,4)) AS DOUBLE) AS price_eur_kwh
        FROM (SELECT date_trunc('hour', start_time) AS hour,
                     CAST(sum(CAST(price_eur_mwh AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS price_eur_mwh
              FROM market_prices GROUP BY 1)"""),
    "bands": ("market_prices", """
        SELECT quantile_cont(price_eur_mwh, 0.25) AS p25, quantile_cont(price_eur_mwh, 0.75) AS p75 FROM market_prices"""),
    "zones": ("hourly_prices bands", """
        SELECT hour, price_eur_mwh, price_eur_kwh,
               CASE WHEN price_eur_mwh < 0 THEN 'NEGATIVE' WHEN price_eur_mwh < p25 THEN 'LOW'
                    WHEN price_eur_mwh > p75 THEN 'HIGH' ELSE 'MEDIUM' END AS price_zone
        FROM hourly_prices, bands"""),
    "customer_hours": ("telemetry", """
        SELECT date_trunc('hour', ts) AS hour, customer_key, count(*) AS n,
               CAST(sum(solar_yield_kw) AS DECIMAL(18,4)) AS solar, CAST(sum(battery_soc_pct) AS DECIMAL(18,4)) AS soc,
               CAST(sum(heatpump_consumption_kw) AS DECIMAL(18,4)) AS heat,
               CAST(sum(grid_import_export_kw) AS DECIMAL(18,4)) AS grid,
               CAST(sum(CASE WHEN grid_import_export_kw > 0 THEN grid_import_export_kw ELSE 0 END) AS DECIMAL(14,4))
                 AS import_kwh,
               CAST(sum(CASE WHEN grid_import_export_kw < 0 THEN -grid_import_export_kw ELSE 0 END) AS DECIMAL(14,4))
                 AS export_kwh
        FROM telemetry GROUP BY 1, 2"""),
    "offers": ("hourly_prices market_prices", """
        SELECT 'hour' AS grain, hour, price_eur_mwh, price_eur_kwh FROM hourly_prices UNION ALL
        SELECT 'interval', date_trunc('hour', start_time), price_eur_mwh,
               CAST(CAST(CAST(price_eur_mwh AS DECIMAL(18,6)) * 0.001 AS DECIMAL(18,4)) AS DOUBLE) FROM market_prices"""),
    "priced_hours": ("customer_hours devices offers bands", """
        SELECT g.grain, h.*, d.customer_name, d.city, d.region, o.price_eur_mwh, o.price_eur_kwh,
               CASE WHEN o.price_eur_mwh IS NULL THEN 'NO_PRICE_DATA' WHEN o.price_eur_mwh < 0 THEN 'NEGATIVE'
                    WHEN o.price_eur_mwh < p25 THEN 'LOW' WHEN o.price_eur_mwh > p75 THEN 'HIGH' ELSE 'MEDIUM' END
                 AS price_zone,
               h.import_kwh * CAST(coalesce(o.price_eur_kwh, 0) AS DECIMAL(10,4)) AS cost,
               h.export_kwh * CAST(coalesce(o.price_eur_kwh, 0) AS DECIMAL(10,4)) AS revenue
        FROM customer_hours h JOIN devices d ON d.customer_key = h.customer_key AND d.is_vpp_enrolled
        CROSS JOIN (VALUES ('hour'), ('interval')) AS g(grain)
        LEFT JOIN offers o ON o.hour = h.hour AND o.grain = g.grain CROSS JOIN bands"""),
    "margins": ("priced_hours", """
        SELECT grain, hour, customer_key, customer_name, city, region, CAST(solar AS DOUBLE) / n AS avg_solar_kw,
               CAST(soc AS DOUBLE) / n AS avg_battery_soc_pct, CAST(heat AS DOUBLE) / n AS avg_heatpump_kw,
               CAST(grid AS DOUBLE) / n AS avg_grid_kw, CAST(import_kwh AS DOUBLE) AS total_import_kwh,
               CAST(export_kwh AS DOUBLE) AS total_export_kwh, price_eur_mwh, price_eur_kwh, price_zone,
               CASE price_zone WHEN 'NEGATIVE' THEN 'MAX_CHARGE' WHEN 'LOW' THEN 'CHARGE' WHEN 'HIGH' THEN 'DISCHARGE'
                    ELSE 'SELF_CONSUME' END AS battery_action,
               CAST(CAST(cost AS DECIMAL(24,4)) AS DOUBLE) AS import_cost_eur,
               CAST(CAST(revenue AS DECIMAL(24,4)) AS DOUBLE) AS export_revenue_eur,
               CAST(CAST(revenue - cost AS DECIMAL(24,4)) AS DOUBLE) AS net_margin_eur,
               CAST(CAST((revenue - cost) * 0.70 AS DECIMAL(24,4)) AS DOUBLE) AS customer_margin_eur,
               CAST(CAST((revenue - cost) * 0.30 AS DECIMAL(24,4)) AS DOUBLE) AS operator_margin_eur
        FROM priced_hours"""),
    "dispatch_bands": ("", """
        SELECT * FROM (VALUES ('NEGATIVE', 85.0, 95.0, 3.5, 5.0), ('LOW', 70.0, 92.0, 2.0, 4.5),
          ('MEDIUM', 40.0, 70.0, -1.5, 2.0), ('HIGH', 12.0, 35.0, -5.0, -2.0), ('NO_PRICE_DATA', 30.0, 70.0, -1.0, 3.0),
          ('NOT_ENROLLED', 20.0, 80.0, -2.0, 5.0)) AS b(dispatch_zone, soc_min, soc_max, grid_min_kw, grid_max_kw)"""),
    "fleet_soc": ("customer_hours devices", """
        SELECT hour, sum(soc) AS soc, CAST(sum(n) AS BIGINT) AS n
        FROM customer_hours JOIN devices USING (customer_key) WHERE is_vpp_enrolled GROUP BY 1"""),
    "billing_history": ("", """
        SELECT o_orderkey AS billing_id, o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS billing_date,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Electricity' ELSE 'Gas' END AS billing_type,
               CAST(floor(o_totalprice / 20) AS BIGINT) AS consumption_kwh, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE 'overdue' END AS payment_status
        FROM orders"""),
    "monthly": ("billing_history", """
        SELECT customer_key, billing_type, CAST(date_trunc('month', billing_date) AS DATE) AS month,
               sum(consumption_kwh) AS kwh FROM billing_history GROUP BY 1, 2, 3"""),
    "service_logs": ("ev", """
        SELECT event_id AS log_id, user_id AS customer_key, CAST(ts AS DATE) AS log_date, event_type AS topic,
               CASE k % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END AS priority,
               CASE WHEN k < 30 THEN 'negative' WHEN k < 85 THEN 'neutral' ELSE 'positive' END AS sentiment,
               CASE WHEN k < 90 THEN CAST(ts AS DATE) + k % 15 END AS resolution_date
        FROM ev"""),
    "hr": ("", """
        SELECT c_custkey AS employee_key, c_mktsegment AS department_key, c_nationkey AS job_key,
               CAST(c_acctbal AS DECIMAL(18,2)) AS salary, CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS attrition_flag,
               upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS department_name
        FROM customer"""),
    "finance": ("", """
        SELECT l_returnflag AS account_key, CAST(l_linenumber AS BIGINT) AS department_key,
               l_linestatus AS approval_status, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem"""),
    "parsed_content": ("", r"""
        SELECT doc_id, 'docs/' || CASE CAST(regexp_extract(source, '(\d+)', 1) AS INTEGER) % 3 WHEN 0 THEN 'energy'
                 WHEN 1 THEN 'products' ELSE 'service' END || '/' || source || '-' || doc_id || '.md' AS relative_path,
               'file:///' || relative_path AS file_url,
               '# Document ' || doc_id || chr(10) || text || chr(10) || '## Origin' || chr(10) || source || ' ' || lang
                 AS content
        FROM documents"""),
    "ticket_texts": ("", """
        SELECT conv_id * 1000 + turn AS log_id, conv_id, turn, text AS description,
               ['billing', 'outage', 'contract', 'device'][conv_id % 4 + 1] AS topic,
               ['low', 'medium', 'high', 'critical'][(conv_id + turn) % 4 + 1] AS priority,
               ['negative', 'neutral', 'positive'][(conv_id * 2 + turn) % 3 + 1] AS sentiment
        FROM conversations WHERE role = 'user'"""),
    "passages": ("parsed_content", r"""
        SELECT doc_id || '#' || section AS doc, doc_id, section, regexp_extract(part, '^#{1,6} ([^\n]*)', 1) AS title, relative_path,
               split_part(relative_path, '/', 2) AS collection, part AS content
        FROM (SELECT doc_id, relative_path, unnest(parts) AS part, CAST(generate_subscripts(parts, 1) AS BIGINT) - 2 AS section
              FROM (SELECT doc_id, relative_path, string_split(regexp_replace(content, '(^|\n)(#{1,6} )', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts
                    FROM parsed_content))
        WHERE trim(part, ' ') <> ''"""),
}


def with_tables(sql: str, names: list[str]) -> str:
    """The statement with the named tables, and those they read, in front of it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in TABLES[name][0].split():
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql.strip()
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name][1]})" for name in ordered) + "\n" + sql.strip()
