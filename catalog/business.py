"""Registered queries on sales, billing, service, workforce, finance and marketing."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from catalog.registry import query
from wattloom.functions.sampling import percent_bucket
from wattloom.operators import accounts, service
from wattloom.plans import models, questions
from wattloom.sources.testdata import HEATPUMP, SOLAR


@query("B1", """
    SELECT category_name, count(*) AS products, CAST(sum(capex_eur) AS DOUBLE) / count(*) AS avg_capex,
           CAST(min(capex_eur) AS DOUBLE) AS min_capex, CAST(max(capex_eur) AS DOUBLE) AS max_capex,
           CAST(sum(opex_eur_year) AS DOUBLE) / count(*) AS avg_opex FROM product_dim GROUP BY 1""", "product_dim")
def product_portfolio(d):
    return accounts.portfolio_by_category(d["product_dim"])


@query("B2 L3 W2", """
    SELECT product_key, product_name, CAST(sum(amount) AS DOUBLE) AS total_revenue
    FROM sales_fact LEFT JOIN product_dim USING (product_key)
    WHERE date >= DATE '1998-01-01' AND date < DATE '1999-01-01' GROUP BY 1, 2
    ORDER BY sum(amount) DESC, product_key LIMIT 5""", "sales_fact product_dim")
def top_products(d):
    return questions.top_products(d, 1998)


@query("W2 L3 J9", """
    SELECT r_name AS contract_region_name, product_key, CAST(total AS DOUBLE) AS total_revenue, rank
    FROM (SELECT r_name, product_key, sum(amount) AS total,
                 row_number() OVER (PARTITION BY r_name ORDER BY sum(amount) DESC, product_key) AS rank
          FROM sales_fact JOIN region ON r_regionkey = contract_region GROUP BY 1, 2) WHERE rank <= 5""", "sales_fact")
def top_products_by_region(d):
    return questions.top_products_by_region(d)


@query("M0 J9 B27", """
    SELECT c.r_name AS contract_region_name, h.r_name AS customer_region_name, CAST(sum(amount) AS DOUBLE) AS total_revenue,
           count(*) AS total_contracts
    FROM sales_fact JOIN customer_dim d USING (customer_key) JOIN region c ON c.r_regionkey = contract_region
    JOIN region h ON h.r_regionkey = d.region_key GROUP BY 1, 2""", "sales_fact customer_dim")
def sales_by_region_roles(d):
    return questions.sales_by_region_roles(d)


@query("B3 A9", """
    SELECT customer_type, customer_count, total_revenue, total_revenue / CAST(sum(r) OVER () AS DOUBLE) AS revenue_share
    FROM (SELECT customer_type, count(*) AS customer_count FROM customer_dim GROUP BY 1)
    JOIN (SELECT customer_type, sum(amount) AS r, CAST(sum(amount) AS DOUBLE) AS total_revenue
          FROM sales_fact JOIN customer_dim USING (customer_key) GROUP BY 1) USING (customer_type)""",
       "customer_dim sales_fact")
def customer_segments(d):
    return questions.customer_segments(d)


@query("B4 J13 M6", """
    SELECT owner_group, CAST(sum(consumption_kwh) AS DOUBLE) / count(*) AS avg_consumption, count(*) AS total_invoices
    FROM (SELECT consumption_kwh, CASE WHEN customer_key IN (SELECT customer_key FROM customer_products
                                                             WHERE category_name = 'ECONOMY')
                 THEN 'with' ELSE 'without' END AS owner_group FROM billing_history) GROUP BY 1""",
       "customer_products billing_history")
def consumption_by_heatpump_ownership(d):
    return questions.owner_consumption(d, HEATPUMP)


@query("B5 M8", """
    SELECT topic, count(*) AS total_tickets FROM service_logs WHERE sentiment = 'negative' GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 10""", "service_logs")
def complaint_topics(d):
    return questions.complaint_topics(d, "negative")


@query("B6", """
    SELECT customer_key, CAST(sum(consumption_kwh) AS BIGINT) AS kwh FROM billing_history GROUP BY 1
    HAVING sum(consumption_kwh) > 6000""", "billing_history")
def heavy_users(d):
    return questions.heavy_user_list(d, 6000)


@query("B13 L3", """
    SELECT r_name AS region_name, CAST(sum(amount) AS DOUBLE) AS total_revenue
    FROM sales_fact JOIN part ON p_partkey = product_key JOIN customer_dim USING (customer_key)
    JOIN region ON r_regionkey = region_key WHERE p_type = 'ECONOMY' GROUP BY 1
    ORDER BY sum(amount) DESC, 1 LIMIT 1""", "sales_fact customer_dim")
def best_region_for_heatpumps(d):
    """All products of the category count, whatever their size."""
    return questions.best_region(ChainMap({"product_dim": d["whole_categories"]}, d), HEATPUMP)


@query("B14 M2", """
    SELECT CAST(date_trunc('month', date) AS DATE) AS contract_month, count(*) AS total_contracts FROM sales_fact
    WHERE date >= DATE '1998-01-01' AND date < DATE '1999-01-01' GROUP BY 1""", "sales_fact")
def monthly_contracts(d):
    return questions.monthly_contracts(d, 1998)


@query("B15 M3", """
    SELECT category_name, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_contract_value
    FROM sales_fact JOIN product_dim USING (product_key) WHERE category_name IN ('PROMO', 'ECONOMY') GROUP BY 1""",
       "sales_fact product_dim")
def contract_value_by_category(d):
    return questions.contract_value(d, SOLAR, HEATPUMP)


@query("B16 J11", """
    SELECT customer_key, CAST(sum(consumption_kwh) AS BIGINT) AS total_consumption FROM billing_history
    WHERE customer_key IN (SELECT customer_key FROM customer_products WHERE category_name = 'PROMO') GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 10""", "billing_history customer_products")
def top_solar_owner_consumption(d):
    return questions.top_owner_consumption(d, SOLAR)


@query("B17 L3", """
    SELECT customer_key, CAST(sum(consumption_kwh) AS BIGINT) AS total_consumption FROM billing_history
    WHERE billing_type = 'Electricity' AND billing_date >= DATE '1998-04-01' AND billing_date < DATE '1998-07-01'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", "billing_history")
def quarter_leaders(d):
    return questions.quarter_leaders(d, "1998-04-01")


@query("B18", """
    SELECT topic, priority, tickets,
           CAST(tickets AS DOUBLE) / CAST(sum(tickets) OVER (PARTITION BY topic) AS DOUBLE) AS share_of_topic
    FROM (SELECT topic, priority, count(*) AS tickets FROM service_logs GROUP BY 1, 2)""", "service_logs")
def topic_priority_shares(d):
    return service.topic_priority_shares(d["service_logs"])


@query("B19 F15", """
    SELECT log_id, customer_key, log_date, topic, priority FROM service_logs
    WHERE log_date <= DATE '2024-01-20' AND (resolution_date IS NULL OR resolution_date > DATE '2024-01-20')
      AND priority IN ('high', 'critical')""", "service_logs")
def open_urgent_tickets(d):
    return service.open_tickets(d["service_logs"], "2024-01-20", ("high", "critical"))


@query("B20", """
    SELECT CAST(date_trunc('month', log_date) AS DATE) AS month, sentiment, count(*) AS tickets FROM service_logs
    WHERE date_trunc('month', log_date) BETWEEN DATE '2023-08-01' AND DATE '2024-01-01' GROUP BY 1, 2""", "service_logs")
def sentiment_trend(d):
    return service.sentiment_trend(d["service_logs"], "2024-01-31")


@query("B25 M11", """
    SELECT department_name, count(*) AS headcount, CAST(sum(attrition_flag) AS BIGINT) AS attrition_count,
           CAST(sum(attrition_flag) AS DOUBLE) / count(*) AS attrition_rate FROM hr GROUP BY 1""", "hr")
def headcount_and_attrition(d):
    return questions.headcount_and_attrition(d)


@query("B26 M10", """
    SELECT department_name, CAST(sum(salary) AS DOUBLE) / count(*) AS avg_salary,
           CAST(sum(salary) AS DOUBLE) AS total_salary FROM hr GROUP BY 1""", "hr")
def department_salaries(d):
    return questions.department_salaries(d)


@query("B27", """
    SELECT r_name AS region_name, CAST(sum(amount) AS DOUBLE) AS total_revenue, count(*) AS total_contracts
    FROM sales_fact JOIN customer_dim USING (customer_key) JOIN region ON r_regionkey = region_key
    WHERE date >= DATE '1998-03-01' AND date < DATE '1998-04-01' GROUP BY 1""", "sales_fact customer_dim")
def region_sales_in_month(d):
    return questions.region_sales(d, "1998-03-01")


@query("B28", """
    SELECT log_id, customer_key, log_date, topic, priority FROM service_logs
    WHERE topic = 'error' AND sentiment = 'negative'""", "service_logs")
def negative_topic_tickets(d):
    return questions.topic_tickets(d, "error", "negative")


@query("B30 M7", """
    SELECT payment_status, total_invoices, total_billing_amount,
           CAST(total_invoices AS DOUBLE) / CAST(sum(total_invoices) OVER () AS DOUBLE) AS invoice_share
    FROM (SELECT payment_status, count(*) AS total_invoices, CAST(sum(amount) AS DOUBLE) AS total_billing_amount
          FROM billing_history GROUP BY 1)""", "billing_history")
def payment_status_split(d):
    return questions.payment_status_split(d)


@query("B31", """
    SELECT city, CAST(sum(consumption_kwh) AS DOUBLE) / count(*) AS avg_consumption, count(*) AS total_invoices
    FROM billing_history JOIN customer_dim USING (customer_key)
    WHERE city = 'NATION_7' AND customer_key IN (SELECT customer_key FROM customer_products
                                                 WHERE category_name = 'ECONOMY') GROUP BY 1""",
       "billing_history customer_dim customer_products")
def heatpump_owners_in_city(d):
    return questions.city_owner_consumption(d, "NATION_7", HEATPUMP)


@query("B32 M4", """
    SELECT product_key, product_name, CAST(sum(units) AS BIGINT) AS total_units, count(*) AS total_contracts
    FROM sales_fact JOIN product_dim USING (product_key) WHERE date >= DATE '1998-03-01' AND date < DATE '1998-04-01'
    GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 5""", "sales_fact product_dim")
def best_sellers_in_month(d):
    return questions.best_sellers(d, "1998-03-01")


@query("B34 J10", """
    SELECT account_key, department_key, approval_status, count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS total_amount
    FROM finance GROUP BY 1, 2, 3""", "finance")
def finance_totals(d):
    return accounts.finance_totals(d["finance_transactions"])


@query("B34", """
    SELECT channel_key, CAST(sum(spend) AS DOUBLE) AS total_spend, CAST(sum(k) AS BIGINT) AS leads,
           CAST(sum(spend) AS DOUBLE) / CAST(sum(k) AS DOUBLE) AS cost_per_lead
    FROM (SELECT event_type AS channel_key, CAST(value AS DECIMAL(18,2)) AS spend, k FROM ev) GROUP BY 1""", "ev")
def campaign_cost_per_lead(d):
    return accounts.campaign_cost_per_lead(d["marketing_campaign_fact"])


@query("B35", """
    SELECT o_orderstatus AS stage_name, count(*) AS opportunities,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount FROM orders GROUP BY 1""")
def opportunity_funnel(d):
    return accounts.open_sales_funnel(d["sf_opportunities"])


@query("B35", """
    SELECT o_orderstatus AS stage_name, count(*) AS opportunities, count(v.amount) AS with_contract,
           CAST(sum(v.amount) AS DOUBLE) AS contract_amount
    FROM orders LEFT JOIN (SELECT sale_id, sum(amount) AS amount FROM sales_fact GROUP BY 1) v ON o_orderkey = sale_id
    GROUP BY 1""", "sales_fact")
def opportunity_contracts(d):
    return accounts.opportunity_contracts(d["sf_opportunities"], d["sales_fact"])


@query("J9 M0", """
    SELECT r_name AS region_name, category_name, customer_type, rep_name, CAST(sum(amount) AS DOUBLE) AS total_revenue,
           count(*) AS total_contracts
    FROM sales_fact JOIN customer_dim USING (customer_key) JOIN product_dim USING (product_key)
    JOIN region ON r_regionkey = region_key JOIN sales_rep_dim USING (sales_rep_key) JOIN vendor_dim USING (vendor_key)
    GROUP BY 1, 2, 3, 4""", "sales_fact customer_dim product_dim sales_rep_dim vendor_dim")
def sales_star(d):
    return models.sales_model(d).query(
        ["total_revenue", "total_contracts"], ["Region", "category_name", "customer_type", "rep_name"],
        where={"vendor_name": lambda name: name.isNotNull()})


@query("M0 M1 M2 M3 M4 M5 P14", """
    SELECT category_name, total_revenue, total_contracts, avg_contract_value, total_units, contract_records, avg_capex,
           avg_opex, product_count
    FROM (SELECT category_name, CAST(sum(amount) AS DOUBLE) AS total_revenue, count(*) AS total_contracts,
                 CAST(sum(amount) AS DOUBLE) / count(*) AS avg_contract_value, CAST(sum(units) AS BIGINT) AS total_units,
                 count(*) AS contract_records
          FROM sales_fact JOIN product_dim USING (product_key) GROUP BY 1)
    FULL JOIN (SELECT category_name, CAST(sum(capex_eur) AS DOUBLE) / count(*) AS avg_capex,
                      CAST(sum(opex_eur_year) AS DOUBLE) / count(*) AS avg_opex, count(*) AS product_count
               FROM product_dim GROUP BY 1) USING (category_name)""", "sales_fact product_dim")
def sales_metrics(d):
    return models.sales_model(d).query(
        ["revenue", "total_contracts", "avg_contract_value", "total_units", "contract_records", "avg_capex",
         "avg_opex", "product_count"], ["Kategorie"])


@query("M0 M6 M7 J10", """
    SELECT city, billing_type, CAST(sum(consumption_kwh) AS BIGINT) AS total_consumption,
           CAST(sum(consumption_kwh) AS DOUBLE) / count(*) AS avg_consumption,
           CAST(sum(amount) AS DOUBLE) AS total_billing_amount, count(*) AS total_invoices
    FROM billing_history JOIN customer_dim USING (customer_key) GROUP BY 1, 2""", "billing_history customer_dim")
def billing_metrics(d):
    return models.billing_model(d).query(
        ["total_consumption", "avg_consumption", "total_billing_amount", "total_invoices"], ["city", "Energieart"])


@query("M0 M8 M9 J10", """
    SELECT city, priority, count(*) AS total_tickets, CAST(count_if(sentiment = 'negative') AS BIGINT) AS negative_tickets
    FROM service_logs JOIN customer_dim USING (customer_key) GROUP BY 1, 2""", "service_logs customer_dim")
def service_metrics(d):
    return models.service_model(d, "negative").query(["total_tickets", "negative_tickets"], ["city", "priority"])


@query("M0 M10 M11 J10", """
    SELECT department_name, n_name AS job_title, CAST(sum(salary) AS DOUBLE) AS total_salary,
           CAST(sum(salary) AS DOUBLE) / count(*) AS avg_salary, CAST(sum(attrition_flag) AS BIGINT) AS attrition_count,
           count(*) AS headcount
    FROM hr JOIN nation ON n_nationkey = job_key GROUP BY 1, 2""", "hr")
def workforce_metrics(d):
    return models.workforce_model(d).query(
        ["total_salary", "avg_salary", "attrition_count", "headcount"], ["department_name", "job_title"])


@query("M0 M12", """
    SELECT (SELECT count(*) FROM customer) AS total_employees, count(*) AS headcount FROM hr""", "hr")
def employee_total(d):
    return models.workforce_model(d).query(["total_employees", "headcount"])


@query("J13 M6 M7", """
    SELECT customer_key, total_billing_amount, owned_products
    FROM (SELECT customer_key, CAST(sum(amount) AS DOUBLE) AS total_billing_amount FROM billing_history GROUP BY 1)
    FULL JOIN (SELECT customer_key, count(*) AS owned_products FROM customer_products GROUP BY 1) USING (customer_key)""",
       "billing_history customer_products")
def bills_and_ownership(d):
    return models.customer_energy_model(d).query(["total_billing_amount", "owned_products"], ["customer_key"])


@query("K8", """
    SELECT CASE WHEN amount <= 5000 THEN 'department_head' WHEN amount <= 25000 THEN 'division_head'
                WHEN amount <= 100000 THEN 'management' ELSE 'board' END AS approval_level,
           count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS total_amount FROM finance GROUP BY 1""", "finance")
def finance_by_approval_level(d):
    return accounts.finance_by_approval_level(d["finance_transactions"])


@query("K9", """
    SELECT billing_type, CAST(month AS BIGINT) AS month,
           (CAST(kwh AS DOUBLE) / CAST(n AS DOUBLE))
             / (CAST(sum(kwh) OVER (PARTITION BY billing_type) AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY billing_type) AS DOUBLE))
             AS seasonality_index
    FROM (SELECT billing_type, month(billing_date) AS month, sum(consumption_kwh) AS kwh, count(*) AS n
          FROM billing_history GROUP BY 1, 2)""", "billing_history")
def seasonality_index(d):
    return accounts.seasonality_index(d["billing_history"])


@query("K10", """
    SELECT a.customer_key, a.billing_type, a.month, CAST(a.kwh AS BIGINT) AS kwh, CAST(b.kwh AS BIGINT) AS kwh_year_before,
           CAST(a.kwh - b.kwh AS BIGINT) AS change_kwh,
           CAST(sum(a.kwh) OVER (PARTITION BY a.customer_key, a.billing_type) AS DOUBLE)
             / CAST(count(*) OVER (PARTITION BY a.customer_key, a.billing_type) AS DOUBLE) AS mean_monthly_kwh
    FROM monthly a LEFT JOIN monthly b ON b.customer_key = a.customer_key AND b.billing_type = a.billing_type
     AND b.month = CAST(a.month - INTERVAL 12 MONTH AS DATE)""", "monthly")
def invoice_summary(d):
    return accounts.invoice_summary(d["billing_history"])


@query("K11", """
    SELECT customer_key, CAST(year(billing_date) AS BIGINT) AS year, CAST(sum(consumption_kwh) AS BIGINT) AS kwh,
           CAST(sum(consumption_kwh) * 5 AS DOUBLE) / 1000.0::DOUBLE AS contribution_eur FROM billing_history GROUP BY 1, 2""",
       "billing_history")
def climate_contribution(d):
    return accounts.climate_contribution(d["billing_history"])


@query("F10", """
    SELECT bucket, count(*) AS customers
    FROM (SELECT CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS bucket FROM customer)
    GROUP BY 1""")
def hash_buckets(d):
    return (d["customer_dim"].groupBy(percent_bucket(F.col("customer_key")).alias("bucket"))
            .agg(F.count("*").alias("customers")))
