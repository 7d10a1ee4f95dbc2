"""SQL for the queries of ``plans.relational``."""

from crownledger.oracle.tables import mean, rate, total
from crownledger.schemas import CATEGORICAL, TABLES

_KEYS = "recall_type, communication_channel, delivery_status, patient_response"


def _fan(measure: str, name: str) -> str:
    """One line of the fan-out report: the measure alone, and summed over the three-way join."""
    return f"""SELECT '{name}' AS measure, (SELECT cast(sum({measure}) AS double) FROM f_{name.split('.')[0]}) AS before,
        (SELECT cast(coalesce(sum({measure}), 0) AS double) FROM f_all) AS after"""


_JOINED = """SELECT a.visits, a.no_shows, i.allowed, c.denied FROM s_patients p
             LEFT JOIN f_appointments a ON a.patient_id = p.patient_id LEFT JOIN f_invoices i ON i.patient_id = p.patient_id
             LEFT JOIN f_claims c ON c.patient_id = p.patient_id"""

SQL = {
    "inner_equi_join": "SELECT l.line_id, l.invoice_id, cast(l.allowed_amount AS double) AS allowed_amount, i.service_date "
    "FROM b_lines_core l JOIN s_invoices i ON l.invoice_id = i.invoice_id",
    "join_using": "SELECT insurance_company_id, claim_id, claim_status, company_name, payer_type "
    "FROM s_claims_and_payments JOIN s_insurance_companies USING (insurance_company_id)",
    "left_join_preagg": """
        SELECT p.patient_id, p.age_group, coalesce(a.n, 0) AS visits, coalesce(i.n, 0) AS bills, coalesce(c.n, 0) AS claims
        FROM s_patients p LEFT JOIN (SELECT patient_id, count(*) AS n FROM s_appointments GROUP BY 1) a USING (patient_id)
        LEFT JOIN (SELECT patient_id, count(*) AS n FROM s_invoices GROUP BY 1) i USING (patient_id)
        LEFT JOIN (SELECT patient_id, count(*) AS n FROM s_claims_and_payments GROUP BY 1) c USING (patient_id)""",
    "left_join_then_group": f"""
        SELECT o.office_id, o.office_name, count(c.claim_id) AS claims,
               cast(sum(CASE WHEN c.is_denied THEN 1 ELSE 0 END) AS bigint) AS denied, {total("c.amount_claimed")} AS claimed
        FROM s_dental_offices o LEFT JOIN s_claims_and_payments c ON o.office_id = c.office_id GROUP BY 1, 2""",
    "fanout_guard": f"""
        SELECT * FROM (
        WITH f_appointments AS (SELECT patient_id, 1 AS visits, CASE WHEN is_no_show THEN 1 ELSE 0 END AS no_shows
                                FROM s_appointments WHERE patient_id IN (SELECT patient_id FROM s_patients)),
             f_invoices AS (SELECT patient_id, total_allowed_amount AS allowed FROM s_invoices),
             f_claims AS (SELECT patient_id, CASE WHEN is_denied THEN 1 ELSE 0 END AS denied FROM s_claims_and_payments),
             f_all AS ({_JOINED})
        {_fan("visits", "appointments.visits")} UNION ALL {_fan("no_shows", "appointments.no_shows")}
        UNION ALL {_fan("allowed", "invoices.allowed")} UNION ALL {_fan("denied", "claims.denied")})""",
    "layer_count_join": """
        SELECT b.t AS table_name, b.n AS bronze_rows, s.n AS silver_rows, b.n = s.n AS match FROM
        (SELECT 'patients' AS t, count(*) AS n FROM b_patients UNION ALL SELECT 'appointments', count(*) FROM b_appointments
         UNION ALL SELECT 'invoices', count(*) FROM b_invoices UNION ALL SELECT 'claims_and_payments', count(*) FROM b_claims_and_payments) b
        JOIN (SELECT 'patients' AS t, count(*) AS n FROM s_patients UNION ALL SELECT 'appointments', count(*) FROM s_appointments
         UNION ALL SELECT 'invoices', count(*) FROM s_invoices UNION ALL SELECT 'claims_and_payments', count(*) FROM s_claims_and_payments) s
        ON b.t = s.t""",
    "fk_orphans": "SELECT appointment_id AS key, count(*) AS n FROM b_invoices WHERE appointment_id IS NOT NULL "
    "AND appointment_id NOT IN (SELECT appointment_id FROM b_appointments) GROUP BY 1",
    "limit_sample": "SELECT claim_id, invoice_id, claim_status FROM b_claims_and_payments ORDER BY claim_id LIMIT 5",
    "cross_join_pairs": "SELECT office_id, insurance_company_id FROM s_dental_offices CROSS JOIN s_insurance_companies",
    "shared_network": "SELECT office_id, insurance_company_id, shared_network_id FROM b_office_insurance_network "
    "WHERE shared_network_id IS NOT NULL",
    "composite_key_join": """
        SELECT c.claim_id, c.office_id, c.insurance_company_id, c.network_status, r.network_status AS network_status_ref,
               c.network_status = r.network_status AS agrees
        FROM s_claims_and_payments c JOIN s_office_insurance_network r
          ON c.office_id = r.office_id AND c.insurance_company_id = r.insurance_company_id""",
    "index_join": f"""
        SELECT i.invoice_id, cast(i.total_gross_amount AS double) AS total_gross_amount,
               cast(i.total_allowed_amount AS double) AS total_allowed_amount, l.g AS line_gross, l.a AS line_allowed
        FROM s_invoices i LEFT JOIN (SELECT invoice_id, {total("unit_price")} AS g, {total("allowed_amount")} AS a
                                     FROM b_lines_core GROUP BY 1) l ON i.invoice_id = l.invoice_id""",
    "dependent_policy": """
        SELECT patient_id, policy_id FROM s_primary_policy_holders UNION ALL
        SELECT d.patient_id, h.policy_id FROM s_policy_dependents d JOIN s_primary_policy_holders h ON d.subscriber_id = h.subscriber_id""",
    "coverage_lookup": """
        SELECT l.line_id, l.invoice_id, l.billing_code_id, i.policy_id, concat(r.policy_id, '-', r.billing_code_id) AS rule_key, cast(r.copay_flat_amount AS double) AS copay_flat_amount,
               r.coinsurance_percentage, r.deductible_applies
        FROM b_lines_core l JOIN b_invoices i ON l.invoice_id = i.invoice_id
        JOIN s_coverage_rules r ON r.policy_id = i.policy_id AND r.billing_code_id = l.billing_code_id""",
    "star_join_metric": """
        SELECT c.claim_id, c.insurance_company_id, c.office_id, c.patient_id, cast(c.amount_claimed AS double) AS amount_claimed,
               p.company_name AS payer_company_name, o.state AS office_state, t.gender AS patient_gender
        FROM s_claims_and_payments c LEFT JOIN s_insurance_companies p ON c.insurance_company_id = p.insurance_company_id
        LEFT JOIN s_dental_offices o ON c.office_id = o.office_id LEFT JOIN s_patients t ON c.patient_id = t.patient_id""",
    "subset_check": """
        SELECT count(*) FILTER (b.k IS NULL) AS only_a, count(*) FILTER (a.k IS NULL) AS only_b,
               count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS in_both
        FROM (SELECT DISTINCT appointment_id AS k FROM s_invoices) a
        FULL JOIN (SELECT DISTINCT appointment_id AS k FROM s_appointments WHERE appointment_status = 'completed') b ON a.k = b.k""",
    "set_equality": """
        SELECT count(*) FILTER (b.k IS NULL) AS only_a, count(*) FILTER (a.k IS NULL) AS only_b,
               count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS in_both
        FROM (SELECT DISTINCT claim_id AS k FROM s_claim_disputes) a
        FULL JOIN (SELECT DISTINCT claim_id AS k FROM s_claims_and_payments WHERE is_denied) b ON a.k = b.k""",
    "conditional_count": "SELECT network_status, count(*) FILTER (is_denied) AS denied, "
    "count(*) FILTER (amount_claimed > 100000) AS large FROM s_claims_and_payments GROUP BY 1",
    "conditional_sum": f"SELECT benefit_year, {total('CASE WHEN is_overdue THEN patient_balance ELSE 0 END')} AS overdue_balance "
    "FROM s_invoices GROUP BY 1",
    "rate_pct": f"SELECT office_id, {rate('is_denied')} AS denial_pct, {rate('is_denied', 1)} AS denial_pct_1 "
    "FROM s_claims_and_payments GROUP BY 1",
    "avg_round": f"SELECT insurance_company_id, {mean('days_to_adjudicate', 1)} AS days, {mean('unpaid_amount', 2)} AS unpaid "
    "FROM s_claims_and_payments GROUP BY 1",
    "count_distinct": "SELECT count(*) AS total_rows, count(DISTINCT patient_id) AS distinct_keys, "
    "count(*) - count(DISTINCT patient_id) AS duplicates FROM s_invoices",
    "min_max_bounds": "SELECT benefit_year AS label, count(*) AS n, min(service_date) AS first, max(service_date) AS last "
    "FROM s_claims_and_payments GROUP BY 1",
    "value_counts": "SELECT 'denial_reason_code' AS column_checked, denial_reason_code AS value, count(*) AS cnt "
    "FROM s_claims_and_payments GROUP BY 2",
    "utilization_buckets": """
        SELECT CASE WHEN benefit_used_pct < 25 THEN '0-25%' WHEN benefit_used_pct < 50 THEN '25-50%'
                    WHEN benefit_used_pct < 75 THEN '50-75%' WHEN benefit_used_pct < 100 THEN '75-100%' ELSE '100%+' END AS bucket,
               count(*) AS cnt FROM s_patient_benefit_years GROUP BY 1""",
    "avg_by_status": f"SELECT claim_status, count(*) AS cnt, {mean('unpaid_amount', 2)} AS mean FROM s_claims_and_payments GROUP BY 1",
    "collect_set_per_key": """
        SELECT DISTINCT n.office_id, n.network_id, m.networks FROM s_office_network_participation n
        JOIN (SELECT office_id, string_agg(DISTINCT cast(network_id AS varchar), ',' ORDER BY cast(network_id AS varchar)) AS networks
              FROM s_office_network_participation GROUP BY 1) m ON m.office_id = n.office_id""",
    "group_sizes": "SELECT appointment_id, count(*) AS n, count(*) BETWEEN 1 AND 3 AS in_range FROM s_appointment_reminders GROUP BY 1",
    "ratio_of_sums": """
        SELECT procedure_category, round(100.0::double * cast(sum(contractual_writeoff) AS double)
               / cast(nullif(sum(allowed_amount + contractual_writeoff), 0) AS double), 2) AS writeoff_pct
        FROM s_invoice_lines GROUP BY 1""",
    "doc_size_stats": """
        SELECT count(*) AS total_rows, cast(sum(length(html)) AS bigint) AS chars,
               round(cast(sum(length(html)) AS double) / count(html), 1) AS mean_chars,
               round(cast(sum(length(html)) AS double) / (1024.0 * 1024.0), 1) AS mb FROM pages""",
    "reminder_sequence": """
        SELECT appointment_reminder_id, appointment_id, cast(lead_days AS bigint) AS lead_days,
               row_number() OVER w AS seq, lead(lead_days) OVER w IS NULL AS is_last
        FROM s_appointment_reminders WINDOW w AS (PARTITION BY appointment_id ORDER BY lead_days DESC, appointment_reminder_id)""",
    "first_in_year": """
        SELECT appointment_id, patient_id, benefit_year, appointment_date_time,
               row_number() OVER (PARTITION BY patient_id, benefit_year ORDER BY appointment_date_time, appointment_id) = 1 AS is_first
        FROM s_appointments WHERE visit_type = 'cleaning'""",
    "noshow_concentration": """
        SELECT s.top_share, cast(max(ceil(s.top_share * r.n)) AS bigint) AS top_entities,
               cast(sum(CASE WHEN r.pos <= ceil(s.top_share * r.n) THEN r.events ELSE 0 END) AS bigint) AS top_events,
               round(cast(sum(CASE WHEN r.pos <= ceil(s.top_share * r.n) THEN r.events ELSE 0 END) AS double) / sum(r.events), 4) AS event_share
        FROM (SELECT events, row_number() OVER (ORDER BY events DESC, patient_id) AS pos, count(*) OVER () AS n
              FROM (SELECT patient_id, count(*) FILTER (is_no_show) AS events FROM s_appointments GROUP BY 1)) r
        CROSS JOIN (VALUES (0.1::double), (0.18::double), (0.5::double)) AS s(top_share) GROUP BY 1""",
    "seasonality": "SELECT month(service_date) AS month_no, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS rnk "
    "FROM s_invoices GROUP BY 1",
    "order_by_multi": "SELECT month, procedure_category, total_allowed FROM g_revenue_by_procedure ORDER BY 1, 2",
    "order_desc": f"SELECT {_KEYS}, total_sent FROM g_recall_effectiveness ORDER BY total_sent DESC, {_KEYS}",
    "topk": """
        SELECT office_id, office_name, specialty_type, total_revenue, no_show_rate_pct, denial_rate_pct
        FROM g_office_performance ORDER BY total_revenue DESC, office_id LIMIT 5""",
    "latest_month_rows": """
        SELECT month, procedure_category, total_allowed, insurance_portion, patient_portion FROM g_revenue_by_procedure
        ORDER BY month DESC, procedure_category LIMIT 12""",
    "distinct_rows": "SELECT DISTINCT visit_type, total_appointments, no_show_rate_pct, cancellation_rate_pct FROM g_appointment_analytics",
    "union_all_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM s_{t}" for t in TABLES),
    "value_inventory": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM s_{t} GROUP BY {c}" for t, c in CATEGORICAL
    ),
    "set_difference": """
        SELECT coalesce(e.k, a.k) AS billing_code_id, CASE WHEN a.k IS NULL THEN 'missing' ELSE 'extra' END AS side
        FROM (SELECT DISTINCT billing_code_id AS k FROM s_billing_codes WHERE requires_prior_auth) e
        FULL JOIN (SELECT DISTINCT billing_code_id AS k FROM b_lines_core) a ON e.k = a.k WHERE e.k IS NULL OR a.k IS NULL""",
}

