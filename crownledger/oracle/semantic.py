"""SQL for the queries of ``plans.semantic``."""

from crownledger.operators.semantic import ROUTE_TERMS, SYNONYMS
from crownledger.oracle.tables import AS_OF, label, rate, total

_SYN = ", ".join(f"('{column}', '{term}', '{stored}')" for column, term, stored in SYNONYMS)
_STAR = """s_claims_and_payments c LEFT JOIN s_insurance_companies p ON c.insurance_company_id = p.insurance_company_id
        LEFT JOIN s_dental_offices o ON c.office_id = o.office_id"""
_REV = "s_invoices i LEFT JOIN s_patients p ON i.patient_id = p.patient_id"


def _says(route: str) -> str:
    return "(" + " OR ".join(f"contains(t, '{w}')" for w in ROUTE_TERMS[route]) + ")"


_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"

_ROUTE = f"""
    WITH r_p AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    r_stat AS (SELECT count(*) AS n, avg(len(w)) AS avg_len FROM r_p),
    r_tf AS (SELECT item_id, l, term, count(*) AS tf FROM (SELECT item_id, len(w) AS l, unnest(w) AS term FROM r_p) GROUP BY 1, 2, 3),
    r_df AS (SELECT term, count(*) AS df FROM r_tf GROUP BY 1),
    r_w AS (SELECT item_id, t.term, ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double
                   / (tf + 1.2::double * (0.25::double + 0.75::double * l / avg_len)) AS weight
            FROM r_tf t JOIN r_df d ON d.term = t.term CROSS JOIN r_stat),
    r_ask AS (SELECT DISTINCT conv_id, turn, unnest({_WORDS}) AS term FROM conversations WHERE role = 'user'),
    r_best AS (SELECT conv_id, turn, max(score) AS best FROM (
        SELECT conv_id, turn, item_id, round(sum(weight), 6) AS score FROM r_ask a JOIN r_w w ON w.term = a.term GROUP BY 1, 2, 3) GROUP BY 1, 2)
    SELECT q.conv_id, q.turn, CASE WHEN {_says("decline")} THEN 'decline' WHEN {_says("data")} AND {_says("document")} THEN 'ambiguous'
           WHEN {_says("data")} THEN 'data' WHEN {_says("document")} OR coalesce(best, 0) >= 10 THEN 'document' ELSE 'ambiguous' END AS route
    FROM (SELECT conv_id, turn, lower(coalesce(text, '')) AS t FROM conversations WHERE role = 'user') q
    LEFT JOIN r_best b ON b.conv_id = q.conv_id AND b.turn = q.turn"""

SQL = {
    "normalize_value": f"""
        SELECT x.claim_id, x.column_name, x.term, s.v AS canonical, s.v IS NOT NULL AS matched
        FROM (SELECT claim_id, 'claim_status' AS column_name, claim_status AS term FROM b_claims_and_payments
              UNION ALL SELECT claim_id, 'network_status', network_status FROM b_claims_and_payments
              UNION ALL SELECT claim_id, 'denial_reason_code', denial_reason_code FROM b_claims_and_payments) x
        LEFT JOIN (VALUES {_SYN}) AS s(c, w, v) ON s.c = x.column_name AND s.w = lower(trim(x.term)) WHERE x.term IS NOT NULL""",
    "amount_semantics": " UNION ALL ".join(
        f"SELECT '{n}' AS measure, {total(c)} AS amount FROM s_{t}"
        for n, t, c in [
            ("production", "invoices", "total_gross_amount"),
            ("allowed", "invoices", "total_allowed_amount"),
            ("write-off", "invoices", "total_contractual_writeoff"),
            ("collections", "claims_and_payments", "amount_paid"),
            ("a/r", "invoices", "patient_balance"),
            ("revenue", "claims_and_payments", "amount_paid"),
        ]
    ),
    "benefit_year_check": f"SELECT {label('service_date')} AS derived_benefit_year, count(*) AS claims, min(service_date) AS first_service, "
    "max(service_date) AS last_service FROM s_claims_and_payments GROUP BY 1",
    "benefit_year_drift": f"SELECT benefit_year AS stored, {label('service_date')} AS derived, count(*) AS n FROM s_invoices GROUP BY 1, 2",
    "q_claims_in_benefit_year": f"SELECT count(*) AS claims FROM s_claims_and_payments WHERE {label('service_date')} = '1998-99'",
    "q_claims_by_reason": "SELECT claim_id, patient_id, service_date, cast(amount_claimed AS double) AS amount_claimed, denial_reason_code "
    "FROM s_claims_and_payments WHERE claim_status = 'denied' AND denial_reason_code = 'Max Benefit Exceeded'",
    "q_denial_rate_by_payer": f"""
        SELECT p.insurance_company_id, p.company_name, count(*) AS total_claims,
               count(*) FILTER (c.claim_status = 'denied') AS denied_claims, {rate("c.claim_status = 'denied'", 1)} AS denial_rate_pct
        FROM s_claims_and_payments c JOIN s_insurance_companies p ON c.insurance_company_id = p.insurance_company_id GROUP BY 1, 2""",
    "q_writeoff_by_category": f"""
        SELECT b.procedure_category, {total("l.contractual_writeoff")} AS total_writeoff,
               round(100.0::double * {total("l.contractual_writeoff")}
                     / nullif({total("l.allowed_amount + l.contractual_writeoff")}, 0), 1) AS writeoff_pct_of_gross
        FROM s_invoice_lines l JOIN s_billing_codes b ON l.billing_code_id = b.billing_code_id GROUP BY 1""",
    "q_monthly_completed": f"""
        SELECT cast(date_trunc('month', appointment_date) AS date) AS month, {label("appointment_date")} AS benefit_year,
               count(*) AS completed_appointments FROM s_appointments WHERE appointment_status = 'completed' GROUP BY 1, 2""",
    "q_ar_over_90": f"""
        SELECT o.office_id, o.office_name, {total("v.patient_balance")} AS balance_over_90d, count(*) AS invoices
        FROM s_invoices v JOIN s_dental_offices o ON v.office_id = o.office_id
        WHERE v.patient_balance > 0 AND datediff('day', v.due_date, {AS_OF}) > 90
        GROUP BY 1, 2 ORDER BY balance_over_90d DESC, o.office_id LIMIT 5""",
    "q_calendar_year_split": f"SELECT {label('service_date')} AS benefit_year, count(*) AS claims FROM s_claims_and_payments "
    "WHERE year(service_date) = 1998 GROUP BY 1",
    "q_noshow_history": "SELECT patient_id, count(*) FILTER (is_no_show) AS no_shows, count(*) AS visits FROM s_appointments GROUP BY 1 "
    "ORDER BY no_shows DESC, patient_id",
    "ar_aging": f"""
        SELECT CASE WHEN d <= 30 THEN '0-30' WHEN d <= 60 THEN '31-60' WHEN d <= 90 THEN '61-90' ELSE '90+' END AS bucket,
               {total("patient_balance")} AS balance, count(*) AS n
        FROM (SELECT patient_balance, datediff('day', due_date, {AS_OF}) AS d FROM s_invoices) WHERE patient_balance > 0 AND d > 0 GROUP BY 1""",
    "metric_view": f"""
        SELECT p.payer_type, c.claim_status, count(*) AS claim_count, {total("c.amount_claimed")} AS total_claimed
        FROM {_STAR} WHERE c.network_status = 'in-network' GROUP BY 1, 2""",
    "mv_claims": f"""
        SELECT p.company_name, o.state AS office_state, p.payer_type, c.claim_status,
               {total("c.amount_claimed - c.amount_paid")} AS unpaid_amount, {total("c.amount_claimed")} AS total_claimed,
               {total("c.amount_paid")} AS total_paid, count(*) AS claim_count FROM {_STAR} GROUP BY 1, 2, 3, 4""",
    "mv_revenue": f"""
        SELECT p.gender, p.state AS patient_state, cast(p.age AS bigint) AS age, {total("i.total_allowed_amount")} AS total_revenue,
               count(*) AS invoice_count FROM {_REV} GROUP BY 1, 2, 3""",
    "chart_unpaid_by_payer": f"SELECT p.company_name, {total('c.amount_claimed - c.amount_paid')} AS unpaid_amount FROM {_STAR} GROUP BY 1",
    "chart_claimed_by_office": f"SELECT o.office_name, {total('c.amount_claimed')} AS total_claimed FROM {_STAR} GROUP BY 1",
    "chart_claims_by_state": f"SELECT o.state AS office_state, count(*) AS claim_count FROM {_STAR} GROUP BY 1",
    "chart_paid_by_payer_type": f"SELECT p.payer_type, {total('c.amount_paid')} AS total_paid FROM {_STAR} GROUP BY 1",
    "chart_revenue_by_gender": f"SELECT p.gender, {total('i.total_allowed_amount')} AS total_revenue FROM {_REV} GROUP BY 1",
    "chart_unpaid_by_office": f"SELECT o.office_name, {total('c.amount_claimed - c.amount_paid')} AS unpaid_amount FROM {_STAR} GROUP BY 1",
    "ds_overview_kpis": "SELECT total_patients, total_appointments, total_claims, total_revenue, denial_rate_pct, no_show_rate_pct FROM g_kpi_summary",
    "ds_appointment_status": "SELECT appointment_status, count(*) AS n FROM s_appointments GROUP BY 1",
    "ds_claim_status": "SELECT claim_status, count(*) AS n FROM s_claims_and_payments GROUP BY 1",
    "ds_dispute_outcomes": "SELECT dispute_outcome, count(*) AS n FROM s_claim_disputes GROUP BY 1",
    "ds_monthly_financials": "SELECT month, net_revenue AS revenue, outstanding_patient_balance AS balance FROM g_monthly_revenue",
    "ds_denial_by_payer": "SELECT insurance_company_id, company_name, actual_denial_rate_pct, avg_days_to_adjudicate FROM g_payer_performance",
    "ds_denial_reasons": "SELECT denial_reason_code, count(*) AS n FROM s_claims_and_payments WHERE is_denied GROUP BY 1",
    "ds_appointments_by_office": "SELECT office_id, office_name, total_appointments FROM g_office_performance",
    "ds_noshow_by_age_group": """
        SELECT age_group, round(100.0::double * sum(no_show_count) / nullif(sum(total_appointments), 0), 2) AS no_show_rate_pct
        FROM g_patient_summary GROUP BY 1""",
    "ds_visit_types": "SELECT visit_type, cast(sum(total_appointments) AS bigint) AS n FROM g_appointment_analytics GROUP BY 1",
    "ds_recall_effectiveness": "SELECT recall_type, round(100.0::double * sum(appointments_created) / sum(total_sent), 2) AS conversion_rate_pct "
    "FROM g_recall_effectiveness GROUP BY 1",
    "ds_balance_by_office": "SELECT office_id, office_name, outstanding_patient_balance FROM g_office_performance",
    "ds_revenue_by_category": f"SELECT procedure_category, {total('allowed_amount')} AS allowed FROM s_invoice_lines l "
    "JOIN s_invoices i ON i.invoice_id = l.invoice_id GROUP BY 1",
    "ds_network_comparison": f"SELECT network_status, count(*) AS n, {total('amount_claimed')} AS claimed FROM s_claims_and_payments GROUP BY 1",
    "measure_revenue_per_patient": f"SELECT round((SELECT {total('total_allowed_amount')} FROM s_invoices) / (SELECT count(*) FROM s_patients), 4) AS revenue_per_patient",
    "measure_claims_per_appointment": "SELECT round(cast((SELECT count(*) FROM s_claims_and_payments) AS double) / (SELECT count(*) FROM s_appointments), 4) AS claims_per_appointment",
    "measure_revenue_per_office": f"SELECT round((SELECT {total('total_allowed_amount')} FROM s_invoices) / (SELECT count(*) FROM s_dental_offices), 4) AS revenue_per_office",
    "measure_unpaid_amount": f"SELECT {total('amount_claimed - amount_paid')} AS unpaid_claim_amount FROM s_claims_and_payments",
    "route_questions": _ROUTE,
    "route_eval": f"""
        WITH r_routes AS ({_ROUTE})
        SELECT f.route AS expected, r.route AS got, count(*) AS n
        FROM r_routes r JOIN (SELECT conv_id, arg_min(route, turn) AS route FROM r_routes GROUP BY 1) f ON f.conv_id = r.conv_id GROUP BY 1, 2""",
}
