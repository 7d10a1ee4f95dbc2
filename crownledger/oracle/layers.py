"""SQL for the queries of ``plans.layers``."""

from crownledger.oracle.tables import AS_OF, SILVER_QUERIES, label

SQL = {
    **SILVER_QUERIES,
    "gold_kpi_summary": "SELECT * FROM g_kpi_summary",
    "gold_monthly_revenue": "SELECT * FROM g_monthly_revenue",
    "gold_revenue_by_procedure": "SELECT * FROM g_revenue_by_procedure",
    "gold_patient_summary": "SELECT * FROM g_patient_summary",
    "gold_office_performance": "SELECT * FROM g_office_performance",
    "gold_payer_performance": "SELECT * FROM g_payer_performance",
    "gold_appointment_analytics": "SELECT * FROM g_appointment_analytics",
    "gold_recall_effectiveness": "SELECT * FROM g_recall_effectiveness",
    "standardize_text": "SELECT office_id, lower(office_name) AS office_name, lower(city) AS city, upper(state) AS state, "
    "lower(specialty_type) AS specialty_type FROM b_dental_offices",
    "null_defaults": "SELECT claim_id, claim_status, coalesce(denial_reason_code, CASE WHEN claim_status = 'Denied' "
    "THEN 'UNKNOWN' ELSE 'N/A' END) AS denial_reason_code, coalesce(office_id, -1) AS office_id FROM b_claims_and_payments",
    "audit_column": "SELECT insurance_company_id, true AS is_stamped, true AS not_in_future FROM s_insurance_companies",
    "scalar_suite": rf"""
        SELECT claim_id, upper(claim_status) AS status_upper, lower(network_status) AS network_lower,
               coalesce(denial_reason_code, 'none') AS reason_or_none,
               CASE WHEN days_to_adjudicate BETWEEN 10 AND 19 THEN 'fast' WHEN days_to_adjudicate BETWEEN 20 AND 39 THEN 'normal'
                    ELSE 'slow' END AS speed_band,
               claim_status = 'Denied' AS is_denied, {AS_OF} > service_date AND amount_claimed > 0 AS is_past_with_amount,
               cast(round(amount_claimed * 0.1, 2) AS double) AS tenth, cast(amount_claimed - amount_paid AS double) AS unpaid,
               cast(service_date AS varchar) AS service_text, dayname(service_date) AS weekday,
               datediff('day', service_date, {AS_OF}) AS age_days, cast(date_trunc('month', service_date) AS date) AS month,
               year(service_date) AS y, month(service_date) AS m, concat('C', right(cast(claim_id AS varchar), 2)) AS short_id,
               round(cast(amount_paid AS double) / cast(nullif(amount_claimed, 0) AS double), 4) AS paid_ratio,
               CASE WHEN claim_id % 120 < 25 THEN '0-25%' WHEN claim_id % 120 < 50 THEN '25-50%' WHEN claim_id % 120 < 75 THEN '50-75%'
                    WHEN claim_id % 120 < 100 THEN '75-100%' ELSE '100%+' END AS band,
               length(coalesce(denial_reason_code, '')) AS reason_len, left(claim_status, 3) AS status_left,
               claim_status LIKE '%-Paid' AS is_paid_suffix, 'amount_paid' LIKE 'amount\_%' ESCAPE '\' AS escaped_like,
               denial_reason_code IN ('Coding Error', 'Missing X-Ray') AS is_listed,
               coalesce(denial_reason_code, 'N/A') <> 'N/A' AS has_reason, denial_reason_code IS NULL AS reason_is_null,
               cast(claim_id AS varchar) AS base_name, cast(service_date + 30 AS date) AS due, cast(service_date - 7 AS date) AS week_before,
               cast(least(days_to_adjudicate, 30) AS bigint) AS capped_days, cast(greatest(days_to_adjudicate, 20) AS bigint) AS floored_days,
               abs(amount_claimed - amount_paid) < 0.02 AS is_settled, '2.0' AS option, claim_id AS first_page,
               'OBJECT<id: BIGINT>' AS shape
        FROM b_claims_and_payments""",
    "benefit_year_label": f"""
        SELECT claim_id, {label("service_date")} AS september,
               CASE WHEN month(service_date) >= 7 THEN concat(year(service_date), '-', right(cast(year(service_date) + 1 AS varchar), 2))
                    ELSE concat(year(service_date) - 1, '-', right(cast(year(service_date) AS varchar), 2)) END AS july,
               concat(year(service_date), '-', right(cast(year(service_date) + 1 AS varchar), 2)) AS january
        FROM b_claims_and_payments""",
    "stable_key": "SELECT doc_id, sha256(concat_ws('::', source, lang, doc_id)) AS chunk_id FROM documents",
}
