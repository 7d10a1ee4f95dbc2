"""SQL for the queries of ``plans.rules``."""

_ALLOWED = """SELECT l.line_id, l.billing_code_id, s.network_status, c.standard_fee,
               CASE WHEN s.network_status = 'In-Network' THEN c.in_network_allowed_amount ELSE c.out_network_allowed_amount END AS allowed_amount
        FROM b_lines_core l JOIN b_claims_and_payments s ON s.invoice_id = l.invoice_id
        JOIN b_billing_codes c ON c.billing_code_id = l.billing_code_id"""

SQL = {
    "deductible_accumulator": "SELECT line_id, invoice_id, patient_id, benefit_year, cast(allowed_amount AS double) AS allowed_amount, "
    "cast(deductible_applied AS double) AS deductible_applied FROM a_deductible",
    "annual_max_accumulator": "SELECT line_id, invoice_id, patient_id, benefit_year, cast(est_uncapped AS double) AS est_uncapped, "
    "cast(est_insurance AS double) AS paid_est FROM a_capped",
    "benefit_year_rollup": """
        SELECT patient_id, benefit_year, policy_id, cast(individual_deductible AS double) AS individual_deductible,
               cast(deductible_met AS double) AS deductible_met, cast(annual_maximum AS double) AS annual_maximum,
               cast(benefit_used AS double) AS benefit_used, cast(benefit_remaining AS double) AS benefit_remaining
        FROM b_patient_benefit_years""",
    "allowed_amount": f"SELECT line_id, billing_code_id, network_status, cast(allowed_amount AS double) AS allowed_amount FROM ({_ALLOWED})",
    "contractual_writeoff": f"""
        SELECT line_id, network_status, cast(standard_fee AS double) AS standard_fee, cast(allowed_amount AS double) AS allowed_amount,
               CASE WHEN network_status = 'In-Network' THEN cast(standard_fee - allowed_amount AS double) ELSE 0.0::double END AS contractual_writeoff
        FROM ({_ALLOWED})""",
    "insurance_estimate": "SELECT line_id, cast(deductible_applied AS double) AS deductible_applied, "
    "cast(copay_flat_amount AS double) AS copay_flat_amount, coinsurance_percentage, cast(est_insurance AS double) AS est_insurance FROM a_capped",
    "patient_estimate": "SELECT line_id, cast(allowed_amount AS double) AS allowed_amount, cast(est_insurance AS double) AS est_insurance, "
    "cast(allowed_amount - est_insurance AS double) AS est_patient FROM a_capped",
    "invoice_rollup": """
        SELECT i.invoice_id, i.service_date, cast(i.actual_patient_paid_at_visit AS double) AS actual_patient_paid_at_visit,
               cast(sum(l.unit_price) AS double) AS total_gross_amount, cast(sum(l.allowed_amount) AS double) AS total_allowed_amount,
               cast(sum(l.contractual_writeoff) AS double) AS total_contractual_writeoff,
               cast(sum(l.estimated_insurance_amount) AS double) AS estimated_insurance_responsibility,
               cast(sum(l.estimated_patient_amount) AS double) AS estimated_copay_due,
               cast(sum(l.estimated_patient_amount) - i.actual_patient_paid_at_visit AS double) AS patient_balance,
               cast(i.service_date + 30 AS date) AS due_date
        FROM b_invoices i JOIN b_invoice_lines l ON l.invoice_id = i.invoice_id
        GROUP BY i.invoice_id, i.service_date, i.actual_patient_paid_at_visit""",
    "needs_prior_auth": "SELECT invoice_id, needs_auth FROM a_auth",
    "adjudication_days": "SELECT claim_id, submitted_date, adjudicated_date, datediff('day', submitted_date, adjudicated_date) AS days "
    "FROM b_claims_and_payments",
    "denial_reason_precedence": """
        SELECT claim_id, is_denied, is_exhausted, needs_auth,
               CASE WHEN NOT is_denied THEN NULL WHEN is_exhausted THEN 'Max Benefit Exceeded' WHEN needs_auth THEN 'Prior Auth Required'
                    ELSE denial_reason_code END AS reason FROM a_claims""",
    "denial_risk_score": """
        SELECT c.claim_id, c.insurance_company_id,
               cast(least(cast(p.denial_rate_baseline AS decimal(6,4)) + CASE WHEN c.needs_auth THEN 0.25 ELSE 0 END
                    + CASE WHEN c.is_exhausted THEN 0.30 ELSE 0 END + CASE WHEN c.network_status <> 'in-network' THEN 0.05 ELSE 0 END, 0.85) AS double) AS risk
        FROM a_claims c JOIN s_insurance_companies p ON p.insurance_company_id = c.insurance_company_id""",
    "dispute_reason_map": """
        SELECT claim_id, dispute_id, dispute_reason_category, denial_reason_code, category,
               lower(category) = dispute_reason_category AS agrees
        FROM (SELECT d.claim_id, d.dispute_id, d.dispute_reason_category, c.denial_reason_code,
                     CASE WHEN c.denial_reason_code IN ('Prior Auth Required', 'Missing X-Ray') THEN 'Medical Necessity'
                          WHEN c.denial_reason_code = 'Max Benefit Exceeded' THEN 'Benefit Limit' ELSE 'Administrative Error' END AS category
              FROM s_claim_disputes d JOIN s_claims_and_payments c ON c.claim_id = d.claim_id)""",
    "amount_recovered": """
        SELECT d.claim_id, d.dispute_id, d.dispute_outcome, cast(c.amount_claimed AS double) AS amount_claimed,
               CASE WHEN d.dispute_outcome = 'overturned-paid' THEN cast(c.amount_claimed AS double) ELSE 0.0::double END AS amount_recovered
        FROM s_claim_disputes d JOIN s_claims_and_payments c ON c.claim_id = d.claim_id""",
    "network_status": "SELECT office_id, insurance_company_id, coalesce(shared_network_id, 0) AS shared_network_id, network_status "
    "FROM b_office_insurance_network",
    "coverage_matrix": """
        SELECT concat(policy_id, '-', billing_code_id) AS rule_key, policy_id, billing_code_id,
               cast(copay_flat_amount AS double) AS copay_flat_amount, coinsurance_percentage, deductible_applies,
               cast(coalesce(frequency_limit_per_year, 0) AS bigint) AS frequency_limit_per_year FROM b_coverage_rules""",
    "coverage_tier": """
        SELECT h.subscriber_id, coalesce(d.n, 0) AS dependents,
               CASE WHEN coalesce(d.n, 0) > 1 THEN 'Employee + Family' ELSE 'Employee + One' END AS tier,
               CASE WHEN coalesce(d.n, 0) > 1 THEN 'Employee + Family' ELSE 'Employee + One' END = h.coverage_tier AS agrees
        FROM b_primary_policy_holders h
        LEFT JOIN (SELECT subscriber_id, count(*) AS n FROM b_policy_dependents GROUP BY 1) d ON d.subscriber_id = h.subscriber_id""",
    "weekday_shift": """
        SELECT claim_id, adjudicated_date, cast(adjudicated_date + CASE isodow(adjudicated_date) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS date) AS business_date
        FROM b_claims_and_payments""",
    "recall_to_visit": """
        SELECT r.communication_channel, count(*) AS sent, count(*) FILTER (a.k IS NOT NULL) AS booked,
               round(100.0::double * count(*) FILTER (a.k IS NOT NULL) / count(*), 2) AS booked_pct
        FROM s_recall_reminders r LEFT JOIN (SELECT DISTINCT source_recall_id AS k FROM s_appointments WHERE source_recall_id > 0) a
          ON a.k = r.recall_id GROUP BY 1""",
}
