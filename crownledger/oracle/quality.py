"""SQL for the queries of ``plans.quality``."""

from crownledger.oracle.retrieval import DUPLICATE_IDS
from crownledger.schemas import FOREIGN_KEYS, TABLES


def _row(name: str, checked: str, violations: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS rule, cast({checked} AS bigint) AS checked, cast({violations} AS bigint) AS violations, "
        f"coalesce({violations}, 0) = 0 AS passed FROM {source}"
    )


def _sizes(table: str, keys: str, lo: int, hi: int, name: str, where: str = "true") -> str:
    return _row(
        name,
        "count(*)",
        f"count(*) FILTER (n NOT BETWEEN {lo} AND {hi})",
        f"(SELECT count(*) AS n FROM {table} WHERE {where} GROUP BY {keys})",
    )


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


SQL = {
    "dq_foreign_keys": _union(
        *[
            _row(
                fk.rule,
                f"count(c.{fk.column})",
                f"count(*) FILTER (c.{fk.column} IS NOT NULL AND p.k IS NULL)",
                f"b_{fk.child} c LEFT JOIN (SELECT DISTINCT {fk.key} AS k FROM b_{fk.parent}) p ON c.{fk.column} = p.k",
            )
            for fk in FOREIGN_KEYS
        ]
    ),
    "dq_cardinality": _union(
        _sizes("b_insurance_company_networks", "insurance_company_id", 1, 3, "1-3 networks per company"),
        _sizes("b_office_network_participation", "office_id", 1, 3, "1-3 networks per office"),
        _sizes("b_policy_dependents", "subscriber_id", 1, 5, "1-5 dependents per holder"),
        _sizes("b_recall_reminders", "patient_id, benefit_year", 2, 2, "2 recalls per patient and year"),
        _sizes("b_appointment_reminders", "appointment_id", 1, 3, "1-3 reminders per visit"),
        _sizes(
            "b_appointments", "patient_id, benefit_year", 0, 2, "0-2 other visits per patient and year", "source_recall_id IS NULL"
        ),
        _sizes("b_invoice_lines", "invoice_id", 1, 5, "1-5 lines per invoice"),
    ),
    "dq_cross_product": _union(
        *[
            _row(
                name,
                f"(SELECT count(*) FROM {child})",
                f"abs((SELECT count(*) FROM {child}) - (SELECT count(*) FROM {a}) * (SELECT count(*) FROM {b}))",
                "(SELECT 1)",
            )
            for name, child, a, b in [
                ("a status for every office and company", "b_office_insurance_network", "b_dental_offices", "b_insurance_companies"),
                ("a rule for every policy and code", "b_coverage_rules", "b_insurance_policies", "b_billing_codes"),
            ]
        ]
    ),
    "dq_unique_key": _union(
        _sizes("b_coverage_rules", "policy_id, billing_code_id", 1, 1, "one rule per policy and code"),
        _sizes("b_patient_benefit_years", "patient_id, benefit_year", 1, 1, "one row per patient and year"),
    ),
    "dq_one_to_one": _union(
        _row("invoice is 1:1 with appointment", "count(*)", "count(*) - count(DISTINCT appointment_id)", "b_invoices"),
        _row("claim is 1:1 with invoice", "count(*)", "count(*) - count(DISTINCT invoice_id)", "b_claims_and_payments"),
    ),
    "dq_set_equality": _row(
        "invoices for exactly the completed visits",
        "count(*)",
        "count(*) FILTER (a.k IS NULL OR b.k IS NULL)",
        "(SELECT DISTINCT appointment_id AS k FROM b_invoices) a FULL JOIN (SELECT DISTINCT appointment_id AS k "
        "FROM b_appointments WHERE appointment_status = 'Completed') b ON a.k = b.k",
    ),
    "dq_conditional_subset": _row(
        "disputes on denied claims only",
        "count(*)",
        "count(*) FILTER (d.n > 1 OR c.claim_id IS NULL)",
        "(SELECT claim_id, count(*) AS n FROM b_claim_disputes GROUP BY 1) d LEFT JOIN (SELECT claim_id FROM b_claims_and_payments "
        "WHERE claim_status = 'Denied') c ON d.claim_id = c.claim_id",
    ),
    "dq_nullable_present": _row(
        "walk-ins exist",
        "count(*)",
        "CASE WHEN count(*) FILTER (source_recall_id IS NULL) > 0 THEN 0 ELSE 1 END",
        "b_appointments",
    ),
    "dq_row_identity": _union(
        _row(
            "write-off = fee - allowed (in-network)",
            "count(*)",
            "count(*) FILTER (abs(unit_price - allowed_amount - contractual_writeoff) >= 0.02)",
            "b_invoice_lines WHERE contractual_writeoff > 0",
        ),
        _row(
            "patient = allowed - insurance",
            "count(*)",
            "count(*) FILTER (abs(estimated_patient_amount - (allowed_amount - estimated_insurance_amount)) >= 0.02)",
            "b_invoice_lines",
        ),
        _row(
            "balance = due - paid",
            "count(*)",
            "count(*) FILTER (abs(estimated_copay_due - actual_patient_paid_at_visit - patient_balance) >= 0.02)",
            "b_invoices",
        ),
        _row(
            "remaining = maximum - used",
            "count(*)",
            "count(*) FILTER (abs(annual_maximum - benefit_used - benefit_remaining) >= 0.02)",
            "b_patient_benefit_years",
        ),
    ),
    "dq_header_vs_lines": _union(
        *[
            _row(
                f"{head} = sum of {line}",
                "count(s.x)",
                f"count(*) FILTER (abs(i.{head} - s.x) >= 0.02)",
                f"b_invoices i JOIN (SELECT invoice_id, sum({line}) AS x FROM b_lines_core GROUP BY 1) s ON i.invoice_id = s.invoice_id",
            )
            for head, line in [("total_gross_amount", "unit_price"), ("total_allowed_amount", "allowed_amount")]
        ]
    ),
    "dq_upper_bound": _row(
        "used within the maximum", "count(*)", "count(*) FILTER (benefit_used > annual_maximum)", "b_patient_benefit_years"
    ),
    "dq_rule_conformance": """
        SELECT concat('plan design: ', lower(c.procedure_category)) AS rule, count(*) AS checked,
               count(*) FILTER (NOT (r.coinsurance_percentage = p.coinsurance_percentage AND r.copay_flat_amount = p.copay_flat_amount
                                     AND r.deductible_applies = p.deductible_applies)) AS violations,
               count(*) FILTER (NOT (r.coinsurance_percentage = p.coinsurance_percentage AND r.copay_flat_amount = p.copay_flat_amount
                                     AND r.deductible_applies = p.deductible_applies)) = 0 AS passed
        FROM b_coverage_rules r JOIN b_billing_codes c ON c.billing_code_id = r.billing_code_id
        JOIN b_plan p ON p.procedure_category = lower(c.procedure_category) GROUP BY 1""",
    "dq_ratio_range": _union(
        _row(
            "in-network 60-75% of fee",
            "count(*)",
            "count(*) FILTER (in_network_allowed_amount NOT BETWEEN standard_fee * 0.60 AND standard_fee * 0.75)",
            "b_billing_codes",
        ),
        _row(
            "out-network 85-95% of fee",
            "count(*)",
            "count(*) FILTER (out_network_allowed_amount NOT BETWEEN standard_fee * 0.85 AND standard_fee * 0.95)",
            "b_billing_codes",
        ),
    ),
    "dq_recompute_status": _row(
        "network status is derived",
        "count(*)",
        "count(*) FILTER ((o.network_status = 'In-Network') <> coalesce(s.ok, false))",
        """b_office_insurance_network o LEFT JOIN (SELECT DISTINCT p.office_id, n.insurance_company_id, true AS ok
           FROM b_office_network_participation p JOIN b_insurance_company_networks n ON p.network_id = n.network_id) s
           ON s.office_id = o.office_id AND s.insurance_company_id = o.insurance_company_id""",
    ),
    "dq_cross_table_status": _row(
        "claim status agrees with the network table",
        "count(*)",
        "count(*) FILTER (c.network_status <> r.network_status)",
        "b_claims_and_payments c JOIN b_office_insurance_network r ON c.office_id = r.office_id "
        "AND c.insurance_company_id = r.insurance_company_id",
    ),
    "dq_layer_reconcile": _union(
        *[
            f"SELECT '{t}' AS table_name, (SELECT count(*) FROM b_{t}) AS bronze_rows, (SELECT count(*) FROM s_{t}) AS silver_rows, "
            f"(SELECT count(*) FROM b_{t}) = (SELECT count(*) FROM s_{t}) AS match"
            for t in TABLES
        ]
    ),
    "dq_no_nulls_after_fix": _union(
        *[
            _row(f"{t}.{c} has no null", "count(*)", f"count(*) FILTER ({c} IS NULL)", f"s_{t}")
            for t, cols in [
                ("claims_and_payments", ["denial_reason_code", "claim_status", "is_denied"]),
                ("appointments", ["source_recall_id", "appointment_status", "is_no_show"]),
                ("office_insurance_network", ["shared_network_id"]),
                ("patients", ["age", "age_group", "gender"]),
            ]
            for c in cols
        ],
        *[
            _row(
                f"{flag} counts the source",
                f"(SELECT count(*) FROM b_{t} WHERE {col} = '{value}')",
                f"abs((SELECT count(*) FROM s_{t} WHERE {flag}) - (SELECT count(*) FROM b_{t} WHERE {col} = '{value}'))",
                "(SELECT 1)",
            )
            for flag, t, col, value in [
                ("is_no_show", "appointments", "appointment_status", "No-Show"),
                ("is_denied", "claims_and_payments", "claim_status", "Denied"),
            ]
        ],
    ),
    "dq_indexed_rows": _row(
        "labels cover the documents",
        "count(s.doc_id)",
        "count(*) FILTER (s.doc_id IS NULL OR i.doc_id IS NULL)",
        "(SELECT DISTINCT doc_id FROM labels) i FULL JOIN (SELECT DISTINCT doc_id FROM documents) s ON i.doc_id = s.doc_id",
    ),
    "dq_expected_tables": f"""
        SELECT 'exactly the declared tables' AS rule, count(*) AS checked, {len(TABLES)} - count(*) AS violations,
               count(*) = {len(TABLES)} AS passed
        FROM ({_union(*[f"SELECT '{t}' AS t, count(*) AS n FROM b_{t}" for t in TABLES])})""",
}

SQL["dq_every_visit"] = _row(
    "1-3 reminders for every visit",
    "count(*)",
    "count(*) FILTER (n NOT BETWEEN 1 AND 3)",
    """(SELECT a.appointment_id, count(r.appointment_id) AS n FROM (SELECT DISTINCT appointment_id FROM b_appointments) a
        LEFT JOIN b_appointment_reminders r ON r.appointment_id = a.appointment_id GROUP BY 1)""",
)
SQL["dq_writeoff_fee"] = _row(
    "write-off = fee of the code * quantity - allowed",
    "count(*)",
    "count(*) FILTER (abs(c.standard_fee * l.quantity - l.allowed_amount - l.contractual_writeoff) >= 0.02)",
    "b_invoice_lines l JOIN b_billing_codes c ON c.billing_code_id = l.billing_code_id WHERE l.contractual_writeoff > 0",
)
SQL["dq_duplicate_ids"] = DUPLICATE_IDS
SQL["dq_report"] = _union(
    *[
        f"({SQL[k]})"
        for k in [
            "dq_foreign_keys",
            "dq_cardinality",
            "dq_cross_product",
            "dq_unique_key",
            "dq_one_to_one",
            "dq_set_equality",
            "dq_conditional_subset",
            "dq_nullable_present",
            "dq_row_identity",
            "dq_header_vs_lines",
            "dq_upper_bound",
            "dq_rule_conformance",
            "dq_ratio_range",
            "dq_recompute_status",
            "dq_cross_table_status",
            "dq_no_nulls_after_fix",
            "dq_indexed_rows",
            "dq_every_visit",
            "dq_writeoff_fee",
            "dq_duplicate_ids",
            "dq_expected_tables",
        ]
    ]
)
