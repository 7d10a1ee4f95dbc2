"""Data-quality queries: each rule on the bound tables, and the whole report."""

from __future__ import annotations

from pyspark.sql import functions as F

from crownledger.operators import adjudication
from crownledger.operators import aggregates as A
from crownledger.operators import joins as J
from crownledger.operators import quality as D
from crownledger.operators import rulebook as B
from crownledger.plans.registry import QUERIES, query
from crownledger.schemas import FOREIGN_KEYS, TABLES
from crownledger.sources.scratch import written


def _named(t):
    """Tables by name: bronze ones plainly, others with their layer or source before a dot."""

    def of(name):
        layer, _, table = name.rpartition(".")
        known = {"": t.bronze, "silver": t.silver, "raw": t.raw}
        if layer in known:
            return known[layer](table)
        return {"lines": t.lines_core, "chunks": t.chunks}[table]()

    return of


#: Queries whose rules are measured in one scan per table; the report measures all of them together.
MEASURED = ['dq_foreign_keys', 'dq_cardinality', 'dq_cross_product', 'dq_unique_key', 'dq_one_to_one', 'dq_set_equality', 'dq_conditional_subset', 'dq_nullable_present', 'dq_every_visit', 'dq_row_identity', 'dq_header_vs_lines', 'dq_upper_bound', 'dq_ratio_range', 'dq_no_nulls_after_fix', 'dq_duplicate_ids', 'dq_indexed_rows']


def rules() -> dict[str, list[B.Rule]]:
    """The rules of each of these queries."""
    c = F.col
    return {
        "dq_foreign_keys": [B.no_orphans(fk) for fk in FOREIGN_KEYS],
        "dq_cardinality": [
            B.sizes("insurance_company_networks", ["insurance_company_id"], 1, 3, "1-3 networks per company"),
            B.sizes("office_network_participation", ["office_id"], 1, 3, "1-3 networks per office"),
            B.sizes("policy_dependents", ["subscriber_id"], 1, 5, "1-5 dependents per holder"),
            B.sizes("recall_reminders", ["patient_id", "benefit_year"], 2, 2, "2 recalls per patient and year"),
            B.sizes("appointment_reminders", ["appointment_id"], 1, 3, "1-3 reminders per visit"),
            B.sizes("appointments", ["patient_id", "benefit_year"], 0, 2, "0-2 other visits per patient and year", c("source_recall_id").isNull()),
            B.sizes("invoice_lines", ["invoice_id"], 1, 5, "1-5 lines per invoice"),
        ],
        "dq_cross_product": [
            B.product("office_insurance_network", "dental_offices", "insurance_companies", "a status for every office and company"),
            B.product("coverage_rules", "insurance_policies", "billing_codes", "a rule for every policy and code"),
        ],
        "dq_unique_key": [
            B.sizes("coverage_rules", ["policy_id", "billing_code_id"], 1, 1, "one rule per policy and code"),
            B.sizes("patient_benefit_years", ["patient_id", "benefit_year"], 1, 1, "one row per patient and year"),
        ],
        "dq_one_to_one": [
            B.single("invoices", "appointment_id", "invoice is 1:1 with appointment"),
            B.single("claims_and_payments", "invoice_id", "claim is 1:1 with invoice"),
        ],
        "dq_set_equality": [
            B.same_keys("invoices", "appointments", "appointment_id", "invoices for exactly the completed visits", c("appointment_status") == "Completed")
        ],
        "dq_conditional_subset": [
            B.subset("claim_disputes", "claims_and_payments", "claim_id", c("claim_status") == "Denied", "disputes on denied claims only")
        ],
        "dq_nullable_present": [B.present("appointments", c("source_recall_id").isNull(), "walk-ins exist")],
        "dq_every_visit": [B.children("appointments", "appointment_reminders", "appointment_id", 1, 3, "1-3 reminders for every visit")],
        "dq_row_identity": [
            B.identity(
                "invoice_lines", c("unit_price") - c("allowed_amount"), c("contractual_writeoff"),
                "write-off = fee - allowed (in-network)", c("contractual_writeoff") > 0,
            ),
            B.identity("invoice_lines", c("estimated_patient_amount"), c("allowed_amount") - c("estimated_insurance_amount"), "patient = allowed - insurance"),
            B.identity("invoices", c("estimated_copay_due") - c("actual_patient_paid_at_visit"), c("patient_balance"), "balance = due - paid"),
            B.identity("patient_benefit_years", c("annual_maximum") - c("benefit_used"), c("benefit_remaining"), "remaining = maximum - used"),
        ],
        "dq_header_vs_lines": [
            B.header_total("invoices", "of.lines", "invoice_id", "total_gross_amount", "unit_price"),
            B.header_total("invoices", "of.lines", "invoice_id", "total_allowed_amount", "allowed_amount"),
        ],
        "dq_upper_bound": [
            B.on_rows("patient_benefit_years", F.lit(True), c("benefit_used") > c("annual_maximum"), "used within the maximum")
        ],
        "dq_ratio_range": [
            B.ratio("billing_codes", "in_network_allowed_amount", "standard_fee", "0.60", "0.75", "in-network 60-75% of fee"),
            B.ratio("billing_codes", "out_network_allowed_amount", "standard_fee", "0.85", "0.95", "out-network 85-95% of fee"),
        ],
        "dq_no_nulls_after_fix": [
            B.on_rows(f"silver.{table}", F.lit(True), c(column).isNull(), f"{table}.{column} has no null")
            for table, columns in {
                "claims_and_payments": ["denial_reason_code", "claim_status", "is_denied"],
                "appointments": ["source_recall_id", "appointment_status", "is_no_show"],
                "office_insurance_network": ["shared_network_id"],
                "patients": ["age", "age_group", "gender"],
            }.items()
            for column in columns
        ]
        + [
            B.equal_counts("silver.appointments", c("is_no_show"), "appointments", c("appointment_status") == "No-Show", "is_no_show counts the source"),
            B.equal_counts("silver.claims_and_payments", c("is_denied"), "claims_and_payments", c("claim_status") == "Denied", "is_denied counts the source"),
        ],
        "dq_duplicate_ids": [B.single("of.chunks", "chunk_id", "chunk ids are unique")],
        "dq_indexed_rows": [B.covers("raw.labels", "raw.documents", "doc_id", "labels cover the documents")],
    }


def _measured(name):
    def run(t):
        return B.measure(_named(t), rules()[name])

    run.__doc__ = f"The rules of ``rules()[{name!r}]``, one scan per table."
    return query(name)(run)


for _name in MEASURED:
    _measured(_name)


@query("dq_writeoff_fee")
def dq_writeoff_fee(t):
    """The write-off against the fee of the line's code, not against the price that the line itself states."""
    codes = t.bronze("billing_codes").select("billing_code_id", "standard_fee")
    lines = t.bronze("invoice_lines").filter(F.col("contractual_writeoff") > 0).join(codes, "billing_code_id")
    return D.identity(
        lines,
        F.col("standard_fee") * F.col("quantity") - F.col("allowed_amount"),
        F.col("contractual_writeoff"),
        "write-off = fee of the code * quantity - allowed",
    )


@query("dq_rule_conformance")
def dq_rule_conformance(t):
    codes = t.silver("billing_codes").select("billing_code_id", "procedure_category")
    rules = t.silver("coverage_rules").join(codes, "billing_code_id")
    return D.conforms(
        rules,
        adjudication.plan_design(t.spark),
        "procedure_category",
        ["coinsurance_percentage", "copay_flat_amount", "deductible_applies"],
    )


@query("dq_recompute_status")
def dq_recompute_status(t):
    again = adjudication.network_status(
        t.bronze("dental_offices"),
        t.bronze("insurance_companies"),
        t.bronze("office_network_participation"),
        t.bronze("insurance_company_networks"),
    )
    return D.derived_equals(
        t.bronze("office_insurance_network"),
        again,
        ["office_id", "insurance_company_id"],
        "network_status",
        "network status is derived",
    )


@query("dq_cross_table_status")
def dq_cross_table_status(t):
    return D.status_agrees(
        t.bronze("claims_and_payments"),
        t.bronze("office_insurance_network"),
        ["office_id", "insurance_company_id"],
        "network_status",
        "claim status agrees with the network table",
    )


@query("dq_layer_reconcile")
def dq_layer_reconcile(t):
    return J.match_counts(A.table_counts(t.bronze_all()), A.table_counts(t.silver_all()))


@query("dq_expected_tables")
def dq_expected_tables(t):
    return D.expected_tables(A.table_counts(t.bronze_all()), list(TABLES), "exactly the declared tables")


#: Rules that compare joined rows; they are measured one by one.
JOINED = ["dq_rule_conformance", "dq_recompute_status", "dq_cross_table_status", "dq_writeoff_fee", "dq_expected_tables"]


@query("dq_report")
def dq_report(t):
    """All rules: those of :func:`rules` in one scan per table, and the joined ones.

    Runs a job for each of these parts, whose few rows are written, so that the shuffles of one are gone before the next begins.
    """
    every = [rule for named in rules().values() for rule in named]
    parts = [lambda: B.measure(_named(t), every), *[lambda name=name: QUERIES[name](t) for name in JOINED]]
    return D.report([written(part()) for part in parts])
