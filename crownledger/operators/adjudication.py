"""Revenue-cycle rules: allowed amounts, deductibles and annual maximums, denial and dispute rules."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import joins
from crownledger.operators.ordered import running_total
from crownledger.schemas import PLAN_DESIGN, PLAN_SCHEMA
from crownledger.sources.scratch import written

ZERO = Decimal("0.00")

# Order in which a patient's lines draw on the benefit year: service date, then invoice, then line.
LINE_ORDER = ("service_date", "invoice_id", "line_id")
BLOCK_INVOICES = 1024  # invoice numbers of a block of a running total
BENEFIT_YEAR_KEY = ("patient_id", "benefit_year")
DESIGN = ("copay_flat_amount", "coinsurance_percentage", "deductible_applies", "frequency_limit_per_year")


def plan_design(spark: SparkSession) -> DataFrame:
    """Plan design per procedure category as a relation of three rows.

    The rows are fixed, so they are marked for broadcast: Spark does not know the size of local rows, and
    would otherwise shuffle the lines by their category, which has three values.
    """
    plan = spark.createDataFrame(PLAN_DESIGN, PLAN_SCHEMA)
    return F.broadcast(plan.withColumn("copay_flat_amount", X.money("copay_flat_amount")))


# --- networks and coverage -------------------------------------------------------------------


def network_status(
    offices: DataFrame, companies: DataFrame, office_nets: DataFrame, company_nets: DataFrame
) -> DataFrame:
    """Exactly one status per office and company: in-network when they share a network."""
    shared = joins.shared_network(office_nets, company_nets)
    pairs = joins.all_pairs(offices, "office_id", companies, "insurance_company_id")
    return pairs.join(shared, ["office_id", "insurance_company_id"], "left").withColumn(
        "network_status",
        F.when(F.col("shared_network_id").isNotNull(), "In-Network").otherwise("Out-of-Network"),
    )


def coverage_matrix(policies: DataFrame, codes: DataFrame, plan: DataFrame) -> DataFrame:
    """One rule per policy and billing code, from the plan design of the code's category.

    The design is looked up per code, before the pairs are made: the matrix itself is not shuffled.
    """
    designed = _designed(codes.select("billing_code_id"), codes, plan)
    return _rules(joins.all_pairs(designed, "billing_code_id", policies, "policy_id", DESIGN))


def rules_for(pairs: DataFrame, codes: DataFrame, plan: DataFrame) -> DataFrame:
    """Rules of given (policy_id, billing_code_id) pairs only, where the whole matrix is not needed."""
    return _rules(_designed(pairs, codes, plan))


def _designed(rows: DataFrame, codes: DataFrame, plan: DataFrame) -> DataFrame:
    category = codes.select("billing_code_id", F.lower("procedure_category").alias("procedure_category"))
    return rows.join(category, "billing_code_id").join(plan, "procedure_category")


def _rules(designed: DataFrame) -> DataFrame:
    return designed.select(F.concat_ws("-", "policy_id", "billing_code_id").alias("rule_key"), "policy_id", "billing_code_id", *DESIGN)


def coverage_tier(holders: DataFrame, dependents: DataFrame) -> DataFrame:
    """Tier by the number of dependents: more than one is a family."""
    n = dependents.groupBy("subscriber_id").agg(F.count(F.lit(1)).alias("dependents"))
    return (
        holders.join(n, "subscriber_id", "left")
        .withColumn("dependents", F.coalesce("dependents", F.lit(0)))
        .withColumn("tier", F.when(F.col("dependents") > 1, "Employee + Family").otherwise("Employee + One"))
    )


# --- line amounts ----------------------------------------------------------------------------


def in_network(status: str = "network_status") -> Column:
    return F.lower(status) == "in-network"


def allowed(lines: DataFrame, codes: DataFrame) -> DataFrame:
    """Fee and allowed amount of each line's code under the line's network status."""
    fees = codes.select(
        "billing_code_id", "standard_fee", "in_network_allowed_amount", "out_network_allowed_amount"
    )
    return (
        lines.drop("allowed_amount")
        .join(fees, "billing_code_id")
        .withColumn(
            "allowed_amount",
            F.when(in_network(), F.col("in_network_allowed_amount")).otherwise(F.col("out_network_allowed_amount")),
        )
        .drop("in_network_allowed_amount", "out_network_allowed_amount")
    )


def writeoff(lines: DataFrame) -> DataFrame:
    """Contractual write-off: fee minus allowed in-network, nothing out-of-network."""
    gap = F.col("standard_fee") - F.col("allowed_amount")
    return lines.withColumn("contractual_writeoff", X.money(F.when(in_network(), gap).otherwise(F.lit(ZERO))))


def drawn(
    df: DataFrame, value: Column, limit: Column, name: str, group: Sequence[str] = BENEFIT_YEAR_KEY
) -> DataFrame:
    """Part of ``value`` that still fits under a yearly limit when rows draw on it in line order.

    Closed form of the sequential rule: what fits is the capped running total minus the capped
    running total before the row. Exact, since all amounts are whole cents. Blocks are a date's invoices in runs of
    ``BLOCK_INVOICES`` numbers, so that a date with very many lines is spread, too.
    """
    run = F.floor(F.col(LINE_ORDER[1]) / BLOCK_INVOICES)
    part, most = _cents(value), _cents(limit)
    out = running_total(df.withColumn("_slot", run), group, [LINE_ORDER[0], "_slot"], LINE_ORDER[1:], part, "_run")
    fits = F.least(most, F.col("_run")) - F.least(most, F.col("_run") - part)
    return out.withColumn(name, X.money(fits.cast("decimal(18,0)") / 100)).drop("_run", "_slot")


def _cents(amount: Column) -> Column:
    """An amount of money in cents: sums of whole numbers are much cheaper than decimal ones."""
    return (X.money(amount) * 100).cast("bigint")


def deductible_applied(lines: DataFrame) -> DataFrame:
    """Deductible drawn by each line; only lines whose rule says so draw on it."""
    eligible = F.when(F.col("deductible_applies"), F.col("allowed_amount")).otherwise(F.lit(ZERO))
    # both levels of the running total read the lines, so their joins are written out
    return drawn(written(lines), eligible, F.col("individual_deductible"), "deductible_applied")


def uncapped_estimate(lines: DataFrame) -> DataFrame:
    """Insurer's share before the annual maximum: coinsurance on what is left after deductible and copay."""
    base = F.greatest(
        F.col("allowed_amount") - F.col("deductible_applied") - F.col("copay_flat_amount"), F.lit(ZERO)
    )
    share = base * F.col("coinsurance_percentage").cast("decimal(6,4)")
    return lines.withColumn("est_uncapped", X.money(F.round(share, 2)))


def capped_benefit(lines: DataFrame) -> DataFrame:
    """Insurer's share limited to what remains of the annual maximum."""
    return drawn(lines, F.col("est_uncapped"), F.col("annual_maximum"), "est_insurance")


def insurance_estimate(lines: DataFrame) -> DataFrame:
    """Insurer's share per line: deductible, coinsurance, then the annual maximum.

    The estimates before the maximum feed both levels of the second running total, so they are written
    out once in between, as the lines are before the first; otherwise the first running total would be computed twice.
    """
    return capped_benefit(written(uncapped_estimate(deductible_applied(lines))))


def patient_estimate(lines: DataFrame) -> DataFrame:
    return lines.withColumn("est_patient", X.money(F.col("allowed_amount") - F.col("est_insurance")))


def benefit_years(lines: DataFrame) -> DataFrame:
    """Final deductible and benefit per patient-year.

    After the last line the capped running totals equal the capped totals, so no window is needed
    for the maximum; only the per-line deductible is.
    """
    eligible = F.when(F.col("deductible_applies"), F.col("allowed_amount")).otherwise(F.lit(ZERO))
    est = uncapped_estimate(deductible_applied(lines))
    sums = est.groupBy("patient_id", "benefit_year").agg(
        F.max("policy_id").alias("policy_id"),
        F.max("individual_deductible").alias("individual_deductible"),
        F.max("annual_maximum").alias("annual_maximum"),
        F.sum(eligible).alias("_eligible"),
        F.sum("est_uncapped").alias("_used"),
    )
    used = F.least(F.col("annual_maximum"), F.col("_used"))
    return sums.select(
        "patient_id",
        "benefit_year",
        "policy_id",
        "individual_deductible",
        X.money(F.least(F.col("individual_deductible"), F.col("_eligible"))).alias("deductible_met"),
        "annual_maximum",
        X.money(used).alias("benefit_used"),
        X.money(F.greatest(F.col("annual_maximum") - used, F.lit(ZERO))).alias("benefit_remaining"),
    )


# --- invoices --------------------------------------------------------------------------------


def roll_up(lines: DataFrame, visits: DataFrame) -> DataFrame:
    """Invoice headers from priced lines: sums, balance after the payment at the visit, due date."""
    sums = lines.groupBy("invoice_id").agg(
        F.sum("unit_price").alias("total_gross_amount"),
        F.sum("allowed_amount").alias("total_allowed_amount"),
        F.sum("contractual_writeoff").alias("total_contractual_writeoff"),
        F.sum("estimated_insurance_amount").alias("estimated_insurance_responsibility"),
        F.sum("estimated_patient_amount").alias("estimated_copay_due"),
    )
    return (
        visits.join(sums, "invoice_id")
        .withColumn("patient_balance", F.col("estimated_copay_due") - F.col("actual_patient_paid_at_visit"))
        .withColumn("due_date", F.date_add("service_date", 30))
    )


def needs_auth(lines: DataFrame, codes: DataFrame) -> DataFrame:
    """Invoices with a flag: does any line need prior authorisation."""
    flags = codes.select("billing_code_id", "requires_prior_auth")
    return (
        lines.select("invoice_id", "billing_code_id")
        .join(flags, "billing_code_id")
        .groupBy("invoice_id")
        .agg(F.bool_or("requires_prior_auth").alias("needs_auth"))
    )


# --- claims ----------------------------------------------------------------------------------


def days_to_adjudicate(claims: DataFrame) -> DataFrame:
    return claims.withColumn("days", F.datediff("adjudicated_date", "submitted_date").cast("bigint"))


def denial_reason(claims: DataFrame) -> DataFrame:
    """Reason of a denied claim: an exhausted maximum wins over a missing authorisation, then the stored one."""
    return claims.withColumn(
        "reason",
        F.when(~F.col("is_denied"), F.lit(None))
        .when(F.col("is_exhausted"), "Max Benefit Exceeded")
        .when(F.col("needs_auth"), "Prior Auth Required")
        .otherwise(F.col("denial_reason_code")),
    )


def denial_risk(claims: DataFrame, payers: DataFrame) -> DataFrame:
    """Expected denial risk: payer baseline plus additive surcharges, capped at 0.85."""
    baseline = payers.select("insurance_company_id", F.col("denial_rate_baseline").cast("decimal(6,4)").alias("_base"))

    def extra(flag: str | Column, points: str) -> Column:
        return F.when(X.as_column(flag), F.lit(Decimal(points))).otherwise(F.lit(Decimal("0.00")))

    # Surcharges for authorisation, an exhausted maximum and an out-of-network office.
    score = F.col("_base") + extra("needs_auth", "0.25") + extra("is_exhausted", "0.30") + extra(~in_network(), "0.05")
    return (
        claims.join(baseline, "insurance_company_id")
        .withColumn("risk", F.least(score, F.lit(Decimal("0.85"))).cast("double"))
        .drop("_base")
    )


def dispute_reason(disputes: DataFrame, reason: str = "denial_reason_code") -> DataFrame:
    return disputes.withColumn(
        "category",
        F.when(F.col(reason).isin("Prior Auth Required", "Missing X-Ray"), "Medical Necessity")
        .when(F.col(reason) == "Max Benefit Exceeded", "Benefit Limit")
        .otherwise("Administrative Error"),
    )


def recovered(disputes: DataFrame, claims: DataFrame) -> DataFrame:
    """Amount won back: the claimed amount if the denial was overturned, else nothing."""
    amounts = claims.select("claim_id", "amount_claimed")
    won = F.lower("dispute_outcome") == "overturned-paid"
    return disputes.join(amounts, "claim_id").withColumn(
        "amount_recovered", F.when(won, F.col("amount_claimed")).otherwise(F.lit(ZERO))
    )


def recall_funnel(recalls: DataFrame, appts: DataFrame) -> DataFrame:
    """Per channel: recalls sent, recalls that led to a visit, and their share.

    Visits are reduced to one row per recall before the join, so a recall counts once.
    """
    booked = (
        appts.filter(F.col("source_recall_id") > 0)
        .select(F.col("source_recall_id").alias("recall_id"))
        .distinct()
        .withColumn("_booked", F.lit(True))
    )
    return (
        recalls.select("recall_id", "communication_channel")
        .join(booked, "recall_id", "left")
        .groupBy("communication_channel")
        .agg(
            F.count(F.lit(1)).alias("sent"),
            X.n_if(F.col("_booked")).alias("booked"),
            X.rate_pct(F.col("_booked")).alias("booked_pct"),
        )
    )
