"""Binds the test tables (a generic order star, events and texts) to the dental tables.

``Lake`` builds each layer lazily from a folder of parquet files. With real dental tables one
would pass their DataFrames to the operators directly; nothing in the operators depends on this file.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import adjudication, documents, gold, joins, silver
from crownledger.schemas import TABLES
from crownledger.sources.files import spread

AS_OF = date(1999, 1, 1)
ZERO = Decimal("0.00")


def _num(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _since(day: str, days: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), days.cast("int"))


def _shared(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """A derived input that is described once per lake; Spark still plans and runs it per query."""

    @wraps(build)
    def once(self: Lake) -> DataFrame:
        return self._once("derived", build.__name__, lambda: build(self))

    return once


class Lake:
    """Bronze, silver and gold tables over one folder of source files, built on first use."""

    def __init__(self, spark: SparkSession, folder: str, as_of: date = AS_OF):
        self.spark, self.folder, self.as_of = spark, folder, as_of
        self._cache: dict[tuple[str, str], DataFrame] = {}

    def _once(self, layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if (layer, name) not in self._cache:
            self._cache[layer, name] = build()
        return self._cache[layer, name]

    def raw(self, name: str) -> DataFrame:
        return self._once("raw", name, lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def spread(self, name: str, key: str) -> DataFrame:
        """A source table whose rows cost much work each, on all cores even if it is one small file."""
        return self._once("spread", name, lambda: spread(self.raw(name), key))

    def bronze(self, name: str) -> DataFrame:
        return self._once("bronze", name, lambda: getattr(self, f"_{name}")())

    def silver(self, name: str) -> DataFrame:
        return self._once("silver", name, lambda: silver.to_silver(name, self.bronze(name), self.as_of))

    def gold(self, name: str) -> DataFrame:
        return self._once("gold", name, lambda: gold.BUILDERS[name](self))

    def bronze_all(self) -> dict[str, DataFrame]:
        return {name: self.bronze(name) for name in TABLES}

    def silver_all(self) -> dict[str, DataFrame]:
        return {name: self.silver(name) for name in TABLES}

    # --- reference ---------------------------------------------------------------------------

    def _dental_offices(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.raw("supplier")
            .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.alias("office_id"),
                F.col("s_name").alias("office_name"),
                F.col("n_name").alias("city"),
                F.lower("r_name").alias("state"),
                _num(key * 37 % 100000, 5).alias("zip_code"),
                F.when(key % 5 == 0, "Orthodontics")
                .when(key % 3 == 0, "Pediatric Dentistry")
                .otherwise("General Dentistry")
                .alias("specialty_type"),
                (key % 7 + 2).cast("int").alias("provider_count"),
                _since("2005-01-01", key % 5000).alias("opened_date"),
            )
        )

    def _insurance_companies(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            key.cast("bigint").alias("insurance_company_id"),
            F.col("n_name").alias("company_name"),
            F.when(key % 3 == 0, "Commercial PPO").when(key % 3 == 1, "DHMO").otherwise("Medicaid").alias("payer_type"),
            (key + 14).alias("average_reimbursement_turnaround_days"),
            ((key % 15 + 8).cast("double") / 100).alias("denial_rate_baseline"),
        )

    def _insurance_networks(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.raw("region").select(
            key.cast("bigint").alias("network_id"),
            F.col("r_name").alias("network_name"),
            F.when(key < 3, "PPO").otherwise("DHMO").alias("network_type"),
            F.lit("Regional").alias("region"),
        )

    def _memberships(self, members: DataFrame, key: str, modulus: int) -> DataFrame:
        """Pairs whose keys add up to a multiple of ``modulus``: an equi-join on what the network lacks to it."""
        networks = self.raw("region").select(F.col("r_regionkey").cast("bigint").alias("network_id"))
        lacking = F.pmod(-F.col("network_id"), F.lit(modulus))
        return (
            members.select(key, F.pmod(F.col(key), F.lit(modulus)).alias("_rest"))
            .join(networks.select("network_id", lacking.alias("_rest")), "_rest")
            .drop("_rest")
        )

    def _insurance_company_networks(self) -> DataFrame:
        pairs = self._memberships(self._insurance_companies(), "insurance_company_id", 3)
        return pairs.select(
            (F.col("insurance_company_id") * 10 + F.col("network_id")).alias("company_network_id"),
            "insurance_company_id",
            "network_id",
            _since("2015-01-01", F.col("insurance_company_id") * 30).alias("participation_start_date"),
        )

    def _office_network_participation(self) -> DataFrame:
        offices = self.raw("supplier").select(F.col("s_suppkey").alias("office_id"))
        pairs = self._memberships(offices, "office_id", 4)
        return pairs.select(
            (F.col("office_id") * 10 + F.col("network_id")).alias("office_network_id"),
            "office_id",
            "network_id",
            _since("2016-01-01", F.col("office_id") % 1000).alias("contract_start_date"),
        )

    def _office_insurance_network(self) -> DataFrame:
        status = adjudication.network_status(
            self.raw("supplier").select(F.col("s_suppkey").alias("office_id")),
            self._insurance_companies(),
            self.bronze("office_network_participation"),
            self.bronze("insurance_company_networks"),
        )
        return status.select(
            (F.col("office_id") * 100 + F.col("insurance_company_id")).alias("association_id"),
            "office_id",
            "insurance_company_id",
            "shared_network_id",
            "network_status",
        )

    def _insurance_policies(self) -> DataFrame:
        nation, tier = F.col("n_nationkey"), F.col("tier")
        tiers = F.sequence(F.lit(0).cast("bigint"), F.lit(4).cast("bigint"))
        return (
            self.raw("nation")
            .withColumn("tier", F.explode(tiers))
            .select(
                (nation.cast("bigint") * 10 + tier).alias("policy_id"),
                nation.cast("bigint").alias("insurance_company_id"),
                F.concat(F.lit("GRP-"), _num(nation.cast("bigint") * 10 + tier, 5)).alias("policy_group_number"),
                F.col("n_name").alias("group_name"),
                X.money((tier + 1) * 50).alias("individual_deductible_per_year"),
                X.money((tier + 1) * 150).alias("family_deductible_per_year"),
                X.money((tier + 1) * 50000).alias("annual_maximum_benefit"),
                (tier % 3 * 6).cast("int").alias("waiting_period_months_major"),
                _since("2010-01-01", nation * 10).alias("effective_date"),
            )
        )

    def _billing_codes(self) -> DataFrame:
        fee = X.money("p_retailprice")
        return self.raw("part").select(
            F.col("p_partkey").alias("billing_code_id"),
            F.concat(F.lit("D"), _num(F.col("p_partkey"), 5)).alias("ada_procedure_code"),
            F.col("p_name").alias("description"),
            F.when(F.col("p_type").isin("ECONOMY", "SMALL"), "Preventive")
            .when(F.col("p_type").isin("MEDIUM", "STANDARD"), "Basic")
            .otherwise("Major")
            .alias("procedure_category"),
            fee.alias("standard_fee"),
            X.money(fee * F.lit(Decimal("0.65"))).alias("in_network_allowed_amount"),
            X.money(fee * F.lit(Decimal("0.90"))).alias("out_network_allowed_amount"),
            (F.col("p_type") == "LARGE").alias("requires_prior_auth"),
        )

    def _coverage_rules(self) -> DataFrame:
        rules = adjudication.coverage_matrix(
            self.bronze("insurance_policies"), self.bronze("billing_codes"), adjudication.plan_design(self.spark)
        )
        return rules.withColumn("rule_id", F.col("billing_code_id") * 1000 + F.col("policy_id"))

    # --- people ------------------------------------------------------------------------------

    def _patients(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("patient_id"),
                F.col("c_name").alias("first_name"),
                F.col("c_mktsegment").alias("last_name"),
                (key % 83).cast("int").alias("age"),
                F.when(key % 20 == 0, "O")
                .when(key % 20 == 1, "X")
                .when(key % 2 == 0, "M")
                .otherwise("F")
                .alias("gender"),
                _num(key * 7 % 100000, 5).alias("zip_code"),
                F.lower("n_name").alias("state"),
                _since("1990-01-01", key % 1500).alias("enrollment_date"),
                F.when(key % 4 == 0, "Subscriber").otherwise("Dependent").alias("patient_role"),
            )
        )

    def _primary_policy_holders(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .filter(key % 4 == 0)
            .select(
                key.alias("subscriber_id"),
                (F.col("c_nationkey").cast("bigint") * 10 + key % 5).alias("policy_id"),
                key.alias("patient_id"),
                F.when(key % 7 == 0, "Retired")
                .when(key % 11 == 0, "Unemployed")
                .otherwise("Employed")
                .alias("employment_status"),
                F.when(key % 8 == 0, "Employee + Family").otherwise("Employee + One").alias("coverage_tier"),
            )
        )

    def _policy_dependents(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .filter((key % 4 != 0) & ((key % 4 == 1) | (key % 8 < 4)))
            .select(
                key.alias("dependent_id"),
                (key - key % 4).alias("subscriber_id"),
                key.alias("patient_id"),
                F.when(key % 4 == 1, "Spouse").otherwise("Child").alias("relationship_to_subscriber"),
            )
        )

    def _patient_benefit_years(self) -> DataFrame:
        return adjudication.benefit_years(self.adjudication_lines())

    # --- activity ----------------------------------------------------------------------------

    def _recall_reminders(self) -> DataFrame:
        key = F.col("event_id")
        return self.raw("events").select(
            key.alias("recall_id"),
            (key % 10).alias("office_id"),
            F.col("user_id").alias("patient_id"),
            X.benefit_year("ts").alias("benefit_year"),
            F.lit("Cleaning").alias("recall_type"),
            F.col("ts").cast("date").alias("due_date"),
            (F.col("ts") - F.expr("INTERVAL 14 DAYS")).alias("sent_timestamp"),
            F.when(key % 3 == 0, "SMS").when(key % 3 == 1, "Email").otherwise("Phone Call").alias("communication_channel"),
            F.when(key % 25 == 0, "Bounced").otherwise("Delivered").alias("delivery_status"),
            F.when(key % 5 < 3, "Scheduled")
            .when(key % 5 == 3, "Declined")
            .otherwise("No Response")
            .alias("patient_response"),
            (key % 5 < 3).alias("resulted_in_appointment"),
        )

    def _appointments(self) -> DataFrame:
        key = F.col("event_id")
        return self.raw("events").select(
            key.alias("appointment_id"),
            (key % 10).alias("office_id"),
            F.col("user_id").alias("patient_id"),
            F.when(key % 5 < 3, key).alias("source_recall_id"),
            F.when(key % 4 == 0, "Cleaning")
            .when(key % 4 == 1, "Restorative")
            .when(key % 4 == 2, "Emergency")
            .otherwise("Major")
            .alias("visit_type"),
            X.benefit_year("ts").alias("benefit_year"),
            F.col("ts").alias("appointment_date_time"),
            F.when(F.col("event_type") == "error", "No-Show")
            .when(F.col("event_type") == "signup", "Cancelled")
            .otherwise("Completed")
            .alias("appointment_status"),
        )

    def _appointment_reminders(self) -> DataFrame:
        key, lead = F.col("event_id"), F.col("lead_days")
        leads = F.when(key % 2 == 0, F.array(F.lit(14), F.lit(7), F.lit(2))).otherwise(F.array(F.lit(7), F.lit(2)))
        return (
            self.raw("events")
            .select("event_id", "ts", F.posexplode(leads).alias("pos", "lead_days"))
            .select(
                (key * 100 + lead).alias("appointment_reminder_id"),
                key.alias("appointment_id"),
                (F.col("pos") + 1).alias("reminder_sequence"),
                "lead_days",
                F.when(lead >= 7, "Email").otherwise("SMS").alias("communication_channel"),
                (F.col("ts") - F.make_dt_interval(lead)).alias("sent_timestamp"),
                F.when(key % 33 == 0, "Bounced").otherwise("Delivered").alias("delivery_status"),
                F.when(key % 4 == 0, "No Response").otherwise("Confirmed").alias("patient_response"),
            )
        )

    # --- money -------------------------------------------------------------------------------

    @_shared
    def lines_core(self) -> DataFrame:
        """Line amounts without the code's attributes, so readers of amounts skip that join.

        The line id is a 60-bit content key: it is computed per row, without a numbering shuffle.
        """
        price = X.money("l_extendedprice")
        discount = F.col("l_discount").cast("decimal(6,4)")
        content = F.concat_ws(
            "|",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            price,
            F.col("l_discount").cast("decimal(4,2)"),
            F.col("l_quantity").cast("int"),
            F.col("l_shipdate").cast("date"),
        )
        return self.spread("lineitem", "l_orderkey").select(
            F.conv(F.substring(F.md5(content), 1, 15), 16, 10).cast("bigint").alias("line_id"),
            F.col("l_orderkey").alias("invoice_id"),
            F.col("l_partkey").alias("billing_code_id"),
            F.col("l_suppkey").alias("office_id"),
            price.alias("unit_price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            X.money(price * (1 - discount)).alias("allowed_amount"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    def _invoice_lines(self) -> DataFrame:
        codes = self.bronze("billing_codes").select("billing_code_id", "ada_procedure_code", "procedure_category")
        insured = X.money(F.col("allowed_amount") * F.lit(Decimal("0.80")))
        return (
            self.lines_core()
            .join(codes, "billing_code_id")
            .withColumns(
                {
                    "contractual_writeoff": X.money(F.col("unit_price") - F.col("allowed_amount")),
                    "deductible_applied": X.money(F.lit(ZERO)),
                    "estimated_insurance_amount": insured,
                    "estimated_patient_amount": X.money(F.col("allowed_amount") - insured),
                    "discount_applied": X.money(F.lit(ZERO)),
                }
            )
        )

    def _visits(self) -> DataFrame:
        """Orders with their customer, policy and date."""
        orders = self.raw("orders").join(
            self.raw("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
        )
        return orders.withColumns(
            {
                "service_date": F.col("o_orderdate").cast("date"),
                "policy_id": F.col("c_nationkey").cast("bigint") * 10 + F.col("o_custkey") % 5,
            }
        )

    @_shared
    def _billing(self) -> DataFrame:
        """Visits with their line sums: the common base of invoices and claims."""
        orders = self._visits()
        lines = self.lines_core()
        sums = lines.groupBy(F.col("invoice_id").alias("l_invoice_id")).agg(
            F.min("office_id").alias("office_id"),
            F.sum("unit_price").alias("gross"),
            F.sum("allowed_amount").alias("allowed"),
        )
        out = orders.join(sums, F.col("o_orderkey") == F.col("l_invoice_id"), "left")
        return out.withColumns(
            {
                "gross": F.coalesce("gross", F.lit(ZERO)),
                "allowed": F.coalesce("allowed", F.lit(ZERO)),
            }
        )

    def _invoices(self) -> DataFrame:
        key = F.col("o_orderkey")
        writeoff = F.col("gross") - F.col("allowed")
        insured = (F.col("allowed") * F.lit(Decimal("0.80"))).cast("decimal(24,2)")
        due = F.col("allowed") - insured
        balance = F.when(key % 3 == 0, writeoff).otherwise(F.lit(ZERO))
        return self._billing().select(
            key.alias("invoice_id"),
            key.alias("appointment_id"),
            "office_id",
            F.col("o_custkey").alias("patient_id"),
            "policy_id",
            X.benefit_year(F.date_sub("service_date", 2)).alias("benefit_year"),
            "service_date",
            F.col("gross").alias("total_gross_amount"),
            F.col("allowed").alias("total_allowed_amount"),
            writeoff.alias("total_contractual_writeoff"),
            insured.alias("estimated_insurance_responsibility"),
            due.alias("estimated_copay_due"),
            (due - balance).alias("actual_patient_paid_at_visit"),
            balance.alias("patient_balance"),
            F.date_add("service_date", 30).alias("due_date"),
        )

    def _claims_and_payments(self) -> DataFrame:
        key, denied = F.col("o_orderkey"), F.col("o_orderstatus") == "P"
        submitted = F.date_add("service_date", (key % 6).cast("int"))
        days = (key % 40 + 10).cast("int")
        return self._billing().select(
            key.alias("claim_id"),
            key.alias("invoice_id"),
            "policy_id",
            F.col("o_custkey").alias("patient_id"),
            "office_id",
            F.col("c_nationkey").cast("bigint").alias("insurance_company_id"),
            F.when(key % 6 == 0, "Out-of-Network").otherwise("In-Network").alias("network_status"),
            X.benefit_year(F.date_sub("service_date", 2)).alias("benefit_year"),
            "service_date",
            submitted.alias("submitted_date"),
            F.date_add(submitted, days).alias("adjudicated_date"),
            days.alias("days_to_adjudicate"),
            F.col("allowed").alias("amount_claimed"),
            F.when(denied, F.lit(ZERO)).otherwise(F.col("allowed")).alias("amount_paid"),
            F.when(denied, "Denied").otherwise("Clean-Paid").alias("claim_status"),
            F.when(~denied | (key % 50 == 0), F.lit(None))
            .when(key % 3 == 0, "Max Benefit Exceeded")
            .when(key % 3 == 1, "Missing X-Ray")
            .otherwise("Coding Error")
            .alias("denial_reason_code"),
            (key % 4 == 0).alias("required_prior_auth"),
        )

    def _claim_disputes(self) -> DataFrame:
        key, reason = F.col("claim_id"), F.col("denial_reason_code")
        disputed = F.date_add("adjudicated_date", (key % 40 + 5).cast("int"))
        return (
            self.bronze("claims_and_payments")
            .filter((F.col("claim_status") == "Denied") & (key % 6 < 2))
            .select(
                key.alias("dispute_id"),
                "claim_id",
                disputed.alias("dispute_date"),
                F.when(reason == "Missing X-Ray", "Medical Necessity")
                .when(reason == "Max Benefit Exceeded", "Benefit Limit")
                .otherwise("Administrative Error")
                .alias("dispute_reason_category"),
                (key % 2 + 1).cast("int").alias("current_appeal_level"),
                F.when(key % 3 == 0, "Upheld-Denied").otherwise("Overturned-Paid").alias("dispute_outcome"),
                F.date_add(disputed, 41).alias("resolved_date"),
                F.when(key % 3 == 0, F.lit(ZERO)).otherwise(F.col("amount_claimed")).alias("amount_recovered"),
            )
        )

    # --- derived inputs ----------------------------------------------------------------------

    @_shared
    def adjudication_lines(self) -> DataFrame:
        """Lines with patient, benefit year, plan rule and policy limits: the input of the accumulators."""
        # without the lines' sums, which would read all lines once more
        visits = self._visits().select(F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("patient_id"), "policy_id", "service_date")
        codes = self.silver("billing_codes").select("billing_code_id", "procedure_category")
        limits = self.bronze("insurance_policies").select(
            "policy_id",
            F.col("individual_deductible_per_year").alias("individual_deductible"),
            F.col("annual_maximum_benefit").alias("annual_maximum"),
        )
        return (
            self.lines_core()
            .select("line_id", "invoice_id", "billing_code_id", "allowed_amount")
            .join(visits, "invoice_id")
            .withColumn("benefit_year", X.benefit_year("service_date"))
            .join(codes, "billing_code_id")
            .join(adjudication.plan_design(self.spark).drop("frequency_limit_per_year"), "procedure_category")
            .join(limits, "policy_id")
            .drop("billing_code_id", "procedure_category")
        )

    @_shared
    def judged_claims(self) -> DataFrame:
        """Claims with the facts the denial rules look at: authorisation and an exhausted maximum."""
        years = self.bronze("patient_benefit_years").select(
            "patient_id", "benefit_year", (F.col("benefit_remaining") <= 0).alias("is_exhausted")
        )
        auth = adjudication.needs_auth(self.lines_core(), self.bronze("billing_codes"))
        return (
            self.silver("claims_and_payments")
            .withColumn("benefit_year", X.benefit_year("service_date"))
            .join(auth, "invoice_id", "left")
            .join(years, ["patient_id", "benefit_year"], "left")
            .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("needs_auth", "is_exhausted")})
        )

    # --- documents ---------------------------------------------------------------------------

    @_shared
    def pages(self) -> DataFrame:
        return self.spread("pages", "page_id").select(
            F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("doc_uri"), "url", "html"
        )

    @_shared
    def elements(self) -> DataFrame:
        """Elements of all web pages."""
        return documents.flatten(documents.parse_documents(self.pages()))

    @_shared
    def element_lists(self) -> DataFrame:
        """The elements of all web pages, one list per page."""
        return documents.element_lists(documents.parse_documents(self.pages()))

    @_shared
    def text_lists(self) -> DataFrame:
        """Plain documents as lists of one element."""
        own = F.struct("element_id", "page", "type", "content").cast(documents.ELEMENT)
        return self.texts().select("doc_uri", F.array(own).alias("elements"))

    @_shared
    def texts(self) -> DataFrame:
        """Plain documents as one element each: they have no headings and no pages."""
        return self.spread("documents", "doc_id").select(
            F.concat_ws("/", F.lit("documents"), "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias(
                "doc_uri"
            ),
            F.lit(0).alias("element_id"),
            F.lit(0).alias("page"),
            F.lit("paragraph").alias("type"),
            F.col("text").alias("content"),
        )

    @_shared
    def chunks(self) -> DataFrame:
        return documents.chunk_table(self.texts())

    def questions(self) -> DataFrame:
        """Reference passages, used as search questions."""
        return self.raw("benchmark").select(F.col("item_id").alias("question"), "text")

    def vector_questions(self) -> DataFrame:
        """Every fiftieth vector, used as a question."""
        return self.raw("embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("question"), "embedding")
