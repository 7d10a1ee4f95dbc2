"""Semantic layer: vocabulary, named measures, metric views, business questions and routing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import joins
from crownledger.operators.aggregates import top_n
from crownledger.operators.gold import one_row

# User wording per column and the stored value it stands for (column, wording, stored value).
SYNONYMS = [
    ("claim_status", "clean-paid", "clean-paid"),
    ("claim_status", "paid", "clean-paid"),
    ("claim_status", "clean", "clean-paid"),
    ("claim_status", "denied", "denied"),
    ("claim_status", "rejected", "denied"),
    ("network_status", "in-network", "in-network"),
    ("network_status", "in network", "in-network"),
    ("network_status", "inn", "in-network"),
    ("network_status", "out-of-network", "out-of-network"),
    ("network_status", "out of network", "out-of-network"),
    ("network_status", "oon", "out-of-network"),
    ("appointment_status", "completed", "completed"),
    ("appointment_status", "cancelled", "cancelled"),
    ("appointment_status", "no-show", "no-show"),
    ("appointment_status", "no show", "no-show"),
    ("appointment_status", "missed", "no-show"),
    ("visit_type", "restorative", "restorative"),
    ("visit_type", "cleaning", "cleaning"),
    ("visit_type", "major", "major"),
    ("visit_type", "emergency", "emergency"),
    ("procedure_category", "preventive", "preventive"),
    ("procedure_category", "basic", "basic"),
    ("procedure_category", "major", "major"),
    ("procedure_category", "prophy", "preventive"),
    ("procedure_category", "hygiene", "preventive"),
    ("payer_type", "commercial ppo", "commercial ppo"),
    ("payer_type", "ppo", "commercial ppo"),
    ("payer_type", "dhmo", "dhmo"),
    ("payer_type", "hmo", "dhmo"),
    ("payer_type", "medicaid", "medicaid"),
    ("specialty_type", "general dentistry", "general dentistry"),
    ("specialty_type", "pediatric dentistry", "pediatric dentistry"),
    ("specialty_type", "peds", "pediatric dentistry"),
    ("specialty_type", "orthodontics", "orthodontics"),
    ("specialty_type", "ortho", "orthodontics"),
    ("dispute_reason_category", "administrative error", "administrative error"),
    ("dispute_reason_category", "benefit limit", "benefit limit"),
    ("dispute_reason_category", "medical necessity", "medical necessity"),
    ("dispute_outcome", "overturned-paid", "overturned-paid"),
    ("dispute_outcome", "won", "overturned-paid"),
    ("dispute_outcome", "overturned", "overturned-paid"),
    ("dispute_outcome", "upheld-denied", "upheld-denied"),
    ("dispute_outcome", "lost", "upheld-denied"),
    ("dispute_outcome", "upheld", "upheld-denied"),
]

# What users call an amount, and the table and column it means. "revenue" means collections.
AMOUNTS = {
    "production": ("invoices", "total_gross_amount"),
    "allowed": ("invoices", "total_allowed_amount"),
    "write-off": ("invoices", "total_contractual_writeoff"),
    "collections": ("claims_and_payments", "amount_paid"),
    "a/r": ("invoices", "patient_balance"),
    "revenue": ("claims_and_payments", "amount_paid"),
}

# Words that point a question to a route.
ROUTE_TERMS = {
    "decline": ["predict", "forecast", "next month", "next year", "will happen", "likely to"],
    "data": [
        "how many", "how much", "rate by", "denial rate", "total", "count", "top five", "largest", "outstanding",
        "balance", "revenue", "invoice", "claims", "appointments", "per month", "monthly", "benefit year",
    ],
    "document": [
        "what does", "what is the difference", "mean", "how do you", "should a", "best practice", "explain",
        "mistakes", "guide", "steps", "why",
    ],
}


# --- vocabulary ------------------------------------------------------------------------------


def synonym_table(spark: SparkSession) -> DataFrame:
    """The fixed synonym rows, marked for broadcast since Spark does not know the size of local rows."""
    return F.broadcast(spark.createDataFrame(SYNONYMS, "column_name string, term string, canonical string"))


def normalize(df: DataFrame, column_name: str, col: str, synonyms: DataFrame) -> DataFrame:
    """Stored value of each wording. Unknown wording stays visible as not matched."""
    terms = synonyms.select(
        F.col("column_name").alias("_c"), F.col("term").alias("_t"), "canonical"
    )
    joined = df.join(
        terms, (F.col(column_name) == F.col("_c")) & (F.lower(F.trim(col)) == F.col("_t")), "left"
    )
    return joined.drop("_c", "_t").withColumn("matched", F.col("canonical").isNotNull())


def measures(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """Named amounts as (measure, amount); measures of one table share one aggregate."""
    wanted: dict[str, list[str]] = {}
    for name in names:
        wanted.setdefault(AMOUNTS[name][0], []).append(name)
    parts = []
    for table, labels in wanted.items():
        sums = tables[table].agg(*[X.total(AMOUNTS[n][1]).cast("decimal(38,2)").alias(f"m{i}") for i, n in enumerate(labels)])
        rows = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(f"m{i}").alias("amount")) for i, n in enumerate(labels)])
        parts.append(sums.select(F.explode(rows).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


# --- benefit years ---------------------------------------------------------------------------


def benefit_year_check(df: DataFrame, date_col: str) -> DataFrame:
    return df.groupBy(X.benefit_year(date_col).alias("derived_benefit_year")).agg(
        F.count(F.lit(1)).alias("claims"), F.min(date_col).alias("first_service"), F.max(date_col).alias("last_service")
    )


def benefit_year_drift(df: DataFrame, stored: str = "benefit_year", date_col: str = "service_date") -> DataFrame:
    """Stored label against the label of the date; rows off the diagonal have drifted."""
    return df.groupBy(F.col(stored).alias("stored"), X.benefit_year(date_col).alias("derived")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- business questions ----------------------------------------------------------------------


def q_claims_in_benefit_year(claims: DataFrame, label: str) -> DataFrame:
    """Claims of one benefit year. The label becomes a date range, which a file scan can prune on."""
    first = int(label[:4])
    start, end = date(first, 9, 1), date(first + 1, 9, 1)
    hit = (F.col("service_date") >= X.day(start)) & (F.col("service_date") < X.day(end))
    return claims.filter(hit).agg(F.count(F.lit(1)).alias("claims"))


def q_claims_by_reason(claims: DataFrame, reason: str) -> DataFrame:
    """Denied claims with one reason; denial is the flag, never a null test on the reason."""
    return claims.filter(F.col("is_denied") & (F.col("denial_reason_code") == reason))


def q_denial_rate_by_payer(claims: DataFrame, payers: DataFrame) -> DataFrame:
    """Claims are counted per payer before the names are joined; payers with equal names stay apart."""
    per_payer = claims.groupBy("insurance_company_id").agg(
        F.count(F.lit(1)).alias("total_claims"),
        X.n_if("is_denied").alias("denied_claims"),
        X.rate_pct("is_denied", 1).alias("denial_rate_pct"),
    )
    return joins.with_dim(per_payer, payers.select("insurance_company_id", "company_name"), "insurance_company_id")


def q_writeoff_by_category(lines: DataFrame, codes: DataFrame) -> DataFrame:
    per_code = lines.groupBy("billing_code_id").agg(
        F.sum("contractual_writeoff").alias("_off"), F.sum("allowed_amount").alias("_kept")
    )
    dated = joins.with_dim(per_code, codes.select("billing_code_id", "procedure_category"), "billing_code_id")
    off, kept = F.sum("_off"), F.sum("_kept")
    return dated.groupBy("procedure_category").agg(
        off.alias("total_writeoff"), X.share_pct(off, off + kept, 1).alias("writeoff_pct_of_gross")
    )


def q_monthly_completed(appointments: DataFrame) -> DataFrame:
    done = appointments.filter(F.col("appointment_status") == "completed")
    return done.groupBy(
        X.month_of("appointment_date").alias("month"), X.benefit_year("appointment_date").alias("benefit_year")
    ).agg(F.count(F.lit(1)).alias("completed_appointments"))


def q_ar_over_90(invoices: DataFrame, offices: DataFrame, as_of: date, n: int = 5) -> DataFrame:
    """Offices with the highest balance more than 90 days past due."""
    late = invoices.filter((F.col("patient_balance") > 0) & (F.datediff(X.day(as_of), "due_date") > 90))
    per_office = late.groupBy("office_id").agg(
        X.total("patient_balance").alias("balance_over_90d"), F.count(F.lit(1)).alias("invoices")
    )
    named = joins.with_dim(per_office, offices.select("office_id", "office_name"), "office_id")
    return top_n(named, "balance_over_90d", ["office_id"], n)


def q_calendar_year_split(claims: DataFrame, year: int) -> DataFrame:
    """A calendar year touches two benefit years; both slices are returned."""
    hit = (F.col("service_date") >= X.day(date(year, 1, 1))) & (F.col("service_date") < X.day(date(year + 1, 1, 1)))
    return claims.filter(hit).groupBy(X.benefit_year("service_date").alias("benefit_year")).agg(
        F.count(F.lit(1)).alias("claims")
    )


def q_noshow_history(appointments: DataFrame) -> DataFrame:
    return appointments.groupBy("patient_id").agg(
        X.n_if("is_no_show").alias("no_shows"), F.count(F.lit(1)).alias("visits")
    )


def ar_aging(invoices: DataFrame, as_of: date) -> DataFrame:
    """Open balance by days past due; balances that are not due yet are left out."""
    days = F.datediff(X.day(as_of), "due_date")
    open_ = invoices.filter((F.col("patient_balance") > 0) & (days > 0))
    return open_.groupBy(X.aging_band(days).alias("bucket")).agg(
        X.total("patient_balance").alias("balance"), F.count(F.lit(1)).alias("n")
    )


# --- metric views ----------------------------------------------------------------------------


@dataclass(frozen=True)
class MetricView:
    """A source table with joined dimensions and additive measures.

    ``joins`` maps a name to (table, key); ``dimensions`` maps a name to ``table.column``, where the
    table is ``source`` or a join; ``measures`` maps a name to an additive SQL expression over the
    source, summed by the view (``1`` counts rows).
    """

    source: str
    joins: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    dimensions: Mapping[str, str] = field(default_factory=dict)
    measures: Mapping[str, str] = field(default_factory=dict)

    def query(
        self, tables: Mapping[str, DataFrame], dims: Sequence[str], names: Sequence[str], where: Column | None = None
    ) -> DataFrame:
        """Chosen measures by chosen dimensions; ``where`` filters source rows.

        Only the joins that a chosen dimension needs take part, and the source is summed per join
        key first, so the joins see one row per key instead of the fact rows.
        """
        owner = {d: self.dimensions[d].split(".")[0] for d in dims}
        column = {d: self.dimensions[d].split(".")[1] for d in dims}
        used = [name for name in self.joins if name in owner.values()]
        fact = tables[self.source] if where is None else tables[self.source].filter(where)
        keys = [F.col(self.joins[name][1]).alias(f"_key_{name}") for name in used]
        own = [F.col(column[d]).alias(d) for d in dims if owner[d] == "source"]
        summed = fact.groupBy(*keys, *own).agg(*[F.sum(F.expr(self.measures[m])).alias(m) for m in names])
        for name in used:
            table, key = self.joins[name]
            wanted = [F.col(column[d]).alias(d) for d in dims if owner[d] == name]
            dim = tables[table].select(F.col(key).alias(f"_key_{name}"), *wanted)
            summed = summed.join(dim, f"_key_{name}", "left")
        return summed.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in names])


CLAIMS_VIEW = MetricView(
    source="claims_and_payments",
    joins={
        "insurance_companies": ("insurance_companies", "insurance_company_id"),
        "dental_offices": ("dental_offices", "office_id"),
    },
    dimensions={
        "company_name": "insurance_companies.company_name",
        "office_name": "dental_offices.office_name",
        "office_state": "dental_offices.state",
        "payer_type": "insurance_companies.payer_type",
        "claim_status": "source.claim_status",
    },
    measures={
        "unpaid_amount": "amount_claimed - amount_paid",
        "total_claimed": "amount_claimed",
        "total_paid": "amount_paid",
        "claim_count": "1",
    },
)

REVENUE_VIEW = MetricView(
    source="invoices",
    joins={"patients": ("patients", "patient_id")},
    dimensions={"gender": "patients.gender", "patient_state": "patients.state", "age": "patients.age"},
    measures={"total_revenue": "total_allowed_amount", "invoice_count": "1"},
)


def per_entity(amount: DataFrame, entities: DataFrame, value: Column, name: str) -> DataFrame:
    """An amount of one table divided by the row count of another, without joining their rows."""
    both = one_row(amount.agg(value.cast("double").alias("_v")), entities.agg(F.count(F.lit(1)).alias("_n")))
    return both.select(F.round(F.try_divide(F.col("_v"), F.col("_n").cast("double")), 4).alias(name))


# --- routing ---------------------------------------------------------------------------------


def _mentions(text: Column, terms: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def route(
    questions: DataFrame,
    key: Sequence[str],
    text: str = "text",
    terms: Mapping[str, Sequence[str]] = ROUTE_TERMS,
    hits: DataFrame | None = None,
) -> DataFrame:
    """Route of each question: data, document, ambiguous or decline.

    Wording decides first. ``hits``, one row per question with an ``answerable`` flag from the document
    search, decides for questions whose wording says nothing: answerable ones go to the documents.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    says = {name: _mentions(low, words) for name, words in terms.items()}
    flagged = questions.select(*key, *[says[name].alias(f"_{name}") for name in terms])
    if hits is None:
        flagged = flagged.withColumn("_found", F.lit(False))
    else:
        flagged = flagged.join(hits.select(*key, F.col("answerable").alias("_found")), list(key), "left")
    decided = (
        F.when(F.col("_decline"), "decline")
        .when(F.col("_data") & F.col("_document"), "ambiguous")
        .when(F.col("_data"), "data")
        .when(F.col("_document") | F.coalesce("_found", F.lit(False)), "document")
        .otherwise("ambiguous")
    )
    return flagged.select(*key, decided.alias("route"))


def route_eval(routes: DataFrame, gold: DataFrame, key: Sequence[str]) -> DataFrame:
    """Confusion counts of routes against expected ones."""
    both = routes.join(gold.select(*key, F.col("route").alias("expected")), list(key))
    return both.groupBy("expected", F.col("route").alias("got")).agg(F.count(F.lit(1)).alias("n"))
