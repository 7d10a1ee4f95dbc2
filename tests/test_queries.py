"""The driver contract, and the queries against their SQL on the smallest folder."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from support import SMALL

import __spark_entry__ as entry
from tools.compare import SOURCES, canon

ROOT = Path(__file__).resolve().parent.parent
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

# One query per operator family; tools/compare.py runs all of them.
SAMPLE = [
    "silver_patients",
    "silver_claims_and_payments",
    "silver_patient_benefit_years",
    "gold_kpi_summary",
    "gold_patient_summary",
    "gold_office_performance",
    "gold_payer_performance",
    "scalar_suite",
    "fanout_guard",
    "composite_key_join",
    "coverage_lookup",
    "value_inventory",
    "first_in_year",
    "noshow_concentration",
    "dq_foreign_keys",
    "dq_row_identity",
    "annual_max_accumulator",
    "denial_risk_score",
    "q_ar_over_90",
    "mv_claims",
    "chunk_fallback",
    "incremental_sync",
    "vector_topk",
    "vector_topk_ann",
    "ann_recall",
    "hybrid_search",
    "keyword_topk",
    "retrieval_eval",
    "copy_into",
    "stream_index_sync",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    corpus = {q for q in QUERIES if q.startswith("op") or q == "pipeline"}
    assert set(QUERIES) - set(ORACLE) == corpus - set(ORACLE)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(map(canon, r)) for r in df.select(*cols).collect())
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() == 25


def test_embeddings_are_normalised(spark):
    for r in QUERIES["embed_chunks"](spark, SMALL).collect():
        assert r["dims"] == 1024 and r["unit"] + r["empty"] == r["chunks"]


def test_plans_have_no_cross_join(spark):
    for name in ["gold_kpi_summary", "cross_join_pairs", "coverage_matrix", "deductible_accumulator", "dq_recompute_status"]:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize("missing", ["xxhash", "crownledger.llm", "corpus_pipeline"])
def test_entry_without_the_corpus_operators(missing):
    """A package that only the corpus operators need, or they themselves, may be missing: all other queries stay."""
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "names = set(entry.queries())\n"
        "assert 'q_denial_rate_by_payer' in names and set(entry.oracle_sql()) <= names\n"
        "assert not any(n.startswith('op1') for n in names) and 'pipeline' not in names\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
