"""SQL for the queries of ``plans.storage``."""

from crownledger.oracle.retrieval import _CHUNKS
from crownledger.oracle.tables import edge
from crownledger.schemas import TABLES, columns_of


def _each(names, cols: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, {cols.format(w=len(columns_of(n)))} FROM b_{n}" for n in names)


def _text_columns(name: str) -> str:
    """Columns in which some value reads neither as a number, a date or a time, nor as true or false; empty ones are text, too."""
    def is_text(column: str) -> str:
        value = f"cast({column} AS varchar)"
        other = f"try_cast({value} AS double) IS NULL AND try_cast({value} AS timestamp) IS NULL AND lower({value}) NOT IN ('true', 'false')"
        return f"CASE WHEN count({column}) = 0 OR count(*) FILTER ({column} IS NOT NULL AND {other}) > 0 THEN 1 ELSE 0 END"

    return " + ".join(is_text(c) for c in columns_of(name))


def _preview(name: str, n: int = 3) -> str:
    """The first rows in the order of the columns, a line of cells each."""
    columns = columns_of(name)
    line = ", ".join(f"coalesce(cast({c} AS varchar), 'NULL')" for c in columns)
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return (
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM b_{name}) AS row_count, {len(columns)}::bigint AS column_count, "
        f"count(*) AS sample_rows, coalesce(string_agg(line, chr(10) ORDER BY no), '') AS sample "
        f"FROM (SELECT concat_ws(' | ', {line}) AS line, row_number() OVER (ORDER BY {order}) AS no FROM b_{name}) WHERE no <= {n}"
    )


SQL = {
    "load_csv_infer": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, {len(columns_of(n))}::bigint AS column_count, "
        f"cast({_text_columns(n)} AS bigint) AS text_columns FROM b_{n}"
        for n in TABLES
    ),
    "load_csv_ctas": _each(TABLES, "count(*) AS row_count"),
    "copy_into": _each(TABLES, "count(*) AS first, 0::bigint AS rerun, count(*) AS new_file, 2 * count(*) AS total"),
    "file_stream": edge("appointments", "b_appointments"),
    "append_sink": "SELECT count(*) AS total_rows, count(DISTINCT claim_id) AS distinct_keys, 0::bigint AS duplicates FROM b_claims_and_payments",
    "source_file_filter": "SELECT o_orderkey FROM orders",
    "bulk_load": _each(TABLES, "count(*) AS rows, 'loaded' AS status"),
    "overwrite_schema": edge("insurance_companies", "s_insurance_companies", {"is_public": "payer_type = 'medicaid'"}),
    "layer_ctas": "SELECT insurance_company_id, total_claims, true AS is_stamped, 'Gold: payer performance' AS comment FROM g_payer_performance",
    "csv_export": _each(TABLES, "count(*) AS row_count, 0::bigint AS different"),
    "csv_export_patients": edge("patients", "b_patients"),
    "table_preview": " UNION ALL ".join(_preview(n) for n in TABLES),
    "stream_ingest": _each(TABLES, "count(*) AS rows, 'loaded' AS status, 0::bigint AS rerun_rows"),
    "stream_schema_store": "SELECT CASE WHEN claim_id % 2 = 1 THEN is_denied END AS is_denied, count(*) AS n, 18::bigint AS stored_columns "
    "FROM s_claims_and_payments GROUP BY 1",
    "stream_silver": _each(TABLES, "count(*) AS first, 0::bigint AS rerun, true AS is_complete"),
    "stream_silver_visits": edge(
        "appointments",
        "s_appointments",
        {c: c for c in ["appointment_date", "day_of_week", "is_no_show", "is_cancelled"]},
    ),
    "stream_index_sync": f"""
        WITH {_CHUNKS} SELECT 'I' AS op, count(*) AS n FROM r_chunks
        UNION ALL SELECT 'U', count(*) FILTER (chunk_to_embed <> regexp_replace(chunk_to_embed, '\\n+', ' ', 'g')) FROM r_chunks
        UNION ALL SELECT 'K', count(*) FILTER (chunk_to_embed = regexp_replace(chunk_to_embed, '\\n+', ' ', 'g')) FROM r_chunks
        UNION ALL SELECT 'live', count(*) FROM r_chunks""",
}
