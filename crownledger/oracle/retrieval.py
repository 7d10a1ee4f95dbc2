"""SQL for the queries of ``plans.retrieval``."""

from html.entities import name2codepoint

from crownledger.operators.documents import BLOCKS, SPACES

# Pages are cut at every "<": a piece is a tag and the text behind it. Dropped parts are found by walking over the pieces.
_NAMES = {**name2codepoint, "apos": 39}
_CODES = f"MAP([{', '.join(repr(n) for n in _NAMES)}], [{', '.join(str(c) for c in _NAMES.values())}])"
_CHAR = f"""CASE WHEN e LIKE '#x%' OR e LIKE '#X%' THEN chr(('0x' || e[3:])::INTEGER) WHEN e LIKE '#%' THEN chr(e[2:]::INTEGER)
                 ELSE chr({_CODES}[e]) END"""
_KINDS = "MAP([" + ", ".join(f"'{t}'" for t in BLOCKS) + "], [" + ", ".join(f"'{k}'" for k in BLOCKS.values()) + "])"
# without comments, and script and style texts, which may hold "<": cut at their ends and rejoined from the rests
_UNDROPPED = """list_aggregate(list_transform(string_split(list_aggregate(list_transform(string_split(
      list_aggregate(list_transform(string_split(html, '-->'), lambda x: split_part(x, '<!--', 1)), 'string_agg', ' '),
      '</script>'), lambda x: split_part(x, '<script', 1)), 'string_agg', ' '),
      '</style>'), lambda x: split_part(x, '<style', 1)), 'string_agg', ' ')"""

_SPACES = " || ".join(f"chr({ord(c)})" for c in SPACES)


def _chunks(source: str) -> str:
    """Fixed windows of rows (doc_uri, page, element_id, content, extra id part)."""
    return f"""
        SELECT doc_uri, page, element_id, row_number() OVER (PARTITION BY doc_uri, page, element_id ORDER BY i) - 1 AS pos, piece FROM (
            SELECT doc_uri, page, element_id, i, trim(substring(content, cast(i * 850 + 1 AS bigint), 1000), {_SPACES}) AS piece
            FROM (SELECT *, unnest(generate_series(0, cast(greatest(ceil((length(content) - 1000) / 850.0), 0) AS bigint))) AS i
                  FROM {source} WHERE length(content) > 0)) WHERE piece <> ''"""


_ELEMENTS = rf"""
    SELECT doc_uri, row_number() OVER (PARTITION BY doc_uri ORDER BY seg) - 1 AS element_id, 0::bigint AS page, type, content FROM (
      SELECT doc_uri, seg, max(kind) AS type,
             trim(regexp_replace(replace(string_agg(decoded, '' ORDER BY i, j), chr(160), ' '), '\s+', ' ', 'g')) AS content
      FROM (SELECT doc_uri, seg, kind, i, j, CASE WHEN j = 1 THEN part WHEN c IS NULL THEN '&' || part ELSE c || part[length(e) + 2:] END AS decoded
            FROM (SELECT *, CASE WHEN e <> '' THEN {_CHAR} END AS c
                  FROM (SELECT *, CASE WHEN j > 1 THEN regexp_extract(part, '^(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[A-Za-z][A-Za-z0-9]{{1,31}});', 1) ELSE '' END AS e
                        FROM (SELECT doc_uri, seg, kind, i, unnest(string_split(txt, '&')) AS part, generate_subscripts(string_split(txt, '&'), 1) AS j
                              FROM (SELECT *, sum(CASE WHEN block THEN 1 ELSE 0 END) OVER (PARTITION BY doc_uri ORDER BY i) AS seg,
                                           CASE WHEN block THEN coalesce({_KINDS}[tag], 'paragraph') WHEN i = 1 THEN 'paragraph' ELSE '' END AS kind
                                    FROM (SELECT doc_uri, i, tag, ltrim(tag, '/') IN (SELECT unnest(map_keys({_KINDS}))) AS block,
                                                 CASE WHEN tag IN ('script', 'style') THEN '' WHEN i = 1 THEN piece ELSE ' ' || piece[instr(piece, '>') + 1:] END AS txt
                                          FROM (SELECT *, CASE WHEN i > 1 THEN lower(regexp_extract(piece, '^/?[a-zA-Z][a-zA-Z0-9]*')) ELSE '' END AS tag
                                                FROM (SELECT doc_uri, unnest(string_split(h, '<')) AS piece, generate_subscripts(string_split(h, '<'), 1) AS i
                                                      FROM (SELECT concat('pages/', page_id, '.html') AS doc_uri, {_UNDROPPED} AS h FROM pages)))))))))
      GROUP BY doc_uri, seg) WHERE content <> ''"""

_TEXTS = """SELECT concat_ws('/', 'documents', source, concat(doc_id, '.txt')) AS doc_uri, 0::bigint AS element_id, 0::bigint AS page,
                   'paragraph' AS type, text AS content FROM documents"""

_SEMANTIC_PARTS = """
    r_body AS (SELECT *, sum(CASE WHEN type = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_uri ORDER BY element_id) AS section
               FROM {src} WHERE type <> 'title'),
    r_sliced AS (SELECT *, floor(coalesce(sum(length(content)) OVER (PARTITION BY doc_uri, section ORDER BY element_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {size}) AS slice,
                        max(CASE WHEN type = 'heading' THEN content END) OVER (PARTITION BY doc_uri, section) AS header FROM r_body),
    r_semantic AS (SELECT doc_uri, min(page) AS page, row_number() OVER (PARTITION BY doc_uri ORDER BY section, slice) - 1 AS chunk_position,
                          string_agg(content, ' ' ORDER BY element_id) AS content, max(header) AS header
                   FROM r_sliced GROUP BY doc_uri, section, slice)"""

_TITLES = "SELECT doc_uri, min_by(content, element_id) AS title FROM r_elements WHERE type = 'title' GROUP BY 1"

_ENRICHED = """
    SELECT sha256(concat_ws('::', s.doc_uri, s.page, s.chunk_position)) AS chunk_id, s.doc_uri, s.page, s.chunk_position, s.content,
           concat_ws(chr(10), t.title, s.header, concat('Page ', s.page), s.content) AS chunk_to_embed, 'semantic' AS chunk_method
    FROM r_semantic s LEFT JOIN r_titles t ON t.doc_uri = s.doc_uri"""


def _semantic(final: str, size: int = 3000, src: str = "r_elements") -> str:
    return (
        f"WITH r_elements AS ({_ELEMENTS}), {_SEMANTIC_PARTS.format(src=src, size=size)}, r_titles AS ({_TITLES}) {final}"
    )


_FIXED = """SELECT sha256(concat_ws('::', doc_uri, page, pos)) AS chunk_id, doc_uri, page, pos AS chunk_position, piece AS content,
                   piece AS chunk_to_embed, 'fixed_window' AS chunk_method FROM ({chunks})"""

_CHUNKS = f"r_texts AS ({_TEXTS}), r_chunks AS ({_FIXED.format(chunks=_chunks('r_texts'))})"

# All pages have a heading and no plain text has one, so each side takes its own method.
_MIXED = f"""{_ENRICHED} UNION ALL
    SELECT sha256(concat_ws('::', doc_uri, page, element_id, pos)) AS chunk_id, doc_uri, page, pos AS chunk_position, piece AS content,
           piece AS chunk_to_embed, 'fixed_window' AS chunk_method FROM ({_chunks(f"({_TEXTS})")})"""

_QUESTIONS = """
    r_vec AS (SELECT vec_id, label, cast(embedding AS double[]) AS v FROM embeddings),
    r_q AS (SELECT vec_id AS question, v AS q, label AS wanted FROM r_vec WHERE vec_id % 50 = 0)"""


def _vector(k: int, where: str = "true") -> str:
    return f"""{_QUESTIONS},
    r_hits AS (SELECT * FROM (SELECT question, wanted, chunk_id, label, score, row_number() OVER (PARTITION BY question ORDER BY score DESC, chunk_id) AS rk
               FROM (SELECT question, wanted, vec_id AS chunk_id, label, round(list_cosine_similarity(v, q), 6) AS score FROM r_vec CROSS JOIN r_q WHERE {where}))
               WHERE rk <= {k})"""


def _bm25(k: int | None) -> str:
    return rf"""{_CHUNKS},
    r_words AS (SELECT chunk_id, regexp_extract_all(lower(content), '[\p{{L}}\p{{N}}]+') AS w FROM r_chunks),
    r_tf AS (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(w) AS term FROM r_words) GROUP BY 1, 2),
    r_len AS (SELECT chunk_id, len(w) AS n FROM r_words WHERE len(w) > 0),
    r_stat AS (SELECT count(*) AS docs, sum(n) / count(*) AS avg_len FROM r_len),
    r_df AS (SELECT term, count(*) AS df FROM r_tf GROUP BY 1),
    r_ask AS (SELECT DISTINCT question, term FROM (SELECT item_id AS question, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS term FROM benchmark)),
    r_hits AS (SELECT * FROM (SELECT question, chunk_id, score, row_number() OVER (PARTITION BY question ORDER BY score DESC, chunk_id) AS rk FROM (
        SELECT a.question, t.chunk_id, round(sum(ln(1 + (s.docs - d.df + 0.5::double) / (d.df + 0.5::double)) * t.tf * 2.2::double
               / (t.tf + 1.2::double * (0.25::double + 0.75::double * l.n / s.avg_len))), 6) AS score
        FROM r_ask a JOIN r_tf t ON t.term = a.term JOIN r_df d ON d.term = a.term JOIN r_len l ON l.chunk_id = t.chunk_id CROSS JOIN r_stat s
        GROUP BY 1, 2)) {f"WHERE rk <= {k}" if k else ""})"""


def _letters(key: str, text: str, source: str) -> str:
    """Unit vectors of letter counts, kept in single precision."""
    return f"""(SELECT {key}, list_transform(c, lambda x: (x / greatest(sqrt(list_sum(list_transform(c, lambda y: (y * y)::double))), 1e-9))::float::double) AS v
               FROM (SELECT {key}, list_transform(range(97, 123), lambda i: (length(lower({text})) - length(replace(lower({text}), chr(i::integer), '')))::double) AS c FROM {source}))"""


def _cosine(a: str, b: str) -> str:
    return f"CASE WHEN list_sum({a}) = 0 OR list_sum({b}) = 0 THEN 0.0::double ELSE list_cosine_similarity({a}, {b}) END"


SQL = {
    "binary_docs": """
        SELECT count(*) AS documents, round(cast(coalesce(sum(length(html)), 0) AS double) / 1024.0 / 1024.0, 1) AS total_mb
        FROM pages WHERE lower(url) LIKE '%.html'""",
    "parse_documents": f"""
        SELECT doc_uri, count(element_id) AS elements, min_by(type, element_id) AS first_type, min_by(content, element_id) AS first_content,
               CASE WHEN max(blank) THEN 'EMPTY_DOCUMENT' END AS error_status
        FROM (SELECT concat('pages/', page_id, '.html') AS doc_uri, html IS NULL OR trim(html) = '' AS blank FROM pages)
        LEFT JOIN ({_ELEMENTS}) USING (doc_uri) GROUP BY doc_uri""",
    "flatten_elements": f"SELECT * FROM ({_ELEMENTS})",
    "parse_verify": f"""
        SELECT count(DISTINCT e.doc_uri) AS documents_parsed, count(e.doc_uri) AS page_elements,
               cast(sum(length(e.content)) AS bigint) AS total_characters,
               count(*) FILTER (e.doc_uri IS NULL) AS documents_without_elements
        FROM pages p LEFT JOIN ({_ELEMENTS}) e ON e.doc_uri = concat('pages/', p.page_id, '.html')""",
    "chunk_fixed": f"""
        SELECT doc_uri AS doc_id, pos, length(piece) AS chars, md5(piece) AS digest
        FROM ({_chunks("(SELECT doc_id AS doc_uri, 0 AS page, 0 AS element_id, text AS content FROM documents)")})""",
    "chunk_table": f"WITH {_CHUNKS} SELECT * FROM r_chunks",
    "chunk_position": _semantic("SELECT doc_uri, chunk_position, length(content) AS chars FROM r_semantic", 2000),
    "chunk_semantic": _semantic(
        "SELECT sha256(concat_ws('::', doc_uri, page, chunk_position)) AS chunk_id, doc_uri, page, chunk_position, content, header, "
        "'semantic' AS chunk_method FROM r_semantic"
    ),
    "chunk_enrich": _semantic(_ENRICHED),
    "chunk_fallback": _semantic(_MIXED),
    "chunk_stats": _semantic(
        f"""SELECT chunk_method, count(*) AS total_chunks, count(DISTINCT chunk_id) AS distinct_ids,
                   count(*) - count(DISTINCT chunk_id) AS duplicate_ids, count(DISTINCT doc_uri) AS documents,
                   round(avg(length(content))) AS avg_retrieved_chars, round(avg(length(chunk_to_embed))) AS avg_embedded_chars
            FROM ({_MIXED}) GROUP BY 1"""
    ),
    "incremental_sync": f"""
        WITH {_CHUNKS},
        r_src AS (SELECT concat_ws('/', 'documents', source, concat(doc_id, '.txt')) AS doc_uri, 0::bigint AS element_id, 0::bigint AS page,
                         regexp_replace(text, '\\n+', ' ', 'g') AS content
                  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
                  UNION ALL SELECT concat('benchmark/', item_id), 0, 0, text FROM benchmark),
        r_new AS ({_FIXED.format(chunks=_chunks("r_src"))})
        SELECT coalesce(o.chunk_id, n.chunk_id) AS chunk_id,
               CASE WHEN o.chunk_id IS NULL THEN 'I' WHEN n.chunk_id IS NULL THEN 'D' ELSE 'U' END AS op
        FROM r_chunks o FULL JOIN r_new n ON o.chunk_id = n.chunk_id
        WHERE o.chunk_id IS NULL OR n.chunk_id IS NULL OR o.chunk_to_embed <> n.chunk_to_embed""",
    "vector_topk": f"WITH {_vector(5)} SELECT question, chunk_id, score, rk FROM r_hits",
    "topk_per_query": f"WITH {_vector(3)} SELECT h.question, h.chunk_id, h.score, h.rk, cast(e.label AS bigint) AS label "
    "FROM r_hits h JOIN embeddings e ON e.vec_id = h.chunk_id",
    "embed_chunks": f"""
        WITH {_CHUNKS} SELECT 1024::bigint AS dims, count(*) AS chunks,
               count(*) FILTER (regexp_matches(chunk_to_embed, '[\\p{{L}}\\p{{N}}]')) AS unit,
               count(*) FILTER (NOT regexp_matches(chunk_to_embed, '[\\p{{L}}\\p{{N}}]')) AS empty FROM r_chunks""",
    "embed_with_model": f"""
        WITH {_CHUNKS} SELECT 26::bigint AS dims, count(*) AS chunks, count(*) FILTER (regexp_matches(lower(chunk_to_embed), '[a-z]')) AS unit,
               count(*) FILTER (NOT regexp_matches(lower(chunk_to_embed), '[a-z]')) AS empty FROM r_chunks""",
    "vector_topk_ann": f"WITH {_vector(5)} SELECT question, chunk_id, score, rk, true AS is_exact FROM r_hits",
    "ann_recall": f"WITH {_vector(5)} SELECT count(DISTINCT question) AS questions, count(*) AS hits, true AS recalled FROM r_hits",
    "hybrid_search": f"""
        WITH {_bm25(None)},
        r_near AS (SELECT question, chunk_id, row_number() OVER (PARTITION BY question ORDER BY round({_cosine("q.v", "c.v")}, 6) DESC, chunk_id) AS rk
                   FROM {_letters("question", "text", "(SELECT item_id AS question, text FROM benchmark)")} q CROSS JOIN {_letters("chunk_id", "content", "r_chunks")} c),
        r_fused AS (SELECT question, chunk_id, round(sum(1.0::double / (60 + rk)), 6) AS score
                    FROM (SELECT question, chunk_id, rk FROM r_hits UNION ALL SELECT question, chunk_id, rk FROM r_near) GROUP BY 1, 2)
        SELECT * FROM (SELECT question, chunk_id, score, row_number() OVER (PARTITION BY question ORDER BY score DESC, chunk_id) AS rk FROM r_fused) WHERE rk <= 5""",
    "embed_vectors": f"WITH {_CHUNKS} SELECT chunk_id, list_transform(v, lambda x: round(x, 4)) AS embedding FROM {_letters('chunk_id', 'chunk_to_embed', 'r_chunks')}",
    "filtered_search": f"WITH {_vector(5, 'label IN (1, 2, 3)')} SELECT question, chunk_id, score, rk FROM r_hits",
    "keyword_topk": f"WITH {_bm25(5)} SELECT question, chunk_id, score, rk FROM r_hits",
    "search_report": rf"""
        WITH {_bm25(5)} SELECT h.question, h.rk AS rank, h.score, c.page, split_part(c.doc_uri, '/', -1) AS source,
               left(trim(regexp_replace(c.content, '\s+', ' ', 'g')), 200) AS snippet
        FROM r_hits h JOIN r_chunks c ON c.chunk_id = h.chunk_id""",
    "answerable_gate": f"WITH {_vector(5, 'vec_id <> question')} SELECT question, max(score) AS best, max(score) >= 0.35 AS answerable FROM r_hits GROUP BY 1",
    "retrieval_eval": f"""
        WITH {_vector(5, "vec_id <> question")}, r_first AS (SELECT question, min(rk) AS rk FROM r_hits WHERE label = wanted GROUP BY 1)
        SELECT count(*) AS questions, round(avg(CASE WHEN f.rk IS NULL THEN 0.0::double ELSE 1.0::double END), 4) AS hit_rate,
               round(avg(coalesce(1.0::double / f.rk, 0)), 4) AS mrr
        FROM r_q q LEFT JOIN r_first f ON f.question = q.question""",
}

DUPLICATE_IDS = f"""
    WITH {_CHUNKS} SELECT 'chunk ids are unique' AS rule, count(*) AS checked, count(*) - count(DISTINCT chunk_id) AS violations,
         count(*) = count(DISTINCT chunk_id) AS passed FROM r_chunks"""
