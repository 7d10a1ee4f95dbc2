"""Documents: HTML pages to elements, elements to chunks, chunks to an index that is kept in step."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.functions import exprs as X

CHUNK_COLUMNS = ["chunk_id", "doc_uri", "page", "chunk_position", "content", "chunk_to_embed", "chunk_method"]

# What is dropped from a page before it is read: all else is text. An unclosed one runs to the end of the page.
DROPPED = r"(?is)<script\b.*?(?:</script\s*>|$)|<style\b.*?(?:</style\s*>|$)|<!--.*?(?:-->|$)|<!doctype[^>]*>"

# Tags that begin a new element where they open and where they close, with the kind of what follows the opening.
BLOCKS = {
    "title": "title",
    **dict.fromkeys(["h1", "h2", "h3", "h4", "h5", "h6"], "heading"),
    **dict.fromkeys(["li", "dt", "dd"], "list_item"),
    **dict.fromkeys(["tr", "caption"], "table_row"),
    **dict.fromkeys(
        ["p", "div", "ul", "ol", "dl", "table", "section", "article", "header", "footer", "nav", "main", "aside", "blockquote",
         "pre", "form", "figure", "figcaption", "hr", "head", "body", "html"],
        "paragraph",
    ),
}
BLOCK = r"(?is)<(/?)(" + "|".join(sorted(BLOCKS)) + r")(?:\s[^>]*)?/?>"

# Every character that counts as white space, up to the ideographic blank; stripped from the ends of a chunk.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


# --- parsing ---------------------------------------------------------------------------------


def _character(code: Column) -> Column:
    """The character of a code point; NULL for what is no character."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_entities(text: Column) -> Column:
    """Named (the standard's list) and numeric entities as characters, once; what is no entity stays as it is."""
    names = F.create_map(*[x for name, code in {**name2codepoint, "apos": 39}.items() for x in (F.lit(name), F.lit(code).cast("bigint"))])

    def piece(part: Column, index: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        code = (
            F.when(name.rlike("^#[0-9]"), F.try_to_number(F.substring(name, 2, 7), F.lit("9999999")).cast("bigint"))
            .when(name.startswith("#"), F.conv(F.substring(name, 3, 6), 16, 10).cast("bigint"))
            .otherwise(F.try_element_at(names, name))
        )
        return F.when(index == 0, part).otherwise(
            F.coalesce(F.concat(_character(code), F.substr(part, F.length(name) + 2)), F.concat(F.lit("&"), part))
        )

    decoded = F.array_join(F.transform(F.split(text, "&"), piece), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def plain_text(html: Column) -> Column:
    """Text of an HTML fragment: tags to blanks, entities decoded, white space collapsed."""
    out = decode_entities(F.regexp_replace(html, r"<[^>]+>", " "))
    return F.btrim(F.regexp_replace(out, r"[\s\x{A0}]+", " "))


def _element(piece: Column) -> Column:
    tag = F.when(F.contains(piece, F.lit("\u0002")), F.lower(F.substring_index(piece, "\u0002", 1))).otherwise("")
    kind = F.lit("paragraph")
    for name in sorted(set(BLOCKS.values()) - {"paragraph"}):
        kind = F.when(tag.isin([t for t, k in BLOCKS.items() if k == name]), name).otherwise(kind)
    return F.struct(kind.alias("type"), plain_text(F.substring_index(piece, "\u0002", -1)).alias("content"))


def html_elements(html: Column) -> Column:
    """All text of a page in page order, cut where a block opens or closes; no shuffle, no UDF.

    Text after a closing tag belongs to whatever is around it and is a paragraph. Only scripts, styles, comments and
    tags are left out; elements without text are dropped.
    """
    kept = F.regexp_replace(F.translate(F.coalesce(html, F.lit("")), "\u0001\u0002", "  "), DROPPED, " ")
    pieces = F.split(F.regexp_replace(kept, BLOCK, "\u0001$1$2\u0002"), "\u0001")
    found = F.filter(F.transform(pieces, _element), lambda e: e["content"] != "")
    return F.transform(
        found,
        lambda e, i: F.struct(i.cast("int").alias("id"), F.lit(0).alias("page_id"), e["type"].alias("type"), e["content"].alias("content")),
    )


def parse_documents(pages: DataFrame, uri: str = "doc_uri", html: str = "html") -> DataFrame:
    """One VARIANT per document with pages, elements and an error status."""
    blank = F.col(html).isNull() | (F.trim(html) == "")
    parsed = F.struct(
        F.struct(
            F.array(F.struct(F.lit(0).alias("id"))).alias("pages"), html_elements(F.col(html)).alias("elements")
        ).alias("document"),
        F.when(blank, "EMPTY_DOCUMENT").alias("error_status"),
    )
    return pages.select(F.col(uri).alias("doc_uri"), F.to_variant_object(parsed).alias("parsed"))


def flatten(parsed: DataFrame) -> DataFrame:
    """One row per element; failed documents and elements without text are dropped."""
    ok = parsed.filter(F.variant_get("parsed", "$.error_status", "string").isNull())
    items = ok.select(
        "doc_uri", F.explode(F.variant_get("parsed", "$.document.elements", "array<variant>")).alias("el")
    )
    return items.select(
        "doc_uri",
        F.variant_get("el", "$.id", "int").alias("element_id"),
        F.variant_get("el", "$.page_id", "int").alias("page"),
        F.variant_get("el", "$.type", "string").alias("type"),
        F.variant_get("el", "$.content", "string").alias("content"),
    ).filter(F.col("content").isNotNull())


def parse_stats(elements: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents, elements, characters, and documents without any element, as one row."""
    both = elements.select("doc_uri", F.length("content").cast("bigint").alias("chars"), F.lit(1).alias("n")).unionByName(
        docs.select("doc_uri", F.lit(0).cast("bigint").alias("chars"), F.lit(0).alias("n"))
    )
    per_doc = both.groupBy("doc_uri").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
    return per_doc.agg(
        F.count_if(F.col("n") > 0).alias("documents_parsed"),
        F.sum("n").alias("page_elements"),
        F.sum("chars").alias("total_characters"),
        F.count_if(F.col("n") == 0).alias("documents_without_elements"),
    )


# --- chunking --------------------------------------------------------------------------------


def chunk_fixed(text: str | Column, size: int = 1000, overlap: int = 150) -> Column:
    """Windows of ``size`` characters that overlap, stripped, empty ones dropped, up to the end of the text."""
    text = X.as_column(text)
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - size) / F.lit(step)), F.lit(0)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.btrim(F.substring(text, i * step + 1, F.lit(size)), F.lit(SPACES))
    )
    return F.when(F.length(text) > 0, F.filter(pieces, lambda p: p != "")).otherwise(F.array().cast("array<string>"))


def chunk_table(elements: DataFrame, size: int = 1000, overlap: int = 150, key: tuple[str, ...] = ()) -> DataFrame:
    """Fixed-window chunks with a stable id over document, page and position.

    ``key`` names further columns for the id where a page has more than one element.
    """
    exploded = elements.select(
        "doc_uri", "page", *key, F.posexplode(chunk_fixed("content", size, overlap)).alias("chunk_position", "content")
    )
    return exploded.select(
        X.stable_key("doc_uri", "page", *key, "chunk_position").alias("chunk_id"),
        "doc_uri",
        "page",
        "chunk_position",
        "content",
        F.col("content").alias("chunk_to_embed"),
        F.lit("fixed_window").alias("chunk_method"),
    )


ELEMENT = "struct<element_id: int, page: int, type: string, content: string>"
PIECE = "struct<page: int, header: string, content: string>"


def element_lists(parsed: DataFrame) -> DataFrame:
    """(doc_uri, elements): the elements of every parsed document as one array, in order; failed documents are dropped."""
    ok = parsed.filter(F.variant_get("parsed", "$.error_status", "string").isNull())
    kind = "array<struct<id: int, page_id: int, type: string, content: string>>"
    read = F.filter(F.variant_get("parsed", "$.document.elements", kind), lambda e: e["content"].isNotNull())
    return ok.select("doc_uri", read.cast(f"array<{ELEMENT}>").alias("elements"))


def listed(elements: DataFrame) -> DataFrame:
    """The same from rows of elements, which are collected by document; rows that are lists already pass through."""
    if "elements" in elements.columns:
        return elements
    own = F.struct(*[F.col(c).cast(t).alias(c) for c, t in (("element_id", "int"), ("page", "int"), ("type", "string"), ("content", "string"))])
    return elements.groupBy("doc_uri").agg(F.array_sort(F.collect_list(own)).alias("elements"))


def sections(elements: Column, max_chars: int) -> Column:
    """The chunks of one document's elements as an array, by a fold over them that carries the section, its offset and the open chunk."""
    none = F.lit(None).cast(PIECE)
    start = F.struct(
        F.array().cast(f"array<{PIECE}>").alias("done"), none.alias("piece"), F.lit(None).cast("string").alias("header"),
        F.lit(0).cast("bigint").alias("offset"), F.lit(-1).cast("bigint").alias("slice"),
    )

    def add(acc: Column, e: Column) -> Column:
        heading = e["type"] == "heading"
        offset = F.when(heading, F.lit(0).cast("bigint")).otherwise(acc["offset"])
        part = F.floor(offset / F.lit(max_chars)).cast("bigint")
        header = F.when(heading, e["content"]).otherwise(acc["header"])
        piece = acc["piece"]
        fresh = piece.isNull() | heading | (part != acc["slice"])
        joined = F.struct(F.least(piece["page"], e["page"]).alias("page"), piece["header"].alias("header"), F.concat_ws(" ", piece["content"], e["content"]).alias("content"))
        opened = F.struct(e["page"].alias("page"), header.alias("header"), e["content"].alias("content"))
        return F.struct(
            F.when(fresh & piece.isNotNull(), F.concat(acc["done"], F.array(piece))).otherwise(acc["done"]).alias("done"),
            F.when(fresh, opened).otherwise(joined).cast(PIECE).alias("piece"),
            header.alias("header"),
            (offset + F.length(e["content"])).cast("bigint").alias("offset"),
            part.alias("slice"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["piece"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["piece"])))

    return F.aggregate(F.filter(elements, lambda e: e["type"] != "title"), start, add, finish)


def chunk_semantic(elements: DataFrame, max_chars: int = 3000) -> DataFrame:
    """Chunks that start at headings and are closed after ``max_chars`` characters of a section.

    A section runs from a heading to the next one. Inside it, elements share a chunk while their
    start offset lies in the same ``max_chars`` slice, so no chunk exceeds the limit by more than one
    element. A chunk may span pages and cites the first one. Given lists of elements per document (:func:`element_lists`),
    chunks are cut inside the row and no text is shuffled.
    """
    return _placed(listed(elements).select("doc_uri", F.posexplode(sections(F.col("elements"), max_chars)).alias("chunk_position", "piece")))


def _placed(pieces: DataFrame, *more: str) -> DataFrame:
    """Rows (doc_uri, chunk_position, piece) as chunks with their key, and further columns."""
    flat = pieces.select("doc_uri", "piece.page", "chunk_position", "piece.content", "piece.header", *more)
    return flat.select(
        X.stable_key("doc_uri", "page", "chunk_position").alias("chunk_id"),
        "doc_uri",
        "page",
        "chunk_position",
        "content",
        "header",
        F.lit("semantic").alias("chunk_method"),
        *more,
    )


def title_of(elements: Column) -> Column:
    """A document's title: the first one where it carries several."""
    return F.try_element_at(F.filter(elements, lambda e: e["type"] == "title"), F.lit(1))["content"]


def context() -> Column:
    """The text to embed: title, section header and page in front of the chunk."""
    return F.concat_ws("\n", "title", "header", F.concat(F.lit("Page "), F.col("page").cast("string")), "content")


def enrich(chunks: DataFrame, titles: DataFrame) -> DataFrame:
    """Adds the text to embed, with titles from a table; the content stays clean."""
    return chunks.join(titles, "doc_uri", "left").withColumn("chunk_to_embed", context()).select(*CHUNK_COLUMNS)


def document_titles(elements: DataFrame) -> DataFrame:
    """Title per document that has one."""
    return listed(elements).select("doc_uri", title_of(F.col("elements")).alias("title")).filter("title is not null")


def chunk_enriched(elements: DataFrame, max_chars: int = 3000) -> DataFrame:
    """Semantic chunks with the text to embed; the title comes from the same row."""
    pieces = F.posexplode(sections(F.col("elements"), max_chars)).alias("chunk_position", "piece")
    cut = listed(elements).select("doc_uri", title_of(F.col("elements")).alias("title"), pieces)
    return _placed(cut, "title").withColumn("chunk_to_embed", context()).select(*CHUNK_COLUMNS)


def chunk(elements: DataFrame, max_chars: int = 3000, size: int = 1000, overlap: int = 150) -> DataFrame:
    """Semantic chunks for documents with headings, fixed windows for the others; one schema."""
    headed = F.exists("elements", lambda e: e["type"] == "heading")
    lists = listed(elements)
    plain = lists.filter(~headed).select("doc_uri", F.inline("elements"))
    return chunk_enriched(lists.filter(headed), max_chars).unionByName(chunk_table(plain, size, overlap, ("element_id",)))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("chunk_method").agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.countDistinct("chunk_id").alias("distinct_ids"),
        (F.count(F.lit(1)) - F.countDistinct("chunk_id")).alias("duplicate_ids"),
        F.countDistinct("doc_uri").alias("documents"),
        F.round(F.avg(F.length("content"))).alias("avg_retrieved_chars"),
        F.round(F.avg(F.length("chunk_to_embed"))).alias("avg_embedded_chars"),
    )


# --- incremental index -----------------------------------------------------------------------


def content_hash(df: DataFrame, key: str, *content: str) -> DataFrame:
    return df.select(key, F.sha2(F.concat_ws("\u0001", *content), 256).alias("content_hash"))


def diff(old: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Keys to insert, update and delete so that ``old`` becomes ``new``; unchanged keys are left out.

    Both sides carry ``content_hash``, so only keys and hashes are shuffled, never texts.
    """
    o = old.select(F.col(key), F.col("content_hash").alias("_old"))
    n = new.select(F.col(key), F.col("content_hash").alias("_new"))
    joined = o.join(n, key, "full")
    op = F.when(F.col("_old").isNull(), "I").when(F.col("_new").isNull(), "D").when(F.col("_old") != F.col("_new"), "U")
    return joined.select(key, op.alias("op")).filter(F.col("op").isNotNull())
