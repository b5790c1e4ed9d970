"""Queries over texts: measures, chunks, prompts, cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumine.functions import dates, text as tx
from vellumine.operators import chunking
from vellumine.operators.chunking import Chunking
from vellumine.plans import sql
from vellumine.session import table

C = Chunking()
TEMPLATE = "Read this text and answer with JSON like {{\"title\": ...}}:\n{text}\nEnd."


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", "lang")


def doc_proxy_metrics(spark: SparkSession, folder: str) -> DataFrame:
    d = _docs(spark, folder).filter("text is not null").withColumn("_lines", tx.lines("text")).withColumn("_dates", dates.date_strings("text"))
    return d.select(
        "doc_id", *[c.alias(n) for n, c in tx.proxies("text", "_lines").items()], F.size("_dates").cast("bigint").alias("n_dates"), F.array_join(F.slice("_dates", 1, 20), "|").alias("dates")
    )


def proxy_summary_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    d = _docs(spark, folder)
    return d.groupBy(F.lower("lang").alias("lang")).agg(
        F.count("*").alias("n_docs"), F.count_if(~tx.blank("text")).alias("n_with_text"), F.count_if(F.col("text").rlike("|".join(dates.PATTERNS))).alias("n_with_dates"), F.sum(F.length("text")).alias("n_chars")
    )


def letter_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).filter("text is not null").select("doc_id", *tx.letter_profile("text"))


def truncate_docs(spark: SparkSession, folder: str) -> DataFrame:
    cut = chunking.truncated("text", 2_000)
    return _docs(spark, folder).select("doc_id", F.length(cut).cast("bigint").alias("n"), F.md5(cut).alias("digest"))


def route_mode(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all")
    return p.filter("ocr_text is not null").groupBy(F.when(chunking.chunked("ocr_text", C), "chunked").otherwise("single").alias("mode")).agg(F.count("*").alias("n"), F.sum(F.length("ocr_text")).alias("n_chars"))


def chunk_explode(spark: SparkSession, folder: str) -> DataFrame:
    parts = chunking.windows("ocr_text", C.size, C.overlap)
    return table(spark, folder, "predictions_all").select("rec_id", F.posexplode(parts).alias("chunk_no", "chunk")).select(
        "rec_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), F.length("chunk").cast("bigint").alias("n"), F.md5("chunk").alias("digest")
    )


def chunk_multi_pass(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").filter(~tx.blank("ocr_text"))
    rows = chunking.prompt_rows(p, "rec_id", "ocr_text", C)
    return rows.select("rec_id", F.col("candidate_order").cast("bigint").alias("candidate_order"), F.length("body").cast("bigint").alias("n"), F.md5("body").alias("digest"))


def header_lines(spark: SparkSession, folder: str) -> DataFrame:
    head = chunking.header("ocr_text", C)
    return table(spark, folder, "predictions_all").filter("ocr_text is not null").select("rec_id", F.length(head).cast("bigint").alias("n"), F.md5(head).alias("digest"))


def render_prompt_hash(spark: SparkSession, folder: str) -> DataFrame:
    prompt = chunking.rendered(TEMPLATE, "text")
    return _docs(spark, folder).filter("text is not null").select("doc_id", F.sha2(prompt, 256).alias("prompt_sha"), chunking.prompt_identity(TEMPLATE).alias("template_sha"))


def prompt_microbatches(spark: SparkSession, folder: str) -> DataFrame:
    d = _docs(spark, folder).filter("text is not null")
    return chunking.micro_batches(d, ["doc_id"], F.length("text"), 32)


def blank_doc_split(spark: SparkSession, folder: str) -> DataFrame:
    d = _docs(spark, folder)
    empty = d.filter(tx.blank("text")).select("doc_id", F.lit("empty_ocr").alias("error"), F.lit(0.0).alias("confidence"))
    return empty.unionByName(d.filter(~tx.blank("text")).select("doc_id"), allowMissingColumns=True)


def normalize_ws(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).filter("text is not null").select("doc_id", F.md5(tx.collapsed("text")).alias("digest"))


def tokens_distinct(spark: SparkSession, folder: str) -> DataFrame:
    normal = tx.strip(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    tokens = tx.distinct_tokens(normal)
    return _docs(spark, folder).filter("text is not null").select("doc_id", F.size(tokens).cast("bigint").alias("n"), F.md5(F.array_join(tokens, " ")).alias("digest"))


def classification_snippets(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").filter("ocr_text is not null")
    found = tx.class_snippets("ocr_text")
    return p.select("rec_id", tx.has_class_cue("ocr_text").alias("has_class"), F.size(found).cast("bigint").alias("n"), F.array_join(found, "|").alias("snippets"))


def self_applicant_cue(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").filter("ocr_text is not null")
    return p.select("rec_id", tx.self_applicant_cue("ocr_text").alias("cue"))


def search_normal_text(spark: SparkSession, folder: str) -> DataFrame:
    """Accent-free normal form of every text."""
    return _docs(spark, folder).filter("text is not null").select("doc_id", F.md5(tx.search_normal("text")).alias("digest"))


QUERIES = {
    f.__name__: f
    for f in (
        doc_proxy_metrics, proxy_summary_by_lang, letter_frequency, truncate_docs, route_mode, chunk_explode, chunk_multi_pass, header_lines, render_prompt_hash,
        prompt_microbatches, blank_doc_split, normalize_ws, tokens_distinct, classification_snippets, self_applicant_cue, search_normal_text,
    )
}

_ALL = [f"regexp_extract_all(text, '{p}', 0)" for p in dates.PATTERNS]
_DATES = f"list_concat(list_concat({_ALL[0]}, {_ALL[1]}), list_concat({_ALL[2]}, {_ALL[3]}))"
_NORMAL = sql.strip("regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')")
_TOKENS = f"list_sort(list_distinct(list_filter(string_split({_NORMAL}, ' '), lambda t: regexp_matches(t, '[0-9]') OR length(t) >= 3)))"


def _windows(offset: int) -> str:
    """Windows of ocr_text from an offset on, with their number in the pass."""
    step = C.size - C.overlap
    return f"""SELECT rec_id, {offset} AS off, k, substring(ocr_text, {offset} + k * {step} + 1, {C.size}) AS body
        FROM (SELECT rec_id, ocr_text, unnest(range(CASE WHEN length(ocr_text) <= {offset} THEN 0
              ELSE 1 + ceil(greatest(length(ocr_text) - {offset} - {C.size}, 0) / {step}.0)::BIGINT END)) AS k FROM predictions_all WHERE ocr_text IS NOT NULL)"""


_TRUNCATED = f"CASE WHEN length(ocr_text) > {C.max_chars} THEN substring(ocr_text, 1, {C.max_chars}) || chr(10) || '[...] (truncated)' ELSE ocr_text END"
_FULL_LINES = f"list_filter({sql.lines('text')}, lambda l: {sql.strip('l')} <> '')"
_SNIP_LINES = rf"list_filter(list_transform({sql.lines('ocr_text')}, lambda l: {sql.strip('l')}), lambda l: regexp_matches(l, '{tx.CLASS_CUE}') AND regexp_matches(l, '\d'))"
_SNIP_INLINE = rf"list_filter(list_transform(regexp_extract_all(ocr_text, '{tx.CLASS_INLINE}', 0), lambda l: {sql.strip('l')}), lambda l: l <> '')"

ORACLE = {
    "search_normal_text": f"SELECT doc_id, md5({sql.normal('text')}) AS digest FROM documents WHERE text IS NOT NULL",
    "doc_proxy_metrics": f"""
        SELECT doc_id, length(text)::BIGINT AS n_chars, len({_FULL_LINES})::BIGINT AS n_lines, (len({sql.lines('text')}) - len({_FULL_LINES}))::BIGINT AS n_empty_lines,
               round(CASE WHEN len({_FULL_LINES}) > 0 THEN coalesce(list_sum(list_transform({_FULL_LINES}, lambda l: length(l))), 0)::DOUBLE / len({_FULL_LINES}) ELSE 0 END, 6) AS avg_line_len,
               len({_DATES})::BIGINT AS n_dates, array_to_string(list_slice({_DATES}, 1, 20), '|') AS dates
        FROM documents WHERE text IS NOT NULL""",
    "proxy_summary_by_lang": f"""
        SELECT lower(lang) AS lang, count(*) AS n_docs, count(*) FILTER (WHERE coalesce({sql.strip('text')}, '') <> '') AS n_with_text,
               count(*) FILTER (WHERE len({_DATES}) > 0) AS n_with_dates, sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY 1""",
    "letter_frequency": "SELECT doc_id, "
    + ", ".join(
        f"round(CASE WHEN length(regexp_replace(lower(text), '[^a-z]', '', 'g')) > 0 THEN length(regexp_replace(lower(text), '[^{c}]', '', 'g')) * 100.0::DOUBLE / length(regexp_replace(lower(text), '[^a-z]', '', 'g')) ELSE 0 END, 2) AS freq_{c}"
        for c in tx.PROFILE
    )
    + " FROM documents WHERE text IS NOT NULL",
    "truncate_docs": """
        SELECT doc_id, length(t)::BIGINT AS n, md5(t) AS digest
        FROM (SELECT doc_id, CASE WHEN length(text) > 2000 THEN substring(text, 1, 2000) || chr(10) || '[...] (truncated)' ELSE text END AS t FROM documents)""",
    "route_mode": f"""
        SELECT CASE WHEN length(ocr_text) > {C.max_chars} THEN 'chunked' ELSE 'single' END AS mode, count(*) AS n, sum(length(ocr_text))::BIGINT AS n_chars
        FROM predictions_all WHERE ocr_text IS NOT NULL GROUP BY 1""",
    "chunk_explode": f"""
        SELECT rec_id, (row_number() OVER (PARTITION BY rec_id ORDER BY k) - 1)::BIGINT AS chunk_no, length(body)::BIGINT AS n, md5(body) AS digest
        FROM ({_windows(0)}) WHERE {sql.strip('body')} <> ''""",
    "chunk_multi_pass": f"""
        WITH full_ AS (SELECT rec_id, ocr_text FROM predictions_all WHERE coalesce({sql.strip('ocr_text')}, '') <> ''),
        w AS (SELECT * FROM ({' UNION ALL '.join(_windows(o) for o in C.offsets)}) WHERE {sql.strip('body')} <> ''),
        parts AS (SELECT w.rec_id, row_number() OVER (PARTITION BY w.rec_id ORDER BY off, k) - 1 AS candidate_order, body FROM w JOIN full_ USING (rec_id) WHERE length(ocr_text) > {C.max_chars}),
        rows_ AS (SELECT * FROM parts UNION ALL SELECT rec_id, 0, {_TRUNCATED} FROM full_ WHERE rec_id NOT IN (SELECT rec_id FROM parts))
        SELECT rec_id, candidate_order::BIGINT AS candidate_order, length(body)::BIGINT AS n, md5(body) AS digest FROM rows_""",
    "header_lines": f"""
        SELECT rec_id, length(h)::BIGINT AS n, md5(h) AS digest
        FROM (SELECT rec_id, array_to_string(list_slice({sql.lines('ocr_text')}, 1, {C.header_lines}), chr(10)) AS h FROM predictions_all WHERE ocr_text IS NOT NULL)""",
    "render_prompt_hash": f"""
        SELECT doc_id, sha256('Read this text and answer with JSON like {{"title": ...}}:' || chr(10) || text || chr(10) || 'End.') AS prompt_sha,
               sha256('Read this text and answer with JSON like {{{{"title": ...}}}}:' || chr(10) || '{{text}}' || chr(10) || 'End.'
                      || chr(10) || chr(10) || 'Now output ONLY the JSON object, without any extra text.' || chr(10)) AS template_sha
        FROM documents WHERE text IS NOT NULL""",
    "prompt_microbatches": """
        SELECT doc_id, length, position, position // 32 AS microbatch
        FROM (SELECT doc_id, length(text)::BIGINT AS length, row_number() OVER (ORDER BY length(text) DESC, doc_id) - 1 AS position FROM documents WHERE text IS NOT NULL)""",
    "blank_doc_split": f"""
        SELECT doc_id, CASE WHEN coalesce({sql.strip('text')}, '') = '' THEN 'empty_ocr' END AS error,
               CASE WHEN coalesce({sql.strip('text')}, '') = '' THEN 0.0::DOUBLE END AS confidence FROM documents""",
    "normalize_ws": f"SELECT doc_id, md5({sql.collapsed('text')}) AS digest FROM documents WHERE text IS NOT NULL",
    "tokens_distinct": f"SELECT doc_id, len({_TOKENS})::BIGINT AS n, md5(array_to_string({_TOKENS}, ' ')) AS digest FROM documents WHERE text IS NOT NULL",
    "classification_snippets": f"""
        WITH s AS (SELECT rec_id, ocr_text, CASE WHEN len({_SNIP_LINES}) > 0 THEN {_SNIP_LINES} ELSE {_SNIP_INLINE} END AS found FROM predictions_all WHERE ocr_text IS NOT NULL),
        u AS (SELECT rec_id, unnest(found) AS x, generate_subscripts(found, 1) AS pos FROM s),
        f AS (SELECT rec_id, x, min(pos) AS pos FROM u GROUP BY 1, 2),
        g AS (SELECT rec_id, count(*) AS n, string_agg(x, '|' ORDER BY pos) AS snippets FROM f GROUP BY 1)
        SELECT s.rec_id, regexp_matches(ocr_text, '{tx.CLASS_INLINE}') AS has_class, coalesce(n, 0)::BIGINT AS n, coalesce(snippets, '') AS snippets FROM s LEFT JOIN g USING (rec_id)""",
    "self_applicant_cue": "SELECT rec_id, contains(lower(ocr_text), 'anmelder') AND ("
    + " OR ".join(f"contains(lower(ocr_text), '{c}')" for c in tx.SELF_CUES)
    + ") AS cue FROM predictions_all WHERE ocr_text IS NOT NULL",
}
