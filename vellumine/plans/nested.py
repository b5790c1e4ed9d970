"""Queries of the tagged emission."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellumine.operators import nested
from vellumine.plans import sql
from vellumine.session import table


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every named party with its record, pass, chunk and place."""
    return nested.party_rows(table(spark, folder, "predictions_all"), table(spark, folder, "raw_outputs"))


def p4_passes(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks of the raw answers as a flat table: keys, title and identifier."""
    raw = nested.once(table(spark, folder, "raw_outputs").select("rec_id", "payload"), "rec_id", "payload")
    rows = nested.tagged_rows(raw, "rec_id", "payload", nested.ANSWER, through=("answer",))
    return nested.flat_table(rows, "chunk", "title STRING, identifier STRING").distinct()


QUERIES = {"p4_found": p4_found, "p4_passes": p4_passes}
_PARTY = """
    SELECT {keys}, party, unnest(CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END) AS e,
           generate_subscripts(CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END, 1) AS pos
    FROM (SELECT {keys}, 'inventor' AS party, CASE WHEN json_type(p, '$.inventors') <> 'NULL' THEN json_extract(p, '$.inventors') ELSE json_extract(p, '$.inventor') END AS v FROM {src}
          UNION ALL SELECT {keys}, 'assignee', CASE WHEN json_type(p, '$.assignees') <> 'NULL' THEN json_extract(p, '$.assignees') ELSE json_extract(p, '$.assignee') END FROM {src})
    WHERE v IS NOT NULL"""

ORACLE = {
    "p4_passes": r"""
        WITH ps AS (SELECT rec_id, unnest(json_extract(payload, '$.answer.passes[*]')) AS x, generate_subscripts(json_extract(payload, '$.answer.passes[*]'), 1) AS place FROM raw_outputs WHERE json_valid(payload)),
        cs AS (SELECT rec_id, coalesce(try_cast(json_extract_string(x, '$.pass') AS INT), place) AS pass_no,
                      unnest(CASE json_type(x, '$.chunks') WHEN 'ARRAY' THEN json_extract(x, '$.chunks[*]') ELSE [json_extract(x, '$.chunks')] END) AS c,
                      generate_subscripts(CASE json_type(x, '$.chunks') WHEN 'ARRAY' THEN json_extract(x, '$.chunks[*]') ELSE [json_extract(x, '$.chunks')] END, 1) AS place FROM ps),
        pr AS (SELECT rec_id, pass_no, coalesce(try_cast(json_extract_string(c, '$.chunk') AS INT), place) AS chunk_no, c,
                      CASE json_type(c, '$.prediction') WHEN 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(c, '$.prediction')) THEN json_extract_string(c, '$.prediction')::JSON END
                           ELSE coalesce(json_extract(c, '$.prediction'), c) END AS p FROM cs WHERE json_type(c) = 'OBJECT')
        SELECT DISTINCT rec_id AS root, rec_id || '/pass:' || pass_no || '/chunk:' || chunk_no AS pk, rec_id || '/pass:' || pass_no AS parent_pk, chunk_no AS ordinal,
               json_extract_string(p, '$.title') AS title, json_extract_string(p, '$.identifier') AS identifier FROM pr""",
    "p4_found": rf"""
        WITH ps AS (SELECT rec_id, unnest(json_extract(payload, '$.answer.passes[*]')) AS x FROM raw_outputs WHERE json_valid(payload)),
        cs AS (SELECT rec_id, json_extract_string(x, '$.pass')::INT AS pass_no,
                      unnest(CASE json_type(x, '$.chunks') WHEN 'ARRAY' THEN json_extract(x, '$.chunks[*]') ELSE [json_extract(x, '$.chunks')] END) AS c FROM ps),
        pr AS (SELECT rec_id, pass_no, json_extract_string(c, '$.chunk')::INT AS chunk_no,
                      CASE json_type(c, '$.prediction') WHEN 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(c, '$.prediction')) THEN json_extract_string(c, '$.prediction')::JSON END
                           ELSE json_extract(c, '$.prediction') END AS p FROM cs),
        el AS ({_PARTY.format(keys='rec_id, pass_no, chunk_no', src='pr')}),
        nm AS (SELECT rec_id, pass_no, chunk_no, party, pos, CASE json_type(e) WHEN 'VARCHAR' THEN json_extract_string(e, '$') WHEN 'OBJECT' THEN json_extract_string(e, '$.name') END AS name FROM el
               UNION ALL SELECT rec_id, 0, 0, 'inventor', generate_subscripts(prediction.inventors, 1), unnest(prediction.inventors).name FROM predictions_all
               UNION ALL SELECT rec_id, 0, 0, 'assignee', generate_subscripts(prediction.assignees, 1), unnest(prediction.assignees).name FROM predictions_all)
        SELECT DISTINCT rec_id, pass_no, chunk_no, party, pos::INT AS pos FROM nm WHERE {sql.present('name')}""",
}
