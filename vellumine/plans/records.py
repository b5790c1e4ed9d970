"""Queries over delivered records: entities, dates, merging, confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumine import config
from vellumine.functions import dates, entities, records, results, scoring, text as tx
from vellumine.operators import delivery
from vellumine.operators.merging import merged_records
from vellumine.plans import sql
from vellumine.session import table

DAYS = ("application", "publication", "foreign")


def _delivered(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return table(spark, folder, "predictions_all").filter("prediction is not null").select("rec_id", "prediction", *more)


def _flat(df: DataFrame, key: str, lists: dict) -> DataFrame:
    """One row an entity: key, kind, pos, name, address."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("es")) for k, c in lists.items()])
    return df.select(key, F.explode(each).alias("l")).select(key, "l.kind", F.posexplode("l.es").alias("pos", "e")).select(
        key, "kind", (F.col("pos") + 1).cast("bigint").alias("pos"), "e.name", "e.address"
    )


def _both(normal: bool = True) -> dict:
    return {k: entities.normalized(f"prediction.{k}") if normal else F.col(f"prediction.{k}") for k in ("inventors", "assignees")}


def company_detector(spark: SparkSession, folder: str) -> DataFrame:
    names = _flat(_delivered(spark, folder), "rec_id", _both(False)).select("name").filter("name is not null").distinct()
    return names.select("name", tx.is_company("name").alias("company"))


def entity_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_delivered(spark, folder), "rec_id", _both())


def entity_from_string(spark: SparkSession, folder: str) -> DataFrame:
    """Entities written into one string and read back."""
    d = _delivered(spark, folder)
    joined = lambda k: F.array_join(F.transform(entities.normalized(f"prediction.{k}"), lambda e: F.concat(F.regexp_replace(e["name"], r"[();]", " "), F.when(e["address"].isNotNull(), F.concat(F.lit(" ("), F.regexp_replace(e["address"], r"[();]", " "), F.lit(")"))).otherwise(F.lit("")))), "; ")
    return _flat(d, "rec_id", {k: entities.from_string(joined(k)) for k in ("inventors", "assignees")})


def entity_merge(spark: SparkSession, folder: str) -> DataFrame:
    d = _delivered(spark, folder, "file_name")
    gathered = d.groupBy("file_name").agg(F.array_sort(F.collect_list(F.struct("rec_id", F.col("prediction.inventors").alias("inventors"), F.col("prediction.assignees").alias("assignees")))).alias("c"))
    return _flat(gathered, "file_name", {k: entities.merged(F.transform("c", lambda x: x[k])) for k in ("inventors", "assignees")})


def company_move(spark: SparkSession, folder: str) -> DataFrame:
    n = _delivered(spark, folder).select("rec_id", *[c.alias(k) for k, c in _both().items()])
    return _flat(n, "rec_id", entities.companies_moved("inventors", "assignees"))


def entity_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _delivered(spark, folder).select("rec_id", *[F.round(entities.quality(c), 6).alias(k) for k, c in _both().items()])


def _days() -> list:
    return [F.col(f"prediction.pub_date_{d}") for d in DAYS]


def date_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _delivered(spark, folder).select("rec_id", *[dates.field_date(c).alias(d) for d, c in zip(DAYS, _days())])


def date_order_repair(spark: SparkSession, folder: str) -> DataFrame:
    fixed = dates.in_order(*[dates.iso_date(c) for c in _days()])
    return _delivered(spark, folder).select("rec_id", *[c.alias(d) for d, c in fixed.items()])


def date_duplicate_repair(spark: SparkSession, folder: str) -> DataFrame:
    return _delivered(spark, folder).select("rec_id", *[c.alias(d) for d, c in dates.without_duplicates(*_days()).items()])


def date_coherence(spark: SparkSession, folder: str) -> DataFrame:
    return _delivered(spark, folder).select("rec_id", dates.coherence(*[dates.iso_date(c) for c in _days()]).alias("coherence"))


def date_presence(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the publication date stands in the text; the texts' normal form isn't SQL."""
    d = _delivered(spark, folder, "ocr_text").filter("ocr_text is not null")
    day = dates.iso_date("prediction.pub_date_publication")
    d = d.withColumn("normal", tx.search_normal("ocr_text")).withColumn("day", day)
    return d.select("rec_id", dates.date_present("normal", "ocr_text", "day").alias("present"))


def _fields() -> dict:
    return {f: F.col("prediction")[f] for f in scoring.CRITICAL}


def missing_critical(spark: SparkSession, folder: str) -> DataFrame:
    lacking = scoring.missing_critical(_fields())
    return _delivered(spark, folder).select("rec_id", F.size(lacking).cast("bigint").alias("n"), F.array_join(lacking, ",").alias("fields"))


def confidence_score(spark: SparkSession, folder: str) -> DataFrame:
    d = _delivered(spark, folder, "ocr_text")
    return d.select("rec_id", *[c.alias(n) for n, c in scoring.confidence(F.col("prediction"), F.coalesce("ocr_text", F.lit(""))).items()])


def _merge(policy: str | None):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        d = _delivered(spark, folder, "file_name")
        m = merged_records(d, "file_name", "rec_id", "prediction", policy)
        one = lambda e: F.concat(F.coalesce(e["name"], F.lit("")), F.lit(" ("), F.coalesce(e["address"], F.lit("")), F.lit(")"))
        people = [F.nullif(F.array_join(F.transform(F.col("prediction")[k], one), "; "), F.lit("")).alias(k) for k in ("inventors", "assignees")]
        return m.select("file_name", *people, *[F.col("prediction")[f].alias(f) for f in ("title", "classification", "industrial_field", "pub_date_application", "pub_date_publication", "pub_date_foreign")])

    query.__name__ = "merge_" + (policy or "legacy")
    query.__doc__ = f"The answers to each file as one, {policy or 'by the rules of each field'}."
    return query


def field_variance(spark: SparkSession, folder: str) -> DataFrame:
    """How far the answers to a file differ, by field and over all fields."""
    d = _delivered(spark, folder, "file_name")
    keys = d.groupBy("file_name").agg(*[F.collect_list(scoring.vote_key(F.col("prediction")[f], f)).alias(f) for f in scoring.VOTED])
    return keys.select("file_name", *[c.alias(n) for n, c in scoring.variances({f: F.col(f) for f in scoring.VOTED}).items()])


def json_shred(spark: SparkSession, folder: str) -> DataFrame:
    """Members of the raw answers by path; invalid JSON gives nulls."""
    v = F.try_parse_json("payload")
    first = "$.answer.passes[0].chunks[0]"
    return table(spark, folder, "raw_outputs").select(
        "raw_id", F.try_variant_get(v, "$.file", "string").alias("file"), F.try_variant_get(v, f"{first}.prediction.title", "string").alias("title"),
        F.try_variant_get(v, f"{first}.usage.prompt_tokens", "bigint").alias("prompt_tokens"), v.isNotNull().alias("valid"),
    )


def extract_json_object(spark: SparkSession, folder: str) -> DataFrame:
    """The answers found in prose and fences, parsed and validated."""
    wrapped = F.concat(F.lit("Here it is:\n```json\n"), F.col("payload"), F.lit("\n```\nDone {not json}."))
    found = records.extracted(wrapped)
    rows = table(spark, folder, "raw_outputs").filter("payload is not null").select("raw_id", found.alias("found"))
    return records.with_validated(rows, "found", "record").select("raw_id", F.md5("found").alias("digest"), "record.title")


def identity_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Identity keys of all distinct names."""
    names = _flat(_delivered(spark, folder), "rec_id", _both(False)).select("name").filter("name is not null").distinct()
    return names.select("name", tx.identity_key("name").alias("key"))


def guardrail(spark: SparkSession, folder: str) -> DataFrame:
    """Assignees left after the rule for inventors who applied alone."""
    d = _delivered(spark, folder, "ocr_text").select("rec_id", "ocr_text", *[c.alias(k) for k, c in _both().items()])
    same = tx.same_person(F.get("inventors", F.lit(0))["name"], F.get("assignees", F.lit(0))["name"])
    marked = d.withColumn("same", same)
    return marked.select("rec_id", F.coalesce(F.size(entities.guarded_assignees("inventors", "assignees", "ocr_text", F.col("same"))), F.lit(0)).alias("n"), "same")


def _trees(spark: SparkSession, folder: str) -> DataFrame:
    """Invented page trees, one an order: a block a return flag, a line an item, words."""
    word = F.struct("l_linenumber", F.array(F.concat(F.lit("p"), F.col("l_partkey").cast("string")), F.lit(" "), F.lit(None).cast("string"), F.concat(F.lit(" "), F.col("l_linestatus"))).alias("words"))
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.array_sort(F.collect_list(word)).alias("l"))
    blocks = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_returnflag", F.col("l.words").alias("b")))).alias("p"))
    return blocks.select("l_orderkey", F.col("p.b").alias("blocks"))


def page_tree_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text of page trees."""
    return _trees(spark, folder).select("l_orderkey", results.page_text("blocks").alias("text"))


def _answers(spark: SparkSession, folder: str, line: str, before: str, after: str) -> DataFrame:
    li = table(spark, folder, "lineitem").select("l_orderkey", F.struct("l_linenumber", F.expr(line).alias("x")).alias("x"))
    return li.groupBy("l_orderkey").agg(F.concat(F.lit(before), F.array_join(F.array_sort(F.collect_list("x"))["x"], ","), F.lit(after)).alias("answer"))


def classic_ocr_text(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of classic answers, with detection and without; odd items are left out."""
    boxed = _answers(spark, folder, "if(l_linenumber = 3, '[1]', concat('[[1,2],[\"p', l_partkey, ' \",0.9]]'))", "[[", "]]")
    plain = _answers(spark, folder, "if(l_linenumber = 2, '[\" \",1]', concat('[\"', l_linestatus, '\",0.5]'))", "[", "]")
    a = boxed.select("l_orderkey", results.classic_text("answer").alias("detected"))
    return a.join(plain.select("l_orderkey", results.classic_text("answer", False).alias("plain")), "l_orderkey")


def line_object_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of object answers, and all their strings."""
    d = _answers(spark, folder, "concat('{\"text\":\"', if(l_linenumber = 2, ' ', concat('p', l_partkey)), '\",\"confidence\":1}')", '{"text_lines":[', "]}")
    return d.select("l_orderkey", F.array_join(results.line_texts("answer"), "|").alias("lines"), F.array_join(results.harvested("answer"), "|").alias("harvest"))


def delivered_records(spark: SparkSession, folder: str) -> DataFrame:
    """Answers assembled into the records that are delivered: successes and errors."""
    p = table(spark, folder, "predictions_all")
    got = p.select(F.col("rec_id").alias("id"), F.col("prediction").cast(records.RECORD).alias("record"), "error", "error_type", "error_detail", F.col("confidence_score").alias("confidence"), "strategy_used", "pass_count", "was_rerun", F.lit("[]").alias("raw_output"))
    docs = p.select(F.col("rec_id").alias("id"), F.coalesce("file_name", F.lit("")).alias("file_name"), "ocr_path", "ocr_text")
    d = delivery.delivered(got, docs, config.Profile(prompt_id="v2", save_strategy_meta=True, strategy="chunked"), "abc")
    return d.select(F.col("id").alias("rec_id"), "file_name", "model", F.col("prediction.identifier").alias("identifier"), F.col("prediction.title").alias("title"), "error", "error_type", "strategy_used", "confidence_score", "prompt_id", "prompt_hash", "pass_count", "was_rerun", F.length("ocr_text").alias("n"))


def ocr_only_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the scans that were recognised well, with their delivered texts."""
    texts = table(spark, folder, "predictions_all").filter("ocr_text is not null and file_name is not null").select("file_name", F.col("ocr_path").alias("path"), "ocr_text")
    d = delivery.ocr_only(table(spark, folder, "ocr_report").select("file_name", "status"), texts)
    return d.select("file_name", "ocr_path", "status", F.md5("ocr_text").alias("digest"))


def raw_file_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The raw answers as the texts of their files."""
    return table(spark, folder, "raw_outputs").select("raw_id", F.md5(delivery.raw_text("payload")).alias("digest"))


def phrase_presence(spark: SparkSession, folder: str) -> DataFrame:
    """How much of the title stands in the text."""
    d = _delivered(spark, folder, "ocr_text").filter("ocr_text is not null")
    title = tx.search_normal("prediction.title")
    scored = d.select("rec_id", tx.phrase_score(tx.search_normal("ocr_text"), title).alias("score"), F.size(tx.search_tokens(title)).alias("n_tokens"))
    return scored.select("rec_id", F.round("score", 6).alias("score"), tx.phrase_present("score", "n_tokens").alias("present"))


_MERGES = [_merge(p) for p in (*scoring.POLICIES, None)]
QUERIES = {
    f.__name__: f
    for f in (
        company_detector, entity_normalize, entity_from_string, entity_merge, company_move, entity_quality, date_parse, date_order_repair, date_duplicate_repair, date_coherence,
        date_presence, missing_critical, confidence_score, *_MERGES, field_variance, json_shred, page_tree_text, classic_ocr_text, line_object_texts, delivered_records, ocr_only_records, raw_file_texts, extract_json_object, identity_keys, guardrail, phrase_presence,
    )
}

_E = sql.ENTITIES
_RAW = {d: f"prediction.pub_date_{d}" for d in DAYS}
_ISO = {d: sql.iso(x) for d, x in _RAW.items()}
_PARSED = f"parsed AS (SELECT rec_id, {', '.join(f'{x} AS {d}' for d, x in _ISO.items())} FROM predictions_all WHERE prediction IS NOT NULL)"
_ORDERED = """
    o1 AS (SELECT * REPLACE (CASE WHEN coalesce(application <= publication, true) THEN application END AS application) FROM {src}),
    o2 AS (SELECT * REPLACE (CASE WHEN coalesce("foreign" <= application, true) THEN "foreign" END AS "foreign") FROM o1),
    ordered AS (SELECT * REPLACE (CASE WHEN application IS NOT NULL OR coalesce("foreign" <= publication, true) THEN "foreign" END AS "foreign") FROM o2)"""


def _q(d: str) -> str:
    return f'"{d}"'


_PARSED = _PARSED.replace(" AS foreign", ' AS "foreign"')
_MISSING = {f: f"NOT {sql.present('prediction.' + f)}" for f in ("title", "classification", "industrial_field", "pub_date_application", "pub_date_publication", "pub_date_foreign")} | {
    f: f"coalesce(len(prediction.{f}), 0) = 0" for f in ("inventors", "assignees")
}
_COHERENCE = """CASE WHEN (application IS NOT NULL AND publication IS NOT NULL)::INT + ("foreign" IS NOT NULL AND application IS NOT NULL)::INT = 0 THEN 0.6::DOUBLE
    ELSE (coalesce((application <= publication)::INT, 0) + coalesce(("foreign" <= application)::INT, 0))::DOUBLE
         / ((application IS NOT NULL AND publication IS NOT NULL)::INT + ("foreign" IS NOT NULL AND application IS NOT NULL)::INT) END"""
_QUALITY = "quality AS (SELECT rec_id, kind, least(1.0::DOUBLE, sum(0.7::DOUBLE + CASE WHEN address IS NOT NULL THEN 0.3::DOUBLE ELSE 0 END) / count(*)) AS q FROM entities GROUP BY 1, 2)"


def _picked(field: str, policy: str | None) -> str:
    """SQL of the value chosen from the ordered list of a field's candidates."""
    full = f"list_filter({field}, lambda v: v IS NOT NULL AND {sql.strip('v')} <> '')"
    if policy == "prefer_first":
        return f"{field}[1]"
    if policy == "prefer_last":
        return f"{field}[-1]"
    if policy == "prefer_non_null":
        return f"{full}[1]"
    if policy is None:
        return f"{sql.strip(full + '[1]')}"
    keys = f"list_transform({full}, lambda v: {sql.lowered('v')})"
    counts = f"list_transform({keys}, lambda k: len(list_filter({keys}, lambda z: z = k)))"
    return f"{full}[list_position({counts}, list_max({counts}))]"


#: The distinct entities of each file over all its answers, in order of answer and place.
_MERGED_ENTITIES = f"""
    raw AS (SELECT file_name, rec_id, 'inventors' AS kind, unnest(prediction.inventors) AS e, generate_subscripts(prediction.inventors, 1) AS pos FROM predictions_all WHERE prediction IS NOT NULL
            UNION ALL SELECT file_name, rec_id, 'assignees', unnest(prediction.assignees), generate_subscripts(prediction.assignees, 1) FROM predictions_all WHERE prediction IS NOT NULL),
    clean AS (SELECT file_name, kind, rec_id, pos, {sql.strip('e.name')} AS name, nullif({sql.strip('e.address')}, '') AS address FROM raw WHERE {sql.present('e.name')}),
    firsts AS (SELECT *, row_number() OVER (PARTITION BY file_name, kind, {sql.lowered('name')}, coalesce({sql.lowered('address')}, '') ORDER BY rec_id, pos) AS rn FROM clean)"""
#: The same with companies moved, as one text a file: names and addresses.
_ONE = "name || ' (' || coalesce(address, '') || ')'"
_MERGED_LISTS = f"""
    moved AS (SELECT *, kind = 'inventors' AND {sql.company('name')} AS move FROM firsts WHERE rn = 1),
    people AS (SELECT file_name, string_agg({_ONE}, '; ' ORDER BY rec_id, pos) FILTER (WHERE kind = 'inventors' AND NOT move) AS inv,
                      string_agg({_ONE}, '; ' ORDER BY move, rec_id, pos) FILTER (WHERE kind = 'assignees' OR move) AS ass FROM moved GROUP BY 1)"""


def _merge_sql(policy: str | None) -> str:
    fields = ("title", "classification", "industrial_field", *[f"pub_date_{d}" for d in DAYS])
    lists = ", ".join(f"list(prediction.{f} ORDER BY rec_id) AS {f}" for f in fields)
    if policy is None:
        longest = "list_transform(list_filter(title, lambda v: v IS NOT NULL AND " + sql.strip("v") + " <> ''), lambda v: " + sql.strip("v") + ")"
        lengths = f"list_transform({longest}, lambda v: length(v))"
        title = f"{longest}[list_position({lengths}, list_max({lengths}))]"
        day = {d: f"list_filter(list_transform(pub_date_{d}, lambda v: {sql.iso('v')}), lambda v: v IS NOT NULL)" for d in DAYS}
        chosen = f"""
            p AS (SELECT *, {title} AS t, {_picked('classification', None)} AS c, {_picked('industrial_field', None)} AS i, list_min({day['publication']}) AS publication,
                         {day['application']} AS as_, {day['foreign']} AS fs FROM g),
            p2 AS (SELECT *, coalesce(list_min(list_filter(as_, lambda v: v <= publication)), list_min(as_)) AS application FROM p),
            src AS (SELECT *, coalesce(list_min(list_filter(fs, lambda v: v <= application)), list_min(fs)) AS "foreign" FROM p2)"""
    else:
        days = ", ".join(f"{sql.iso('(' + _picked('pub_date_' + d, policy) + ')')} AS {_q(d)}" for d in DAYS)
        chosen = f"src AS (SELECT *, {_picked('title', policy)} AS t, {_picked('classification', policy)} AS c, {_picked('industrial_field', policy)} AS i, {days} FROM g)"
    one = ", ".join(
        f"CASE WHEN n = 1 THEN {f}[1] ELSE {v} END AS {f}"
        for f, v in zip(fields, ("t", "c", "i", *[f"{_q(d)}::VARCHAR" for d in DAYS]))
    )
    # dates are put in order under a policy only; then those that were copied go, as after every validation
    order = f"{chosen}, {_ORDERED.format(src='src')}" if policy else f"{chosen}, ordered AS (SELECT * FROM src)"
    copied = """checked AS (SELECT * REPLACE (CASE WHEN NOT coalesce(application = publication, false) THEN application END AS application,
                                              CASE WHEN NOT coalesce(application = publication AND "foreign" = publication, false) THEN "foreign" END AS "foreign") FROM ordered)"""
    alone = ", ".join(
        f"CASE WHEN n = 1 THEN list_aggregate(list_transform({k}[1], lambda x: coalesce(x.name, '') || ' (' || coalesce(x.address, '') || ')'), 'string_agg', '; ') ELSE {v} END AS {k}"
        for k, v in (("inventors", "inv"), ("assignees", "ass"))
    )
    return f"""
        WITH g AS (SELECT file_name, count(*) AS n, {lists}, list(prediction.inventors ORDER BY rec_id) AS inventors, list(prediction.assignees ORDER BY rec_id) AS assignees
                   FROM predictions_all WHERE prediction IS NOT NULL GROUP BY 1),
        {order}, {copied}, {_MERGED_ENTITIES}, {_MERGED_LISTS}
        SELECT file_name, {one}, {alone} FROM checked LEFT JOIN people USING (file_name)"""


_MONTHS = "[" + ", ".join("[" + ", ".join(f"'{n}'" for n in names) + "]" for names in dates.MONTHS) + "]"
_VOTED = ("title", "inventors", "assignees", "pub_date_application", "pub_date_publication", "pub_date_foreign", "classification", "industrial_field")


def _vote_key(field: str) -> str:
    """The form in which values are compared; null where the value is missing."""
    if field in ("inventors", "assignees"):
        one = lambda k: f"coalesce('=' || x.{k}, '')"
        return f"CASE WHEN len(prediction.{field}) > 0 THEN list_aggregate(list_transform(prediction.{field}, lambda x: coalesce({one('name')} || chr(1) || {one('address')}, '-')), 'string_agg', chr(2)) END"
    return f"nullif({sql.lowered('prediction.' + field)}, '')"


_VARIANCE = ", ".join(
    f"round(CASE WHEN count({f}) > 1 THEN (count(DISTINCT {f}) - 1)::DOUBLE / (count({f}) - 1) ELSE 0 END, 6) AS {f}" for f in _VOTED
)
_VARIANCE_SQL = f"""
    WITH k AS (SELECT file_name, {', '.join(f'{_vote_key(f)} AS {f}' for f in _VOTED)} FROM predictions_all WHERE prediction IS NOT NULL),
    v AS (SELECT file_name, {_VARIANCE} FROM k GROUP BY 1)
    SELECT *, round(({' + '.join(_VOTED)}) / {len(_VOTED)}, 6) AS mean FROM v"""

ORACLE = {
    "company_detector": f"""
        SELECT DISTINCT name, {sql.company('name')} AS company
        FROM (SELECT unnest(prediction.inventors).name AS name FROM predictions_all UNION ALL SELECT unnest(prediction.assignees).name FROM predictions_all) WHERE name IS NOT NULL""",
    "entity_normalize": f"WITH {_E} SELECT rec_id, kind, pos, name, address FROM entities",
    "entity_from_string": f"""
        WITH {_E},
        s AS (SELECT rec_id, kind, pos, {sql.strip("regexp_replace(name, '[();]', ' ', 'g')")} AS name,
                     nullif({sql.strip("regexp_replace(address, '[();]', ' ', 'g')")}, '') AS address FROM entities),
        f AS (SELECT *, row_number() OVER (PARTITION BY rec_id, kind, {sql.lowered('name')}, coalesce({sql.lowered('address')}, '') ORDER BY pos) AS rn FROM s WHERE name <> '')
        SELECT rec_id, kind, row_number() OVER (PARTITION BY rec_id, kind ORDER BY pos) AS pos, name, address FROM f WHERE rn = 1""",
    "entity_merge": f"""
        WITH {_MERGED_ENTITIES}
        SELECT file_name, kind, row_number() OVER (PARTITION BY file_name, kind ORDER BY rec_id, pos) AS pos, name, address FROM firsts WHERE rn = 1""",
    "company_move": f"""
        WITH {_E},
        m AS (SELECT rec_id, CASE WHEN kind = 'inventors' AND {sql.company('name')} THEN 'assignees' ELSE kind END AS kind, kind = 'inventors' AS moved, pos, name, address FROM entities)
        SELECT rec_id, kind, row_number() OVER (PARTITION BY rec_id, kind ORDER BY kind = 'assignees' AND moved, pos) AS pos, name, address FROM m""",
    "entity_quality": f"""
        WITH {_E}, {_QUALITY}
        SELECT p.rec_id, round(coalesce(i.q, 0), 6) AS inventors, round(coalesce(a.q, 0), 6) AS assignees FROM predictions_all p
        LEFT JOIN quality i ON i.rec_id = p.rec_id AND i.kind = 'inventors' LEFT JOIN quality a ON a.rec_id = p.rec_id AND a.kind = 'assignees' WHERE prediction IS NOT NULL""",
    "date_parse": "SELECT rec_id, "
    + ", ".join(
        rf"coalesce({_ISO[d]}, CASE WHEN regexp_full_match({_RAW[d]}, '\d{{1,2}} [A-Za-z]{{3}} \d{{4}}') THEN try_strptime({_RAW[d]}, '%d %b %Y')::DATE END) AS {_q(d)}" for d in DAYS
    )
    + " FROM predictions_all WHERE prediction IS NOT NULL",
    "date_order_repair": f"WITH {_PARSED}, {_ORDERED.format(src='parsed')} SELECT * FROM ordered",
    "date_duplicate_repair": f"""
        SELECT rec_id, CASE WHEN NOT coalesce({_RAW['application']} = {_RAW['publication']}, false) THEN {_RAW['application']} END AS application, {_RAW['publication']} AS publication,
               CASE WHEN NOT (coalesce({_RAW['application']} = {_RAW['publication']}, false) AND coalesce({_RAW['foreign']} = {_RAW['publication']}, false)) THEN {_RAW['foreign']} END AS "foreign"
        FROM predictions_all WHERE prediction IS NOT NULL""",
    "date_coherence": f"WITH {_PARSED} SELECT rec_id, {_COHERENCE} AS coherence FROM parsed",
    "missing_critical": "SELECT rec_id, ("
    + " + ".join(f"({_MISSING[f]})::BIGINT" for f in scoring.CRITICAL)
    + ") AS n, concat_ws(',', "
    + ", ".join(f"CASE WHEN {_MISSING[f]} THEN '{f}' END" for f in scoring.CRITICAL)
    + ") AS fields FROM predictions_all WHERE prediction IS NOT NULL",
    "confidence_score": f"""
        WITH {_E}, {_QUALITY}, {_PARSED},
        parts AS (SELECT p.rec_id, ({' + '.join(f'(NOT ({m}))::INT' for m in _MISSING.values())})::DOUBLE / 8 AS completeness, {_COHERENCE} AS date_coherence,
                         (coalesce(i.q, 0) + coalesce(a.q, 0)) / 2 AS entity_quality,
                         CASE WHEN coalesce({sql.strip('prediction.title')}, '') <> '' AND contains(coalesce(ocr_text, ''), {sql.strip('prediction.title')}) THEN 1.0::DOUBLE ELSE 0 END AS title_in_text
                  FROM predictions_all p JOIN parsed USING (rec_id)
                  LEFT JOIN quality i ON i.rec_id = p.rec_id AND i.kind = 'inventors' LEFT JOIN quality a ON a.rec_id = p.rec_id AND a.kind = 'assignees' WHERE prediction IS NOT NULL)
        SELECT rec_id, round(completeness, 6) AS completeness, round(date_coherence, 6) AS date_coherence, round(entity_quality, 6) AS entity_quality, title_in_text,
               round(least(1.0::DOUBLE, 0.45::DOUBLE * completeness + 0.25::DOUBLE * date_coherence + 0.2::DOUBLE * entity_quality + 0.1::DOUBLE * title_in_text), 6) AS confidence FROM parts""",
    **{("merge_" + (p or "legacy")): _merge_sql(p) for p in (*scoring.POLICIES, None)},
    "field_variance": _VARIANCE_SQL,
    "identity_keys": f"""
        SELECT DISTINCT name, {sql.identity('name')} AS key
        FROM (SELECT unnest(prediction.inventors).name AS name FROM predictions_all UNION ALL SELECT unnest(prediction.assignees).name FROM predictions_all) WHERE name IS NOT NULL""",
    "date_presence": f"""
        WITH n AS (SELECT rec_id, ocr_text, {sql.normal('ocr_text')} AS normal, {_ISO['publication']} AS day FROM predictions_all WHERE prediction IS NOT NULL AND ocr_text IS NOT NULL),
        s AS (SELECT *, strftime(day, '%d') AS dd, strftime(day, '%m') AS mm, strftime(day, '%Y') AS yy, dayofmonth(day)::VARCHAR AS d, month(day)::VARCHAR AS m FROM n)
        SELECT rec_id, CASE WHEN day IS NOT NULL THEN contains(normal, yy || ' ' || mm || ' ' || dd) OR contains(normal, dd || ' ' || mm || ' ' || yy) OR contains(normal, d || ' ' || m || ' ' || yy)
            OR len(list_filter(({_MONTHS})[month(day)], lambda x: contains(normal, d || ' ' || x || ' ' || yy) OR contains(normal, dd || ' ' || x || ' ' || yy))) > 0
            OR regexp_matches(ocr_text, '\\b(?:' || dd || '[./-]' || mm || '[./-]' || yy || '|' || d || '[./-]' || m || '[./-]' || yy || '|' || yy || '[./-]' || mm || '[./-]' || dd || ')\\b') END AS present FROM s""",
    "page_tree_text": """
        WITH l AS (SELECT l_orderkey, l_returnflag, l_linenumber, trim(('p' || l_partkey) || '   ' || trim(l_linestatus)) AS t FROM lineitem),
        b AS (SELECT l_orderkey, l_returnflag, string_agg(t, chr(10) ORDER BY l_linenumber, t) AS t FROM l GROUP BY 1, 2)
        SELECT l_orderkey, string_agg(t, chr(10) || chr(10) ORDER BY l_returnflag) AS text FROM b GROUP BY 1""",
    "classic_ocr_text": """
        SELECT l_orderkey, coalesce(string_agg(('p' || l_partkey), chr(10) ORDER BY l_linenumber, 'p' || l_partkey) FILTER (WHERE l_linenumber <> 3), '') AS detected,
               CASE WHEN count(*) = 1 THEN '' ELSE coalesce(string_agg(trim(l_linestatus), chr(10) ORDER BY l_linenumber, l_linestatus) FILTER (WHERE l_linenumber <> 2), '') END AS plain FROM lineitem GROUP BY 1""",
    "line_object_texts": """
        WITH l AS (SELECT l_orderkey, string_agg(('p' || l_partkey), '|' ORDER BY l_linenumber, 'p' || l_partkey) FILTER (WHERE l_linenumber <> 2) AS t,
                          string_agg(('p' || l_partkey) || '|' || ('p' || l_partkey), '|' ORDER BY l_linenumber, 'p' || l_partkey) FILTER (WHERE l_linenumber <> 2) AS h FROM lineitem GROUP BY 1)
        SELECT l_orderkey, coalesce(t, '') AS lines, coalesce(h, '') AS harvest FROM l""",
    "delivered_records": r"""
        SELECT rec_id, coalesce(file_name, '') AS file_name, CASE WHEN prediction IS NOT NULL THEN 'mistralai/Mistral-Small-3.1-24B-Instruct-2503' END AS model,
               CASE WHEN prediction IS NOT NULL THEN split_part(regexp_replace(regexp_replace(coalesce(file_name, ''), '^.*/', ''), '\.[^.]*$', ''), '_', 1) END AS identifier, prediction.title AS title,
               CASE WHEN prediction IS NULL THEN coalesce(error, 'exception: RuntimeError') END AS error, CASE WHEN prediction IS NULL THEN error_type END AS error_type,
               coalesce(strategy_used, 'chunked') AS strategy_used, CASE WHEN prediction IS NOT NULL THEN coalesce(confidence_score, 0) ELSE 0 END AS confidence_score, 'v2' AS prompt_id, 'abc' AS prompt_hash,
               CASE WHEN prediction IS NOT NULL THEN pass_count END AS pass_count, CASE WHEN prediction IS NOT NULL THEN was_rerun END AS was_rerun,
               CASE WHEN prediction IS NOT NULL THEN length(ocr_text) END AS n FROM predictions_all""",
    "ocr_only_records": r"""
        SELECT file_name, ocr_path, 'ocr_only' AS status, md5(ocr_text) AS digest FROM predictions_all WHERE ocr_text IS NOT NULL AND file_name IS NOT NULL
        AND regexp_replace(regexp_replace(file_name, '^.*/', ''), '\.[^.]*$', '') IN (SELECT regexp_replace(regexp_replace(file_name, '^.*/', ''), '\.[^.]*$', '') FROM ocr_report WHERE status = 'ok' AND file_name IS NOT NULL)""",
    "json_shred": """
        SELECT raw_id, json_extract_string(p, '$.file') AS file, json_extract_string(p, '$.answer.passes[0].chunks[0].prediction.title') AS title,
               json_extract_string(p, '$.answer.passes[0].chunks[0].usage.prompt_tokens')::BIGINT AS prompt_tokens, p IS NOT NULL AS valid
        FROM (SELECT raw_id, CASE WHEN json_valid(payload) THEN payload END AS p FROM raw_outputs)""",
}
