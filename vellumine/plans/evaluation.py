"""Queries that score, join, summarise, rank and sample the collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumine.functions import boxes, dates, entities, text as tx
from vellumine.operators import evaluation as ev
from vellumine.operators import strategies
from vellumine.operators.chunking import Chunking
from vellumine.plans import sql
from vellumine.session import table


def _id(path: str):
    return tx.id_without_full(path).alias("norm_id")


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").select(_id("file_name"), "rec_id", "confidence_score", "ingested_at", "error")
    return ev.last_per_key(p, "norm_id", F.col("ingested_at"), F.col("rec_id"))


def _catalog(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "patent_catalog")
    return ev.last_per_key(c, "norm_id", F.col("updated_at"), F.coalesce("grant_year", F.lit(-1)), F.coalesce("n_pages", F.lit(-1)), F.coalesce("shelf", F.lit("")), F.coalesce("office", F.lit("")))


def _report(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "ocr_report").select(_id("file_name"), "status", "scanned_at", "ingested_at", "t_total_s", "n_blocks")
    return ev.last_per_key(r, "norm_id", F.col("scanned_at"), F.col("ingested_at"), F.coalesce("t_total_s", F.lit(-1.0)), F.col("status"))


def gold_pred_inner(spark: SparkSession, folder: str) -> DataFrame:
    return ev.matched(_catalog(spark, folder), _latest(spark, folder), "norm_id").select("norm_id", "grant_year", "rec_id", "confidence_score")


def gold_pred_left(spark: SparkSession, folder: str) -> DataFrame:
    joined = ev.with_missing(_catalog(spark, folder), _latest(spark, folder), "norm_id", "error")
    return joined.select("norm_id", "grant_year", "rec_id", "pred_missing", "error")


def report_left(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").select("rec_id", _id("file_name"))
    return p.join(_report(spark, folder), "norm_id", "left").select("rec_id", "norm_id", F.coalesce("status", F.lit("missing")).alias("status"), "n_blocks")


def catalog_anti(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sample_manifest").select("norm_id").join(_latest(spark, folder), "norm_id", "left_anti").distinct()


def wanted_semi(spark: SparkSession, folder: str) -> DataFrame:
    return _latest(spark, folder).select("norm_id", "rec_id").join(_catalog(spark, folder).filter("office is not null"), "norm_id", "left_semi")


def id_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    office = F.substring("norm_id", 1, 2).alias("office")
    expected = table(spark, folder, "patent_catalog").filter("norm_id is not null").select(office, "norm_id")
    found = table(spark, folder, "predictions_all").select(_id("file_name")).filter("norm_id is not null").select(office, "norm_id")
    return ev.reconciled(expected, found, "office", "norm_id")


def resume_skip(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "ocr_report").select(_id("file_name")).distinct()
    todo, skipped = ev.resumed(docs, table(spark, folder, "predictions_all").select(_id("file_name")), "norm_id")
    return todo.withColumn("status", F.lit("todo")).unionByName(skipped)


def report_status(spark: SparkSession, folder: str) -> DataFrame:
    r = _report(spark, folder)
    mid = ev.medians(r, ["status"], ["t_total_s"]).select("status", F.round("t_total_s_median", 4).alias("median_s"))
    return r.groupBy("status").agg(F.count("*").alias("n"), F.round(F.avg("t_total_s"), 4).alias("mean_s"), F.sum("n_blocks").cast("bigint").alias("blocks")).join(mid, "status", "left")


def confidence_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all")
    ranks = ev.nearest_rank(p, "strategy_used", "confidence_score", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    counts = p.groupBy("strategy_used").agg(F.count("*").alias("n"), F.round(F.avg("confidence_score"), 6).alias("mean"), F.round(100.0 * F.avg(F.coalesce(F.col("was_rerun").cast("int"), F.lit(0))), 4).alias("rerun_pct"))
    return counts.join(ranks, "strategy_used")


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").withColumn("model", F.coalesce("model", F.lit("")))
    valid = F.col("prediction").isNotNull()
    seconds = F.sum(F.col("timing")["t_total_file_s"])
    mid = ev.medians(p.filter(valid), ["model"], ["confidence_score"]).withColumn("confidence_score_median", F.round("confidence_score_median", 6))
    told = p.groupBy("model").agg(
        F.count("*").alias("docs"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_if(valid).alias("valid"), F.round(F.count("*") / seconds, 6).alias("docs_per_s"), *ev.summary(p, ["confidence_score"], valid)
    )
    return told.join(mid, "model", "left")


def run_compare_delta(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").filter("was_rerun is not null")
    side = p.groupBy("strategy_used").pivot("was_rerun", [False, True]).agg(F.avg("confidence_score"))
    a, b = F.col("false"), F.col("true")
    return side.select("strategy_used", F.round(a, 6).alias("once"), F.round(b, 6).alias("again"), F.round(b - a, 6).alias("delta"))


#: The fields whose presence is looked for, with their labels.
LABELS = {
    "title": "Title", "inventor_name": "Inventor name", "inventor_address": "Inventor address", "assignee_name": "Assignee name", "assignee_address": "Assignee address",
    "pub_date_application": "Application date", "pub_date_publication": "Publication date", "pub_date_foreign": "Priority date", "classification": "Classification", "industrial_field": "Industrial field",
}
#: Those that SQL can look for as well: phrases are matched by a ratio that it lacks.
EXACT = ("pub_date_application", "pub_date_publication", "pub_date_foreign", "classification")


def field_items(record: str = "prediction") -> dict:
    """The items of each field of a record, an array each; blank ones don't count."""
    r = F.col(record)
    both = {f"{one}_{what}": r[many][what] for one, many in (("inventor", "inventors"), ("assignee", "assignees")) for what in ("name", "address")}
    plain = {f: F.array(r[f]) for f in LABELS if f not in both}
    return {f: F.filter(F.coalesce((both | plain)[f], F.array().cast("array<string>")), lambda x: ~tx.blank(x)) for f in LABELS}


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over the files, united: the first and the last answer to each. run, norm_id, prediction, ocr_text."""
    p = table(spark, folder, "predictions_all").filter("prediction is not null and ocr_text is not null and file_name is not null").select(_id("file_name"), "rec_id", "prediction", "ocr_text")
    kept = [c for c in p.columns if c != "norm_id"]
    first = p.groupBy("norm_id").agg(F.min_by(F.struct(*kept), "rec_id").alias("r"))
    last = p.groupBy("norm_id").agg(F.max_by(F.struct(*kept), "rec_id").alias("r"))
    return first.withColumn("run", F.lit("first")).unionByName(last.withColumn("run", F.lit("last"))).select("run", "norm_id", "r.prediction", "r.ocr_text")


def _judged(spark: SparkSession, folder: str, fields: tuple[str, ...]) -> DataFrame:
    """One row an item, and one a field without any: run, norm_id, field, present, score."""
    own = field_items()
    each = F.array(*[F.struct(F.lit(f).alias("field"), own[f].alias("items")) for f in fields])
    r = runs(spark, folder).withColumn("normal", tx.search_normal("ocr_text"))
    items = r.select("run", "norm_id", "ocr_text", "normal", F.explode(each).alias("f")).select("run", "norm_id", "ocr_text", "normal", "f.field", F.explode_outer("f.items").alias("item"))
    dated, classed = F.col("field").startswith("pub_date_"), F.col("field") == "classification"
    value = tx.search_normal("item")
    exact = F.when(dated, dates.date_present("normal", "ocr_text", dates.iso_date("item"))).when(classed, tx.classification_present("normal", value))
    if set(fields) <= set(EXACT):
        return items.select("run", "norm_id", "field", exact.alias("present"), exact.cast("double").alias("score"))
    marked = items.withColumns({"exact": exact, "score": F.when(dated | classed, exact.cast("double")).otherwise(tx.phrase_score("normal", F.when(~(dated | classed), value)))})
    fits = tx.phrase_present("score", F.size(tx.search_tokens(value)))
    return marked.select("run", "norm_id", "field", F.when(dated | classed, F.col("exact")).otherwise(fits).alias("present"), "score")


def presence_all_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Presence of the items of all ten fields, by run, document and field; phrases nearly or exactly."""
    return ev.presence_by_field(_judged(spark, folder, tuple(LABELS)), "run", "norm_id", "field", "present", "score")


def presence_all_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The same by run and field, with labels."""
    return ev.presence_summary(presence_all_fields(spark, folder), "run", "field", LABELS)


def field_presence(spark: SparkSession, folder: str) -> DataFrame:
    """Presence of dates and classifications by run, document and field."""
    return ev.presence_by_field(_judged(spark, folder, EXACT), "run", "norm_id", "field", "present", "score")


def field_presence_rate(spark: SparkSession, folder: str) -> DataFrame:
    return ev.presence_summary(field_presence(spark, folder), "run", "field", LABELS)


def _by_document(spark: SparkSession, folder: str) -> DataFrame:
    return ev.presence_by_document(field_presence(spark, folder), "run", "norm_id")


def doc_presence_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _by_document(spark, folder).groupBy("run").agg(F.round(F.avg("presence"), 6).alias("mean_presence"), F.round(F.avg("score"), 6).alias("mean_score"), F.count("*").alias("docs"))


def presence_ecdf(spark: SparkSession, folder: str) -> DataFrame:
    per_doc = _by_document(spark, folder).filter("presence is not null").select("run", "norm_id", "presence")
    return ev.ecdf(per_doc, "run", "presence", "norm_id")


def _titles(spark: SparkSession, folder: str) -> DataFrame:
    """The first title of a file against each of its titles, in ASCII."""
    plain = F.regexp_replace(F.lower("prediction.title"), "[^a-z0-9 ]", "")
    p = table(spark, folder, "predictions_all").filter("prediction.title is not null").select("rec_id", "file_name", plain.alias("pred"))
    first = p.groupBy("file_name").agg(F.min_by("pred", "rec_id").alias("gold"))
    return p.join(first, "file_name").select("rec_id", "gold", "pred")


def title_error_rates(spark: SparkSession, folder: str) -> DataFrame:
    return ev.error_rates(_titles(spark, folder), "gold", "pred").select("rec_id", "char_dist", "word_dist", "cer", "wer", "len_ratio", "similarity")


def cer_top20(spark: SparkSession, folder: str) -> DataFrame:
    return ev.worst(title_error_rates(spark, folder), 20, F.desc_nulls_last("cer"), F.desc_nulls_last("wer"), F.asc("rec_id")).select("rec_id", "cer", "wer")


def cer_summary(spark: SparkSession, folder: str) -> DataFrame:
    s = title_error_rates(spark, folder)
    one = s.agg(F.count("*").alias("n"), *ev.summary(s, ["cer", "wer"]), *ev.summary(s, ["cer"], F.col("char_dist") > 0, "changed_"))
    mid = ev.medians(s.withColumn("changed_cer", F.when(F.col("char_dist") > 0, F.col("cer"))).withColumn("k", F.lit(1)), ["k"], ["cer", "wer", "changed_cer"])
    told = mid.select("k", *[F.round(f"{v}_median", 6).alias(f"{v}_median") for v in ("cer", "wer", "changed_cer")])
    return one.withColumn("k", F.lit(1)).join(told, "k", "left").drop("k")


def request_timing(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "request_metrics").select("request_id", *[c.alias(n) for n, c in ev.request_timing().items()])


def batch_timing_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: times of its requests summed, of the scheduler the most of each ten minutes."""
    m = table(spark, folder, "request_metrics").withColumns({n: c for n, c in ev.request_timing().items()})
    sums = ["t_request", "t_ttft", "t_decode", "t_queue", "t_model_forward", "t_model_execute"]
    rolled = ev.batch_rollup(m, "file_name", F.floor(F.col("arrival_time") / 600), sums, "t_scheduler", ["t_request"])
    return rolled.select("file_name", *sums, "t_shared", "t_total")


def timing_map_sum(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "predictions_all").select("strategy_used", F.explode("timing").alias("k", "v"))
    return p.groupBy("strategy_used", "k").agg(F.count("*").alias("n"), F.round(F.sum("v"), 3).alias("total"))


def running_avg_progress(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "ocr_report").filter("t_total_s is not null")
    return ev.running_mean(r, "status", "t_total_s", 10, "scanned_at", "file_name", "ingested_at", "t_total_s")


def catalog_ids(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "patent_catalog").filter(F.col("norm_id").rlike(r"^CH-\d+-")).select("norm_id").distinct()
    return c.select("norm_id", tx.number_in_id("norm_id").cast("bigint").alias("number"))


def even_sample(spark: SparkSession, folder: str) -> DataFrame:
    return ev.evenly_spaced(catalog_ids(spark, folder), "norm_id", tx.number_in_id("norm_id"), "norm_id", count=40)


def combined_manifest(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "sample_manifest").select(F.lit(0).alias("src"), F.col("sample_rank").alias("pos"), "norm_id")
    b = even_sample(spark, folder).select(F.lit(1).alias("src"), F.col("sample_rank").alias("pos"), "norm_id")
    return ev.numbered(a.unionByName(b), "src", "pos", name="rank").select(F.col("rank").cast("bigint").alias("rank"), "norm_id", "src")


def input_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Position of each file in the order of the names, from 0."""
    names = table(spark, folder, "ocr_report").filter("file_name is not null").select("file_name").distinct()
    return ev.numbered(names, "file_name", start=0, name="position")


def first_files(spark: SparkSession, folder: str) -> DataFrame:
    """The first fifty files by name: the limit is the operator."""
    return input_positions(spark, folder).filter("position < 50").select("file_name")


def first_seen_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers of two catalogs, once each, by where they were seen first."""
    a = table(spark, folder, "sample_manifest").select("norm_id", F.lit(0).alias("src"), F.col("sample_rank").cast("string").alias("at"))
    b = table(spark, folder, "patent_catalog").select("norm_id", F.lit(1).alias("src"), F.col("norm_id").alias("at"))
    return ev.first_seen(a.unionByName(b), "norm_id", F.col("src"), F.col("at")).select("norm_id", F.col("first_0").alias("src"), F.col("first_1").alias("place"))


def manifest_files(spark: SparkSession, folder: str) -> DataFrame:
    """The file of each sample: its page image if named, else the scan of the catalog, else none."""
    wanted = table(spark, folder, "sample_manifest").select("norm_id").distinct()
    images = table(spark, folder, "sample_manifest").filter("source is not null").select("norm_id", F.col("png_name").alias("path")).filter("path is not null")
    scans = table(spark, folder, "ocr_report").select(_id("file_name"), F.col("file_name").alias("path")).filter("path is not null")
    return ev.chosen_file(wanted, "norm_id", images, scans)


def report_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Scans of the report with whether their text was delivered."""
    r = table(spark, folder, "ocr_report").select("file_name", "status", "out_txt")
    texts = table(spark, folder, "predictions_all").filter("ocr_text is not null").select(F.col("file_name").alias("path"))
    return ev.with_texts(r, texts, "file_name").groupBy("status", "has_text").agg(F.count("*").alias("n"), F.count("out_txt").alias("named"))


def wrapper_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """First against last title of each file: equal as they stand, in normal form, and lengths."""
    p = table(spark, folder, "predictions_all").filter("prediction.title is not null and file_name is not null").select("file_name", "rec_id", F.col("prediction.title").alias("title"))
    pairs = p.groupBy("file_name").agg(F.min_by("title", "rec_id").alias("a"), F.max_by("title", "rec_id").alias("b"))
    return ev.compared(pairs, "a", "b").select("file_name", "exact_equal", "normal_equal", "ratio", "length_a", "length_b")


def wrapper_summary(spark: SparkSession, folder: str) -> DataFrame:
    """How many of these pairs are equal."""
    return ev.comparison_summary(wrapper_comparison(spark, folder))


def score_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of the catalog with a prediction, without, and the share that has one."""
    g = gold_pred_left(spark, folder)
    has = ~F.col("pred_missing")
    return g.agg(F.count("*").alias("wanted"), F.count_if(has).alias("found"), F.count_if(~has).alias("missing"), F.count_if(has & (F.col("error") == "")).alias("ok"), F.round(tx.safe_ratio(F.count_if(has), F.count("*")), 6).alias("coverage"))


def printed_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """Confidence with two places, NA where there is none."""
    return table(spark, folder, "predictions_all").select("rec_id", tx.printed("confidence_score", 2).alias("confidence"))


def skew_medians(spark: SparkSession, folder: str) -> DataFrame:
    """Median skew of the scans of a status: of angles within five degrees, 0 for fewer than five."""
    r = table(spark, folder, "ocr_report").filter("deskew_angle is not null").groupBy("status").agg(F.collect_list("deskew_angle").alias("angles"))
    return r.select("status", F.round(boxes.median_skew("angles", 5.0), 6).alias("angle"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes of invented pages, one an order."""
    li = table(spark, folder, "lineitem")
    box = F.struct(
        (40 * (F.col("l_partkey") % 20)).cast("int").alias("x1"), (30 * F.col("l_linenumber")).cast("int").alias("y1"),
        (40 * (F.col("l_partkey") % 20) + 20 * F.col("l_quantity").cast("int")).cast("int").alias("x2"), (30 * F.col("l_linenumber") + 25 + F.col("l_suppkey") % 10).cast("int").alias("y2"),
    )
    return li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(box)).alias("boxes"))


def boxes_nested(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("l_orderkey", F.size(boxes.without_nested("boxes")).cast("bigint").alias("n"))


def boxes_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("l_orderkey", boxes.needs_split("boxes", F.lit(1000), F.lit(40)).alias("fallback"))


def boxes_order(spark: SparkSession, folder: str) -> DataFrame:
    """Reading order of the boxes of a page, as text."""
    return _pages(spark, folder).select("l_orderkey", F.to_json(boxes.reading_order("boxes")).alias("boxes"))


def boxes_band_merge(spark: SparkSession, folder: str) -> DataFrame:
    """One box a band."""
    return _pages(spark, folder).select("l_orderkey", F.to_json(boxes.band_boxes("boxes")).alias("boxes"))


def boxes_inner(spark: SparkSession, folder: str) -> DataFrame:
    """Width, height and inner crop of each page's first box."""
    b = F.element_at("boxes", 1)
    d = _pages(spark, folder).select("l_orderkey", boxes.size(b).alias("s"), boxes.inner(b, 0.15).alias("c"))
    return d.select("l_orderkey", "s.width", "s.height", F.col("c.x1").alias("x1"), F.col("c.y1").alias("y1"), F.col("c.x2").alias("x2"), F.col("c.y2").alias("y2"))


def boxes_split(spark: SparkSession, folder: str) -> DataFrame:
    """A page of one large box split into title and columns, by its line numbers as ink."""
    li = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("int").alias("ink")))).alias("l"))
    box = F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), (F.size("l") * 10).alias("x2"), F.lit(500).alias("y2"))
    ink = F.flatten(F.transform("l", lambda x: F.array_repeat(x["ink"], 10)))
    return li.select("l_orderkey", F.to_json(boxes.title_and_columns(box, ink)).alias("boxes"))


def boxes_fused(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes merged to a fixed point."""
    return _pages(spark, folder).select("l_orderkey", F.size(boxes.fused("boxes")).alias("n"))


def _strategy(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        docs = table(spark, folder, "documents")
        got = strategies.extract(docs, "doc_id", "text", name)
        return got.select(
            "id", F.col("record.title").alias("title"), F.col("record.pub_date_application").alias("application"), F.col("record.pub_date_publication").alias("publication"), "error",
            "confidence", "strategy_used", "was_rerun", F.col("pass_count").cast("bigint").alias("pass_count"), "merge_policy_used", F.col("self_consistency_variance").alias("variance"),
        )

    query.__name__ = "strategy_" + name
    query.__doc__ = f"The {name} strategy over all documents with the stand-in backend."
    return query


QUERIES = {
    f.__name__: f
    for f in (
        gold_pred_inner, gold_pred_left, report_left, catalog_anti, wanted_semi, id_reconciliation, resume_skip, report_status, confidence_percentiles, run_summary, run_compare_delta,
        field_presence, field_presence_rate, doc_presence_mean, presence_ecdf, title_error_rates, cer_top20, cer_summary, request_timing, batch_timing_rollup, timing_map_sum,
        presence_all_fields, presence_all_summary, input_positions, first_files, first_seen_ids, manifest_files, report_texts, wrapper_comparison, wrapper_summary, score_coverage,
        printed_confidence, skew_medians, boxes_inner, boxes_split, running_avg_progress, catalog_ids, even_sample, combined_manifest, boxes_nested, boxes_fallback, boxes_order, boxes_band_merge, boxes_fused,
        *[_strategy(s) for s in strategies.STRATEGIES],
    )
}


def _stem(x: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace({x}, '^.*/', ''), '\.[^.]*$', ''), '_full$', '')"


_PRED = f"pred AS (SELECT * FROM (SELECT {_stem('file_name')} AS norm_id, rec_id, confidence_score, error, row_number() OVER (PARTITION BY {_stem('file_name')} ORDER BY ingested_at DESC NULLS LAST, rec_id DESC) AS rn FROM predictions_all) WHERE rn = 1)"
_CAT = """cat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY norm_id ORDER BY updated_at DESC NULLS LAST, coalesce(grant_year, -1) DESC, coalesce(n_pages, -1) DESC, coalesce(shelf, '') DESC, coalesce(office, '') DESC) AS rn
        FROM patent_catalog WHERE norm_id IS NOT NULL) WHERE rn = 1)"""
_REP = f"""rep AS (SELECT * FROM (SELECT {_stem('file_name')} AS norm_id, status, t_total_s, n_blocks, row_number() OVER (PARTITION BY {_stem('file_name')}
        ORDER BY scanned_at DESC NULLS LAST, ingested_at DESC NULLS LAST, coalesce(t_total_s, -1) DESC, status DESC) AS rn FROM ocr_report) WHERE rn = 1)"""
_RUNS = f"""runs AS (
        SELECT run, norm_id, prediction, ocr_text FROM (
            SELECT {_stem('file_name')} AS norm_id, prediction, ocr_text, unnest(['first', 'last']) AS run,
                   row_number() OVER (PARTITION BY {_stem('file_name')} ORDER BY rec_id) AS a, row_number() OVER (PARTITION BY {_stem('file_name')} ORDER BY rec_id DESC) AS z
            FROM predictions_all WHERE prediction IS NOT NULL AND ocr_text IS NOT NULL AND file_name IS NOT NULL) WHERE CASE run WHEN 'first' THEN a ELSE z END = 1)"""
_MONTHS = "[" + ", ".join("[" + ", ".join(f"'{n}'" for n in names) + "]" for names in dates.MONTHS) + "]"
_DATED = f"""n AS (SELECT run, norm_id, prediction, ocr_text, {sql.normal('ocr_text')} AS normal FROM runs),
    items AS ({' UNION ALL '.join(f"SELECT run, norm_id, '{f}' AS field, prediction.{f} AS item, ocr_text, normal FROM n" for f in EXACT)}),
    days AS (SELECT *, CASE WHEN field <> 'classification' THEN {sql.iso('item')} END AS day, {sql.normal('item')} AS plain FROM items),
    spelt AS (SELECT *, day::VARCHAR AS iso, strftime(day, '%d') AS dd, strftime(day, '%m') AS mm, strftime(day, '%Y') AS yy, dayofmonth(day)::VARCHAR AS d, month(day)::VARCHAR AS m FROM days),
    there AS (SELECT run, norm_id, field, CASE
        WHEN NOT coalesce({sql.present('item')}, false) THEN NULL
        WHEN field = 'classification' THEN CASE WHEN plain <> '' THEN contains(normal, plain) END
        WHEN day IS NOT NULL THEN contains(normal, yy || ' ' || mm || ' ' || dd) OR contains(normal, dd || ' ' || mm || ' ' || yy) OR contains(normal, d || ' ' || m || ' ' || yy)
            OR len(list_filter(({_MONTHS})[month(day)], lambda x: contains(normal, d || ' ' || x || ' ' || yy) OR contains(normal, dd || ' ' || x || ' ' || yy))) > 0
            OR regexp_matches(ocr_text, '\\b(?:' || dd || '[./-]' || mm || '[./-]' || yy || '|' || d || '[./-]' || m || '[./-]' || yy || '|' || yy || '[./-]' || mm || '[./-]' || dd || ')\\b') END AS present FROM spelt),
    fields AS (SELECT run, norm_id, field, count(present) AS n_items, count(*) FILTER (WHERE present) AS n_present,
                      CASE WHEN count(present) > 0 THEN round(count(*) FILTER (WHERE present)::DOUBLE / count(present), 6) END AS presence_rate,
                      count(*) FILTER (WHERE present)::DOUBLE AS score_sum FROM there GROUP BY 1, 2, 3),
    docs AS (SELECT run, norm_id, sum(n_present)::DOUBLE / nullif(sum(n_items), 0) AS p FROM fields GROUP BY 1, 2)"""
_TITLES = """t AS (SELECT rec_id, file_name, regexp_replace(lower(prediction.title), '[^a-z0-9 ]', '', 'g') AS pred FROM predictions_all WHERE prediction.title IS NOT NULL),
    f AS (SELECT file_name, arg_min(pred, rec_id) AS gold FROM t GROUP BY 1),
    n AS (SELECT rec_id, trim(regexp_replace(gold, ' +', ' ', 'g')) AS g, trim(regexp_replace(pred, ' +', ' ', 'g')) AS p FROM t JOIN f USING (file_name)),
    w AS (SELECT *, list_filter(string_split(g, ' '), lambda x: x <> '') AS gw, list_filter(string_split(p, ' '), lambda x: x <> '') AS pw FROM n),
    u AS (SELECT *, list_sort(list_distinct(list_concat(gw, pw))) AS ws FROM w),
    d AS (SELECT *, levenshtein(g, p)::BIGINT AS char_dist,
                 levenshtein(array_to_string(list_transform(gw, lambda x: chr((33 + list_position(ws, x))::INT)), ''), array_to_string(list_transform(pw, lambda x: chr((33 + list_position(ws, x))::INT)), ''))::BIGINT AS word_dist FROM u),
    e AS (SELECT rec_id, char_dist, word_dist, CASE WHEN length(g) > 0 THEN round(char_dist::DOUBLE / length(g), 6) END AS cer, CASE WHEN len(gw) > 0 THEN round(word_dist::DOUBLE / len(gw), 6) END AS wer,
                 CASE WHEN length(g) > 0 THEN round(length(p)::DOUBLE / length(g), 6) END AS len_ratio, round(1 - char_dist::DOUBLE / greatest(length(g), length(p), 1), 6) AS similarity FROM d)"""


def _stats(v: str, name: str, where: str = "") -> str:
    w = f" FILTER (WHERE {where})" if where else ""
    return ", ".join(f"round({f}({v}){w}::DOUBLE, 6) AS {name}_{s}" for s, f in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max")))


_SPAN = lambda a, b: f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL AND greatest({b}, 0) >= greatest({a}, 0) THEN round(greatest({b}, 0) - greatest({a}, 0), 6) END"
_OWN = lambda c: f"CASE WHEN {c} IS NOT NULL THEN round(greatest({c}, 0), 6) END"
_TIMES = f"""{_SPAN('arrival_time', 'finished_time')} AS t_request, {_SPAN('arrival_time', 'first_token_time')} AS t_ttft, {_SPAN('first_token_time', 'finished_time')} AS t_decode,
    coalesce({_OWN('time_in_queue')}, {_SPAN('arrival_time', 'first_scheduled_time')}) AS t_queue, {_OWN('scheduler_time')} AS t_scheduler, {_OWN('model_forward_time')} AS t_model_forward, {_OWN('model_execute_time')} AS t_model_execute"""
_SUMMED = ("t_request", "t_ttft", "t_decode", "t_queue", "t_model_forward", "t_model_execute")
_SAMPLE = r"""ids AS (SELECT DISTINCT norm_id, regexp_extract(norm_id, '^[A-Z]{2}-(\d+)-', 1)::BIGINT AS number FROM patent_catalog WHERE regexp_matches(norm_id, '^CH-\d+-')),
    o AS (SELECT norm_id, row_number() OVER (ORDER BY number, norm_id) - 1 AS pos, count(*) OVER () AS total FROM ids),
    s AS (SELECT k + 1 AS sample_rank, norm_id FROM (SELECT unnest(range(40)) AS k) JOIN o ON pos = least(greatest(round_even((k + 0.5) * total::DOUBLE / 40 - 0.5, 0), 0), total - 1))"""
_BOXES = """b AS (SELECT l_orderkey, 40 * (l_partkey % 20) AS x1, 30 * l_linenumber AS y1, 40 * (l_partkey % 20) + 20 * trunc(l_quantity)::BIGINT AS x2, 30 * l_linenumber + 25 + l_suppkey % 10 AS y2,
        row_number() OVER () AS id FROM lineitem),
    a AS (SELECT *, greatest(x2 - x1, 0) * greatest(y2 - y1, 0) AS area FROM b)"""

_CHUNKS = Chunking()
_PROMPTED = strategies.TEMPLATE.split("\n")[0]


def _windows(offset: int) -> str:
    """Windows of the documents from an offset on, with their number in the pass."""
    step = _CHUNKS.size - _CHUNKS.overlap
    return f"""SELECT id, {offset} AS off, k, substring(text, {offset} + k * {step} + 1, {_CHUNKS.size}) AS body, length(text) AS n
        FROM (SELECT id, text, unnest(range(CASE WHEN length(text) <= {offset} THEN 0 ELSE 1 + ceil(greatest(length(text) - {offset} - {_CHUNKS.size}, 0) / {step}.0)::BIGINT END)) AS k FROM docs)"""


def _answers(name: str, prompts: str) -> str:
    """What the stand-in model answers to prompts (id, ord, body): the first date and the last, validated."""
    return f"""{name}_d AS (SELECT id, ord, regexp_extract_all(body, '\\b(\\d{{4}}-\\d{{2}}-\\d{{2}})\\b', 1) AS days FROM ({prompts})),
        {name}_r AS (SELECT id, ord, days[1] AS a, CASE WHEN len(days) > 1 THEN days[-1] END AS p FROM {name}_d),
        {name} AS (SELECT id, ord, CASE WHEN coalesce(a = p, false) THEN NULL ELSE {sql.iso('a')} END AS application, {sql.iso('p')} AS publication FROM {name}_r)"""


def _by_policy(name: str, source: str) -> str:
    """Answers (id, ord, application, publication) merged by the first that isn't missing; one stays as it is."""
    return f"""{name}_m AS (SELECT id, count(*) AS n, arg_min(application, ord) FILTER (WHERE application IS NOT NULL) AS a, arg_min(publication, ord) FILTER (WHERE publication IS NOT NULL) AS p FROM ({source}) GROUP BY 1),
        {name} AS (SELECT id, n, CASE WHEN n > 1 AND coalesce(a >= p, false) THEN NULL ELSE a END AS application, p AS publication FROM {name}_m)"""


_TRUNCATED_DOC = f"CASE WHEN length(text) > {_CHUNKS.max_chars} THEN substring(text, 1, {_CHUNKS.max_chars}) || chr(10) || '[...] (truncated)' ELSE text END"
_STRATEGY = f"""
    WITH docs AS (SELECT doc_id AS id, text FROM documents WHERE coalesce({sql.strip('text')}, '') <> ''),
    w AS (SELECT * FROM ({' UNION ALL '.join(_windows(o) for o in _CHUNKS.offsets)}) WHERE {sql.strip('body')} <> ''),
    parts AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY off, k) AS ord, body, n FROM w),
    {_answers('auto_', f"SELECT id, ord, body FROM parts WHERE n > {_CHUNKS.max_chars} UNION ALL SELECT id, 1, {_TRUNCATED_DOC} FROM docs WHERE id NOT IN (SELECT id FROM parts WHERE n > {_CHUNKS.max_chars})")},
    {_answers('all_', f"SELECT id, ord, body FROM parts UNION ALL SELECT id, 1, {_TRUNCATED_DOC} FROM docs WHERE id NOT IN (SELECT id FROM parts)")},
    {_answers('head_', f"SELECT id, 1 AS ord, array_to_string(list_slice({sql.lines('text')}, 1, {_CHUNKS.header_lines}), chr(10)) AS body FROM docs")},
    base_m AS (SELECT id, count(*) AS n, min(publication) AS p, min(application) AS a FROM auto_ GROUP BY 1),
    base_f AS (SELECT m.id, any_value(n) AS n, any_value(p) AS p, coalesce(min(application) FILTER (WHERE application <= p), any_value(a)) AS a FROM base_m m JOIN auto_ USING (id) GROUP BY 1),
    base AS (SELECT id, n, CASE WHEN n > 1 AND coalesce(a = p, false) THEN NULL ELSE a END AS application, p AS publication FROM base_f),
    {_by_policy('parted', 'SELECT * FROM all_')},
    {_by_policy('headed', 'SELECT * FROM head_ UNION ALL SELECT id, 2, application, publication FROM base')},
    {_by_policy('twice', 'SELECT id, 1 AS ord, application, publication FROM base UNION ALL SELECT id, 2, application, publication FROM base')}"""


def _strategy_sql(name: str) -> str:
    source, passes, policy, rerun = {
        "baseline": ("base", "b.n", "CASE WHEN length(text) > 10000 AND b.id IN (SELECT id FROM parts) THEN 'legacy_baseline' ELSE 'n/a_single' END", "false"),
        "chunked": ("parted", "m.n", "'prefer_non_null'", "false"),
        "header_first": ("headed", "1 + b.n", "'prefer_non_null'", "true"),
        "two_pass_targeted": ("twice", "2 * b.n", "'prefer_non_null'", "true"),
        "self_consistency": ("twice", "2 * b.n", "'vote_majority'", "true"),
    }[name]
    variance = "0.0::DOUBLE" if name == "self_consistency" else "NULL::DOUBLE"
    full = "(1 + (m.application IS NOT NULL)::INT + (m.publication IS NOT NULL)::INT)::DOUBLE / 8"
    ordered = "CASE WHEN m.application IS NOT NULL AND m.publication IS NOT NULL THEN (m.application <= m.publication)::INT::DOUBLE ELSE 0.6::DOUBLE END"
    return f"""{_STRATEGY}
        SELECT d.id, '{_PROMPTED}' AS title, m.application::VARCHAR AS application, m.publication::VARCHAR AS publication, NULL::VARCHAR AS error,
               round(0.45::DOUBLE * {full} + 0.25::DOUBLE * {ordered} + CASE WHEN contains(text, '{_PROMPTED}') THEN 0.1::DOUBLE ELSE 0 END, 6) AS confidence,
               '{name}' AS strategy_used, {rerun} AS was_rerun, ({passes})::BIGINT AS pass_count, {policy} AS merge_policy_used, {variance} AS variance
        FROM docs d JOIN {source} m USING (id) JOIN base b USING (id)
        UNION ALL SELECT doc_id, NULL, NULL, NULL, 'empty_ocr', 0, '{name}', NULL, NULL, NULL, NULL FROM documents WHERE coalesce({sql.strip('text')}, '') = ''"""


_BOX_LISTS = """pages AS (SELECT l_orderkey, {'y1': y1, 'x1': x1, 'x2': x2, 'y2': y2} AS b, row_number() OVER (PARTITION BY l_orderkey ORDER BY y1, x1, x2, y2) AS rn FROM b)"""


def _bands(least: float) -> str:
    """SQL of the groups of boxes of a page: each box, from the top, joins the first group with one in its band."""
    over, lower = "(least(m.y2, p.b.y2) - greatest(m.y1, p.b.y1))", "greatest(least(m.y2 - m.y1, p.b.y2 - p.b.y1), 1)"
    at = f"list_position(list_transform(gs, lambda g: len(list_filter(g, lambda m: {over}::DOUBLE / {lower} >= {least}::DOUBLE)) > 0), true)"
    return f"""WITH RECURSIVE {_BOXES}, {_BOX_LISTS},
        steps AS (SELECT l_orderkey, 1 AS i, [[b]] AS gs FROM pages WHERE rn = 1
                  UNION ALL
                  SELECT s.l_orderkey, i + 1, CASE WHEN coalesce({at}, 0) = 0 THEN list_append(gs, [p.b]) ELSE list_transform(gs, lambda g, k: CASE WHEN k = {at} THEN list_append(g, p.b) ELSE g END) END
                  FROM steps s JOIN pages p ON p.l_orderkey = s.l_orderkey AND p.rn = i + 1),
        bands AS (SELECT l_orderkey, arg_max(gs, i) AS gs FROM steps GROUP BY 1)"""


def _edge(f: str, name: str) -> str:
    return f"'{name}': list_{f}(list_transform(g, lambda m: m.{name}))"


ORACLE = {
    **{f"strategy_{n}": _strategy_sql(n) for n in strategies.STRATEGIES},
    "boxes_order": f"""{_bands(0.3)}
        SELECT l_orderkey, to_json(flatten(list_transform(gs, lambda g: list_sort(list_transform(g, lambda m: {{'x1': m.x1, 'y1': m.y1, 'x2': m.x2, 'y2': m.y2}})))))::VARCHAR AS boxes FROM bands""",
    "boxes_band_merge": f"""{_bands(0.2)}
        SELECT l_orderkey, to_json(list_transform(gs, lambda g: {{{_edge('min', 'x1')}, {_edge('min', 'y1')}, {_edge('max', 'x2')}, {_edge('max', 'y2')}}}))::VARCHAR AS boxes FROM bands""",
    "boxes_split": """
        WITH i AS (SELECT l_orderkey, count(*) * 10 AS w, flatten(list(list_transform(range(10), lambda k: trunc(l_quantity)::BIGINT) ORDER BY l_linenumber, trunc(l_quantity)::BIGINT)) AS ink FROM lineitem GROUP BY 1),
        m AS (SELECT *, greatest(5, trunc(0.1::DOUBLE * w)::BIGINT) AS edge FROM i),
        v AS (SELECT *, list_slice(ink, edge + 1, w - edge) AS mid FROM m),
        a AS (SELECT *, edge + list_position(mid, list_min(mid)) - 1 AS split_x, coalesce(list_max(mid) > 0 AND list_min(mid)::DOUBLE / list_max(mid) < 0.75, false) AS two FROM v)
        SELECT l_orderkey, CASE WHEN two THEN to_json([{'x1': 0, 'y1': 0, 'x2': w, 'y2': 110}, {'x1': 0, 'y1': 110, 'x2': split_x, 'y2': 500}, {'x1': split_x, 'y1': 110, 'x2': w, 'y2': 500}])
               ELSE to_json([{'x1': 0, 'y1': 0, 'x2': w, 'y2': 110}, {'x1': 0, 'y1': 110, 'x2': w, 'y2': 500}]) END::VARCHAR AS boxes FROM a""",
    "gold_pred_inner": f"WITH {_PRED}, {_CAT} SELECT norm_id, grant_year, rec_id, confidence_score FROM cat JOIN pred USING (norm_id)",
    "gold_pred_left": f"WITH {_PRED}, {_CAT} SELECT cat.norm_id, grant_year, rec_id, rec_id IS NULL AS pred_missing, coalesce(error, '') AS error FROM cat LEFT JOIN pred USING (norm_id)",
    "report_left": f"WITH {_REP} SELECT rec_id, p.norm_id, coalesce(status, 'missing') AS status, n_blocks FROM (SELECT rec_id, {_stem('file_name')} AS norm_id FROM predictions_all) p LEFT JOIN rep USING (norm_id)",
    "catalog_anti": f"WITH {_PRED} SELECT DISTINCT norm_id FROM sample_manifest WHERE norm_id NOT IN (SELECT norm_id FROM pred WHERE norm_id IS NOT NULL)",
    "wanted_semi": f"WITH {_PRED}, {_CAT} SELECT norm_id, rec_id FROM pred WHERE norm_id IN (SELECT norm_id FROM cat WHERE office IS NOT NULL)",
    "id_reconciliation": f"""
        WITH e AS (SELECT DISTINCT substring(norm_id, 1, 2) AS office, norm_id FROM patent_catalog WHERE norm_id IS NOT NULL),
        f AS (SELECT DISTINCT substring({_stem('file_name')}, 1, 2) AS office, {_stem('file_name')} AS norm_id FROM predictions_all WHERE file_name IS NOT NULL)
        SELECT office, count(e.norm_id) AS expected, count(f.norm_id) AS found, count(*) FILTER (WHERE e.norm_id IS NOT NULL AND f.norm_id IS NOT NULL) AS present,
               count(*) FILTER (WHERE f.norm_id IS NULL) AS missing, count(*) FILTER (WHERE e.norm_id IS NULL) AS extra
        FROM e FULL JOIN f USING (office, norm_id) GROUP BY 1""",
    "resume_skip": f"""
        SELECT norm_id, CASE WHEN norm_id IN (SELECT {_stem('file_name')} FROM predictions_all WHERE file_name IS NOT NULL) THEN 'skipped' ELSE 'todo' END AS status
        FROM (SELECT DISTINCT {_stem('file_name')} AS norm_id FROM ocr_report)""",
    "report_status": f"WITH {_REP} SELECT status, count(*) AS n, round(avg(t_total_s), 4) AS mean_s, round(median(t_total_s), 4) AS median_s, sum(n_blocks)::BIGINT AS blocks FROM rep WHERE norm_id IS NOT NULL GROUP BY 1",
    "confidence_percentiles": """
        WITH g AS (SELECT strategy_used, list(confidence_score ORDER BY confidence_score) FILTER (WHERE confidence_score IS NOT NULL) AS l, count(*) AS n, round(avg(confidence_score), 6) AS mean,
                          round(100.0::DOUBLE * avg(coalesce(was_rerun::INT, 0)), 4) AS rerun_pct FROM predictions_all GROUP BY 1)
        SELECT strategy_used, n, mean, rerun_pct, l[1 + round_even((len(l) - 1) * 0.1::DOUBLE, 0)::BIGINT] AS p10, l[1 + round_even((len(l) - 1) * 0.5::DOUBLE, 0)::BIGINT] AS p50,
               l[1 + round_even((len(l) - 1) * 0.9::DOUBLE, 0)::BIGINT] AS p90 FROM g""",
    "run_summary": f"""
        SELECT coalesce(model, '') AS model, count(*) AS docs, count(error) AS errors, count(*) FILTER (WHERE prediction IS NOT NULL) AS valid, round(count(*) / sum(timing['t_total_file_s']), 6) AS docs_per_s,
               {_stats('confidence_score', 'confidence_score', 'prediction IS NOT NULL')} FROM predictions_all GROUP BY 1""",
    "run_compare_delta": """
        SELECT strategy_used, round(avg(confidence_score) FILTER (WHERE NOT was_rerun), 6) AS once, round(avg(confidence_score) FILTER (WHERE was_rerun), 6) AS again,
               round(avg(confidence_score) FILTER (WHERE was_rerun) - avg(confidence_score) FILTER (WHERE NOT was_rerun), 6) AS delta
        FROM predictions_all WHERE was_rerun IS NOT NULL GROUP BY 1""",
    "field_presence": f"WITH {_RUNS}, {_DATED} SELECT *, presence_rate AS score_mean FROM fields",
    "field_presence_rate": f"""WITH {_RUNS}, {_DATED} SELECT run, field, sum(n_items)::BIGINT AS n_items, sum(n_present)::BIGINT AS n_present,
        round(sum(n_present)::DOUBLE / nullif(sum(n_items), 0), 6) AS presence_rate, round(sum(n_present)::DOUBLE / nullif(sum(n_items), 0), 6) AS score_mean,
        CASE field {' '.join(f"WHEN '{f}' THEN '{LABELS[f]}'" for f in EXACT)} END AS label FROM fields GROUP BY 1, 2""",
    "doc_presence_mean": f"WITH {_RUNS}, {_DATED} SELECT run, round(avg(round(p, 6)), 6) AS mean_presence, round(avg(round(p, 6)), 6) AS mean_score, count(*) AS docs FROM docs GROUP BY 1",
    "presence_ecdf": f"""WITH {_RUNS}, {_DATED} SELECT run, norm_id, round(p, 6) AS presence,
        round(row_number() OVER (PARTITION BY run ORDER BY round(p, 6), norm_id)::DOUBLE / count(*) OVER (PARTITION BY run), 6) AS ecdf FROM docs WHERE p IS NOT NULL""",
    "title_error_rates": f"WITH {_TITLES} SELECT * FROM e",
    "cer_top20": f"WITH {_TITLES} SELECT rec_id, cer, wer FROM e ORDER BY cer DESC NULLS LAST, wer DESC NULLS LAST, rec_id LIMIT 20",
    "cer_summary": f"WITH {_TITLES} SELECT count(*) AS n, {_stats('cer', 'cer')}, {_stats('wer', 'wer')}, {_stats('cer', 'changed_cer', 'char_dist > 0')} FROM e",
    "request_timing": f"SELECT request_id, {_TIMES} FROM request_metrics",
    "batch_timing_rollup": f"""
        WITH t AS (SELECT file_name, floor(arrival_time / 600) AS b, {_TIMES} FROM request_metrics),
        b AS (SELECT file_name, b, {', '.join(f'sum({c}) AS {c}' for c in _SUMMED)}, max(t_scheduler) AS s FROM t GROUP BY 1, 2),
        d AS (SELECT file_name, {', '.join(f'round(sum({c}), 6) AS {c}' for c in _SUMMED)}, round(sum(s), 6) AS t_shared FROM b GROUP BY 1)
        SELECT *, CASE WHEN coalesce(t_request, 0) > 0 THEN t_request ELSE t_shared END AS t_total FROM d""",
    "input_positions": "SELECT file_name, row_number() OVER (ORDER BY file_name) - 1 AS position FROM (SELECT DISTINCT file_name FROM ocr_report WHERE file_name IS NOT NULL)",
    "first_files": "SELECT DISTINCT file_name FROM ocr_report WHERE file_name IS NOT NULL ORDER BY file_name LIMIT 50",
    "first_seen_ids": """
        WITH u AS (SELECT norm_id, 0 AS src, sample_rank::VARCHAR AS place FROM sample_manifest UNION ALL SELECT norm_id, 1, norm_id FROM patent_catalog)
        SELECT norm_id, src, place FROM (SELECT *, row_number() OVER (PARTITION BY norm_id ORDER BY src, place) AS rn FROM u WHERE norm_id IS NOT NULL) WHERE rn = 1""",
    "manifest_files": f"""
        WITH w AS (SELECT DISTINCT norm_id FROM sample_manifest), p AS (SELECT norm_id, min(png_name) AS png FROM sample_manifest WHERE source IS NOT NULL GROUP BY 1),
        r AS (SELECT {_stem('file_name')} AS norm_id, min(file_name) AS scan FROM ocr_report GROUP BY 1)
        SELECT norm_id, coalesce(png, scan) AS path, CASE WHEN png IS NOT NULL THEN 'better' WHEN scan IS NOT NULL THEN 'worse' ELSE 'missing' END AS source
        FROM w LEFT JOIN p USING (norm_id) LEFT JOIN r USING (norm_id)""",
    "report_texts": """
        SELECT status, has_text, count(*) AS n, count(out_txt) AS named FROM (
            SELECT status, out_txt, coalesce(file_name IN (SELECT file_name FROM predictions_all WHERE ocr_text IS NOT NULL AND file_name IS NOT NULL), false) AS has_text FROM ocr_report) GROUP BY 1, 2""",
    "wrapper_summary": f"""
        WITH p AS (SELECT file_name, arg_min(prediction.title, rec_id) AS a, arg_max(prediction.title, rec_id) AS b FROM predictions_all WHERE prediction.title IS NOT NULL AND file_name IS NOT NULL GROUP BY 1)
        SELECT count(*) AS n, count(*) FILTER (WHERE a = b) AS exact_equal, count(*) FILTER (WHERE {sql.collapsed('a')} = {sql.collapsed('b')}) AS normal_equal FROM p""",
    "score_coverage": f"""
        WITH {_PRED}, {_CAT}, g AS (SELECT cat.norm_id, rec_id, coalesce(error, '') AS error FROM cat LEFT JOIN pred USING (norm_id))
        SELECT count(*) AS wanted, count(rec_id) AS found, count(*) - count(rec_id) AS missing, count(*) FILTER (WHERE rec_id IS NOT NULL AND error = '') AS ok, round(count(rec_id)::DOUBLE / count(*), 6) AS coverage FROM g""",
    "printed_confidence": "SELECT rec_id, coalesce(printf('%.2f', confidence_score), 'NA') AS confidence FROM predictions_all",
    "skew_medians": """
        SELECT status, round(CASE WHEN count(deskew_angle) FILTER (WHERE abs(deskew_angle) <= 5) >= 5 THEN median(deskew_angle) FILTER (WHERE abs(deskew_angle) <= 5) ELSE 0 END::DOUBLE, 6) AS angle
        FROM ocr_report WHERE deskew_angle IS NOT NULL GROUP BY 1""",
    "boxes_inner": """
        WITH f AS (SELECT l_orderkey, unnest(arg_min({'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}, (x1, y1, x2, y2))) FROM (SELECT l_orderkey, 40 * (l_partkey % 20) AS x1, 30 * l_linenumber AS y1,
            40 * (l_partkey % 20) + 20 * trunc(l_quantity)::BIGINT AS x2, 30 * l_linenumber + 25 + l_suppkey % 10 AS y2 FROM lineitem) GROUP BY 1),
        m AS (SELECT *, trunc(0.15::DOUBLE * (x2 - x1))::BIGINT AS mx, trunc(0.15::DOUBLE * (y2 - y1))::BIGINT AS my FROM f),
        a AS (SELECT *, least(x2 - 1, x1 + mx) AS ax, least(y2 - 1, y1 + my) AS ay FROM m)
        SELECT l_orderkey, greatest(x2 - x1, 0) AS width, greatest(y2 - y1, 0) AS height, ax AS x1, ay AS y1, greatest(ax + 1, x2 - mx) AS x2, greatest(ay + 1, y2 - my) AS y2 FROM a""",
    "timing_map_sum": """
        SELECT strategy_used, k, count(*) AS n, round(sum(v), 3) AS total
        FROM (SELECT strategy_used, unnest(map_keys(timing)) AS k, unnest(map_values(timing)) AS v FROM predictions_all WHERE timing IS NOT NULL) GROUP BY 1, 2""",
    "running_avg_progress": """
        SELECT status, n, round(a, 6) AS running_avg FROM (
            SELECT status, (row_number() OVER w)::INT AS n, avg(t_total_s) OVER (PARTITION BY status ORDER BY scanned_at NULLS FIRST, file_name NULLS FIRST, ingested_at NULLS FIRST, t_total_s ROWS UNBOUNDED PRECEDING) AS a
            FROM ocr_report WHERE t_total_s IS NOT NULL WINDOW w AS (PARTITION BY status ORDER BY scanned_at NULLS FIRST, file_name NULLS FIRST, ingested_at NULLS FIRST, t_total_s)) WHERE n % 10 = 0""",
    "catalog_ids": r"SELECT DISTINCT norm_id, regexp_extract(norm_id, '^[A-Z]{2}-(\d+)-', 1)::BIGINT AS number FROM patent_catalog WHERE regexp_matches(norm_id, '^CH-\d+-')",
    "even_sample": f"WITH {_SAMPLE} SELECT sample_rank::INT AS sample_rank, norm_id FROM s",
    "combined_manifest": f"""WITH {_SAMPLE}, m AS (SELECT 0 AS src, sample_rank, norm_id FROM sample_manifest UNION ALL SELECT 1, sample_rank, norm_id FROM s)
        SELECT row_number() OVER (ORDER BY src, sample_rank) AS rank, norm_id, src FROM m""",
    "boxes_nested": f"""WITH {_BOXES} SELECT l_orderkey, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM a o WHERE o.l_orderkey = a.l_orderkey AND a.area < o.area
        AND greatest(least(a.x2, o.x2) - greatest(a.x1, o.x1), 0) * greatest(least(a.y2, o.y2) - greatest(a.y1, o.y1), 0) > a.area * 0.7::DOUBLE)) AS n FROM a GROUP BY 1""",
    "boxes_fallback": f"WITH {_BOXES} SELECT l_orderkey, count(*) = 1 AND max(area) > 1000 * 40 * 0.55::DOUBLE AS fallback FROM a GROUP BY 1",
}
