"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellumine.llm import addresses, encoding, language, leakage, names, ocr, split, tokens
from vellumine.session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of spellings of one person or company."""
    return names.name_pairs(table(spark, folder, "predictions_all"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with a defect of scanning."""
    return ocr.defects(table(spark, folder, "predictions_all"))


def p2_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """The scanned texts as continuous paragraphs."""
    return ocr.paragraphs(table(spark, folder, "predictions_all"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The coarsest unit that fits, of every text of more than 7,000 characters."""
    return split.boundary_units(table(spark, folder, "predictions_all"), "rec_id", "ocr_text")


def p3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All texts as pieces of at most 7,000 characters."""
    return split.pieces(table(spark, folder, "predictions_all"), "rec_id", "ocr_text")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of wordings of one location."""
    return addresses.address_pairs(table(spark, folder, "predictions_all"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The language segments of rows with a missing or wrong label or several languages."""
    return language.relabelled(table(spark, folder, "predictions_all")).select("rec_id", "seg_no", "lang")


def p6_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The same segments with their words and confidence."""
    return language.relabelled(table(spark, folder, "predictions_all"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_corpus(table(spark, folder, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with a passage of an evaluation item, and the item."""
    found = leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    return found.select("doc_id", "item_id")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with a wrongly decoded stretch."""
    return encoding.affected(table(spark, folder, "documents"))


def p9_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The wrongly decoded documents with their text restored."""
    return encoding.restore(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_paragraphs, p3_found, p3_pieces, p5_found, p6_found, p6_segments, p7_ids, p8_found, p9_found, p9_restored)}

#: White space as SQL patterns write it.
_WS = r"\t\n\x0b\x0c\r \x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_INNER = _WS.replace(r"\n", "")

#: What may count as characters up to a boundary of each kind, as SQL patterns.
_UPTO = {"paragraphs": rf"(?s:.*?)\n(?:[{_INNER}]*\n)+", "lines": r"[^\n]*\n", "words": rf"[^{_WS}]*[{_WS}]+"}
_PLACES = ", ".join(
    f"list_transform(range(1, len({k}) + 1), lambda i: list_sum(list_transform({k}[1:i], lambda x: length(x)))::BIGINT) AS {k}" for k in _UPTO
)


def _last(kind: str) -> str:
    """SQL of the last boundary of a kind in the window of the piece that starts at s."""
    return f"list_last(list_filter({kind}, lambda x: x > s + 3500 AND x <= s + 7000))"


ORACLE = {
    "p3_pieces": rf"""
        WITH RECURSIVE u AS (SELECT rec_id, ocr_text, length(ocr_text) AS n, {', '.join(f"CASE WHEN length(ocr_text) > 7000 THEN regexp_extract_all(ocr_text, '{p}') ELSE [] END AS {k}" for k, p in _UPTO.items())}
                             FROM predictions_all WHERE ocr_text IS NOT NULL),
        b AS (SELECT rec_id, ocr_text, n, {_PLACES} FROM u),
        p AS (SELECT rec_id, 0 AS piece_no, 0::BIGINT AS s FROM b
              UNION ALL
              SELECT p.rec_id, piece_no + 1, coalesce({_last('paragraphs')}, {_last('lines')}, {_last('words')}, s + 7000) - 800 FROM p JOIN b USING (rec_id) WHERE n - s > 7000),
        e AS (SELECT rec_id, piece_no, s, ocr_text, CASE WHEN n - s <= 7000 THEN n ELSE coalesce({_last('paragraphs')}, {_last('lines')}, {_last('words')}, s + 7000) END AS e,
                     CASE WHEN n - s <= 7000 THEN 'end' WHEN {_last('paragraphs')} IS NOT NULL THEN 'paragraph' WHEN {_last('lines')} IS NOT NULL THEN 'line'
                          WHEN {_last('words')} IS NOT NULL THEN 'word' ELSE 'none' END AS cut FROM p JOIN b USING (rec_id))
        SELECT rec_id, piece_no, s AS start, e - s AS length, cut, substring(ocr_text, s + 1, e - s) AS piece FROM e
    """,
    "p3_found": rf"""
        WITH t AS (SELECT rec_id, ocr_text FROM predictions_all WHERE length(ocr_text) > 7000),
        l AS (SELECT rec_id, list_max(list_transform(string_split(ocr_text, chr(10)), lambda x: length(x))) AS line,
                     list_max(list_transform(regexp_split_to_array(ocr_text, '[{_WS}]+'), lambda x: length(x))) AS word,
                     list_max(list_transform(regexp_split_to_array(chr(10) || ocr_text || chr(10), '\n([{_INNER}]*\n)+'),
                                             lambda x: length(x) - CASE WHEN x LIKE chr(10) || '%' THEN 1 ELSE 0 END)) AS para
              FROM t)
        SELECT rec_id, CASE WHEN para <= 7000 THEN 'paragraph' WHEN line <= 7000 THEN 'line' WHEN word <= 7000 THEN 'word' ELSE 'none' END AS boundary FROM l
    """,
}
