"""Column expressions against plain Python, on small rows with nulls, blanks and ties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vellumine.functions import boxes, dates, entities, records, scoring, text as tx

TEXTS = [None, "", "  ", "a\r\nb\n\nc\n", " x  y z ", "Für\x0bÖl\x85end", "Klasse 96 g\nno class\nClass here", "word " * 3000]


def rows(spark, values, schema="v string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")


def column(df, expr):
    return [r["x"] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_lines_as_python(spark):
    got = column(rows(spark, TEXTS), tx.lines("v"))
    assert got == [None if t is None else t.splitlines() for t in TEXTS]


def test_normal_forms(spark):
    got = column(rows(spark, TEXTS), tx.collapsed("v"))
    assert got == [None if t is None else " ".join(t.split()) for t in TEXTS]
    assert column(rows(spark, TEXTS), tx.blank("v")) == [t is None or not t.strip() for t in TEXTS]


def test_proxies(spark):
    for name, expr in tx.proxies("v").items():
        for t, x in zip(TEXTS, column(rows(spark, TEXTS), expr)):
            if t is None:
                continue
            full = [line for line in t.splitlines() if line.strip()]
            want = {"n_chars": len(t), "n_lines": len(full), "n_empty_lines": len(t.splitlines()) - len(full), "avg_line_len": round(sum(map(len, full)) / len(full), 6) if full else 0.0}
            assert x == want[name]


def test_first_and_longest(spark):
    df = rows(spark, [[" ", None, " b ", "cc", "dd"], [], None, [None]], "v array<string>")
    assert column(df, tx.first_filled("v")) == ["b", None, None, None]
    assert column(df, tx.longest_filled("v")) == ["cc", None, None, None]


@pytest.mark.parametrize("name,company", [("Meyer & Cie.", True), ("Jean et Marie", True), ("KARL ERB", True), ("Emil Fredrik SCHEDWIN", False), ("Anna Berg", False), ("", False)])
def test_company(spark, name, company):
    assert column(rows(spark, [name]), tx.is_company("v")) == [company]


def test_identifiers(spark):
    df = rows(spark, ["data/x/CH-20123-A_full.txt", "CH-7-B.pdf", "odd"])
    assert column(df, tx.id_without_full("v")) == ["CH-20123-A", "CH-7-B", "odd"]
    assert column(df, tx.number_in_id(tx.id_without_full("v"))) == [20123, 7, None]


def test_word_distance_against_brute_force(spark):
    def brute(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    pairs = [("a b c", "a c"), ("", "x"), ("ü ü b", "ü b b"), ("one two", "one two"), ("p q r s", "s r q p")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    assert column(df, tx.word_distance("a", "b")) == [brute(a.split(), b.split()) for a, b in pairs]


def test_ratios_without_builtin(spark):
    assert tx.indel_percent("kitten", "sitting") == pytest.approx(200 * 4 / 13)
    df = spark.createDataFrame([(0, "Müller, Karl", "MULLER KARL"), (1, "Karl", "Kurt"), (2, None, "x"), (3, "", "")], "i int, a string, b string")
    assert column(df, tx.same_person("a", "b")) == [True, False, False, False]
    df = spark.createDataFrame([(0, "cooling cover for blinds", "coolng cover"), (1, "abc", ""), (2, None, "x"), (3, "cover for", "cover")], "i int, a string, b string")
    assert column(df, tx.phrase_score("a", "b")) == [1.0, None, None, 1.0]


def test_snippets(spark):
    got = column(rows(spark, TEXTS), tx.class_snippets("v"))
    assert got[6] == ["Klasse 96 g"] and got[1] == []


def test_dates(spark):
    days = ["1926-01-05", " 1926-01-05 ", "5 Jan 1926", "1926", "1926-13-01", "", None]
    df = rows(spark, days)
    assert column(df, dates.field_date("v")) == [dt.date(1926, 1, 5)] * 3 + [None] * 4
    assert column(df, dates.iso_date("v"))[2] is None
    df = spark.createDataFrame([(0, "1930-01-01", "1929-01-01", "1931-01-01"), (1, "1920-01-01", "1921-01-01", "1922-01-01"), (2, None, "1920-01-01", "1919-01-01"), (3, None, None, None)], "i int, a string, p string, f string")
    fixed = dates.in_order("a", "p", "f")
    assert column(df, fixed["application"]) == [None, "1920-01-01", None, None]
    assert column(df, fixed["foreign"]) == [None, None, "1919-01-01", None]
    assert column(df, dates.coherence("a", "p", "f")) == [0.0, 0.5, 0.6, 0.6]


def test_date_in_text(spark):
    df = spark.createDataFrame([(0, "filed 5 janvier 1926", dt.date(1926, 1, 5)), (1, "on 05.01.1926", dt.date(1926, 1, 5)), (2, "none", dt.date(1926, 1, 5)), (3, "x", None)], "i int, t string, d date")
    assert column(df.withColumn("n", tx.search_normal("t")), dates.date_present("n", "t", "d")) == [True, True, False, None]


E = "array<struct<name:string,address:string>>"


def names(xs):
    return None if xs is None else [(x["name"], x["address"]) for x in xs]


def test_entities(spark):
    df = rows(spark, [[(" A ", " "), ("a", None), (None, "x"), ("B", "y")], [], None, [(" ", None)]], f"v {E}")
    assert [names(x) for x in column(df, entities.normalized("v"))] == [[("A", None), ("B", "y")], None, None, None]
    assert column(df, F.round(entities.quality(entities.normalized("v")), 3)) == [0.85, 0.0, 0.0, 0.0]
    text = rows(spark, ["A (x); B ;; a (x)", "", None])
    assert [names(x) for x in column(text, entities.from_string("v"))] == [[("A", "x"), ("B", None)], None, None]


def test_companies_move(spark):
    df = spark.createDataFrame([(0, [("ACME GmbH", None), ("Alice", None)], None), (1, None, None)], f"i int, a {E}, b {E}")
    moved = entities.companies_moved("a", "b")
    assert [names(x) for x in column(df, moved["inventors"])] == [[("Alice", None)], None]
    assert [names(x) for x in column(df, moved["assignees"])] == [[("ACME GmbH", None)], None]


@pytest.mark.parametrize("policy,want", [("prefer_first", None), ("prefer_last", "B"), ("prefer_non_null", " b "), ("vote_majority", " b ")])
def test_policies(spark, policy, want):
    df = rows(spark, [[None, " b ", "a", "A  ", "B"]], "v array<string>")
    assert column(df, scoring.chosen("v", policy)) == [want]


def test_unknown_policy():
    with pytest.raises(ValueError, match="unknown policy"):
        scoring.chosen("v", "best")


def test_confidence_of_a_known_record(spark):
    record = ("Chain", [("A", "x")], None, "1920-01-01", "1921-01-01", None, "8", "Uhren", "CH-1")
    df = spark.createDataFrame([(0, record, "A Chain of wheels")], f"i int, r {records.RECORD}, t string")
    assert column(df, scoring.confidence(F.col("r"), F.col("t"))["confidence"]) == [0.45 * 0.75 + 0.25 + 0.1 + 0.1]


def test_json_out_of_text():
    assert records.find_json('x {"a": 1} y {"b": {"c": 2}} {bad}') == '{"b": {"c": 2}}'
    assert records.find_json('say "identifier": "x"') == '{\n"identifier": "x"\n}'
    assert records.find_json("nothing") == "{}" and records.outer_objects("{{a}") == ["{a}"]


def test_validation(spark):
    raws = ['{"title": "T", "inventor": [{"name": "ACME GmbH"}, {"name": "Al"}], "class": "8"}', '{"title": 5}', "no json", None, '[{"title": "L"}]', '{"title": "D", "pub_date_application": "1920-01-01", "pub_date_publication": "1919-01-01"}']
    got = [r["r"] for r in records.with_validated(rows(spark, raws), "v", "r").orderBy("i").collect()]
    assert got[0]["title"] == "T" and got[0]["classification"] == "8" and names(got[0]["assignees"]) == [("ACME GmbH", None)]
    assert got[1] is got[2] is got[3] is None
    assert got[4]["title"] == "L" and got[5]["pub_date_application"] == "1920-01-01"  # one answer's dates aren't put in order


def test_boxes(spark):
    page = [(0, 0, 100, 10), (10, 1, 20, 9), (200, 2, 300, 12), (0, 50, 50, 60)]
    df = rows(spark, [page, [], None], f"v array<{boxes.BOX}>")
    assert [None if x is None else len(x) for x in column(df, boxes.without_nested("v"))] == [3, 0, None]
    assert [tuple(b) for b in column(df, boxes.reading_order("v"))[0]] == [(0, 0, 100, 10), (10, 1, 20, 9), (200, 2, 300, 12), (0, 50, 50, 60)]
    assert [tuple(b) for b in column(df, boxes.band_boxes("v"))[0]] == [(0, 0, 300, 12), (0, 50, 50, 60)]
    assert len(column(df, boxes.fused("v"))[0]) <= 3
    one = rows(spark, [[(0, 0, 90, 90)]], f"v array<{boxes.BOX}>")
    assert column(one, boxes.needs_split("v", F.lit(100), F.lit(100))) == [True]
