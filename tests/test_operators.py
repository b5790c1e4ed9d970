"""Operators as dataflow: expansion, inference, merging, strategies, nesting, readers, streams."""

import io
import json
import sys
import tarfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vellumine import config
from vellumine.functions import text as tx
from vellumine.functions import records, scoring
from vellumine.operators import chunking, evaluation as ev, inference, merging, nested, strategies
from vellumine.operators.merging import merged_records
from vellumine.sources import readers, writers
from vellumine.streaming import incremental


def brute_windows(text, size, overlap, offset=0):
    out, at = [], offset
    while at < len(text):
        out.append(text[at : at + size])
        if at + size >= len(text):
            break
        at += size - overlap
    return [w for w in out if w.strip()]


@pytest.mark.parametrize("size,overlap,offset", [(4, 0, 0), (4, 1, 0), (5, 2, 3), (100, 10, 0)])
def test_windows(spark, size, overlap, offset):
    texts = ["", "abcdefgh", "    ", "ab    cdefghijklm", "x" * 23, "éü" * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["w"] for r in df.select("i", chunking.windows("t", size, overlap, offset).alias("w")).orderBy("i").collect()]
    assert got == [brute_windows(t, size, overlap, offset) for t in texts]


def test_rendering(spark):
    df = spark.createDataFrame([("{x} $",)], "t string")
    assert df.select(chunking.rendered("{{a}} {text} b", "t")).first()[0] == "{a} {x} $ b"
    with pytest.raises(ValueError):
        chunking.rendered("no place", "t")
    with pytest.raises(ValueError):
        chunking.Chunking(size=5, overlap=5)


def test_micro_batches(spark):
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate([1, 5, 3, 5])], "i int, t string")
    got = {r["i"]: (r["position"], r["microbatch"]) for r in chunking.micro_batches(df, ["i"], F.length("t"), 2).collect()}
    assert got == {1: (0, 0), 3: (1, 0), 2: (2, 1), 0: (3, 1)}
    assert chunking.micro_batches(df.limit(0), ["i"], F.length("t"), 2).count() == 0


class Failing:
    def generate(self, prompts):
        if any("bad" in p for p in prompts):
            raise KeyError("bad")
        return [p.upper() for p in prompts]


def test_failing_batches_are_tried_singly():
    assert inference._answers(Failing(), ["a", "bad", "c"]) == [("A", None, None), (None, "KeyError", "'bad'"), ("C", None, None)]
    with pytest.raises(ValueError):
        inference.backend("nothing")


DOCS = [(0, "Title one\n1920-01-01 1921-02-02"), (1, ""), (2, None), (3, "   "), (4, "Long " * 4000)]


@pytest.mark.parametrize("strategy", sorted(strategies.STRATEGIES))
def test_strategies(spark, strategy):
    df = spark.createDataFrame(DOCS, "doc int, body string").withColumn("id", F.lit("clash"))
    got = {r["id"]: r for r in strategies.extract(df, "doc", "body", strategy).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    assert got[0]["record"]["title"] is not None and got[0]["error"] is None and got[0]["confidence"] > 0
    assert {got[i]["error"] for i in (1, 2, 3)} == {"empty_ocr"} and got[1]["confidence"] == 0.0


class Rounds:
    """A backend that fails on some texts, and needs a correction on others."""

    def generate(self, prompts, **options):
        if any("bad text" in p for p in prompts):
            raise KeyError("bad")
        out = []
        for p in prompts:
            extra = "" if "Correction" not in p else ', "pub_date_publication": "1921-02-02", "assignees": [{"name": "Ge GmbH"}]'
            out.append('{"title": "T%d", "inventors": [{"name": "Al Bo"}, {"name": "Acme GmbH"}], "pub_date_application": "1920-01-01"%s}' % (0, extra))
        return out


def test_failed_documents_stay_in_every_strategy(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have this module
    df = spark.createDataFrame([(0, "good text T0"), (1, "a bad text"), (2, "")], "doc int, body string")
    c = strategies.Extraction(backend=f"{__name__}:Rounds", threshold=1.0)
    for strategy in strategies.STRATEGIES:
        got = {r["id"]: r for r in strategies.extract(df, "doc", "body", strategy, c).collect()}
        assert sorted(got) == [0, 1, 2], strategy
        assert got[0]["record"]["title"] == "T0" and got[0]["error"] is None and got[0]["strategy_used"] == strategy
        assert "Acme GmbH" in [e["name"] for e in got[0]["record"]["assignees"]]  # moved after merging too
        assert (got[1]["record"], got[1]["error"], got[1]["error_type"], got[1]["confidence"]) == (None, "exception: KeyError", "KeyError", 0.0)
        assert got[2]["error"] == "empty_ocr"
    again = {r["id"]: r for r in strategies.extract(df, "doc", "body", "two_pass_targeted", c).collect()}[0]
    assert again["was_rerun"] and again["pass_count"] == 2 and again["record"]["pub_date_publication"] == "1921-02-02"
    rounds = {r["id"]: r for r in strategies.extract(df, "doc", "body", "self_consistency", c).collect()}[0]
    assert rounds["self_consistency_variance"] == 0.0 and set(rounds["self_consistency_variance_by_field"]) == set(scoring.VOTED) and rounds["chunks_count"] == 2


def test_fallback_to_baseline(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    df = spark.createDataFrame([(0, "a bad text"), (1, "fine")], "doc int, body string")
    c = strategies.Extraction(backend=f"{__name__}:Rounds", fallback=True)
    got = {r["id"]: r for r in strategies.extract(df, "doc", "body", "chunked", c).collect()}
    assert got[0]["strategy_used"] == "baseline" and got[0]["strategy_fallback_from"] == "chunked" and got[1]["strategy_used"] == "chunked"


def test_merging_validates_again(spark):
    def record(**v):
        return tuple(v.get(k) for k in ("title", "inventors", "assignees", "pub_date_application", "pub_date_publication", "pub_date_foreign", "classification", "industrial_field", "identifier"))

    one = record(inventors=[("Acme GmbH", None), ("Al Bo", None)], pub_date_application="1920-01-01", pub_date_publication="1920-01-01", identifier="x")
    df = spark.createDataFrame([(1, 0, one), (1, 1, one), (2, 0, one)], f"k int, o int, r {records.RECORD}")
    for policy in (*scoring.POLICIES, None):
        got = {r["k"]: r["r"] for r in merging.merged_records(df, "k", "o", "r", policy).collect()}
        assert [e["name"] for e in got[1]["inventors"]] == ["Al Bo"] and [e["name"] for e in got[1]["assignees"]] == ["Acme GmbH"]
        assert got[1]["pub_date_application"] is None and got[1]["pub_date_publication"] == "1920-01-01" and got[1]["identifier"] is None
        assert got[2]["pub_date_application"] == "1920-01-01" and len(got[2]["inventors"]) == 2


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        strategies.extract(spark.createDataFrame(DOCS, "doc int, body string"), "doc", "body", "best")


def test_missing_result_fails(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception, match="no result for 2"):
        inference.checked(df, "k", spark.createDataFrame([(1, "x")], "k int, r string")).collect()


ANSWER = {"answer": {"passes": [{"pass": 1, "chunks": {"chunk": 2, "prediction": json.dumps({"inventors": [None, {"name": "A"}, "B", {"name": " "}], "assignee": "C"})}},
                                {"pass": 3, "chunks": [{"chunk": 1, "prediction": None}, {"chunk": 4, "prediction": {"inventor": {"name": "D"}, "assignees": []}}]}]}}


def test_nested_rows(spark):
    pred = spark.createDataFrame([(7, ([(None, None), ("X", None)], None)), (8, None)], "rec_id long, prediction struct<inventors:array<struct<name:string,address:string>>,assignees:array<struct<name:string,address:string>>>").withColumn("tag", F.lit(1))
    raw = spark.createDataFrame([(1, json.dumps(ANSWER)), (1, json.dumps(ANSWER)), (2, "{broken"), (3, None), (None, "{}"), (4, "[1]")], "rec_id long, payload string").withColumn("pk", F.lit("clash"))
    got = sorted(tuple(r) for r in nested.party_rows(pred, raw).collect())
    assert got == sorted([(7, 0, 0, "inventor", 2), (1, 1, 2, "inventor", 2), (1, 1, 2, "inventor", 3), (1, 1, 2, "assignee", 1), (1, 3, 4, "inventor", 1)])
    assert nested.party_rows(pred.limit(0), raw.limit(0)).count() == 0


def test_nested_links(spark, tmp_path):
    raw = spark.createDataFrame([(1, json.dumps(ANSWER))], "rec_id long, payload string")
    rows = nested.tagged_rows(raw, "rec_id", "payload", nested.ANSWER, through=("answer",))
    nested.write_tagged(rows, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    party = nested.flat_table(back, "inventor", "name STRING, address STRING")
    chunk = nested.flat_table(back, "chunk", "title STRING").select(F.col("pk").alias("parent_pk"))
    assert party.count() == 4 and party.join(chunk, "parent_pk").count() == 4


def test_merging_ties_and_single(spark):
    schema = "k int, o int, r struct<title:string,inventors:array<struct<name:string,address:string>>,assignees:array<struct<name:string,address:string>>,pub_date_application:string,pub_date_publication:string,pub_date_foreign:string,classification:string,industrial_field:string,identifier:string>"
    one = ("t", None, None, "1922-01-01", "1920-01-01", None, None, None, None)
    df = spark.createDataFrame([(1, 0, one), (2, 0, one), (2, 1, ("tt", None, None, None, None, None, "8", None, None)), (3, 0, None)], schema)
    got = {r["k"]: r["r"] for r in merged_records(df, "k", "o", "r", "prefer_non_null").collect()}
    assert got[1]["pub_date_application"] == "1922-01-01"  # a single candidate stays as it is
    assert got[2]["pub_date_application"] is None and got[2]["classification"] == "8" and 3 not in got
    assert {r["k"]: r["r"]["title"] for r in merged_records(df, "k", "o", "r", None).collect()} == {1: "t", 2: "tt"}


def test_nearest_rank(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [5, 1, 1, 3, 9, 7]] + [("b", None), ("c", 2.0)], "g string, v double")
    got = {r["g"]: (r["p10"], r["p50"], r["p90"]) for r in ev.nearest_rank(df, "g", "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9}).collect()}
    want = sorted([5, 1, 1, 3, 9, 7])
    assert got == {"a": tuple(float(want[round(5 * q)]) for q in (0.1, 0.5, 0.9)), "c": (2.0, 2.0, 2.0)}


def test_even_sample(spark):
    ids = spark.createDataFrame([(f"CH-{i}-A",) for i in range(1, 24)], "norm_id string")
    got = [r["norm_id"] for r in ev.evenly_spaced(ids, "norm_id", tx.number_in_id("norm_id"), count=5).orderBy("sample_rank").collect()]
    assert got == [f"CH-{round((i + 0.5) * 23 / 5 - 0.5) + 1}-A" for i in range(5)]
    with pytest.raises(ValueError):
        ev.evenly_spaced(ids, "norm_id", "norm_id", count=99)


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z")], "k string, o int, v string")
    assert [tuple(r) for r in ev.last_per_key(df, "k", F.col("o")).collect()] == [("a", 2, "y")]


def test_config(tmp_path):
    p = config.overridden(config.Profile(prompt_id="v4"), strategy="chunked", doc_batch_size=4, max_ocr_chars=5, temperature=None)
    assert (p.name, p.doc_batch_size, p.max_ocr_chars, p.temperature) == ("chunked", 4, 5, 0.0) and p.guarded()
    assert p.section("engine")["doc_batch_size"] == 4 and set(p.as_dict()) == set(config.SECTIONS)
    for wrong in ({"nothing": 1}, {"chunk_overlap_chars": 7_000}, {"chunk_size_chars": 0}, {"extraction_passes": 0}, {"temperature": -1.0}, {"max_ocr_chars": 0}, {"name": "best"},
                  {"gpu_memory_utilization": 0.0}, {"merge_policy": None}, {"self_consistency_n": 0}, {"do_sample": 1}, {"timings": "all"}):
        with pytest.raises(ValueError):
            config.overridden(p, **wrong) if None not in wrong.values() else config.Profile(**wrong)
    with pytest.raises(AttributeError):
        p.temperature = 1.0
    path = tmp_path / "p.json"
    path.write_text(json.dumps({"prompt_id": "v2", "strategy": {"name": "header_first"}, "engine": {"swap_space": 0.0}}))
    q = config.load_profile(path)
    assert q.name == "header_first" and not q.guarded() and q.swap_space == 0.0 and q == config.Profile(prompt_id="v2", strategy="header_first", swap_space=0.0)
    path.write_text(json.dumps({"strategy": "chunked"}))
    assert config.load_profile(path).name == "chunked"
    with pytest.raises(FileNotFoundError):
        config.load_profile(tmp_path / "none.json")
    assert config.tesseract_options("--psm 6 --oem=1 -c a=b") == (6, 1, {"a": "b"})


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts/a.txt").write_bytes("Öl".encode() + b"\xff!")
    (tmp_path / "texts/b.txt").write_text("")
    got = {r["file_name"]: r["ocr_text"] for r in readers.texts(spark, str(tmp_path / "texts")).collect()}
    assert got == {"a.txt": "Öl!", "b.txt": ""}
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n[1]\nbroken\n{"a": 2}\n')
    assert sorted(r["a"] for r in readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a int").collect()) == [1, 2]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a int", "strict").collect()
    writers.json_lines(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"a":1,"b":null}'
    with pytest.raises(Exception):
        writers.json_lines(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "out"))


def test_report_round_trip(spark, tmp_path):
    row = ("a.png", "ok", 1, 1, 0.12345, "a.txt", "", 1.0, 2.0, 3.0, 4.0, 5.0, 15.0)
    writers.report(spark.createDataFrame([row], readers.REPORT), str(tmp_path / "r"))
    back = readers.report(spark, str(tmp_path / "r")).first()
    assert back["deskew_angle"] == 0.1235 and back["t_total_s"] == 15.0


def test_archive(spark, tmp_path):
    path = tmp_path / "a.tar.gz"
    with tarfile.open(path, "w:gz") as out:
        for name in ("d/one.png", "two.png", "three.png"):
            data = name.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            out.addfile(info, io.BytesIO(data))
    assert readers.archive_members(spark, [str(path)]).count() == 3
    got = readers.archive_members(spark, [str(path)], ["one.png", "none.png"]).collect()
    assert [(r["name"], bytes(r["content"])) for r in got] == [("one.png", b"d/one.png")]


def test_stream_is_incremental(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1, "a\nb 1920"), (2, None)], "k int, t string").write.parquet(source)
    for want in (2, 2, 3):
        if want == 3:
            spark.createDataFrame([(3, "c")], "k int, t string").write.mode("append").parquet(source)
        stream = incremental.proxies(incremental.arriving(spark, source, "k int, t string"), "k", "t")
        incremental.into_table(stream, out, state).awaitTermination()
        assert spark.read.parquet(out).count() == want
