"""Result readers, record assembly, sinks, registries and settings from outside."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vellumine import config
from vellumine.functions import boxes, records, results, text as tx
from vellumine.operators import delivery, evaluation as ev, nested, pages, strategies
from vellumine.sources import readers, writers


def test_result_readers(spark):
    answers = [None, "no json", "[]", '[[[[1,2],["a ",0.9]],[[1],[5]],[["x"],[" ",1]]]]', '[["b",0.5],["c"],[[1],["d",1]],[" ",2]]', '{"text_lines":[{"text":" t "},{"text":null},5,null]}', '{"k":["x"," "],"rec_texts":["r"]}']
    df = spark.createDataFrame(list(enumerate(answers)), "i int, a string").withColumn("text", F.lit("clash"))
    got = {r["i"]: r for r in df.select("i", results.classic_text("a").alias("det"), results.classic_text("a", False).alias("rec"), results.line_texts("a").alias("lines"), results.harvested("a").alias("all")).collect()}
    assert got[0]["det"] is None and got[1]["det"] == got[2]["det"] == "" and got[3]["det"] == "a" and got[4]["rec"] == "b\nd"
    assert got[5]["lines"] == ["t"] and got[0]["lines"] == got[1]["lines"] == []
    assert got[6]["all"] == ["r", "x", "r"] and got[1]["all"] is None and got[0]["all"] is None
    assert results.harvest(json.loads("[" * 900 + '"deep"' + "]" * 900)) == ["deep"]
    tree = spark.createDataFrame([([[[" a", None, "b "], [" "]], [], [["c"]]],), (None,), ([],)], "t array<array<array<string>>>")
    assert [r[0] for r in tree.select(results.page_text("t")).collect()] == ["a   b\n\nc".replace("   ", "  "), None, ""]


def test_deep_documents_give_an_error_row(spark):
    deep = '{"answer":' + "[" * 200_000 + "]" * 200_000 + "}"
    rows = nested.tagged_rows(spark.createDataFrame([(1, deep), (2, "{"), (3, '{"answer":{"passes":[]}}')], "k long, d string"), "k", "d", nested.ANSWER, ("answer",)).collect()
    assert [(r["root"], r["tag"]) for r in rows] == [(1, "error")]


def test_delivered_records(spark):
    docs = spark.createDataFrame([(1, "CH-1-A_full.txt", "/t/CH-1-A_full.txt", "Some title"), (2, "CH-2-A_full.txt", "/t/2", "")], "id long, file_name string, ocr_path string, ocr_text string").withColumn("model", F.lit("clash"))
    got = strategies.extract(docs, "id", "ocr_text", "baseline")
    few = delivery.delivered(got, docs, config.Profile(), "h")
    assert "prompt_id" not in few.columns and "pass_count" not in few.columns and "raw_output" not in few.columns
    all_ = delivery.delivered(got, docs, config.Profile(prompt_id="v1", save_strategy_meta=True, save_raw_output=True), "h")
    rows = {r["id"]: r for r in all_.collect()}
    assert rows[1]["prediction"]["identifier"] == "CH-1-A" and rows[1]["pass_count"] == 1 and rows[1]["error"] is None and rows[1]["prompt_id"] == "v1" and rows[1]["confidence_subscores"] is not None
    assert rows[2]["error"] == "empty_ocr" and rows[2]["prediction"] is None and rows[2]["ocr_text"] is None and rows[2]["confidence_score"] == 0.0
    assert delivery.delivered(got.limit(0), docs, config.Profile(), "h").count() == 0
    raw = spark.createDataFrame([('["a", {"b": 1}]',), ('{"c":2}',), ("text",), (None,)], "raw string")
    texts = [r[0] for r in raw.select(delivery.raw_text("raw", "|")).collect()]
    assert texts == ['a|{"b":1}', '{"c":2}', "text", ""]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a.txt", '["x","y"]', 1), ("b.txt", None, 2)], "file_name string, raw_output string, n int")
    writers.raw_outputs(df, str(tmp_path / "raw"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "raw")).collect()] == [("a.txt.raw.txt", "x\n\n" + "=" * 40 + " CHUNK " + "=" * 40 + "\n\ny")]
    writers.scored(df.select("file_name", "n"), df.agg(F.sum("n").alias("total"), F.lit(None).cast("string").alias("none")), str(tmp_path / "s"), ["file_name"], df.select("n"))
    assert json.loads(spark.read.text(str(tmp_path / "s/summary")).first()[0]) == {"total": 3, "none": None}
    assert spark.read.csv(str(tmp_path / "s/scores"), header=True).count() == 2 == spark.read.csv(str(tmp_path / "s/worst"), header=True).count()
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    meta = writers.run_metadata(str(tmp_path / "m/run.json"), start, start + dt.timedelta(seconds=2), folder=Path("/x"), config=config.Profile().as_dict(), pair=(1, {Path("k"): Path("v")}))
    assert json.loads((tmp_path / "m/run.json").read_text()) == meta and meta["wall_s"] == 2.0 and meta["folder"] == "/x" and meta["pair"] == [1, {"k": "v"}]
    assert readers.json_object(str(tmp_path / "m/run.json"))["wall_s"] == 2.0 and readers.json_object(str(tmp_path / "none.json")) == {}
    report = spark.createDataFrame([("a.png", "ok"), ("b.png", "error"), ("c.png", "ok")], "file_name string, status string")
    texts = spark.createDataFrame([("a.txt", "/t/a.txt", "A"), ("b.txt", "/t/b.txt", "B")], "file_name string, path string, ocr_text string")
    writers.ocr_only(delivery.ocr_only(report, texts), str(tmp_path / "o"))
    assert [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "o")).collect()] == [{"file_name": "a.txt", "ocr_path": "/t/a.txt", "status": "ocr_only", "ocr_text": "A"}]


def test_file_readers(spark, tmp_path):
    for name in ("b.PNG", "a.png", "c.pdf", "d.txt", "CH-12-A_full.pdf", "sub/e.png"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    names = lambda df: sorted(r["path"].split("/")[-1] for r in df.collect())
    assert names(readers.pages(spark, str(tmp_path))) == ["CH-12-A_full.pdf", "a.png", "b.PNG", "c.pdf", "e.png"]
    assert names(readers.pages(spark, str(tmp_path), recursive=False, limit=2)) == ["CH-12-A_full.pdf", "a.png"]
    assert readers.pages(spark, str(tmp_path), limit=0).columns == ["path", "length", "content"] and readers.pages(spark, str(tmp_path), limit=0).count() == 0
    drawn = names(readers.sample_pages(spark, str(tmp_path), 3, 7))
    assert len(drawn) == 3 and drawn == names(readers.sample_pages(spark, str(tmp_path), 3, 7))
    assert [r[0] for r in readers.ids_from_names(spark, str(tmp_path), "pdf").collect()] == ["CH-12-A"]
    (tmp_path / "m1.csv").write_text("norm_id,x\n CH-9-A ,1\nCH-10-A,2\nDE-1-A,3\n")
    (tmp_path / "m2.csv").write_text("norm_id,x\nCH-9-A,1\nCH-2-A,2\n")
    assert [tuple(r) for r in readers.catalog_ids(spark, [str(tmp_path / "m1.csv"), str(tmp_path / "m2.csv")]).collect()] == [("CH-2-A", 1), ("CH-9-A", 0), ("CH-10-A", 0)]
    assert sorted(r[0] for r in readers.manifest_ids(spark, str(tmp_path / "m1.csv")).collect()) == ["CH-10-A", "CH-9-A", "DE-1-A"]


def test_plug_ins_and_prompts(spark, tmp_path):
    assert pages.plug_in("json:loads") is json.loads and pages.plug_in("json.loads") is json.loads and pages.plug_in("short", {"short": "json:dumps"}) is json.dumps
    with pytest.raises(ValueError):
        pages.plug_in("nothing")
    with pytest.raises(ImportError):
        pages.plug_in("json:nothing")
    df = spark.createDataFrame([(["a", "b", "c"],), ([],), (None,)], "blocks array<string>")
    assert [r[0] for r in df.select(pages.block_prompts("blocks", "H", "O", 2)).collect()] == [["H", "H", "O"], [], None]
    prompt = tmp_path / "p.txt"
    prompt.write_text("x")
    assert config.prompt_path(tmp_path / "profile.json", relative="p.txt") == prompt.resolve() and config.prompt_path(tmp_path / "profile.json") is None
    assert config.prompt_path("x", explicit=str(prompt), relative="none") == prompt.resolve()
    with pytest.raises(FileNotFoundError):
        config.prompt_path(tmp_path / "profile.json", relative="none.txt")
    assert config.flags(["--no-do-sample", "--chunk-size-chars", "9", "--name", "chunked"]) == {"do_sample": False, "chunk_size_chars": 9, "name": "chunked"}
    with pytest.raises(ValueError):
        config.flags(["--odd", "1"])
    times = {"t_total_s": (1.0, 3.0), "t_generate_s": (2.0, 1.0), "t_parse_s": (None, 1.0), "t_prompt_s": (0.0, 0.5)}
    assert config.timings_kept(config.Profile(), times) == {"t_total_s": 2.0, "t_generate_s": 0.0} and config.timings_kept(config.Profile(timings="off"), times) == {}
    assert config.timings_kept(config.Profile(timings="detailed"), times) == {"t_total_s": 2.0, "t_generate_s": 0.0, "t_prompt_s": 0.5}


def test_ranks_over_ranges(spark):
    import random

    random.seed(1)
    rows = [(random.choice(["a", "b", None]), random.choice([None, 1.0, 2.0, 2.0, 5.0]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, i int").withColumn("n_upto", F.lit("clash"))
    ranked = ev.cumulated(df.drop("n_upto"), ["g"], ["v", "i"], n=F.lit(1), s=F.coalesce("v", F.lit(0.0))).collect()
    for g in ("a", "b", None):
        own = sorted((r for r in ranked if r["g"] == g), key=lambda r: (r["v"] is not None, r["v"] or 0, r["i"]))
        total = 0.0
        for at, r in enumerate(own, 1):
            total += r["v"] or 0.0
            assert r["n_upto"] == at and r["n_all"] == len(own) and abs(r["s_upto"] - total) < 1e-9
    want = {}
    for g in ("a", "b", None):
        values = sorted(v for h, v, _ in rows if h == g and v is not None)
        want[g] = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
    assert {r["g"]: r["v_median"] for r in ev.medians(df, ["g"], ["v"]).collect()} == want
    assert ev.numbered(df.limit(0), "i").count() == 0 and ev.medians(df.limit(0), [], ["v"]).count() == 0


def test_presence_of_phrases_dates_and_classes(spark):
    assert tx.printed is not None
    df = spark.createDataFrame([("the spindle of the lathe", "spindle lathe wheel"), ("a", None), (None, "x")], "t string, p string")
    got = df.select(tx.phrase_present(tx.phrase_score(tx.search_normal("t"), tx.search_normal("p")), F.lit(3)).alias("p"), tx.classification_present(tx.search_normal("t"), tx.search_normal("p")).alias("c"), tx.languages(F.lit(" de, ,fr")).alias("l")).collect()
    assert [r["p"] for r in got] == [True, None, None] and got[0]["c"] is False and got[1]["c"] is None and got[0]["l"] == ["de", "fr"]
    items = spark.createDataFrame([("r", 1, "f", True, 1.0), ("r", 1, "f", False, 0.5), ("r", 1, "g", None, None)], "run string, k int, field string, p boolean, s double")
    fields = ev.presence_by_field(items, "run", "k", "field", "p", "s")
    assert {r["field"]: (r["n_items"], r["n_present"], r["presence_rate"], r["score_mean"]) for r in fields.collect()} == {"f": (2, 1, 0.5, 0.75), "g": (0, 0, None, None)}
    assert [tuple(r) for r in ev.presence_by_document(fields, "run", "k").collect()] == [("r", 1, 2, 1, 0.5, 0.75)]


def test_box_geometry(spark):
    df = spark.createDataFrame([([0.5, 1.0, -0.2, 9.0, 0.1, 0.3],), ([1.0],), (None,)], "a array<double>")
    assert [r[0] for r in df.select(boxes.median_skew("a", 5.0)).collect()] == [0.3, 0.0, 0.0]
    box = F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), F.lit(100).alias("x2"), F.lit(1000).alias("y2"))
    ink = lambda low: F.array(*[F.lit(9 if not 45 <= i < 50 else low) for i in range(100)])
    one = spark.range(1).select(boxes.title_and_columns(box, ink(9)).alias("one"), boxes.title_and_columns(box, ink(1)).alias("two"), boxes.inner(box, 0.1).alias("in")).first()
    assert [tuple(b) for b in one["one"]] == [(0, 0, 100, 220), (0, 220, 100, 1000)]
    assert [tuple(b) for b in one["two"]] == [(0, 0, 100, 220), (0, 220, 45, 1000), (45, 220, 100, 1000)] and tuple(one["in"]) == (10, 100, 90, 900)
    page = spark.createDataFrame([([(0, 0, 100, 1000), (5, 5, 10, 10)],)], "b array<struct<x1:int,y1:int,x2:int,y2:int>>")
    got = boxes.segmented(page, "b", F.lit(100), F.lit(1000), ink(1)).first()["boxes"]
    assert len(got) == 3
    assert records.RECORD.startswith("struct")


def test_whole_runs(spark, tmp_path):
    from vellumine.__main__ import main
    from vellumine.operators import runs

    for name, text in (("b_full.txt", "Title b\n1920-01-01"), ("a_full.txt", ""), ("c_full.txt", "Title c")):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    told = runs.extract_texts(spark, str(tmp_path / "in"), str(tmp_path / "out"), config.Profile(save_raw_output=True, strategy="chunked"), "echo", limit=2)
    assert (told["docs_total"], told["docs_written"], told["errors"]) == (3, 2, 1)
    rows = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out/predictions")).orderBy("value").collect()]
    by = {r["file_name"]: r for r in rows}
    assert set(by) == {"a_full.txt", "b_full.txt"} and by["a_full.txt"]["error"] == "empty_ocr" and by["b_full.txt"]["prediction"]["identifier"] == "b" and "raw_output" not in by["b_full.txt"]
    assert spark.read.parquet(str(tmp_path / "out/raw_outputs")).count() == 1
    assert main(["extract", str(tmp_path / "in"), str(tmp_path / "again"), "--strategy", "baseline", "--no-do-sample"]) == 0
    assert json.loads((tmp_path / "again/run.json").read_text())["docs_written"] == 3
    program = tmp_path / "reader"
    program.write_text("#!/bin/sh\ncat > /dev/null\necho some text\n")
    program.chmod(0o755)
    (tmp_path / "scans").mkdir()
    image = bytearray(b"\xff" * 300 * 400)
    for y in range(60, 240, 12):
        for x in range(60, 330):
            image[y * 400 + x] = image[(y + 1) * 400 + x] = image[(y + 2) * 400 + x] = 0
    (tmp_path / "scans/x.pgm").write_bytes(b"P5 400 300 255\n" + bytes(image))
    (tmp_path / "scans/y.png").write_bytes(b"no image")
    (tmp_path / "scans/x.png").write_bytes(b"P5 400 300 255\n" + bytes(image))
    assert main(["ocr", str(tmp_path / "scans"), str(tmp_path / "read"), "--engine", "tesseract", "lang=deu", "config=--psm 6", f"program={program}"]) == 0
    assert json.loads((tmp_path / "read/run.json").read_text())["docs"] == {"ok": 1, "error": 1}
    assert "some text" in json.loads(spark.read.text(str(tmp_path / "read/ocr_only")).first()[0])["ocr_text"]
    report = {r["file_name"]: r["status"] for r in readers.report(spark, str(tmp_path / "read/report")).collect()}
    assert report == {"x.png": "ok", "y.png": "error"}


def test_checkpoints_need_a_shared_folder():
    from types import SimpleNamespace

    from vellumine.session import shared_dir

    fake = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:1"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake)
    fake.conf["spark.checkpoint.dir"] = "/shared"
    assert shared_dir(fake) == "/shared"
