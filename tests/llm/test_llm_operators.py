"""The operators as Spark jobs: planted cases, nulls, empty tables, repeated rows, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from vellumine.llm import addresses, edits, encoding, language, leakage, names, ocr, sampling, split, tokens

PARTY = "array<struct<name:string,address:string>>"
DE = "Die Welle ist mit dem Lager verbunden und wird durch eine Feder gehalten, damit kein Öl austreten kann. Zum Öffnen schwenkt man den größten Deckel gegen die Stange, bis das Rad frei liegt. "
FR = "Le couvercle est relié à la bielle par une lame flexible, afin d'éviter toute fuite d'huile. Pour ouvrir, on pousse le levier contre la plaque jusqu'à ce que la roue soit dégagée. "


def predictions(spark, people, addresses_=()):
    """A table with each name as an inventor, and clashing column names."""
    rows = [(i, ([(n, None)], None)) for i, n in enumerate(people)] + [(99, ([(None, a) for a in addresses_], []))] + [(100, None), (101, (None, [None]))]
    df = spark.createDataFrame(rows, f"rec_id long, prediction struct<inventors:{PARTY},assignees:{PARTY}>")
    return df.withColumn("name", F.lit("clash")).withColumn("core", F.lit(1)).withColumn("node", F.lit("x"))


def test_name_pairs(spark):
    one = ["Viktor Krassenner", "KRASSENNER Viktor", "V. Krassenner", "Krassener, Viktor", " Viktor Krassenner ", "Viktor Krassenner"]
    other = ["Otto Krassenner", "Dr. Otto Krassenner", "Gebrüder Krassenner", "Gebr. Krassenner", "  ", None, "..."]
    got = {tuple(r) for r in names.name_pairs(predictions(spark, one + other)).collect()}
    a = sorted({x.strip() for x in one})
    want = {(x, y) for x in a for y in a if x < y} | {("Dr. Otto Krassenner", "Otto Krassenner"), ("Gebr. Krassenner", "Gebrüder Krassenner")}
    assert got == want
    assert names.name_pairs(predictions(spark, []).limit(0)).count() == 0


def test_frequent_misspellings_link_in_any_layout(spark):
    def layouts(core, times):
        return [x for x in (f"{core}, Emil", f"Emil {core}", f"{core.upper()} Emil", f"Dr. Emil {core}") for _ in range(times)]

    # ten times as rare: a misspelling, whatever its layouts; as frequent and no rare sequence: two names
    others = [f"Emil {a}{b}" for a in ("Hölti", "Bilti", "Rolti", "Gulti", "Sulti") for b in ("melin", "menin", "mekor", "mefal")]
    got = {tuple(r) for r in names.name_pairs(predictions(spark, layouts("Krönzhofer", 10) + layouts("Krönzhfer", 1) + layouts("Höltimelin", 3) + layouts("Höltimenin", 3) + others)).collect()}
    assert ("Emil Krönzhfer", "Emil Krönzhofer") in got and ("Dr. Emil Krönzhofer", "Krönzhfer, Emil") in got
    assert ("Emil Höltimelin", "Emil Höltimenin") not in got


def test_ambiguous_initials_link_to_no_one(spark):
    got = {tuple(r) for r in names.name_pairs(predictions(spark, ["Johann Sifosoz", "Josef Sifosoz", "J. Sifosoz"])).collect()}
    assert got == set()


def recall_and_precision(got, want):
    return len(got & want) / len(want), len(got & want) / len(got)


def test_names_outside_every_list(spark):
    random.seed(11)
    given = "Sophie Lorenz Felix Hugo Regula Urs Silvia Dominik Nadine Beat Cornelia Gilbert".split()
    assert not {edits.fold(g) for g in given} & set(names._GIVEN_OF)
    people, want, taken = [], set(), set()
    while len(people) < 150:
        family = random.choice("B D F G K L M N P R S T V W Z Br Kr Schl Tr".split()) + "".join(random.choice(("al", "en", "ir", "ot", "um", "ack", "est", "inz")) + random.choice("bdfglmnrst") for _ in range(2)) + random.choice(("er", "li", "mann", "hofer"))
        if family not in taken:
            taken.add(family)
            people.append((random.choice(given), family))
    for g, f in people:
        at = random.randint(2, len(f) - 2)
        wrong = f[:at] + random.choice("xqy") + f[at + 1 :]
        forms = {f"{g} {f}", f"{f} {g}", f"{f}, {g}", f"Dr. {g} {f}", f"{g[0]}. {f}", f"{f.upper()} {g}", f"{g} {wrong}"}
        want |= {(x, y) for x in forms for y in forms if x < y}
    got = {tuple(r) for r in names.name_pairs(predictions(spark, sorted({x for p in want for x in p}))).collect()}
    recall, precision = recall_and_precision(got, want)
    assert recall >= 0.9 and precision >= 0.95, (recall, precision)


def test_links_follow_chains_to_their_end(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(37)] + [(100, 101)], "node long, up long")
    got = {r["node"]: r["up"] for r in names.follow(df).collect()}
    assert got == {**{i: 37 for i in range(37)}, 100: 101}


def test_companies_of_unknown_kind(spark):
    got = {tuple(r) for r in names.name_pairs(predictions(spark, ["Giesserei Thalmeier Bernau", "Bernau Giesserei Thalmeier", "Giess. Thalmeier Bernau", "Giesserei Korbander Bernau"])).collect()}
    one = sorted(["Giesserei Thalmeier Bernau", "Bernau Giesserei Thalmeier", "Giess. Thalmeier Bernau"])
    assert got == {(x, y) for x in one for y in one if x < y}


def test_address_pairs(spark):
    door = ["Pfergelgasse 102, Bellinstetten (Schweiz)", "Bellinstetten, Pfergel-Gasse No. 102", "Pfergelg. 102, CH-2289", "102, Pfergelgasse, 2289 Bellinstetten", "Pfergellgasse 102 Bellinstetten"]
    rest = ["Pfergelgasse 102a, Bellinstetten (Schweiz)", "Pfergelgasse 103, Bellinstetten (Schweiz)", "Bellinstetten (Schweiz)", "CH-2289 Bellinstetten", "Wolfacker", None, " ", "Pfergelgasse 102, Wolfacker (Schweiz)"]
    got = {tuple(r) for r in addresses.address_pairs(predictions(spark, [], door + rest)).collect()}
    a = sorted(door)
    assert got == {(x, y) for x in a for y in a if x < y} | {("Bellinstetten (Schweiz)", "CH-2289 Bellinstetten")}
    assert addresses.address_pairs(predictions(spark, []).limit(0)).count() == 0


def test_streets_outside_every_list(spark):
    random.seed(3)
    kinds = ["allee", "steig", "damm", "ufer", "quai", "hof"]
    assert not set(kinds) & (set(addresses.ENDINGS) | set(addresses.BEFORE))
    towns = ["Bellin", "Orstetten", "Wolfacker", "Krumbach"]

    def stem():
        return random.choice(("Kitt", "Tromp", "Salv", "Birk", "Nord", "Gelf", "Pran")) + random.choice(("al", "en", "or", "ust", "ick")) + random.choice(("er", "in", "berg", "ot"))

    want, doors = set(), set()
    while len(doors) < 120:
        doors.add((stem(), random.choice(kinds), random.randint(1, 40), random.choice(towns)))
    seen: dict = {}
    for street, kind, n, town in sorted(doors):
        at = random.randint(1, len(street) - 2)
        wrong = street[:at] + "x" + street[at + 1 :]
        forms = {f"{n}, {street}{kind}, {town}", f"{street}-{kind.title()} {n}, {town}", f"{town}, {street} {kind.title()} Nr. {n}", f"{wrong}{kind} {n}, {town} (Schweiz)", f"{street}{kind} {n} {town}"}
        seen[street, kind, n, town] = forms
        want |= {(x, y) for x in forms for y in forms if x < y}
    got = {tuple(r) for r in addresses.address_pairs(predictions(spark, [], sorted({x for p in want for x in p}))).collect()}
    recall, precision = recall_and_precision(got, want)
    assert recall >= 0.9 and precision >= 0.95, (recall, precision)


def test_bare_places_make_no_group_and_kinds_contradict(spark):
    rows = ["Pfergelgasse 7, Bellin", "Pfergelweg 7, Bellin", "Pfergelgasse 7, Orstetten", "Pfergelgasse 7", "Kittallee 12", "12, Kittallee, Bellin", "Bellin", "Orstetten", "8", "8, 9"]
    assert {tuple(r) for r in addresses.address_pairs(predictions(spark, [], rows)).collect()} == {("12, Kittallee, Bellin", "Kittallee 12")}


def texts(spark, values, key="id", column="t"):
    return spark.createDataFrame(list(enumerate(values)), f"{key} long, {column} string").withColumn("_text", F.lit("clash")).withColumn("k", F.lit(7))


def test_pieces_cover_their_texts(spark):
    random.seed(1)
    values = [None, "", "short", "".join(random.choices(["word ", "w\n", "\n\n", "xxxxxxxxxx"], k=900)), "x" * 3000, "字 " * 1500]
    whole = None
    for range_chars in (500, 1 << 20):
        got = split.pieces(texts(spark, values), "id", "t", 300, 40, range_chars).collect()
        for i, t in enumerate(values):
            own = sorted((r for r in got if r["id"] == i), key=lambda r: r["piece_no"])
            if t is None:
                assert own == []
                continue
            assert own[0]["start"] == 0 and own[-1]["start"] + own[-1]["length"] == len(t) and max(r["length"] for r in own) <= 300
            assert all(b["start"] == a["start"] + a["length"] - 40 for a, b in zip(own, own[1:]))
            assert all(r["piece"] == t[r["start"] : r["start"] + r["length"]] for r in own)
        rows = sorted(map(tuple, got))
        assert whole in (None, rows)  # the same by ranges and in one
        whole = rows
    for wrong in ((300, 200, 500), (300, 40, 200)):
        with pytest.raises(ValueError):
            split.pieces(texts(spark, values), "id", "t", *wrong)


def test_files_by_byte_ranges(spark, tmp_path):
    random.seed(2)
    values = ["", "short é", "字é word\n" * 900, "".join(random.choices(["wörd ", "wé\n", "\n\n", "字" * 10], k=2500))]
    for i, t in enumerate(values):
        (tmp_path / f"{i} f.txt").write_text(t, encoding="utf-8")
    got = split.file_pieces(spark, str(tmp_path), 300, 40, 1_501)
    assert got.select("path").distinct().count() == 3  # an empty file isn't read
    want = {tuple(r) for r in split.pieces(texts(spark, values), "id", "t", 300, 40).collect() if r["id"]}
    assert {(int(r["path"].split("/")[-1][0]), *r[1:]) for r in got.collect()} == want
    units = {int(r["path"].split("/")[-1][0]): r["boundary"] for r in split.file_boundary_units(spark, str(tmp_path), 300, 1_501).collect()}
    assert units == {r["id"]: r["boundary"] for r in split.boundary_units(texts(spark, values), "id", "t", 300).collect()}


def test_units(spark):
    values = [None, "", "x" * 50, "a\n\n" + "b " * 30, "a\n" * 40, "x" * 200]
    for range_chars in (45, 1 << 20):
        got = {r["id"]: r["boundary"] for r in split.boundary_units(texts(spark, values), "id", "t", 40, range_chars).collect()}
        assert got == {2: "none", 3: "word", 4: "line", 5: "none"}


def test_ids(spark):
    import os

    if not os.path.exists(tokens.VOCABULARY):
        pytest.skip("no vocabulary here")
    own = tokens.encoder(tokens.VOCABULARY)
    values = [None, "", DE * 40, DE * 40, "  ", FR * 30 + DE * 40, "<|endoftext|>"]
    got = {r["id"]: r["ids"] for r in tokens.encode_corpus(texts(spark, values), "id", "t", spacing=64).collect()}
    assert got == {i: own.encode_ordinary(t or "") for i, t in enumerate(values)}
    assert tokens.encode_corpus(texts(spark, values).limit(0), "id", "t").count() == 0


def test_leaks(spark):
    item = " ".join(f"word{i}" for i in range(40))
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "too short")], "item_id long, text string").withColumn("words", F.lit(0))
    docs = texts(spark, ["intro " + item.upper().replace("WORD7 ", "odd "), "word1 word2 word3", None, "", " ".join(item.split()[:12])])
    rows = set()
    for held in (1_000_000, 40):  # sent to the workers, and joined by shuffle
        got = leakage.leaks(docs, items, "id", "t", held_words=held, filter_bits=1 << 12).collect()
        assert {(r["id"], r["item_id"]) for r in got} == {(0, 1), (0, 2)} and len(got) == 2
        rows.add(tuple(sorted((r["id"], r["item_id"], r["words"], round(r["agreement"], 9)) for r in got)))
    assert len(rows) == 1
    assert leakage.leaks(docs.limit(0), items, "id", "t", held_words=1).count() == 0
    assert leakage.leaks(docs, items.limit(0), "id", "t").count() == 0 == leakage.leaks(docs.limit(0), items, "id", "t").count()


def test_recall_of_changed_passages(spark):
    random.seed(4)
    vocabulary = ["".join(random.choices("abcdefghilmnoprstu", k=random.randint(3, 9))) for _ in range(1500)]
    weights = [1 / (i + 3) for i in range(1500)]

    def draw(n):
        return random.choices(vocabulary, weights, k=n)

    items = [draw(70) for _ in range(60)]
    docs, want = [], set()
    for i in range(240):
        item, at, changed = random.randrange(60), random.randrange(30), i % 3
        passage = items[item][at : at + 26]
        for place in random.sample(range(3, 23), changed):
            passage[place] = random.choice(vocabulary)
        docs.append(" ".join(draw(40) + passage + draw(40)))
        want.add((i, item))
    docs += [" ".join(draw(80) + items[i % 60][10:22] + draw(30)) for i in range(60)]  # too short
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {held: {(r["id"], r["item_id"]) for r in leakage.leaks(texts(spark, docs), table, "id", "t", held_words=held).collect()} for held in (10**6, 0)}
    recall, precision = recall_and_precision(got[0], want)
    assert got[0] == got[10**6] and recall >= 0.9 and precision >= 0.95, (recall, precision)


def test_wrong_encoding(spark):
    broken = DE.encode().decode("cp1252"), DE.encode("cp1252").decode("mac_roman"), "Das R�d", FR.encode("cp1252").decode("cp1251")
    values = [DE] * 30 + [FR] * 30 + list(broken) + [None, "", "plain", "Завод Триволь указан.", "Die M&uuml;hle läuft.", "São Ø Å ≈"]
    docs = texts(spark, values).withColumn("source", F.when(F.col("id") % 2 == 0, "s")).withColumn("letter", F.lit("clash"))
    got = {r["id"] for r in encoding.affected(docs, "id", "t").collect()}
    assert got == {60, 61, 62, 63}
    fixed = {r["id"]: r for r in encoding.restore(docs, "id", "t").collect()}
    assert fixed[60]["restored"] == DE and fixed[61]["restored"] == DE and fixed[62]["lost"] == 1
    assert encoding.affected(docs.limit(0), "id", "t").count() == 0


UMLAUTS = "Der Träger hält die Wärme, die Räder fällen den Zähler nicht, die Schwäche wäre größer, die Wände lägen höher, könnte man öfter für die Hülse fühlen, müßte die Büchse über die Kühlung führen, löst, stößt, öffnet man die Röhre. "


def test_pages_outside_the_list_are_learned(spark):
    assert "cp1253" not in encoding.PAGES
    broken = [UMLAUTS.encode("cp1252").decode("cp1253")] * 3
    values = [UMLAUTS] * 60 + [FR] * 40 + broken + ["Der Fluß Αλφα heißt Ωμεγα."]
    docs = texts(spark, values).withColumn("source", F.when(F.col("id").between(100, 102), "greek").otherwise("s"))
    fixed = {r["id"]: r["restored"] for r in encoding.restore(docs, "id", "t").collect()}
    assert set(fixed) == {100, 101, 102}
    wrong = [a for a, b in zip(fixed[100], UMLAUTS) if a != b]
    assert len(fixed[100]) == len(UMLAUTS) and len(wrong) <= 9  # ß, and ö and ü beside it, have too few neighbours here
    assert encoding.restore(docs, "id", "t", learn=False).count() == 0  # nothing but learning finds them


def test_learning_decides_between_letters_of_one_symbol(spark):
    # one symbol is one letter read from one page, another letter read from another page; the place can't tell
    assert {"ä", "è"} <= set(encoding.swaps()["Š"])
    plain = ["die Wäb e Häl"] * 30 + ["la Wèb e tèl"] * 30 + ["das Kät und Häl"] * 20
    odd = ["so Häl Kät Häl Wäb".replace("ä", "Š")]
    docs = texts(spark, plain + odd).withColumn("source", F.when(F.col("id") < 80, "s").otherwise("mac"))
    fixed = [r["restored"] for r in encoding.restore(docs, "id", "t").collect()]
    blind = [r["restored"] for r in encoding.restore(docs, "id", "t", learn=False).collect()]
    assert fixed == ["so Häl Kät Häl Wäb"] and blind != fixed


def test_translation():
    assert encoding.translated("a‰b‰cÃ¤", [(1, "‰", "ä"), (3, "‰", "ä"), (5, "Ã¤", "ä")]) == "aäbäcä"
    assert encoding.translated("a‰b‰c", [(3, "‰", "ä")]) == "a‰bäc" and encoding.translated("x\ufffdy", [(1, "\ufffd", None)]) == "x\ufffdy"


def test_relabelled(spark):
    rows = [(i, DE * 3, "de", (1,)) for i in range(8)] + [(i, FR * 3, "fr", (1,)) for i in range(10, 18)]
    rows += [(20, DE * 2, "FR", (1,)), (21, DE * 2, None, (1,)), (22, DE * 2, "german", (1,)), (23, DE * 2 + "\n\n" + FR * 2, "de-CH", (1,)), (24, DE, "fr", None), (25, "", "xx", (1,)), (26, None, "xx", (1,)), (27, DE, "und", (1,))]
    df = spark.createDataFrame(rows, "rec_id long, ocr_text string, lang string, prediction struct<a:int>").withColumn("seg_no", F.lit("clash"))
    got = sorted((r["rec_id"], r["seg_no"], r["lang"]) for r in language.relabelled(df).collect())
    assert got == [(20, 1, "de"), (21, 1, "de"), (23, 1, "de"), (23, 2, "fr"), (27, 1, "de")]


def test_relabelled_within_a_line(spark):
    rows = [(i, DE * 3, "de", (1,)) for i in range(8)] + [(i, FR * 3, "fr", (1,)) for i in range(10, 18)] + [(20, DE * 3 + FR * 2, "de", (1,))]
    df = spark.createDataFrame(rows, "rec_id long, ocr_text string, lang string, prediction struct<a:int>")
    got = sorted((r["rec_id"], r["seg_no"], r["lang"]) for r in language.relabelled(df).collect())
    assert got == [(20, 1, "de"), (20, 2, "fr")]


def test_profiles_of_short_and_of_long_texts(spark):
    short = ["Die Welle ist mit dem Lager verbunden", "wird durch eine Feder gehalten", "damit kein Öl austreten kann", "Zum Öffnen schwenkt man den Deckel"]
    rows = [(i, FR * 3, "fr") for i in range(8)] + [(10 + i, t, "de") for i, t in enumerate(short)] + [(20, FR * 150 + "xyz" * 50, "fr"), (21, None, "de"), (22, "", "de")]
    df = spark.createDataFrame(rows, "rec_id long, t string, lang string")
    ranks = language.profiles_of(df, "t", "lang")
    got = language.segments_of([DE * 2, FR * 2], ranks)
    assert [[language.LANGUAGES[k] for k, _, _ in s] for s in got] == [["de"], ["fr"]]
    x, y, z = (language._SYMBOLS.index(c) + 1 for c in "xyz")
    assert ranks[1][(x << 12) | (y << 6) | z] < language.LENGTH  # stands behind the first 20,000 characters


def test_defects_and_paragraphs(spark):
    page = "Die Welle ist mit dem Lager ver-\n\n— 2 —\n\nbunden und wird durch eine Feder gehalten."
    values = [DE] * 30 + [page, page, None, "", "  \n", DE.replace("durch", "dureh")]
    df = texts(spark, values).withColumn("line_no", F.lit("clash"))
    got = sorted((r["id"], r["line_no"], r["defect"]) for r in ocr.defects(df, "id", "t").collect())
    assert got == [(30, 1, "hyphen"), (30, 3, "running"), (31, 1, "hyphen"), (31, 3, "running"), (35, 1, "misread")]
    whole = {r["id"]: r["paragraph"] for r in ocr.paragraphs(df, "id", "t").collect()}
    assert whole[30] == "Die Welle ist mit dem Lager verbunden und wird durch eine Feder gehalten." and 32 not in whole
    assert ocr.defects(df.limit(0), "id", "t").count() == 0


def test_lexicon_has_a_bound(spark):
    df = texts(spark, [f"common word{i % 40} rare{i}" for i in range(400)] + [None, ""])
    words, total, share = ocr.lexicon_of(df, "t")
    assert total == 400 and share == ocr.SHARE and words["common"] == 400 and words["word1"] == 10 and "rare1" not in words
    few, _, raised = ocr.lexicon_of(df, "t", most=5)
    assert few == {"common": 400} and raised > share


def test_a_lexicon_in_parts_gives_the_same_rows(spark):
    words = "Stahl Bohrgestell Federring Bremsring Federrad Deckelrad verbunden Bremsgestell".split()
    plain = [f"{DE}Der {words[i % 8]} und der {words[(i + 3) % 8]} liegen frei, weil die Stange sie hält.\n{FR}" for i in range(400)]
    odd = [
        DE.replace("durch", "dureh"), "Die Stange ist aus 5tahl.", "Das 8ohrgestell liegt frei und das Bremsrinq auch.", "Der Deckelrinq liegt bei dem 8remsrad frei.",
        "Die Welle ist mit dem Lager ver-\n\n— 2 —\n\nbundcn und wird durch eine Feder gehalten.", "Die Welle ist mit dem Lager ver\nbunden und das Rad liegt frei.",
        "Die Stange ist aus 5ta-\nhl und das Rad liegt frei.", "Der Ein- und\nDeckel liegt frei, den Ein-\nund das Rad.", None, "", "  \n", "x", "K" * 60, DE.replace("durch", "dureh"),
    ]
    keys = "id + 1152921504606846977 AS word"  # not exact as a float
    df = texts(spark, plain + odd).selectExpr(keys, "t AS chunk").repartition(5)
    found = [tuple(r) for r in ocr.defects(df, "word", "chunk").collect()]
    assert {kind for _, _, kind in found} == {"hyphen", "misread", "running"} and len({k for k, _, kind in found if kind == "misread"}) >= 7
    whole = [tuple(r) for r in ocr.paragraphs(df, "word", "chunk").collect()]
    for most in (20, 3):
        assert sorted(map(tuple, ocr.defects(df, "word", "chunk", most=most).collect())) == sorted(found)
        assert sorted(map(tuple, ocr.paragraphs(df, "word", "chunk", most=most).collect())) == sorted(whole)
    assert ocr.defects(df, "word", "chunk", most=3).schema == ocr.defects(df, "word", "chunk").schema


def test_confusions_of_a_table_of_words(spark):
    random.seed(9)
    proper = {"".join(random.choices("abcdefghilmnoprstuzäß", k=random.randint(5, 9))): random.randint(2, 400) for _ in range(600)}
    wrong = {w[:1] + w[1:-2].replace("z", "x", 1) + w[-2:]: 3 for w in proper} | {w.replace("b", "8").replace("m", "rn").capitalize(): 2 for w in proper} | {"s" * 30: 2, "a": 9}
    words = proper | wrong
    got = ocr.confusions_of(spark.createDataFrame(list(words.items()), "word string, n bigint"))
    assert got == ocr.learned_confusions(words) and "z" in got["x"]


def test_bounded_samples(spark):
    df = texts(spark, ["same"] * 500 + [str(i) for i in range(500)] + [None])
    got = sampling.bounded(df, "t", 50)
    assert len(got) <= 50 and len(set(got)) == len(got) and got == sampling.bounded(df.repartition(7), "t", 50)
