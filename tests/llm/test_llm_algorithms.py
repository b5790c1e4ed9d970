"""The algorithms of this subpackage against brute force, round trips and planted cases."""

import itertools
import random

import numpy as np
import pytest

from vellumine.llm import edits, encoding, language, leakage, names, ocr, split, tokens
from vellumine.llm.addresses import read_address

DE = "Die Welle ist mit dem Lager verbunden und wird durch eine Feder gehalten, damit kein Öl austreten kann. Zum Öffnen schwenkt man den Deckel gegen die Stange, bis das Rad frei liegt. "
FR = "Le couvercle est relié à la bielle par une lame flexible, afin d'éviter toute fuite d'huile. Pour ouvrir, on pousse le levier contre la plaque jusqu'à ce que la roue soit libre. "
EN = "The shaft is connected to the bearing and is held by a spring, so that no oil can escape. To open it, the cover is swung against the rod until the wheel is free, without further adjustment. "
IT = "Il coperchio è unito alla biella mediante una lama flessibile, affinché l'olio non possa uscire. Per aprire si spinge la leva contro la piastra finché la ruota sia libera. "


def plain_distance(a, b):
    rows = {}
    for i in range(-1, len(a)):
        for j in range(-1, len(b)):
            if min(i, j) < 0:
                rows[i, j] = max(i, j) + 1
                continue
            best = min(rows[i - 1, j] + 1, rows[i, j - 1] + 1, rows[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                best = min(best, rows[i - 2, j - 2] + 1)
            rows[i, j] = best
    return rows[len(a) - 1, len(b) - 1] if a and b else max(len(a), len(b))


def test_distance_and_neighbourhood():
    random.seed(1)
    for _ in range(400):
        a = "".join(random.choices("abcd", k=random.randint(0, 7)))
        b = "".join(random.choices("abcd", k=random.randint(0, 7)))
        d = plain_distance(a, b)
        assert edits.distance(a, b) == min(d, 3)
        if d <= 2:
            assert edits.neighbourhood(a, 2) & edits.neighbourhood(b, 2)


@pytest.mark.parametrize(
    "left,right",
    [("Viktor Krässenner", "KRAESSENNER Viktor"), ("Dipl.-Ing. V. Krässenner", "V. Krässenner"), ("Krässenner, Viktor E.", "Viktor E. Krässenner"), ("Uhrenfabr. Büfundäli", "Uhren-Fabrik Büfundäli A.-G."),
     ("Herr Chas. Fenerson", "Charles Fenerson"), ("Bill Sifosoz", "William Sifosoz"), ("F.lli Dickalbach", "Fratelli Dickalbach"), ("Pfimmal&Cie.", "Pfimmal und Compagnie")],
)
def test_names_of_one_form(left, right):
    kind, bag = names.read_name(left)[:2]
    assert kind == names.read_name(right)[0]
    assert names.align(*([names.Token(t) for t in names.read_name(n)[1]] for n in (left, right))) is not None and bag


def aligned(left, right, common=()):
    def read(tokens):
        return [names.Token(t, common=t in common, lead=i == 0) for i, t in enumerate(tokens)]

    return names.align(read(left), read(right))


def test_name_parts():
    assert sorted(names.read_name("A1bert Gürga1er")[1]) == ["albert", "gurgaler"]
    assert names.read_name("...")[1] == [] and names.read_name("X")[1] == ["x"]
    assert names.read_name("Krass, Soph.")[1:] == (["krass", "soph."], [], ["krass"]) and names.read_name("Thalmeier L.")[2:] == ([], ["thalmeier"])
    assert aligned(["karl", "e", "moser"], ["k", "ernst", "moser"], ("karl", "ernst"))[0] < 1 and aligned(["karl", "moser"], ["josef", "moser"]) is None
    assert aligned(["k", "moser"], ["otto", "karl", "moser"]) is None  # the leading name isn't a later one
    assert aligned(["karl", "moser"], ["karl", "mosar"], ("karl",)) == (0.4, 1) and aligned(["karl", "moser"], ["karl", "huber"], ("karl",)) is None
    assert names.shortened("wm", "william") and names.shortened("chas", "charles") and not names.shortened("karl", "kaspar")


def test_assignment_by_brute_force():
    random.seed(5)
    for _ in range(300):
        rows = random.randint(1, 5)
        costs = [[random.choice((0.0, 0.1, 0.2, 0.4, 0.8, 9.0)) for _ in range(random.randint(rows, 7) if not i else 0)] for i in range(1)]
        columns = len(costs[0])
        costs += [[random.choice((0.0, 0.1, 0.2, 0.4, 0.8, 9.0)) for _ in range(columns)] for _ in range(rows - 1)]
        got = names.assignment(costs)
        assert len(set(got)) == rows
        best = min(sum(costs[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(columns), rows))
        assert abs(sum(costs[i][j] for i, j in enumerate(got)) - best) < 1e-9


@pytest.mark.parametrize(
    "address,want",
    [("Pfergel-Gasse No. 102a, Bellin (Suisse)", ("102a", "gasse", "pfergel", "bellin", "")), ("12, avenue Kitt, FR-2120", ("12", "avenue", "kitt", "", "2120")), ("CH-1583 Bellin, v.le Stass 66", ("66", "viale", "stass", "bellin", "1583")),
     ("Bellin/Switzerland", ("", "", "", "bellin", "")), ("107 Sattin Street, Bellin (England)", ("107", "street", "sattin", "bellin", "")), ("", ("", "", "", "", ""))],
)
def test_addresses(address, want):
    assert read_address(address) == want


def test_seed_masks_tolerate_four_changes():
    masks = [sum(1 << (s + o) for o in m) for m in leakage.MASKS for s in range(20 - m[-1])]
    for changed in itertools.combinations(range(20), 4):
        hit = sum(1 << c for c in changed)
        assert any(not m & hit for m in masks)


def test_passages_by_brute_force():
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(random.choices(words, k=60))) for i in range(30)]
    block = leakage._Items.of_texts(items)
    texts, want = [], set()
    for n in range(60):
        body = random.choices(words, k=80)
        if n % 3 == 0:
            item, text = random.choice(items)
            at = random.randint(0, 30)
            part = text.split()[at : at + random.choice([26, 30])]
            part[7] = "changed"
            part[15] = "other"
            body[40:40] = [w.upper() + "," for w in part]
            want.add((n, item))
        elif n % 3 == 1:  # too short
            body[10:10] = random.choice(items)[1].split()[:12]
        texts.append(" ".join(body))
    got = {(t, i) for t, i, n, _ in leakage.find_passages(texts, block) if n >= leakage.LEAST}
    assert got == want


def test_passage_across_line_breaks():
    text = "Der Deckel sitzt auf der Achse und wird vom Rad " * 3
    item = [(1, "Die Größe des Rades bestimmt den Weg der Kurbel; sie läuft über zwölf Zähne, bevor das Seil die grüne Klappe am Gehäuse öffnet und schließt.")]
    body = item[0][1].replace("Zähne", "Zäh-\nne").replace("Größe", "Groesse").replace("über", "ÜBER")
    assert [x[:2] for x in leakage.find_passages([text + body, text, "", None], leakage._Items.of_texts(item))] == [(0, 1)]


def test_token_parts_concatenate():
    random.seed(2)
    texts = [EN * 30, " " * 50, "a", "", "字" * 3000, "x  y\n\n z \t" * 200, "don't <|endoftext|> " * 99, "ab" * 5000, "é è " * 700, "\ud800 odd " * 50]
    texts += ["".join(random.choices("ab  \n字é'1", k=3000)) for _ in range(20)]
    for t in texts:
        for spacing in (16, 512):
            assert "".join(s for _, s in tokens.parts(t, tokens.cores([t], spacing)[0])) == t


def test_tokens_exact():
    import os

    if not os.path.exists(tokens.VOCABULARY):
        pytest.skip("no vocabulary here")
    own = tokens.encoder(tokens.VOCABULARY)
    random.seed(5)
    texts = [EN * 9 + FR * 7, "x  y\n\n z \t" * 200, "字" * 900 + " " + "ab" * 900, " leading", "trailing  ", "\n x" + EN * 3, EN * 3 + "x \n"]
    texts += ["".join(random.choices("ab  \n字é'1s.", k=2000)) for _ in range(30)]
    assert tokens.cores(texts, 32) == [tokens.cores([t], 32)[0] for t in texts]
    for t in texts:
        assert [i for _, s in tokens.parts(t, tokens.cores([t], 32)[0]) for i in own.encode_ordinary(s)] == own.encode_ordinary(t)


def test_languages_held_out():
    rows = [(c, t * 3) for c, t in (("de", DE), ("fr", FR), ("it", IT), ("en", EN)) for _ in range(5)]
    ranks = language.fit_profiles(rows + [("de", FR * 3)])
    texts = [DE, EN + "\n\n" + FR.replace(". ", ".\n") + FR, "", "   ", "123 456", IT.replace(" ", "\n")]
    got = [[language.LANGUAGES[k] for k, _, _ in s] for s in language.segments_of(texts, ranks)]
    assert got[0] == ["de"] and got[1] == ["en", "fr"] and got[2] == got[3] == [] and got[5] == ["it"]
    assert [language.named(x) for x in ("FR-ch", "german", "und", "", None, "ES")] == ["fr", "de", None, None, None, "es"]


def test_languages_within_a_line():
    ranks = language.fit_profiles([(c, t * 3) for c, t in (("de", DE), ("fr", FR), ("it", IT), ("en", EN)) for _ in range(5)])
    texts = [DE * 3 + FR * 3, (EN + IT + DE).replace(". ", ".  "), "Fig. 1\n" + FR * 2 + EN * 2 + "\n\n" + EN, DE * 200, ""]
    got = language.segments_of(texts, ranks)
    assert [[language.LANGUAGES[k] for k, _, _ in s] for s in got] == [["de", "fr"], ["en", "it", "de"], ["fr", "en"], ["de"], []]
    assert [sum(n for _, n, _ in s) for s in got] == [len(t.split()) for t in texts]
    assert abs(got[0][0][1] - len((DE * 3).split())) <= 2 * language.BLOCK


def lexicon():
    words = {w: 400 for w in (DE + " " + FR).replace(",", "").replace(".", "").split()}
    return ocr.Lexicon(words | {"Zeichnung": 300, "Ein": 50, "und": 900, "Unterteil": 90, "gehalten": 200})


def test_line_defects():
    head = "BESCHREIBUNG ZUM PATENT\n\nNr. 20536\nKlasse 31 f\n\nAngemeldet am 21.3.1901\nErfinder: Karl Erb, Altis (Schweiz)\n\nDeckel für Fässer\n\n"
    body = "Die Welle ist mit dem Lager ver-\n\n— 2 —\nNr. 20536\n\nbunden und wird dureh eine Feder\ngehalten, damit kein Ein- und\nUnterteil frei liegt. Der De-\nckel liegt.\n8,5\n59\n27,9\n\nDECKEL FÜR FÄSSER\nZum Öffnen schwenkt man den Ein-\nund das Rad."
    text = head + body
    lines = text.split("\n")
    at = lambda s: lines.index(s) + 1
    words = lexicon()
    words.words["verbunden"] = words.words["deckel"] = 300
    got = ocr.line_defects(text, ocr.LineModel(), words)
    assert got == sorted([
        (at("Die Welle ist mit dem Lager ver-"), "hyphen"), (at("— 2 —"), "running"), (len(head.split("\n")) + 3, "running"), (at("bunden und wird dureh eine Feder"), "misread"),
        (at("Unterteil frei liegt. Der De-"), "hyphen"), (at("DECKEL FÜR FÄSSER"), "running"),
    ])
    joined = " ".join(ocr.repaired(text, ocr.LineModel(), words))
    assert "Lager verbunden und wird durch eine Feder gehalten" in joined and "— 2 —" not in joined


def test_words_with_a_misread_first_letter():
    assert ocr._WORD.findall("5tahl 9mm 15tahl 2,5mal x5tahl 1a 7ahn") == ["5tahl", "9mm", "tahl", "mal", "x5tahl", "a", "ahn"]
    words = {w: 400 for w in DE.replace(",", "").replace(".", "").split()} | {"Stahl": 300, "seine": 90, "Bund": 90, "Bohrgestell": 300, "sie": 90}
    own = ocr.Lexicon(words)
    assert [own.correction(w) for w in ("5tahl", "1iegt", "0effnen", "8ohrgestell", "6und", "5eine", "9mm", "5TAHL")] == ["Stahl", "liegt", None, "Bohrgestell", None, None, None, None]
    text = "Die Welle ist mit dem Lager aus 5tahl verbunden.\nDas Rad 1iegt frei und die Stange 6und das Rad\nsind mit der 5tange ver-\nbunden aus 5ta-\nhl. Das Rad liegt frei."
    assert [n for n, kind in ocr.line_defects(text, ocr.LineModel(), own) if kind == "misread"] == [1, 2, 3, 4]
    assert "Lager aus Stahl verbunden. Das Rad liegt frei und die Stange 6und das Rad" in " ".join(ocr.repaired(text, ocr.LineModel(), own))


def test_verdicts_at_any_number_of_texts():
    words = {"Stange": 30, "Hebel": 400, "Feder": 300, "Kolbenring": 40, "Kolbenrad": 40, "Federring": 40, "Bremsring": 40}
    wrong = ("Stanqe", "Hebei", "Fedcr", "Kolbenrinq", "Bremsrad", "Bremsrinq")
    small = [ocr.Lexicon(words, total=20_000).correction(w) for w in wrong]
    assert small == ["Stange", "Hebel", "Feder", "Kolbenring", None, "Bremsring"]
    for k in (25, 800):
        large = {w: n * k for w, n in words.items()}
        assert [ocr.Lexicon(large, total=20_000 * k).correction(w) for w in wrong] == small
    # words that may be in 24 texts aren't misread because others are in 25 or in 400
    large = ocr.Lexicon(words, total=500_000)
    assert ocr.floor(500_000) == 25 and [large.correction(w) for w in wrong] == [None] * 6
    assert ocr.floor(1_999) == ocr.floor(2_001) == 2


def test_line_defects_of_odd_texts():
    words = lexicon()
    for text in ("", "\n\n", "x", "Il1" * 5000, "-\n-\n", "a" * 20_000 + "-\nb"):
        assert isinstance(ocr.line_defects(text, ocr.LineModel(), words), list)
    assert ocr.fit_lines([]).label("x_Px") == "SRRB" and ocr.LineModel().label_all(["", "x", "x_Px"]) == ["", ocr.LineModel().label("x"), "SRRB"]


def test_line_model_decodes_like_brute_force():
    random.seed(6)
    model = ocr.LineModel()
    looks = ["".join(random.choices(ocr.LOOKS, k=random.randint(1, 5))) for _ in range(40)]
    for own, got in zip(looks, model.label_all(looks)):
        def score(path):
            at = [ocr.STATES.index(s) for s in path]
            seen = [ocr.LOOKS.index(x) for x in own]
            return ocr._FIRST_STATE[at[0]] + sum(model.emit[k, x] for k, x in zip(at, seen)) + sum(model.move[a, b] for a, b in zip(at, at[1:]))

        assert score(got) >= max(score(p) for p in itertools.product(ocr.STATES, repeat=len(own))) - 1e-9


def test_model_tells_paragraphs_and_running_heads():
    line = "Die Welle ist mit dem Lager verbunden und wird"
    text = "\n".join([line, line, "gehalten.", "Das Rad liegt frei neben der Stange und dem Deckel", line, "", "DECKEL FÜR RÄDER", "", "gehalten.", "", line, line])
    words = ocr.Lexicon({w: 100 for w in text.split()})
    got = ocr.repaired(text, ocr.LineModel(), words)
    assert len(got) == 3 and "DECKEL" not in " ".join(got) and got[1].startswith("Das Rad") and got[1].endswith("wird gehalten.")
    assert (7, "running") in ocr.line_defects(text, ocr.LineModel(), words)
    furniture = ocr._EMIT.copy()
    furniture[ocr.STATES.index("R")] = ocr._EMIT[1]  # a model that knows no furniture
    assert (7, "running") not in ocr.line_defects(text, ocr.LineModel(furniture), words)


def test_confusions_are_learned():
    random.seed(9)
    proper = {"".join(random.choices("abcdefghilmnoprstuz", k=8)): 400 for _ in range(400)}
    proper = {w: n for w, n in proper.items() if "z" in w[1:-2]}
    swapped = {w[:1] + w[1:-2].replace("z", "x", 1) + w[-2:]: 3 for w in list(proper)[:40]}
    learned = ocr.learned_confusions(proper | swapped)
    assert "z" in learned["x"] and "e" in learned["c"]  # seen often; believed, and no evidence against it yet
    word = next(iter(swapped))
    fresh = list(proper)[60]
    wrong = fresh[:1] + fresh[1:-2].replace("z", "x", 1) + fresh[-2:]
    assert ocr.Lexicon(proper | swapped, total=1000).correction(wrong) == fresh
    assert ocr.Lexicon(proper, total=1000, confusions=ocr.learned_confusions({})).correction(wrong) is None and word != wrong
    many = {"".join(random.choices("cehilmnorst", k=9)): 4000 for _ in range(20_000)}
    assert "e" not in ocr.learned_confusions(many).get("c", ())  # believed, but it never happens


def test_swapped_pages_round_trip():
    for letter, read, written in (("ä", "cp1252", "utf-8"), ("é", "mac_roman", "cp1252"), ("ö", "cp437", "cp1252"), ("ü", "cp1251", "cp1252")):
        assert letter in encoding.swaps()[letter.encode(written).decode(read)]
    proper = frozenset("äöüéè")
    assert [s[1] for s in encoding.symbols("W" + "ä".encode().decode("cp1252") + "rme Завод größer é", proper)] == ["Ã¤", "ß"]


def brute_unit(text, limit):
    paras, current = [], []
    for line in text.split("\n") + [""]:
        if line.strip():
            current.append(line)
        elif current:
            paras.append("\n".join(current))
            current = []
    for unit, parts in (("paragraph", paras), ("line", text.split("\n")), ("word", text.split())):
        if max(map(len, parts), default=0) <= limit:
            return unit
    return "none"


@pytest.mark.parametrize("range_chars", [7, 50, 1_000])
def test_range_summaries_stitch(range_chars):
    random.seed(7)
    for limit in (10, 30):
        for _ in range(150):
            text = "".join(random.choices(["word ", "longerword ", "\n", "\n \n", "x", "  "], [5, 2, 2, 1, 3, 1], k=random.randint(1, 120)))
            parts = [split._summary(text[a : a + range_chars]) for a in range(0, len(text), range_chars)]
            assert split._unit(parts, limit) == brute_unit(text, limit)


@pytest.mark.parametrize("range_chars", [60, 77, 1_000])
def test_boundary_tables_stitch(range_chars):
    random.seed(8)
    for _ in range(150):
        text = "".join(random.choices(["word ", "longerword ", "\n", "\n \n", "x" * 30, "\n\n\n"], [9, 5, 2, 1, 2, 1], k=random.randint(1, 150)))
        whole = split._Plan(60, 12).add(len(text), split._boundaries(text, "", 60), True)
        run, got = split._Plan(60, 12), []
        for a in range(0, len(text), range_chars):
            own, behind = text[a : a + range_chars], text[a + range_chars : a + range_chars + 60]
            got += run.add(len(own), split._boundaries(own, behind, 60), a + range_chars >= len(text))
        assert got == whole
        for (_, s, e, unit), (_, s2, _, _) in zip(got, got[1:]):
            inner = text[s + 31 : s + 60]
            assert e - s <= 60 and s2 == e - 12 and (unit != "none" or not any(c.isspace() for c in inner[:-1]))


def test_letters_by_expectation():
    rows = [("l", "ä", "W", 90), ("r", "ä", "r", 90), ("l", "é", "r", 50), ("r", "é", "g", 50), ("l", "‰", "W", 1), ("r", "‰", "r", 1)]
    share = encoding._expect([("W", "r", 3)], encoding._Fits(encoding.Bigrams(rows)))
    assert encoding.LETTERS[int(np.argmax(share))] == "ä"
