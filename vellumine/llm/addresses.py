"""Postal addresses in different wordings: which of them denote one location.

Numbers first: an address is read into its digit tokens (house numbers, postal code) and its
words; countries and stop words go, and the kind of street is set apart where its word is
known. Then

1. places: postal codes are resolved by the place they most often stand beside, and place
   words a few edits from a much better supported place are corrected to it; an address
   without a place gets the only place its street and number stand beside;
2. blocks: addresses meet that share all house numbers, sorted, and one rare word: a word that
   isn't the commonest of its address. Since that word may be misspelt, they also meet on
   their numbers, the rarest of their other words and a deletion of the word, so a large town
   makes no large block. Two words written as one, or one as two, meet as the joined word;
3. acceptance, in SQL: ``array_intersect`` of the words, each weighted by its rarity; what is
   left over counts as far as its Levenshtein distance lets it, joined in order of writing. The
   share of the weight in agreement decides. Known kinds of street and known places (that
   stand without a street, or beside one of a known kind) must not contradict;
4. wordings attach to the best supported one; attachments are followed to a fixed point.

Defined cases: null and blank addresses are left out; they are compared without leading
and trailing blanks; repeated ones count once; a bare place links only to bare places; an
address without any word links to nothing; one without a place links only if a single
place is known for its street and number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vellumine.llm.edits import LOOKALIKES, distance, fold, neighbourhood, reach
from vellumine.llm.names import _Vocabulary, follow, hash_key, neighbour_cores, trigrams
from vellumine.session import cut, spread

#: Share of the words' weight that must agree.
AGREE = 0.75

# Names of countries in four languages.
COUNTRIES = [fold(w) for w in (
    "Schweiz Suisse Svizzera Switzerland Deutschland Allemagne Germania Germany Frankreich France Francia Italien Italie Italia Italy "
    "Österreich Autriche Austria England Angleterre Inghilterra Grossbritannien Britain Bretagna Great Grande Gran Liechtenstein"
).split()]
#: Kinds of street, folded; fixed values, and hints: other kinds are words like any. Before the name, and endings of it.
BEFORE = {"avenu": "avenue", "av": "avenue", "ave": "avenue", "vial": "viale", "viale": "viale", "via": "via", "v": "via", "piazza": "piazza", "pza": "piazza", "p": "piazza", "vle": "viale", "chemin": "chemin", "ch": "chemin", "ru": "rue", "r": "rue", "rue": "rue", "boulevard": "boulevard", "bd": "boulevard", "corso": "corso", "vicolo": "vicolo"}
ENDINGS = {"strasse": "street", "str": "street", "gasse": "gasse", "g": "gasse", "platz": "platz", "pl": "platz", "weg": "weg", "w": "weg", "street": "street", "st": "street", "road": "road", "rd": "road", "lane": "lane"}
_FULL_ENDINGS = ("strasse", "gasse", "platz", "weg", "street", "road")
_STOP = {"du", "de", "la", "le", "des", "della", "di", "del", "in", "nr", "no", "n", "num", "bei", "the", "of", "a"}
_COUNTRY = _Vocabulary([c for c in COUNTRIES if len(c) > 5], lambda w: 1 if len(w) < 8 else 2)
_ZIP = re.compile(r"(?:\b[a-z]{1,2}\s?-\s?)?\b(\d{4,5})\b")
_NUMBER = re.compile(r"(?:\b(?:nr|no|n|num)\b\.?\s*)?\b(\d{1,3})([a-z])?\b(?!-\d)")
_TOKEN = re.compile(r"[a-z]+")
_INNER = re.compile(r"(?<=[^\W\d_])[015](?=[^\W\d_])|(?<![\w])[015](?=[^\W\d_]{2})|(?<=[^\W\d_]{2})[015](?![\w])")
_TO_LETTER = {"0": "o", "1": "l", "5": "s"}


def _country(token: str, dotted: bool) -> bool:
    if token in COUNTRIES or dotted and len(token) >= 4 and any(c.startswith(token) for c in COUNTRIES):
        return True
    return len(token) > 5 and _COUNTRY.nearest(token) is not None


def read_address(address: str) -> tuple[str, str, str, str, str]:
    """(house numbers, kind, street, place, postal code), folded, each empty where it is missing.

    Words joined by a hyphen are one, unless the second is a known kind of street.

    >>> read_address("Kaltorwang/Switzerland"), read_address("CH-1583")
    (('', '', '', 'kaltorwang', ''), ('', '', '', '', '1583'))
    >>> read_address("Bellin (Suisse), Pfergel-Gasse No. 102a")
    ('102a', 'gasse', 'pfergel', 'bellin', '')
    """
    text = fold(_INNER.sub(lambda m: _TO_LETTER[m.group()], address))
    text = re.sub(r"\bv\s?\.\s?le\b", "vle", re.sub(r"\bp\s?\.\s?za\b", "pza", text))
    code = number = ""
    m = _ZIP.search(text)
    if m:
        code = m.group(1)
        text = f"{text[: m.start()]} , {text[m.end() :]}"
    numbers = [m.group(1).lstrip("0") + (m.group(2) or "") for m in _NUMBER.finditer(text)]
    number = " ".join(sorted(set(numbers)))
    text = _NUMBER.sub(" # ", text)
    tokens = []
    for m in _TOKEN.finditer(text):
        w, after = m.group(), text[m.end() : m.end() + 1]
        if not _country(w, after == "."):
            tokens.append((w, after == ".", text[max(m.start() - 1, 0) : m.start()] == "-"))
    kind = street = ""
    left: list[str] = []
    i = 0
    while i < len(tokens):
        w, dotted, hyphen = tokens[i]
        if not street and number and w in BEFORE and (len(w) > 2 or dotted or w == "ru"):
            j = i + 1
            while j < len(tokens) and tokens[j][0] in _STOP:
                j += 1
            if j < len(tokens):
                kind, street = BEFORE[w], tokens[j][0]
                i = j + 1
                continue
        if number and w in ENDINGS and left and not street and (len(w) > 1 and w != "pl" or dotted):
            kind, street = ENDINGS[w], left.pop()
            i += 1
            continue
        if not street and number:
            end = next((e for e in _FULL_ENDINGS if w.endswith(e) and len(w) > len(e) + 2), None)
            end = end or (next((e for e in ("str", "pl", "g", "w") if w.endswith(e) and len(w) > len(e) + 2), None) if dotted else None)
            if end:
                kind, street = ENDINGS[end], w[: -len(end)]
                i += 1
                continue
        if hyphen and left and i and tokens[i - 1][0] == left[-1]:
            left[-1] += w
        elif w not in _STOP:
            left.append(w)
        i += 1
    if number and not street and len(left) > 1:
        # an ending with a typing error in it
        for at, w in enumerate(left):
            for end in ("strasse", "gasse", "platz"):
                cut_ = [w[:-n] for n in range(len(end) - 1, len(end) + 2) if len(w) > n + 3 and distance(w[-n:], end, 1) <= 1]
                if cut_ and not street:
                    kind, street = ENDINGS[end], cut_[0]
                    left.pop(at)
                    break
    return number, kind, street, " ".join(left), code


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        read = [read_address(a) for a in batch["address"]]
        yield batch.assign(**{c: [r[i] for r in read] for i, c in enumerate(("number", "kind", "street", "place", "code"))})


def _corrected(words: DataFrame) -> DataFrame:
    """word and the better supported word it is a spelling of: word, proper.

    words has word and support. One edit needs four times the support; two edits eight
    times and a letter sequence that is rare among the words.
    """
    words = cut(words)
    grams = words.select("word", F.explode(trigrams("word")).alias("gram"))
    odd = grams.join(grams.groupBy("gram").agg(F.countDistinct("word").alias("n")), "gram").groupBy("word").agg((F.min("n") <= 2).alias("odd"))
    near = neighbour_cores(words.select(F.col("word").alias("core")))
    own = near.join(words.join(odd, "word").select(F.col("word").alias("a"), F.col("support").alias("sa"), "odd"), "a").join(words.select(F.col("word").alias("b"), F.col("support").alias("sb")), "b")
    best = (
        own.filter("d <= 1 and sb >= 4 * sa or d = 2 and odd and sb >= 8 * sa")
        .groupBy("a").agg(F.max_by("b", F.struct(-F.col("d"), "sb", "b")).alias("proper"))
    )
    return best.select(F.col("a").alias("word"), "proper")


def link_addresses(predictions: DataFrame) -> DataFrame:
    """The distinct addresses of inventors with their location: address, location (a number)."""
    distinct = (
        predictions.filter("prediction is not null")
        .select(F.explode(F.transform("prediction.inventors", lambda p: p["address"])).alias("address"))
        .select(F.trim("address").alias("address"))
        .filter("address <> ''")
        .groupBy("address").agg(F.count("*").alias("mentions"))
    )
    read = cut(spread(distinct).mapInPandas(_read, "address string, mentions bigint, number string, kind string, street string, place string, code string"))

    # Places: rows with a number but no known kind of street hold two words, one of them a place.
    sure = read.filter("place <> '' and place not like '% %'").filter("street <> '' or number = ''")
    places = sure.groupBy(F.col("place").alias("word")).agg(F.count("*").alias("support"))
    unsure = read.filter("number <> '' and street = '' and place like '% %'")
    fix = _corrected(places)
    rooted = places.join(fix, "word", "left").select("word", "support", F.coalesce("proper", "word").alias("proper"))
    picked = (
        unsure.select("address", F.posexplode(F.split("place", " ")).alias("at", "word"), F.split("place", " ").alias("all"))
        .join(rooted, "word", "left")
        .groupBy("address")
        .agg(F.max_by("word", F.struct(F.coalesce("support", F.lit(0)), "at")).alias("place2"), F.first("all").alias("all"))
        .select("address", "place2", F.array_join(F.filter("all", lambda w: w != F.col("place2")), " ").alias("street2"))
    )
    settled = read.join(picked, "address", "left").withColumns(
        {"place": F.coalesce("place2", "place"), "street": F.coalesce("street2", "street")}
    ).drop("place2", "street2")
    settled = settled.join(rooted.select(F.col("word").alias("place"), "proper"), "place", "left")
    # one word with a number that is no known place is a street
    alone = (F.col("number") != "") & (F.col("street") == "") & F.col("proper").isNull() & ~F.col("place").contains(" ")
    settled = settled.withColumns(
        {"street": F.when(alone, F.col("place")).otherwise(F.col("street")), "place": F.when(alone, "").otherwise(F.coalesce("proper", "place"))}
    ).withColumn("known", F.col("proper").isNotNull()).drop("proper")
    beside = (
        settled.filter("code <> '' and place <> ''").groupBy("code", "place").agg(F.count("*").alias("n"))
        .groupBy("code").agg(F.max_by("place", F.struct("n", "place")).alias("of_code"))
    )
    settled = settled.join(beside, "code", "left").withColumn(
        "place", F.when(F.col("place") != "", F.col("place")).when(F.col("code") != "", F.coalesce("of_code", "code")).otherwise("")
    )
    # without a place: the only one that its street and number stand beside
    only = (
        settled.filter("place <> '' and street <> '' and number <> ''").groupBy("number", "street", "kind")
        .agg(F.min("place").alias("one"), F.max("place").alias("last")).filter("one = last").drop("last")
    )
    lacking = F.col("place") == ""
    settled = settled.filter(~lacking).unionByName(
        settled.filter(lacking).join(only, ["number", "street", "kind"], "left").withColumn("place", F.coalesce("one", F.lit(""))).drop("one")
    )
    words = F.array_distinct(F.filter(F.split(F.concat_ws(" ", "street", "place"), " "), lambda w: w != ""))
    nodes = cut(
        settled.withColumn("words", words).filter("size(words) > 0")
        # rows without a number are bare places, told apart as wholes
        .groupBy("number", "kind", F.array_sort("words").alias("key"))
        .agg(F.first("words").alias("words"), F.max("place").alias("place"), F.max("known").alias("known"), F.count("*").alias("support"), F.sum("mentions").alias("mentions"), F.collect_list("address").alias("addresses"))
        .withColumn("node", F.xxhash64("number", "kind", "key"))
    )
    up = follow(_attached(nodes))
    return nodes.join(up, "node", "left").select(F.explode("addresses").alias("address"), F.coalesce("up", "node").alias("location"))


def _alike(words: Column) -> Column:
    """The words with look-alike letters in their short form."""

    def shorter(word: Column) -> Column:
        for long, short in LOOKALIKES:
            word = F.replace(word, F.lit(long), F.lit(short))
        return word

    return F.transform(words, shorter)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The block keys of each node; its words come rarest first."""
    for batch in batches:
        rows = []
        for node, number, words, written in batch.itertuples(index=False):
            words, written = list(words), list(written)
            whole = set(words[: max(len(words) - 1, 1)]) | {a + b for a, b in zip(written, written[1:])}
            keys = {f"{number}|{w}" for w in whole}
            for w in words:
                other = next((x for x in words if x != w), "")
                keys |= {f"{number}|{other}|{d}" for d in neighbourhood(w, reach(w))}
            rows += [(node, hash_key(k)) for k in keys]
        yield pd.DataFrame(rows, columns=["node", "key"])


def _attached(nodes: DataFrame) -> DataFrame:
    """The nodes with a number that are a wording of a better supported one: node, up."""
    doors = nodes.filter("number <> ''").withColumn("words", F.array_distinct(_alike("words")))
    each = doors.select("node", F.posexplode("words").alias("at", "word"))
    total = doors.agg(F.count("*").alias("doors"))
    weight = (F.log((F.col("doors") + 1) / F.col("df")) + 0.2).alias("w")
    weights = each.groupBy("word").agg(F.count("*").alias("df")).join(F.broadcast(total)).select("word", weight)
    weighed = cut(
        each.join(weights, "word").groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("o"), "word", "w"))).alias("told"))
        .join(doors.select("node", "number", "kind", "place", "known", "words", "support", "mentions"), "node")
    )
    keys = spread(weighed.select("node", "number", F.transform("told", lambda x: x["word"]).alias("rare"), "words")).mapInPandas(_blocks, "node bigint, key bigint")
    met = keys.alias("x").join(keys.alias("y"), F.expr("x.key = y.key and x.node < y.node")).select(F.col("x.node").alias("a_node"), F.col("y.node").alias("b_node")).distinct()
    a, b = (weighed.select(*[F.col(c).alias(f"{side}_{c}") for c in weighed.columns]) for side in "ab")
    pairs = met.join(a, "a_node").join(b, "b_node").filter("a_number = b_number and (a_kind = b_kind or a_kind = '' or b_kind = '') and (a_place = '') = (b_place = '') and (a_place = b_place or not (a_known and b_known))")
    common = F.array_intersect("a_words", "b_words")

    def weight_of(told: str, inside: Column | None = None) -> Column:
        own = F.col(told) if inside is None else F.filter(told, lambda x: F.array_contains(inside, x["word"]))
        return F.aggregate(own, F.lit(0.0), lambda n, x: n + x["w"])

    pairs = pairs.withColumn("common", common).withColumns(
        {
            "agreed": weight_of("a_told", F.col("common")) + weight_of("b_told", F.col("common")),
            "all": weight_of("a_told") + weight_of("b_told"),
            "a_rest": F.array_join(F.array_except("a_words", "common"), ""),
            "b_rest": F.array_join(F.array_except("b_words", "common"), ""),
        }
    )
    # two rests may be as far apart as the shorter allows; words that one side lacks count as they
    # weigh, but for the place, which is filled in before where there is but one
    apart, least = F.levenshtein("a_rest", "b_rest"), F.least(F.length("a_rest"), F.length("b_rest"))
    most = F.greatest(F.length("a_rest"), F.length("b_rest"), F.lit(1))
    allowed = F.when(least < 4, 0).when(least < 6, 1).when(least < 8, 3).otherwise(4)
    near = F.when(apart <= allowed, 1 - apart / most).when(least == 0, 0.0)
    agreed = pairs.withColumn("d", apart).withColumn("share", (F.col("agreed") + (F.col("all") - F.col("agreed")) * near) / F.col("all")).filter(F.col("share") >= AGREE)
    # upwards, to the better supported wording
    better = [("a", "b", "(a_support, a_mentions, a_node) < (b_support, b_mentions, b_node)"), ("b", "a", "(a_support, a_mentions, a_node) > (b_support, b_mentions, b_node)")]
    ways = [agreed.filter(order).select(F.col(f"{low}_node").alias("node"), F.col(f"{high}_node").alias("to"), F.col(f"{high}_support").alias("s"), F.col(f"{high}_mentions").alias("m"), "d") for low, high, order in better]
    return ways[0].unionByName(ways[1]).groupBy("node").agg(F.max_by("to", F.struct("s", -F.col("d"), "m", "to")).alias("up"))


def address_pairs(predictions: DataFrame) -> DataFrame:
    """All pairs of different addresses of one location: address_a < address_b by code point."""
    linked = cut(link_addresses(predictions))
    return (
        linked.alias("x")
        .join(linked.alias("y"), F.expr("x.location = y.location and x.address < y.address"))
        .select(F.col("x.address").alias("address_a"), F.col("y.address").alias("address_b"))
    )
