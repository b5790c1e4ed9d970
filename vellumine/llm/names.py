"""Variant spellings of names: which of them name one person or company.

1. Distinct names are read into a bag of tokens, without case, accents, titles and order; the
   kind of a company ("Gebrüder", "Maschinenfabrik") is set apart where its words are known.
   Equal bags with the same leading token make one node.
2. What a token is is learned from all names: where it stands (before or behind a comma, in
   capitals beside others, last), and beside how many other tokens. A token that mostly stands
   where given names do and beside several others is common; in a name with a token that isn't,
   it can't tell who is meant. Lists serve as hints only: short and familiar forms of given
   names, words of companies.
3. A symmetric-delete index over all distinct tokens finds tokens a few edits apart. Nodes meet
   on a token of theirs that isn't common, or a neighbour of it, together with the first letter
   of another token; a second meeting, on the exact token and a neighbour of the other one,
   finds errors in that first letter. So a bucket holds the given names of one family with one
   letter: it grows with the vocabulary, not with the rows.
4. Nodes that met are compared by optimal assignment of all their tokens, initials and
   abbreviations permitted; a token of the shorter name without a partner refuses the pair.
5. Each node is attached to the fullest, most mentioned node among the nearest that fit it, if
   all of these agree with one another; where two people fit, it isn't. Names of one token join
   the only entity that has the token. Attachments are followed to a fixed point.

A typing error and another real name are told apart by shares, which hold at any size: of two
spellings the one with a quarter of the other's mentions or fewer is the misspelling; else, and
for two edits always, a letter sequence must be rare among all tokens, which an error nearly
always makes and a real name rarely has. A spelling of a given name that stands beside more
than three hundredths of the other's partners is a name of its own.

Defined cases: null and blank names are left out; names are compared without leading and
trailing blanks; repeated names count once; a name that can't be read into tokens (only
punctuation) links to nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vellumine.llm.edits import distance, fold, merged, neighbourhood
from vellumine.session import cut, spread

# Familiar forms of given names that no rule of abbreviation finds, folded; hints, all else is learned.
GIVEN = {
    "albert": "bertli", "alexander": "alex alexandre", "alfred": "fredi", "andreas": "res", "anna": "anni", "anton": "toni antoine antonio", "arnold": "noldi", "august": "auguste gusti",
    "charles": "charley charlie", "christian": "christen", "eduard": "edi edouard", "elisabeth": "lisbeth lisi betli elise", "emil": "emile", "ernst": "aernst ernest", "eugen": "eugene",
    "etienne": "stefan stephan", "franz": "francois", "friedrich": "fritz frederic", "georg": "georges jorg", "giovanni": "gianni", "giuseppe": "beppe", "gottfried": "gopf godi",
    "gustav": "gustave", "heinrich": "heiri heinz henri", "jakob": "jacques kobi jacob", "johann": "hans hannes johannes", "josef": "joseph sepp", "karl": "carl", "kaspar": "caspar",
    "konrad": "conrad", "louis": "ludwig", "margaretha": "gretli margrit margarete", "maria": "marie", "nikolaus": "nikl klaus niklaus nicolas", "oskar": "oscar", "paul": "pauli",
    "peter": "pierre piero", "robert": "robi", "rosa": "rosli rose", "rudolf": "rudolph ruedi", "theodor": "theo", "thomas": "tom", "ulrich": "uli", "viktor": "victor", "walter": "walti", "wilhelm": "willi",
    "william": "bill",
}
TITLES = set("herr herrn frau hr fr dr prof dipl ing sig mr mrs mme mlle ingenieur ingenieurs".split()) - {"fr"}
# Words of company names, folded, by the kind of company they tell.
KINDS = {
    "watch": "uhrenfabrik uhrenfabr uhren", "machine": "maschinenfabrik maschf masch maschinen", "electric": "elektrizitatsgesellschaft electricitatsgesellschaft elektr elektrizitats electricitats elektrizitatsges",
    "chemical": "chemische chem", "united": "vereinigte ver verein", "brothers": "gebruder gebr geb", "fratelli": "fratelli flli", "manufacture": "manufacture", "factory": "fabbrica",
    "manufacturing": "manufacturing mfg manufg", "house": "etablissements etabl ets", "sons": "sohne fils", "partners": "cie compagnie", "stock": "aktiengesellschaft ag actg aktg", "anonyme": "societe soc ste sa anonyme anon",
}
#: Words that say nothing more beside the kind.
COMPANY_WORDS = set("fabrik fabr werke gmbh gesmbh gesellschaft ges freres frs fres company limited ltd co und et u e act an inc corp".split())
_KIND_OF = {w: k for k, ws in KINDS.items() for w in ws.split()}
_ORDER = list(KINDS)
_GIVEN_OF = {w: g for g, ws in GIVEN.items() for w in [g, *ws.split()]}
_SURE_COMPANY = set("gmbh gesmbh werke fabrik fabr company limited ltd".split())
_LONG = [w for w in [*_KIND_OF, *COMPANY_WORDS] if len(w) >= 7]
_WORDS = re.compile(r"[^\W\d_]+")
#: Digits that stand for letters inside a word; fixed values.
_LETTER_OF = {"0": "o", "1": "l", "5": "s"}
_DIGITS = re.compile(r"(?<=[^\W\d_])[015]|[015](?=[^\W\d_])")
#: Legal forms written with points or blanks are drawn together first; fixed values.
_FORMS = [(re.compile(p), r) for p, r in (
    (r"\bg\.?\s?m\.?\s?b\.?\s?h\b\.?", " gmbh "), (r"\bges\.?\s?m\.?\s?b\.?\s?h\b\.?", " gmbh "), (r"\ba\.?\s?-?\s?g\b\.", " ag "), (r"\bact\.?\s?-\s?ges\b\.?", " ag "),
    (r"\bs\.\s?a\b\.?", " sa "), (r"\bf\.?\s?lli\b", " flli "), (r"\bsoc\.?\s?an(on)?\b\.?", " sa "), (r"&", " & "),
)]


#: A misspelling is at least so many times rarer than the name.
CLEAR = 4
#: Share of its places from which a token counts as a given name, and below which as a family
#: name; a given name stands beside at least so many other tokens.
GIVEN_SHARE, FAMILY_SHARE, BESIDE = 0.6, 0.45, 3
#: Share of the other's partners from which a spelling of a given name is a name of its own.
OWN_NAME = 0.03
#: Cost of two tokens that can't be one.
NEVER = 9.0


class _Vocabulary:
    """Fixed words behind a deletion index: the one nearest to a token."""

    def __init__(self, words, edits):
        self.edits = {w: edits(w) for w in words}
        self.index: dict[str, list[str]] = {}
        for w, n in self.edits.items():
            for key in neighbourhood(w, n):
                self.index.setdefault(key, []).append(w)
        self.most = max(self.edits.values())
        self.lengths = range(min(map(len, words)) - self.most, max(map(len, words)) + self.most + 1)
        self.nearest = lru_cache(maxsize=200_000)(self._nearest)

    def _nearest(self, token: str) -> str | None:
        if len(token) not in self.lengths:
            return None
        near = {w for key in neighbourhood(token, self.most) for w in self.index.get(key, ())}
        fits = [(distance(token, w), w) for w in near]
        fits = sorted((d, w) for d, w in fits if d <= self.edits[w] and (d < 2 or token[0] == w[0]))
        return fits[0][1] if fits and (len(fits) == 1 or fits[0][0] < fits[1][0]) else None


_NEAR_KIND = _Vocabulary(_LONG, lambda w: 1 if len(w) < 8 else 2)


def read_name(name: str) -> tuple[str, list[str], list[str], list[str]]:
    """(kind, tokens, tokens in the place of given names, in that of family names).

    kind is empty for persons. Tokens are in order; an abbreviation keeps its point.

    >>> read_name("Krässenner, Viktor E.")[:2], read_name("Dipl.-Ing. V. Kraessenner")[:2]
    (('', ['krassenner', 'viktor', 'e']), ('', ['v', 'krassenner']))
    >>> read_name("Uhrenfabr. Büfundäli")[:2], read_name("UHRENFABRIK BÜFUNDÄLI A.-G.")[:2]
    (('watch', ['bufundali']), ('watch', ['bufundali']))
    """
    text = unicodedata.normalize("NFC", _DIGITS.sub(lambda m: _LETTER_OF[m.group()], name))
    joined = fold(text)
    for pattern, to in _FORMS:
        joined = pattern.sub(to, joined)
    words = _WORDS.findall(joined)
    kinds = {_KIND_OF[w] for w in words if w in _KIND_OF}
    company = bool(kinds) or "&" in joined or any(w in _SURE_COMPANY for w in words)
    typed = []
    for w in words:
        if w in _KIND_OF or w in COMPANY_WORDS:
            continue
        near = _NEAR_KIND.nearest(w) if len(w) >= 6 else None
        if near:
            company = True
            if near in _KIND_OF:
                kinds.add(_KIND_OF[near])
        else:
            typed.append(w)
    if company:
        kind = next((k for k in _ORDER if k in kinds), "partners" if "&" in joined or "co" in words else "other")
        return kind, list(dict.fromkeys([w for w in typed if len(w) > 2] or typed or words)), [], []
    found = [(fold(m.group()), m) for m in _WORDS.finditer(text)]
    found = [x for x in found if x[0] not in TITLES] or found
    tokens, behind, capital = [], [], []
    for i, (w, m) in enumerate(found):
        comma = "," in text[: m.start()]
        # at the end a point is an abbreviation's only behind a comma
        dotted = 1 < len(w) <= 7 and text[m.end() : m.end() + 1] == "." and (i + 1 < len(found) or comma)
        w = _GIVEN_OF.get(w, f"{w}." if dotted else w)
        tokens.append(w)
        behind.append(comma)
        capital.append(m.group().isupper() and len(w) > 1)
    last = max((i for i, w in enumerate(tokens) if len(w) > 1 and not w.endswith(".")), default=-1)
    family = [i == last for i in range(len(tokens))]
    if len(set(behind)) == 2:
        family = [not x for x in behind]
    elif len(set(capital)) == 2:
        family = capital
    known = [(w, f) for w, f in zip(tokens, family) if len(tokens) > 1 and len(w) > 1 and not w.endswith(".")]
    return "", list(dict.fromkeys(tokens)), [w for w, f in known if not f], [w for w, f in known if f]


def shortened(short: str, full: str) -> bool:
    """Whether ``short`` is an initial or an abbreviation of ``full`` (also Chas, Thos, Wm)."""
    if not short or full.startswith(short):
        return True
    if short[0] != full[0] or short[-1] != full[-1] or len(short) > 5:
        return False
    at = iter(full)
    return all(c in at for c in short)


class Token:
    """A token with what the corpus says of it; without that, a name seen once.

    common: can't tell who is meant; lead: the first token of the name but for the family name.
    """

    __slots__ = ("text", "abbreviated", "partners", "rarity", "common", "lead")

    def __init__(self, text: str, partners: int = 1, rarity: int = 1, common: bool = False, lead: bool = False):
        self.text, self.abbreviated = text.rstrip("."), text.endswith(".")
        self.partners, self.rarity, self.common, self.lead = partners, rarity, common, lead

    @property
    def weak(self) -> bool:
        """Whether the token alone can't tell who is meant."""
        return self.common or self.abbreviated or len(self.text) == 1


class Bounds:
    """What misspellings are judged by beside the tokens themselves.

    few, unique: in how many tokens a letter sequence is rare, or next to unique; support: the
    layouts of the rarer of the two names; clear: whether one name is CLEAR times rarer.
    """

    __slots__ = ("few", "unique", "support", "clear")

    def __init__(self, few: float = 2, unique: float = 2, support: int = 1, clear: bool = False):
        self.few, self.unique, self.support, self.clear = few, unique, support, clear


def token_cost(a: Token, b: Token, bounds: Bounds = Bounds()) -> tuple[float, int]:
    """What it costs to read two tokens as one (0 equal, NEVER impossible), and the edits between them."""
    x, y = a.text, b.text
    if x == y:
        return 0.0, 0
    if len(x) == 1 or len(y) == 1:
        return (0.2, 0) if x[0] == y[0] else (NEVER, 0)
    given = a.common or b.common or x in GIVEN and y in GIVEN
    low, high = sorted((a.partners, b.partners))
    own = given and (low > max(2, OWN_NAME * high) or x in GIVEN and y in GIVEN)
    if (a.abbreviated and shortened(x, y)) or (b.abbreviated and shortened(y, x)) or given and not own and (shortened(x, y) or shortened(y, x)):
        return 0.1, 0
    if a.abbreviated or b.abbreviated or own:
        return NEVER, 0
    d = distance(merged(x), merged(y))
    if d > 2 or min(len(x), len(y)) < (0, 4, 6)[d]:
        return NEVER, d
    if d and not given:
        rarity = min(a.rarity, b.rarity)
        # spellings that are both used, and about as often: only an all but unique sequence tells an error
        if d == 2 and rarity > (bounds.few if bounds.clear or bounds.support < 2 else bounds.unique) or bounds.support >= 3 and not bounds.clear and rarity > bounds.unique:
            return NEVER, d
    return 0.4 * d, d


def assignment(costs: list[list[float]]) -> list[int]:
    """The column of each row in the cheapest assignment; no more rows than columns.

    Shortest augmenting paths with potentials: exact for any number of tokens.
    """
    rows, columns = len(costs), len(costs[0])
    u, v, owner = [0.0] * (rows + 1), [0.0] * (columns + 1), [0] * (columns + 1)
    for i in range(1, rows + 1):
        owner[0], column = i, 0
        least, came, done = [float("inf")] * (columns + 1), [0] * (columns + 1), [False] * (columns + 1)
        while owner[column]:
            done[column] = True
            row, step, to = owner[column], float("inf"), 0
            for j in range(1, columns + 1):
                if not done[j]:
                    reduced = costs[row - 1][j - 1] - u[row] - v[j]
                    if reduced < least[j]:
                        least[j], came[j] = reduced, column
                    if least[j] < step:
                        step, to = least[j], j
            for j in range(columns + 1):
                if done[j]:
                    u[owner[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            column = to
        while column:
            owner[column] = owner[came[column]]
            column = came[column]
    out = [0] * rows
    for j in range(1, columns + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out


def align(left: list[Token], right: list[Token], bounds: Bounds = Bounds()) -> tuple[float, int] | None:
    """(cost, edits) of the best assignment of the shorter name's tokens, or None if it isn't the same name.

    Each token left over costs 0.3. At least one pair of tokens that aren't common must be in
    it, no more than three edits in all, and the leading given name of one must not be a later
    one of the other.
    """
    if len(left) > len(right):
        left, right = right, left
    if not left:
        return None
    found = [[token_cost(a, b, bounds) for b in right] for a in left]
    chosen = assignment([[c for c, _ in row] for row in found])
    cost, edits, anchored = 0.3 * (len(right) - len(left)), 0, False
    for i, j in enumerate(chosen):
        c, d = found[i][j]
        if c >= NEVER:
            return None
        a, b = left[i], right[j]
        if (a.weak or b.weak) and (a.lead and not b.lead or len(left) == len(right) and b.lead and not a.lead):
            return None
        cost, edits = cost + c, edits + d
        anchored = anchored or not a.weak and not b.weak
    return (cost, edits) if anchored and edits <= 3 else None


def distinct_names(predictions: DataFrame) -> DataFrame:
    """name and its number of mentions over inventors and assignees."""
    names = F.concat(
        F.coalesce(F.transform("prediction.inventors", lambda p: p["name"]), F.array()),
        F.coalesce(F.transform("prediction.assignees", lambda p: p["name"]), F.array()),
    )
    return (
        predictions.filter("prediction is not null")
        .select(F.explode(names).alias("name"))
        .select(F.trim("name").alias("name"))
        .filter("name <> ''")
        .groupBy("name")
        .agg(F.count("*").alias("mentions"))
    )


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        read = [read_name(n) for n in batch["name"]]
        yield batch.assign(**{c: [r[i] for r in read] for i, c in enumerate(("kind", "bag", "given", "family"))})


def neighbour_cores(cores: DataFrame) -> DataFrame:
    """Pairs of distinct cores at most two edits apart, both ways: a, b, d.

    The cores under one key differ from it by one or two letters put in, so their number is
    bounded by the alphabet and a core's length, whatever the rows.
    """

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(hash_key(k), c) for c in batch["core"] for k in neighbourhood(merged(c))]
            yield pd.DataFrame(rows, columns=["key", "core"])

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d = [distance(merged(a), merged(b)) for a, b in zip(batch["a"], batch["b"])]
            batch = batch.assign(d=d)
            shorter = batch[["a", "b"]].map(len).min(axis=1)
            yield batch[(batch["d"] == 0) | (batch["d"] == 1) & (shorter >= 4) | (batch["d"] == 2) & (shorter >= 6)]

    keys = spread(cores).mapInPandas(keyed, "key bigint, core string")
    met = (
        keys.alias("x")
        .join(keys.alias("y"), F.expr("x.key = y.key and x.core < y.core"))
        .select(F.col("x.core").alias("a"), F.col("y.core").alias("b"))
        .distinct()
    )
    pairs = spread(met).mapInPandas(verified, "a string, b string, d int")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))


def hash_key(text: str) -> int:
    """A stable 63-bit key."""
    import xxhash

    return xxhash.xxh3_64_intdigest(text) >> 1


def trigrams(core: str) -> Column:
    """The letter sequences of a column of cores, with marks at both ends."""
    marked = F.concat(F.lit("^"), F.col(core), F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(marked) - 2), lambda i: F.substring(marked, i, F.lit(3)))


def token_stats(names: DataFrame) -> DataFrame:
    """token, partners (tokens it stands beside), place (share of given names' places), rarity, tokens (their number).

    rarity is the number of tokens that have the token's rarest letter sequence.
    """
    counts = names.select(F.explode("bag").alias("token")).distinct()
    beside = (
        names.filter("size(bag) > 1").select("bag", F.explode("bag").alias("token")).select("token", F.explode("bag").alias("other"))
        .filter("token <> other").distinct().groupBy("token").agg(F.count("*").alias("partners"))
    )
    places = (
        names.select(F.explode(F.concat(F.transform("given", lambda w: F.struct(w.alias("token"), F.lit(1).alias("g"))), F.transform("family", lambda w: F.struct(w.alias("token"), F.lit(0).alias("g"))))).alias("x"))
        .groupBy("x.token").agg((F.sum("x.g") / F.count("*")).alias("place"))
    )
    grams = counts.filter("length(token) > 2").select("token", F.explode(trigrams("token")).alias("gram"))
    strange = grams.join(grams.groupBy("gram").agg(F.countDistinct("token").alias("tokens")), "gram").groupBy("token").agg(F.min("tokens").alias("rarity"))
    total = counts.agg(F.count("*").alias("tokens"))
    stats = counts.join(beside, "token", "left").join(places, "token", "left").join(strange, "token", "left").join(F.broadcast(total))
    return stats.fillna({"partners": 0, "place": 0.5, "rarity": 1})


def _bags(names: DataFrame, stats: DataFrame) -> DataFrame:
    """The distinct token lists with their node and their tokens' figures: kind, bag, node, tokens, m, s.

    One node are the lists of the same tokens with the same leading one. m and s are mentions
    and names.
    """
    bags = names.filter("size(bag) > 0").groupBy("kind", "bag").agg(F.sum("mentions").alias("m"), F.count("*").alias("s"))
    told = bags.select("*", F.posexplode("bag").alias("at", "token")).join(stats, "token").groupBy("kind", "bag", "m", "s").agg(
        F.array_sort(F.collect_list(F.struct("token", "partners", "rarity", "place", "at"))).alias("t"), F.max("tokens").alias("total")
    )
    whole = F.filter("t", lambda x: (F.length(x["token"]) > 1) & ~x["token"].endswith("."))
    # the family name stands where family names do, and else last; the first of the others leads
    family = F.array_min(F.transform(whole, lambda x: F.struct(x["place"], -x["at"])))["col2"]
    told = told.withColumn("family", F.coalesce(-family, F.size("t") - 1)).withColumn("first", F.when(F.col("family") == 0, 1).otherwise(0))
    # common beside a token that rather stands where family names do
    telling = F.exists("t", lambda x: (x["place"] <= FAMILY_SHARE) & (F.length(x["token"]) > 2))
    person = F.col("kind") == ""
    tokens = F.transform("t", lambda x: F.struct(
        *[x[c].alias(c) for c in ("token", "partners", "rarity")],
        (person & telling & (x["place"] >= GIVEN_SHARE) & (x["partners"] >= BESIDE)).alias("common"),
        (person & (x["at"] == F.col("first")) & (F.size("t") > 1)).alias("lead"),
    ))
    return told.withColumn("tokens", tokens).select(
        "kind", "bag", F.xxhash64("kind", F.to_json(F.transform("tokens", lambda x: F.struct(x["token"], x["lead"])))).alias("node"), "tokens", "m", "s", "total"
    )


def _nodes(bags: DataFrame) -> DataFrame:
    """node, kind, tokens, rank and total; rank orders nodes: full tokens, tokens, mentions, names, node."""
    nodes = bags.groupBy("node").agg(F.first("kind").alias("kind"), F.first("tokens").alias("tokens"), F.sum("m").alias("m"), F.sum("s").alias("s"), F.first("total").alias("total"))
    full = F.size(F.filter("tokens", lambda x: (F.length(x["token"]) > 1) & ~x["token"].endswith(".")))
    return nodes.select("node", "kind", "tokens", F.struct(full.alias("full"), F.size("tokens").alias("size"), F.col("m").alias("mentions"), F.col("s").alias("names"), "node").alias("rank"), "total")


def _met(nodes: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs of nodes to be compared, the lower ranked first: a, b."""
    words = F.filter("tokens", lambda x: (F.length(x["token"]) > 1) & ~x["token"].endswith("."))
    telling = nodes.select("node", "kind", "rank", F.transform("tokens", lambda x: x["token"]).alias("all"), F.explode(F.filter(words, lambda x: ~x["common"])).alias("t")).select("node", "kind", "rank", "all", F.col("t.token").alias("token"))
    others = F.array_remove("all", F.col("token"))
    letters = F.array_distinct(F.transform(others, lambda w: F.substring(w, 1, 1)))
    one = telling.select("node", "kind", "rank", "token", F.explode(F.when(F.size(letters) > 0, letters).otherwise(F.array(F.lit("")))).alias("also"))
    two = telling.select("node", "kind", "rank", "token", F.explode(F.filter(others, lambda w: (F.length(w) > 3) & ~w.endswith("."))).alias("also"))

    def sides(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
        return tuple(keys.select("kind", "token", "also", F.col("node").alias(side), F.col("rank").alias(f"{side}_rank")) for side in "ab")

    left, right = sides(one)
    itself = left.unionByName(left.withColumnRenamed("token", "x").join(near.select(F.col("a").alias("x"), F.col("b").alias("token")), "x").drop("x"))
    first = itself.join(right, ["kind", "token", "also"])
    left, right = sides(two)
    moved = near.filter(F.substring("a", 1, 1) != F.substring("b", 1, 1)).select(F.col("a").alias("x"), F.col("b").alias("also"))
    second = left.withColumnRenamed("also", "x").join(moved, "x").drop("x").join(right, ["kind", "token", "also"])
    columns = ["a", "b", "a_rank", "b_rank"]
    return first.select(*columns).unionByName(second.select(*columns)).filter("a_rank < b_rank").select("a", "b").distinct()


def follow(up: DataFrame) -> DataFrame:
    """node, up with every attachment followed to its end: doubling until nothing changes.

    Attachments lead to higher ranks only, so there is no circle.
    """
    up = cut(up)
    while True:
        hop = up.select(F.col("node").alias("up"), F.col("up").alias("higher"))
        stepped = cut(up.join(hop, "up", "left").select("node", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("moved")))
        moved = stepped.filter("moved").limit(1).count()
        up = stepped.drop("moved")
        if not moved:
            return up


def link_names(predictions: DataFrame, rare: float = 0.0004) -> DataFrame:
    """The distinct names with their entity: name, entity (a number). See the module's text.

    rare: a letter sequence is rare if no more than this share of all tokens have it, and next
    to unique at two fifths of the share (or two tokens, where that is more).
    """
    names = cut(spread(distinct_names(predictions)).mapInPandas(_parsed, "name string, mentions bigint, kind string, bag array<string>, given array<string>, family array<string>"))
    stats = cut(token_stats(names))
    near = cut(neighbour_cores(stats.filter("length(token) > 3 and not endswith(token, '.')").select(F.col("token").alias("core"))))
    bags = cut(_bags(names, stats))
    nodes = cut(_nodes(bags))
    a, b = (nodes.select(F.col("node").alias(side), F.col("tokens").alias(f"{side}_tokens"), F.col("rank").alias(f"{side}_rank"), *(["total"] if side == "a" else [])) for side in "ab")
    pairs = _met(nodes, near).join(a, "a").join(b, "b").select("a", "b", "a_tokens", "b_tokens", "total", "a_rank", "b_rank", F.expr("a_rank.full = b_rank.full and a_rank.size = b_rank.size").alias("alike"))

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for left, right, total, x, y in zip(batch["a_tokens"], batch["b_tokens"], batch["total"], batch["a_rank"], batch["b_rank"]):
                clear = min(x["mentions"], y["mentions"]) * CLEAR <= max(x["mentions"], y["mentions"])
                bounds = Bounds(max(2, rare * total), max(2, 0.4 * rare * total), min(x["names"], y["names"]), clear)
                found.append(align(*([Token(*t.values()) for t in side] for side in (left, right)), bounds))
            kept = [f is not None for f in found]
            out = batch.loc[kept, ["a", "b", "b_rank", "alike"]]
            yield out.assign(cost=[f[0] for f in found if f], edits=[f[1] for f in found if f])

    rank = nodes.schema["rank"].dataType.simpleString()
    good = cut(spread(pairs).mapInPandas(judged, f"a bigint, b bigint, b_rank {rank}, alike boolean, cost double, edits int"))
    nearest = good.join(good.groupBy("a").agg(F.min("edits").alias("edits")), ["a", "edits"])
    best = nearest.groupBy("a").agg(F.max_by("b", F.struct("b_rank", -F.col("cost"))).alias("up"), F.max_by("b", F.when(F.col("alike"), F.struct(-F.col("cost"), "b_rank"))).alias("alike"))
    others = nearest.select("a", "b").join(best.select("a", "up"), "a").filter("b <> up")
    torn = others.join(good.select(F.col("a").alias("b"), F.col("b").alias("up")), ["b", "up"], "left_anti").select("a").distinct().withColumn("torn", F.lit(True))
    up = best.join(torn, "a", "left").select(F.col("a").alias("node"), F.when(F.col("torn"), F.col("alike")).otherwise(F.col("up")).alias("up")).filter("up is not null")
    roots = cut(nodes.select("node", "kind", "tokens").join(follow(up), "node", "left").withColumn("root", F.coalesce("up", "node")).drop("up"))
    # a name of one token belongs to the only entity that has it beside others
    only = (
        roots.filter("size(tokens) > 1").select("kind", "root", F.explode(F.filter("tokens", lambda x: ~x["common"])).alias("t"))
        .groupBy("kind", F.col("t.token").alias("token")).agg(F.min("root").alias("one"), F.max("root").alias("last")).filter("one = last").drop("last")
    )
    alone = roots.filter("size(tokens) = 1 and node = root").select("node", "kind", F.col("tokens")[0]["token"].alias("token")).filter("length(token) > 1")
    joined = alone.join(only, ["kind", "token"]).select(F.col("node").alias("root"), "one")
    entities = roots.join(joined, "root", "left").select("node", F.coalesce("one", "root").alias("entity"))
    return names.join(bags.select("kind", "bag", "node"), ["kind", "bag"]).join(entities, "node").select("name", "entity")


def name_pairs(predictions: DataFrame) -> DataFrame:
    """All pairs of different names of one entity: name_a < name_b by code point."""
    linked = cut(link_names(predictions))
    return (
        linked.alias("x")
        .join(linked.alias("y"), F.expr("x.entity = y.entity and x.name < y.name"))
        .select(F.col("x.name").alias("name_a"), F.col("y.name").alias("name_b"))
    )
