"""Entities, arrays of STRUCT<name STRING, address STRING>, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vellumine.functions.text import Text, _c, collapsed, is_company, self_applicant_cue, strip

ENTITY = "struct<name:string,address:string>"
_NONE = f"array<{ENTITY}>"


def _filled(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def or_null(entities: Column) -> Column:
    """An empty array becomes null."""
    return F.when(F.size(entities) > 0, entities)


def deduped(entities: Text) -> Column:
    """First seen of each name and address, both compared in lower case and single blanks."""
    key = lambda e: F.struct(F.lower(collapsed(e["name"])).alias("n"), F.coalesce(F.lower(collapsed(e["address"])), F.lit("")).alias("a"))
    keyed = F.transform(_c(entities), lambda e: F.struct(e["name"].alias("name"), e["address"].alias("address"), key(e).alias("key")))
    kept = F.aggregate(
        keyed,
        F.array().cast("array<struct<name:string,address:string,key:struct<n:string,a:string>>>"),
        lambda acc, e: F.when(F.exists(acc, lambda x: x["key"] == e["key"]), acc).otherwise(F.concat(acc, F.array(e))),
    )
    return F.transform(kept, lambda e: F.struct(e["name"].alias("name"), e["address"].alias("address")))


def normalized(entities: Text) -> Column:
    """Stripped, blank names out, blank addresses null, deduped; null if nothing is left."""
    clean = F.transform(_c(entities), lambda e: F.struct(strip(e["name"]).alias("name"), _filled(e["address"]).alias("address")))
    return or_null(deduped(F.filter(clean, lambda e: F.coalesce(e["name"] != "", F.lit(False)))))


def from_string(x: Text) -> Column:
    """Entities of a string like "Name (Address); Name"."""
    parts = F.filter(F.transform(F.split(_c(x), ";"), strip), lambda p: p != "")

    def read(p: Column) -> Column:
        paired = p.rlike(r"^.+?\s*\([^)]+\)")
        name = F.when(paired, F.regexp_extract(p, r"^(.+?)\s*\(([^)]+)\)", 1)).otherwise(p)
        return F.struct(strip(name).alias("name"), F.when(paired, _filled(F.regexp_extract(p, r"^(.+?)\s*\(([^)]+)\)", 2))).alias("address"))

    return or_null(deduped(F.transform(parts, read)))


def merged(lists: Text) -> Column:
    """Union of an array of entity arrays, first seen first."""
    return normalized(F.flatten(F.filter(_c(lists), lambda x: x.isNotNull())))


def companies_moved(inventors: Text, assignees: Text) -> dict[str, Column]:
    """Companies among the inventors go to the end of the assignees."""
    inv = F.coalesce(_c(inventors), F.array().cast(_NONE))
    moved = F.filter(inv, lambda e: is_company(e["name"]))
    return {
        "inventors": or_null(F.filter(inv, lambda e: ~is_company(e["name"]))),
        "assignees": or_null(F.concat(F.coalesce(_c(assignees), F.array().cast(_NONE)), moved)),
    }


def quality(entities: Text) -> Column:
    """Mean of 0.7 for a name and 0.3 for an address, at most 1; 0 without entities."""
    has = lambda x: F.coalesce(F.length(strip(x)) > 0, F.lit(False)).cast("int")
    total = F.aggregate(_c(entities), F.lit(0.0), lambda a, e: a + 0.7 * has(e["name"]) + 0.3 * has(e["address"]))
    return F.when(F.coalesce(F.size(_c(entities)), F.lit(0)) > 0, F.least(F.lit(1.0), total / F.size(_c(entities)))).otherwise(0.0)


def missing(x: Text, kind: str) -> Column:
    """Null, a blank string, or an empty array."""
    c = _c(x)
    if kind == "string":
        return c.isNull() | (strip(c) == "")
    return c.isNull() | (F.size(c) <= 0) if kind == "array" else c.isNull()


def guarded_assignees(inventors: Text, assignees: Text, text: Text, same: Column) -> Column:
    """Assignees, null where a single inventor applied alone.

    That is: one inventor, one assignee who is no company and the same person (``same``),
    and a cue for it in the text.
    """
    one = (F.size(_c(inventors)) == 1) & (F.size(_c(assignees)) == 1)
    alone = one & ~is_company(_c(assignees)[0]["name"]) & same & self_applicant_cue(text)
    return F.when(~F.coalesce(alone, F.lit(False)), _c(assignees))
