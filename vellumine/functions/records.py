"""Model answers to records: JSON out of free text, and all-or-nothing validation."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from vellumine.functions import dates, entities
from vellumine.functions.text import Text, _c

RECORD = (
    "struct<title:string,inventors:array<struct<name:string,address:string>>,assignees:array<struct<name:string,address:string>>,"
    "pub_date_application:string,pub_date_publication:string,pub_date_foreign:string,classification:string,industrial_field:string,identifier:string>"
)
SCALARS = ("title", "pub_date_application", "pub_date_publication", "pub_date_foreign", "classification", "industrial_field", "identifier")
#: Other names of keys that models use; fixed values.
ALIASES = {"inventors": "inventor", "assignees": "assignee", "classification": "class"}


def empty() -> Column:
    """A record without any value."""
    return F.from_json(F.lit("{}"), RECORD)


def outer_objects(text: str) -> list[str]:
    """Outermost balanced {...} stretches, braces inside strings counting too.

    A brace without a partner is skipped, and the search goes on behind it.
    """
    opened: list[int] = []
    pairs: dict[int, int] = {}
    for i, c in enumerate(text):
        if c == "{":
            opened.append(i)
        elif c == "}" and opened:
            pairs[opened.pop()] = i
    out, at = [], -1
    for begin in sorted(pairs):
        if begin > at:
            at = pairs[begin]
            out.append(text[begin : at + 1])
    return out


def find_json(text: str) -> str:
    """The last balanced object that parses, else the last one, else what follows "identifier"."""
    found = outer_objects(text)
    for raw in reversed(found):
        try:
            json.loads(raw)
            return raw
        except ValueError:
            continue
    if found:
        return found[-1]
    at = text.find('"identifier"')
    if at < 0:
        return "{}"
    raw = text[at:].strip()
    return (raw if raw.startswith("{") else "{\n" + raw) + ("" if raw.endswith("}") else "\n}")


@F.pandas_udf(StringType())
def json_of(text: pd.Series) -> pd.Series:
    """The JSON object in a free text; null for null."""
    return text.map(lambda t: None if t is None else find_json(t))


def extracted(text: Text) -> Column:
    """As json_of, but a text that is one object as it stands isn't sent to Python."""
    x = F.trim(_c(text))
    plain = x.startswith("{") & x.endswith("}") & F.is_variant_null(F.try_parse_json(x)).isNotNull()
    return F.when(plain & (F.length(x) - F.length(F.replace(x, F.lit("{"), F.lit(""))) == 1), x).otherwise(json_of(_c(text)))


def _entity_list(v: Column, key: str) -> Column:
    """Entities of a member that is a list of objects, a list of strings, or one string."""
    path = f"$.{key}"
    raw = F.coalesce(F.try_variant_get(v, path, "variant"), F.try_variant_get(v, f"$.{ALIASES[key]}", "variant"))
    kind = F.schema_of_variant(raw)
    listed = F.try_variant_get(raw, "$", "array<struct<name:string,address:string>>")
    return F.when(kind == "STRING", entities.from_string(F.try_variant_get(raw, "$", "string"))).when(kind.startswith("ARRAY"), entities.normalized(listed))


def with_validated(df: DataFrame, raw: str, out: str) -> DataFrame:
    """df with a record from a JSON string: aliases, copied dates removed, moved companies.

    All or nothing: text that is no JSON, or a scalar field that is no string, gives null.
    A list stands for its first element. Done in steps, so that each is evaluated once.
    """
    day = ("application", "publication", "foreign")
    parsed = F.try_parse_json(F.col(raw))
    step = df.withColumn("_parsed", parsed).withColumn("_shape", F.schema_of_variant("_parsed"))
    step = step.withColumn("_v", F.when(F.col("_shape").startswith("ARRAY"), F.try_variant_get("_parsed", "$[0]", "variant")).otherwise(F.col("_parsed")))
    step = step.withColumn("_shape", F.schema_of_variant("_v"))
    members = {}
    for name in SCALARS:
        member = F.try_variant_get("_v", f"$.{name}", "variant")
        if name in ALIASES:
            member = F.coalesce(member, F.try_variant_get("_v", f"$.{ALIASES[name]}", "variant"))
        members[f"_m_{name}"] = member
    step = step.withColumns(members)
    good = F.coalesce(F.col("_shape").startswith("OBJECT"), F.lit(False))
    for name in SCALARS:
        good = good & F.coalesce(F.schema_of_variant(f"_m_{name}"), F.lit("VOID")).isin("STRING", "VOID")
    step = step.withColumn("_good", good).withColumns({f"_s_{n}": F.try_variant_get(f"_m_{n}", "$", "string") for n in SCALARS})
    step = step.withColumns({f"_l_{k}": _entity_list(F.col("_v"), k) for k in ("inventors", "assignees")})
    once = dates.without_duplicates(*[F.col(f"_s_pub_date_{d}") for d in day])
    step = step.withColumns({f"_d_{d}": dates.field_date(once[d]) for d in day})
    values = {n: F.col(f"_s_{n}") for n in SCALARS} | {f"pub_date_{d}": F.col(f"_d_{d}").cast("string") for d in day} | entities.companies_moved("_l_inventors", "_l_assignees")
    names = ("title", "inventors", "assignees", *[f"pub_date_{d}" for d in day], "classification", "industrial_field", "identifier")
    whole = F.when(F.col("_good"), F.struct(*[values[n].alias(n) for n in names])).cast(RECORD)
    kept = [c for c in df.columns if c != out]
    return step.select(*kept, whole.alias(out))
