"""Pieces of SQL shared by the oracles."""

#: The Unicode property White_Space, as SQL patterns write it.
WS = r"\t\n\x0b\x0c\r \x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def collapsed(x: str) -> str:
    return strip(f"regexp_replace({x}, '[{WS}]+', ' ', 'g')")


def lowered(x: str) -> str:
    return f"lower({collapsed(x)})"


def lines(x: str) -> str:
    """Lines without a last empty one."""
    cut = rf"regexp_split_to_array(replace({x}, chr(13) || chr(10), chr(10)), '[\n\r\x0b\x0c\x1c-\x1e\x{{0085}}\x{{2028}}\x{{2029}}]')"
    return f"(CASE WHEN ({cut})[-1] = '' THEN list_slice({cut}, 1, greatest(len({cut}) - 1, 0)) ELSE {cut} END)"


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND {strip(x)} <> '')"


def iso(x: str) -> str:
    """A strict ISO date."""
    return rf"(CASE WHEN regexp_full_match({strip(x)}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN try_strptime({strip(x)}, '%Y-%m-%d')::DATE END)"


def normal(x: str) -> str:
    """The search form: without accents and case, & read as "and", other signs one blank. Halves and the like as they decompose."""
    return identity(f"replace({x}, '&', ' and ')")


#: Characters whose compatibility form isn't a letter with marks, as far as the tables have them; fixed values.
_COMPATIBLE = {"½": "1 2", "¼": "1 4", "¾": "3 4", "²": "2", "³": "3", "¹": "1", "ſ": "s", "ª": "a", "º": "o", "ĳ": "ij", "ﬁ": "fi", "ﬂ": "fl", "™": "tm", "ⁿ": "n"}


def identity(x: str) -> str:
    """Letters and digits without accents and case, in single blanks."""
    for sign, plain in _COMPATIBLE.items():
        x = f"replace({x}, '{sign}', '{plain}')"
    return f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g'))"


COMPANY = r"\&|\bund\b|\bet\b|\bgmbh\b|\bag\b|\bsa\b|\bco\.|\bkg\b|\bltd\b|\binc\b|\bcorp\b|\bs\.a\.|\bs\.r\.l\."


def company(x: str) -> str:
    letters, capitals = rf"length(regexp_replace({x}, '\P{{L}}', '', 'g'))", rf"length(regexp_replace({x}, '\P{{Lu}}', '', 'g'))"
    return f"coalesce(regexp_matches(lower({x}), '{COMPANY}') OR ({letters} > 0 AND {capitals} > {letters} * 0.6), false)"


#: The distinct entities of each delivered record: rec_id, kind, pos (in the list), name, address.
ENTITIES = f"""
    raw AS (SELECT rec_id, 'inventors' AS kind, unnest(prediction.inventors) AS e, generate_subscripts(prediction.inventors, 1) AS pos FROM predictions_all WHERE prediction IS NOT NULL
            UNION ALL SELECT rec_id, 'assignees', unnest(prediction.assignees), generate_subscripts(prediction.assignees, 1) FROM predictions_all WHERE prediction IS NOT NULL),
    clean AS (SELECT rec_id, kind, pos, {strip('e.name')} AS name, nullif({strip('e.address')}, '') AS address FROM raw WHERE {present('e.name')}),
    firsts AS (SELECT *, row_number() OVER (PARTITION BY rec_id, kind, {lowered('name')}, coalesce({lowered('address')}, '') ORDER BY pos) AS rn FROM clean),
    entities AS (SELECT rec_id, kind, name, address, row_number() OVER (PARTITION BY rec_id, kind ORDER BY pos) AS pos FROM firsts WHERE rn = 1)
"""
