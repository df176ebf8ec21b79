"""Transforms and coercions of extracted text, and JSON paths, by built-in functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_price(c: Column) -> Column:
    """``€ 1.299,99`` -> ``1299.99``: the last of ``.`` and ``,`` is the decimal point if one
    or two digits follow it."""
    s = F.regexp_replace(c, r"[^0-9.,\-]", "")
    plain = F.regexp_replace(s, r"[.,](?=[0-9.,]*[.,][0-9]{1,2}$)|[.,](?=[0-9]{3}(?:[.,]|$))", "")
    return F.regexp_replace(plain, ",", ".")


def strip_html(c: Column) -> Column:
    no_code = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    text = F.regexp_replace(no_code, r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(text)


def extract_number(c: Column) -> Column:
    return F.regexp_extract(c, r"-?\d+(?:[.,]\d+)?", 0)


TRANSFORMS = {
    "trim": F.trim,
    "lowercase": F.lower,
    "uppercase": F.upper,
    "parse_price": parse_price,
    "strip_html": strip_html,
    "extract_number": extract_number,
    "clean_text": lambda c: F.trim(F.regexp_replace(c, r"\s+", " ")),
    "parse_date": lambda c: F.coalesce(*(F.date_format(F.try_to_timestamp(F.trim(c), F.lit(f)), "yyyy-MM-dd") for f in ("yyyy-MM-dd", "d MMM yyyy", "d.M.yyyy", "M/d/yyyy"))),
    "parse_currency": lambda c: F.when(c.rlike("€|EUR"), "EUR").when(c.rlike("£|GBP"), "GBP").when(c.rlike(r"\$|USD"), "USD").when(c.rlike("kr|SEK"), "SEK"),
    "parse_quantity": lambda c: F.nullif(F.regexp_extract(c, r"(\d+(?:[.,]\d+)?)\s*(?:kg|g|mg|l|cl|ml|dl|st|pcs?)\b", 1), F.lit("")),
    "parse_unit": lambda c: F.nullif(F.regexp_extract(c, r"\d\s*(kg|g|mg|l|cl|ml|dl|st|pcs?)\b", 1), F.lit("")),
    "parse_stock": lambda c: ~F.lower(c).rlike(r"out of stock|sold out|unavailable|outofstock"),
}


def normalize_quantity(c: Column) -> Column:
    """In grams, millilitres or pieces: ``2kg`` -> ``2000``."""
    n = F.replace(TRANSFORMS["parse_quantity"](c), F.lit(","), F.lit(".")).try_cast("decimal(18,6)")
    unit = F.lower(TRANSFORMS["parse_unit"](c))
    size = F.when(unit.isin("kg", "l"), 1000).when(unit == "mg", F.lit(0.001)).when(unit == "cl", 10).when(unit == "dl", 100).otherwise(1)
    return F.regexp_replace((n * size.cast("decimal(12,3)")).cast("string"), r"\.?0+$", "")


def join_array(c: Column, separator: str = ", ") -> Column:
    """A JSON array of texts as one text."""
    return F.array_join(F.from_json(c, "array<string>"), separator)


TRANSFORMS["normalize_quantity"] = normalize_quantity
TRANSFORMS["join_array"] = join_array


def transform(c: Column, *names: str) -> Column:
    for n in names:
        c = TRANSFORMS[n](c)
    return c


def coerce(c: Column, kind: str) -> Column:
    """DECIMAL keeps digits, point and minus, INTEGER digits and minus, BOOLEAN reads
    true/false, yes/no, 1/0, on/off; what doesn't parse is null."""
    kind = kind.upper()
    if kind.endswith("[]"):
        return F.from_json(c, "array<string>")
    if kind.startswith("DECIMAL"):
        return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast(kind.lower() if "(" in kind else "decimal(18,4)")
    if kind in ("INTEGER", "INT", "BIGINT"):
        return F.regexp_replace(c, r"[^0-9\-]", "").try_cast("int" if kind != "BIGINT" else "bigint")
    if kind in ("BOOLEAN", "BOOL"):
        low = F.lower(F.trim(c))
        return F.when(low.isin("true", "yes", "1", "on"), True).when(low.isin("false", "no", "0", "off"), False)
    if kind in ("VARCHAR", "STRING", "TEXT"):
        return c
    return c.try_cast(kind.lower())


_STEP = re.compile(r"""(->>?)\s*(?:'([^']*)'|"([^"]*)"|\[(\d+)\]|(\d+)|([^\s'"\[\->]+))""")


def json_path(c: Column, path: str) -> Column:
    """``->'a'->[0]->>'b'`` on a JSON column. After ``->>`` the value is text, after ``->``
    JSON; a miss is ``''``."""
    steps = _STEP.findall(path)
    target = "$"
    for _, a, b, i, j, k in steps:
        target += f"[{i or j}]" if i or j else f"['{a or b or k}']"
    v = F.get_json_object(c, target)
    if steps and steps[-1][0] == "->":
        # a JSON string loses its quotes on the way out; they are put back
        whole = F.get_json_object(F.to_json(F.struct(v.alias("v"))), "$")
        scalar = v.rlike(r"^(?:\{|\[|-?\d|true$|false$|null$)")
        v = F.when(scalar, v).otherwise(F.regexp_extract(whole, r'^\{"v":(.*)\}$', 1))
    return F.coalesce(v, F.lit(""))
