"""Strict JSON decoding and variant tests.

The helpers take and return SQL expression text over column names: the envelope
rules are large, and one parsed text plans faster than hundreds of column calls.
Only names from this package are ever formatted into the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def settle(df: DataFrame, *names: str) -> DataFrame:
    """Compute ``names`` once per row, however often later steps refer to them.

    Catalyst pushes a filter through a projection by copying the projected
    expressions into it, which would repeat JSON parsing once per reference.
    A generator over a one-element array keeps filters on these columns above it.
    """
    others = [f"`{c}`" for c in df.columns if c not in names]
    row = ", ".join(f"`{n}`" for n in names)
    return df.selectExpr(*others, f"inline(array(struct({row})))")


def with_strict_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the variant of the JSON document in ``text``, or NULL.

    ``try_parse_json`` ignores whatever follows the first document. The text is
    therefore parsed as the first of two array elements, the second being its own
    digest, which the text cannot contain: if the digest does not come back as
    element 1, something other than exactly one document was there.

    Escapes of NUL and of half a surrogate pair are valid JSON, but no stored text
    could hold them, so such a text counts as invalid.
    """
    # Without escaped backslashes and whole pairs, what is left of these is lone.
    bare = rf"replace({text}, r'\\', ' ')"
    pair = r"r'\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}'"
    unstorable = rf"""contains({text}, r'\u') and (contains({bare}, r'\u0000')
        or regexp_replace({bare}, {pair}, ' ') rlike r'\\u[dD][89a-fA-F]')"""
    checked = f"is_valid_utf8({text}) and not ({unstorable})"
    probe = f"_{out}_probe"
    return df.selectExpr(
        "*",
        f"""case when {checked}
                 then try_parse_json(concat('[', {text}, ',"', md5({text}), '"]')) end as {probe}""",
    ).selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"""case when try_variant_get({probe}, '$[1]', 'string') = md5({text})
                 then try_variant_get({probe}, '$[0]', 'variant') end as {out}""",
    )


def members(value: str, *names: str) -> str:
    """A struct of the named members, NULL unless ``value`` is a JSON object.

    An absent member is SQL NULL; a member that is JSON null stays a variant.
    """
    fields = ",".join(f"`{n}`:variant" for n in names)
    return f"try_variant_get({value}, '$', 'struct<{fields}>')"


def is_object(value: str) -> str:
    return f"({members(value, '_')} is not null)"


def shape(value: str) -> str:
    """'missing' (absent or JSON null), 'object' or 'other'."""
    return f"""case when {value} is null or is_variant_null({value}) then 'missing'
                    when {is_object(value)} then 'object' else 'other' end"""


def as_text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def string_of(value: str) -> str:
    """Content of a JSON string; NULL for any other kind of value."""
    return f"case when schema_of_variant({value}) = 'STRING' then {as_text(value)} end"


def number_of(value: str) -> str:
    """A JSON number as decimal(18,3); NULL for other kinds and beyond 10^15."""
    # A whole number is read as such: for another type each row would set up a cast.
    return f"""case when schema_of_variant({value}) = 'BIGINT'
                    then try_cast(try_variant_get({value}, '$', 'bigint') as decimal(18,3))
                    when schema_of_variant({value}) in ('DOUBLE', 'FLOAT')
                      or schema_of_variant({value}) like 'DECIMAL%'
                    then try_variant_get({value}, '$', 'decimal(18,3)') end"""


def instant_of_millis(millis: str) -> str:
    """Timestamp of epoch milliseconds, fractions kept to the microsecond; NULL
    outside years 1 to 9999."""
    # 0001-01-01 and 9999-12-31T23:59:59.999 in epoch milliseconds.
    return f"""case when {millis} between -62135596800000 and 253402300799999
                    then timestamp_micros(cast({millis} * 1000 as bigint)) end"""


def python_repr(value: str) -> str:
    """Text of a JSON scalar the way Python's ``repr`` shows it."""
    text = as_text(value)
    escaped = (
        rf"replace(replace(replace(replace({text}, r'\', r'\\'), '\n', r'\n'), "
        r"'\r', r'\r'), '\t', r'\t')"
    )
    return rf"""case
        when {value} is null or is_variant_null({value}) then 'None'
        when schema_of_variant({value}) = 'STRING' then
            case when contains({text}, "'") and not contains({text}, '"')
                 then concat('"', {escaped}, '"')
                 else concat("'", replace({escaped}, "'", r"\'"), "'") end
        when schema_of_variant({value}) = 'BOOLEAN' then initcap({text})
        else {text} end"""


def python_str(value: str) -> str:
    """Text of a JSON value the way Python's ``str`` shows it; null stays NULL.

    A fraction of zero is kept apart from an integer, which is a decimal only from
    19 digits on. Integers of over 38 digits and floats in exponent form are shown
    as Spark shows a double.
    """
    text = as_text(value)
    return f"""case when schema_of_variant({value}) = 'BOOLEAN' then initcap({text})
                    when schema_of_variant({value}) rlike '^DECIMAL[(]([0-9]|1[0-8]),0[)]$' then concat({text}, '.0')
                    else {text} end"""


def merged_text(base: str, overlay: str) -> str:
    """JSON text of two objects merged one level deep; the overlay's members win.
    Anything that is not an object counts as an empty object."""

    def as_map(value: str) -> str:
        kind = "'map<string,variant>'"
        empty = f"variant_get(parse_json('{{}}'), '$', {kind})"
        return f"coalesce(try_variant_get({value}, '$', {kind}), {empty})"

    # A lambda names both maps, so that each is made once and not once a key.
    kept = "map_filter(m.base, (k, v) -> not map_contains_key(m.overlay, k))"
    maps = f"array(named_struct('base', {as_map(base)}, 'overlay', {as_map(overlay)}))"
    return f"transform({maps}, m -> to_json(map_concat({kept}, m.overlay)))[0]"
