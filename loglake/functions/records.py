"""CSV and JSON payloads as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A field: blanks, then a quoted or a bare value. Possessive, so that a bad quote fails at once.
FIELD = r'[^\S\n]*+(?:"(?:[^"]++|"")*+"|[^",\n]*+)'
VALID = rf"\A(?:{FIELD}(?:,{FIELD})*+(?:\n+|\z))*+\z"
RECORD = r'((?:[^"\n]++|"(?:[^"]++|"")*+")++)'
VALUE = r',[^\S\n]*+("(?:[^"]++|"")*+"|[^",\n]*+)'


def csv_rows(payload: Column) -> Column:
    """array<array<string>> of strict CSV, blank lines left out; null if a quote is out of place or rows differ in width."""
    text = F.replace(payload, F.lit("\r\n"), F.lit("\n"))
    bare = lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
    values = lambda r: F.transform(F.regexp_extract_all(F.concat(F.lit(","), r), F.lit(VALUE), F.lit(1)), bare)
    rows = F.transform(F.regexp_extract_all(text, F.lit(RECORD), F.lit(1)), values)
    return F.when(text.rlike(VALID), rows)


def same_width(rows: Column) -> Column:
    return F.forall(rows, lambda r: F.size(r) == F.size(rows[0]))


def once(value: Column, use) -> Column:
    """use(value), with the value made once for each row, however often use names it."""
    return F.transform(F.array(value), use)[0]


def json_value(payload: Column) -> Column:
    """The payload's one JSON value as a variant; null if it isn't strict JSON or more than one value.

    In brackets, what follows the value is seen too.
    """
    items = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]"))).try_cast("array<variant>")
    return once(items, lambda x: F.when(F.size(x) == 1, x[0]))


def variants(names) -> str:
    """The type of an object's fields of those names, of any type each."""
    return f"struct<{','.join(f'`{n}`:variant' for n in names)}>"


#: A key with a capital; the parts of a JSON text: keys, other strings, all else.
CAPITAL_KEY = r'\p{Lu}[^"]*"\s*:'
PART = r'("(?:[^"\\]++|\\.)*+"(?:\s*+:)?|[^"]++|")'


def lower_keys(payload: Column) -> Column:
    """JSON text with all keys in lower case, in their order: so a field is found whatever its case, and the last one counts."""
    parts = F.regexp_extract_all(payload, F.lit(PART), F.lit(1))
    lowered = F.array_join(F.transform(parts, lambda p: F.when(p.startswith('"') & p.endswith(":"), F.lower(p)).otherwise(p)), "")
    return F.when(payload.rlike(CAPITAL_KEY), lowered).otherwise(payload)


def fixed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with more columns, made once for each row: the optimizer copies no expression through a generator."""
    # A projection makes them, compiled; the generator only opens the struct.
    made = df.withColumn("__made", F.struct(*[c.alias(n) for n, c in columns.items()]))
    return made.select(*df.columns, F.inline_outer(F.array("__made")))


def present(value: Column) -> Column:
    """A variant that isn't JSON's null, else null."""
    return F.when(~F.is_variant_null(value), value)


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def not_text(value: Column) -> Column:
    return F.coalesce(kind(value) != "STRING", F.lit(False))


def not_object(value: Column) -> Column:
    return F.coalesce(~kind(value).startswith("OBJECT"), F.lit(False))


def port_of(value: Column) -> Column:
    """A number without its fraction, or a string that is one; else null."""
    from loglake.functions.text import integer, trim

    number = kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(number, value.try_cast("double").try_cast("bigint")).when(kind(value) == "STRING", integer(trim(value.try_cast("string"))))
