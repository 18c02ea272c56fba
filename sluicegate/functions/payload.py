"""Reading JSON objects out of text: strict whole-text parse, known fields, the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.constants import KNOWN_FIELDS


def wrapped(raw: Column) -> Column:
    """The text between square brackets.

    A JSON reader stops at the end of the first value and ignores what follows it. Read as
    the only element of an array, the text must be one whole value.
    """
    return F.concat(F.lit("["), raw, F.lit("]"))


def parse_elements(raw: Column, fields: str) -> Column:
    """All objects found in the bracketed text; NULL when it is not an array of objects."""
    return F.from_json(wrapped(raw), f"array<struct<{fields}>>")


def closes_early(raw: Column) -> Column:
    """True when the text itself closes the bracket of :func:`wrapped`, as in ``{..}]`` or ``{..}],[{..}``.

    Only text with an object directly before a bracket can, so only that is read again, this
    time inside an object, where a stray bracket is an error.
    """
    suspicious = F.contains(raw, F.lit("]")) & raw.rlike(r"\}\s*\]")
    inside_object = F.json_object_keys(F.concat(F.lit('{"r":'), raw, F.lit("}")))
    return F.coalesce(F.when(suspicious, inside_object.isNull()), F.lit(False))


def is_one_object(raw: Column, elements: Column) -> Column:
    """Whether the whole text is exactly one JSON object (or the word ``null``)."""
    return F.coalesce((F.size(elements) == 1) & ~closes_early(raw), F.lit(False))


def known_fields_ddl() -> str:
    """The known fields as text, whatever their JSON type; of a repeated key the last one counts."""
    return ", ".join(f"{name}: string" for name in KNOWN_FIELDS)


def typed_entries(df: DataFrame, raw: Column, kind: str = "map<string, variant>") -> Column:
    """Entries of an object with their JSON types; of a key repeated anywhere inside a value the last one counts.

    Spark refuses repeated keys in variants unless told otherwise, and then the whole object would be lost.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return F.from_json(raw, kind)


def unknown_entries(entries: Column) -> Column:
    """Entries of a ``map<string, variant>`` whose key is not a known field."""
    return F.map_filter(entries, lambda key, _: ~key.isin(*KNOWN_FIELDS))


def last_wins(entries: Column) -> Column:
    """Keep the last of repeated keys. Costs nothing noticeable unless a key does repeat."""
    keys = F.map_keys(entries)

    def not_repeated_later(entry: Column, index: Column) -> Column:
        return ~F.array_contains(F.slice(keys, index + 2, F.size(keys)), entry["key"])

    unique = F.map_from_entries(F.filter(F.map_entries(entries), not_repeated_later))
    repeats = (F.size(entries) > 1) & (F.size(F.array_distinct(keys)) < F.size(keys))
    return F.when(repeats, unique).otherwise(entries)


def collect_ext_json(entries: Column) -> Column:
    """Unknown entries as JSON object text, NULL when there are none; JSON types are kept, nulls left out."""
    shown = F.map_filter(last_wins(entries), lambda _, value: ~F.is_variant_null(value))
    return F.when(F.size(entries) > 0, F.to_json(shown))
