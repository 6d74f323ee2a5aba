"""JSON document columns (string-typed) and their extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.functions._col import as_col
from rankforge.functions.text import simple_lower, strip_chars


def json_text(doc, path: str) -> Column:
    """Scalar at ``path`` as text (strings unquoted, arrays/objects as JSON)."""
    return F.get_json_object(as_col(doc), path)


def json_fields(doc, paths: dict[str, str]) -> list[Column]:
    """``{alias: path}`` -> aliased text columns."""
    return [json_text(doc, p).alias(a) for a, p in paths.items()]


def json_list_as_csv(doc, path: str) -> Column:
    """A JSON array of strings as comma-joined text: ``["A","B"]`` -> ``A,B``.

    Brackets and double quotes are deleted from the whole text, so an empty
    array gives ``''``.
    """
    return strip_chars(json_text(doc, path), '[]"')


def array_has_struct(arr, match: dict) -> Column:
    """True when the array of structs ``arr`` holds an element whose fields
    equal ``match`` (field order as given); False otherwise, also for NULL.

    A struct ``array_contains`` (whole-stage codegen), not a lambda.
    """
    probe = F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("string").alias(k)
                       for k, v in match.items()])
    return F.coalesce(F.array_contains(as_col(arr), probe), F.lit(False))


def json_object(doc) -> Column:
    """An object document as a map from its keys to their values' texts, entries in the document's
    order; NULL where the text is no JSON object. Numbers and nested values are their JSON text."""
    return F.from_json(as_col(doc), "map<string,string>")


def first_of(obj, key: str) -> Column:
    """The value of a key in a :func:`json_object`; of a repeated key the first one."""
    return F.try_element_at(as_col(obj), F.lit(key))


# A JSON string with nothing escaped.
_PLAIN_TEXT = r'"[^"\\\x00-\x1f]*"'
_PLAIN_TEXTS = rf'\A\["([^"\\\x00-\x1f]*)"(?:,{_PLAIN_TEXT})*+\]\z'


def first_text(text) -> Column:
    """The first of :func:`list_texts`; lists of strings with nothing escaped aren't parsed for it."""
    c = as_col(text)
    return F.when(c.rlike(_PLAIN_TEXTS), F.regexp_extract(c, _PLAIN_TEXTS, 1)).otherwise(F.try_element_at(list_texts(c), F.lit(1)))


def list_texts(text) -> Column:
    """A JSON array's elements as texts; NULL for anything else."""
    return F.from_json(as_col(text), "array<string>")


def list_objects(text, fields: list[str]) -> Column:
    """A JSON array of objects as structs of text ``fields`` (the first value of a repeated key); NULL for anything else."""
    return F.transform(F.from_json(as_col(text), "array<map<string,string>>"),
                       lambda m: F.struct(*(first_of(m, f).alias(f) for f in fields)))


def list_contains(text, match: dict) -> Column:
    """Whether some object of a JSON array, given as the text :func:`json_object` has of it, has all ``match`` attributes
    (the first value of a repeated one) equal to the given columns/literals; False otherwise, also for NULL.

    Objects of just these attributes in this order, with nothing escaped, are told by the text itself; others are parsed.
    """
    c = as_col(text)
    pairs = [(k, (v if isinstance(v, Column) else F.lit(v)).cast("string")) for k, v in match.items()]
    one = r"\{" + ",".join(f'"{k}":{_PLAIN_TEXT}' for k, _ in pairs) + r"\}"
    plain = rf"\A\[{one}(?:,{one})*+\]\z"
    bits = [b for i, (k, v) in enumerate(pairs) for b in (F.lit(("," if i else "{") + f'"{k}":"'), v, F.lit('"'))]
    told = F.coalesce(F.contains(c, F.concat(*bits, F.lit("}"))), F.lit(False))
    return F.when(c.rlike(plain), told).otherwise(array_has_struct(list_objects(c, list(match)), match))


def is_malformed(doc, parsed=None) -> Column:
    """Whether a text is no JSON document (NULL is no text). ``parsed``: its :func:`json_object`, so that
    only texts that are no object are looked at again."""
    doc = as_col(doc)
    parsed = json_object(doc) if parsed is None else as_col(parsed)
    return F.coalesce(doc.isNotNull() & parsed.isNull() & F.try_parse_json(doc).isNull(), F.lit(False))


def json_array_contains(doc, field: str, match: dict) -> Column:
    """True when some object of the JSON array ``field`` has all ``match``
    attributes equal to the given columns/literals; False otherwise.

    Parses only the one field (one pass over the document) and tests it
    without generating rows.
    """
    return list_contains(first_of(json_object(doc), field), match)


def json_flag_true(doc, path: str) -> Column:
    """1 when the value at ``path`` reads ``true`` (case-insensitive), else 0."""
    return F.when(simple_lower(F.coalesce(json_text(doc, path), F.lit("false"))) == "true", 1).otherwise(0)
