"""Nested JSON and encoded text, by Arrow kernels that see a batch at a time."""

from __future__ import annotations

import html
import json
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType

def _rows(**fields) -> ArrayType:
    return ArrayType(StructType([StructField(k, t) for k, t in fields.items()]))


_TEXT, _INT = StringType(), IntegerType()
NODES = _rows(document=_INT, path=_TEXT, name=_TEXT, kind=_TEXT, value=_TEXT, parent=_INT)
ABOUT = _rows(identity=_TEXT, types=_TEXT, description=_TEXT)
_KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}
_NODE = pa.struct([("document", pa.int32()), ("path", pa.string()), ("name", pa.string()), ("kind", pa.string()), ("value", pa.string()), ("parent", pa.int32())])


class _Number(str):
    """A number as it is written."""


#: Made once: json.loads and json.dumps with options make theirs anew for each call.
_DECODER = json.JSONDecoder(parse_int=_Number, parse_float=_Number, parse_constant=_Number)
_PLAIN = json.JSONDecoder(parse_int=str)  # where no value is shown; an int of many digits would be refused


def walk(value) -> Iterator[tuple]:
    """(path, name, value, parent) of every value of a parsed document, in its order; parent is the place of a value's
    holder in the walk, -1 for the document. A list's values have no name. Depth is bounded by memory alone."""
    stack, place = [("$", None, value, -1)], 0
    while stack:
        path, name, value, parent = stack.pop()
        yield path, name, value, parent
        if isinstance(value, dict):
            stack += [(f"{path}.{k}", k, v, place) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            stack += [(f"{path}[{i}]", None, v, place) for i, v in reversed(list(enumerate(value)))]
        place += 1


def parsed(text: str, decoder: json.JSONDecoder = _DECODER):
    """A parsed document with numbers as they are written; ValueError if it is none, or nested too deep to be parsed."""
    try:
        try:
            value, end = decoder.scan_once(text, 0)
            if end == len(text):
                return value
        except StopIteration:
            pass
        return decoder.decode(text)  # blanks around it, or no document
    except RecursionError as e:
        raise ValueError("nested too deep") from e


def _nodes_of(texts: list[str | None]) -> list[dict]:
    out = []
    for number, text in enumerate(texts):
        if text is None:
            continue
        first = len(out)
        try:
            document = parsed(text)
        except ValueError:
            out.append({"document": number, "path": "$", "name": None, "kind": "invalid", "value": text, "parent": -1})
            continue
        for path, name, value, parent in walk(document):
            kind = "number" if isinstance(value, _Number) else _KINDS[type(value)]
            shown = None if kind in ("object", "array", "null") else str(value).lower() if kind == "boolean" else str(value)
            out.append({"document": number, "path": path, "name": name, "kind": kind, "value": shown, "parent": parent + first if parent >= 0 else -1})
    return out


@F.arrow_udf(NODES)
def json_nodes(documents: pa.Array) -> pa.Array:
    """All values of an array of JSON documents, one after another; ``parent`` is the place of a value's holder in the
    result. A document that is no JSON is one value of kind ``invalid``; a null array gives null."""
    return pa.array([None if texts is None else _nodes_of(texts) for texts in documents.to_pylist()], pa.list_(_NODE))


def _names(texts: list[str | None]) -> list[str]:
    found = set()
    for text in texts:
        if text is None:
            continue
        try:
            stack = [parsed(text, _PLAIN)]
        except ValueError:
            continue
        while stack:
            value = stack.pop()
            if isinstance(value, dict):
                found.update(value)
                value = value.values()
            elif not isinstance(value, list):
                continue
            stack += [v for v in value if isinstance(v, (dict, list))]
    return sorted(found)


@F.arrow_udf(ArrayType(_TEXT))
def json_names(documents: pa.Array) -> pa.Array:
    """The names of all fields at any depth of an array of JSON documents, each once; those of json_nodes without its other
    columns, which take most of its time. What is no JSON has none; a null array gives null."""
    return pa.array([None if texts is None else _names(texts) for texts in documents.to_pylist()], pa.list_(pa.string()))


def _described(texts: list[str | None]) -> list[dict]:
    out = []
    for text in texts:
        try:
            document = parsed(text or "")
        except ValueError:
            continue
        for *_, value, _ in walk(document):
            if isinstance(value, dict) and type(value.get("description")) is str:
                types = value.get("@type") or ""
                named = " ".join(str(value.get(k, "")) for k in ("@id", "url", "name"))
                out.append({"identity": named, "types": " ".join(map(str, types)) if isinstance(types, list) else str(types), "description": value["description"]})
    return out


_ABOUT = pa.struct([("identity", pa.string()), ("types", pa.string()), ("description", pa.string())])


@F.arrow_udf(ABOUT)
def described_nodes(documents: pa.Array) -> pa.Array:
    """The objects with a description in an array of JSON documents, at any depth: what names them (@id, url and name),
    their types and the description. Documents that are no JSON have none."""
    return pa.array([None if texts is None else _described(texts) for texts in documents.to_pylist()], pa.list_(_ABOUT))


@F.arrow_udf(_TEXT)
def percent_decoded(text: pa.Array) -> pa.Array:
    """Text with its valid %XX escapes decoded as UTF-8; a bare % and all else stays as it is."""
    return pa.array([x if x is None or "%" not in x else urllib.parse.unquote(x) for x in text.to_pylist()], pa.string())


@F.arrow_udf(ArrayType(_TEXT))
def _unquoted(runs: pa.Array) -> pa.Array:
    return pa.array([None if r is None else [urllib.parse.unquote(x) for x in r] for r in runs.to_pylist()], pa.list_(pa.string()))


#: Escapes that follow one another, which together may be one character.
_ESCAPES = "(?:%[0-9A-Fa-f]{2})+"


def percent_replaced(df: DataFrame, text: str) -> DataFrame:
    """df with percent_decoded of a column: only the escapes leave the JVM, however long the texts are."""
    decoded = df.withColumn("_runs", _unquoted(F.regexp_extract_all(text, F.lit(_ESCAPES), 0)))
    pieces = F.zip_with(F.split(text, _ESCAPES), "_runs", lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return decoded.withColumn(text, F.array_join(pieces, "")).drop("_runs")


@F.arrow_udf(_TEXT)
def unescaped(text: pa.Array) -> pa.Array:
    """Text with all named and numbered character references replaced."""
    return pa.array([x if x is None or "&" not in x else html.unescape(x) for x in text.to_pylist()], pa.string())


def values_named(nodes: Column, names: tuple[str, ...], kinds: tuple[str, ...] = ("string", "number")) -> Column:
    """The values of the nodes of these names and kinds."""
    wanted = F.filter(nodes, lambda x: x["name"].isin(*names) & x["kind"].isin(*kinds))
    return F.transform(wanted, lambda x: x["value"])


def _fields(texts: list[str | None]) -> list[list[tuple[str, str]] | None]:
    out = []
    for text in texts:
        try:
            document = parsed(text or "")
        except ValueError:
            document = None
        out.append([(k, _canonical(v)) for k, v in document.items()] if isinstance(document, dict) else None)
    return out


#: json.dumps of a text with ensure_ascii=False.
_quoted = json.encoder.encode_basestring


def _canonical(value) -> str:
    """JSON without blanks, names in order, numbers as they are written."""
    kind = type(value)
    if kind is str:
        return _quoted(value)
    if kind is _Number:
        return str(value)
    if kind is dict:
        return "{" + ",".join([f"{_quoted(k)}:{_canonical(value[k])}" for k in sorted(value)]) + "}"
    if kind is list:
        return "[" + ",".join([_canonical(v) for v in value]) + "]"
    return "null" if value is None else "true" if value else "false"


@F.arrow_udf(ArrayType(MapType(_TEXT, _TEXT)))
def json_fields(documents: pa.Array) -> pa.Array:
    """Of each of an array of JSON objects its fields as canonical JSON, so that texts and numbers differ; null for what is
    no object."""
    kind = pa.list_(pa.map_(pa.string(), pa.string()))
    return pa.array([None if texts is None else _fields(texts) for texts in documents.to_pylist()], kind)
