"""Validation of documents against a JSON schema.

The keywords envelopes use are understood: type (one or several), enum, const, required, properties, additionalProperties (false), items, pattern, minimum, maximum,
minLength, minItems, anyOf, allOf and $ref within the schema. Others are refused (ValueError), so that nothing passes unchecked.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KEYWORDS = {"type", "enum", "const", "required", "properties", "additionalProperties", "items", "pattern", "minimum", "maximum", "minLength", "minItems", "anyOf", "allOf", "$ref"}
SILENT = {"$schema", "$id", "$defs", "definitions", "title", "description", "default", "examples", "$comment", "format"}
KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: object, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(value, int | float) and not isinstance(value, bool) and (kind == "number" or float(value).is_integer())
    return isinstance(value, KINDS[kind])


def errors_of(value: object, schema: dict, root: dict | None = None, path: tuple = ()) -> Iterator[tuple[tuple, str]]:
    """(path, message) of everything in ``value`` that the schema does not allow."""
    root = schema if root is None else root
    if unknown := set(schema) - KEYWORDS - SILENT:
        raise ValueError(f"unknown keywords: {sorted(unknown)}")
    if "$ref" in schema:
        target = root
        for step in schema["$ref"].removeprefix("#/").split("/"):
            target = target[step]
        yield from errors_of(value, target, root, path)
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        yield path, f"{value!r} is not of type {', '.join(map(repr, kinds))}"
    if "enum" in schema and value not in schema["enum"]:
        yield path, f"{value!r} is not one of {schema['enum']!r}"
    if "const" in schema and value != schema["const"]:
        yield path, f"{schema['const']!r} was expected"
    for part in schema.get("allOf", []):
        yield from errors_of(value, part, root, path)
    if "anyOf" in schema and all(any(True for _ in errors_of(value, part, root, path)) for part in schema["anyOf"]):
        yield path, f"{value!r} is not valid under any of the given schemas"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                yield path, f"{name!r} is a required property"
        if schema.get("additionalProperties") is False and (more := [k for k in value if k not in known]):
            yield path, f"Additional properties are not allowed ({', '.join(map(repr, sorted(more)))} {'was' if len(more) == 1 else 'were'} unexpected)"
        for name, part in known.items():
            if name in value:
                yield from errors_of(value[name], part, root, (*path, name))
    elif isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            yield path, f"{value!r} is too short"
        for i, x in enumerate(value if "items" in schema else ()):
            yield from errors_of(x, schema["items"], root, (*path, i))
    elif isinstance(value, str):
        if "pattern" in schema and not re.search(schema["pattern"], value):
            yield path, f"{value!r} does not match {schema['pattern']!r}"
        if len(value) < schema.get("minLength", 0):
            yield path, f"{value!r} is too short"
    elif isinstance(value, int | float) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            yield path, f"{value} is less than the minimum of {schema['minimum']}"
        if "maximum" in schema and value > schema["maximum"]:
            yield path, f"{value} is greater than the maximum of {schema['maximum']}"


def messages(text: str | None, schema: dict) -> list[str]:
    """'path:  message' strings of a JSON document by path; its steps are joined by '  >  ', the whole document is (root)."""
    try:
        value = json.loads(text) if text is not None else None
    except ValueError as problem:
        return [f"(root):  no valid JSON: {problem}"]
    found = sorted(errors_of(value, schema), key=lambda e: [str(p) for p in e[0]])
    return [f"{'  >  '.join(map(str, path)) or '(root)'}:  {message}" for path, message in found]


def schema_errors(document: Column, schema: dict) -> Column:
    """``messages`` for a column of JSON texts."""

    @F.pandas_udf("array<string>")
    def check(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: messages(t, schema))

    return check(document)
