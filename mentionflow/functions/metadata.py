"""Predicates on the JSON metadata of a post."""

from __future__ import annotations

import json
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(raw: Column) -> Column:
    return F.try_parse_json(raw)


#: Numbers up to here are compared exactly; larger ones as doubles.
_EXACT = 10**19


def _member(node: Column, key: str, data_type: str) -> Column:
    """A value of an object by key, whatever characters the key has."""
    for quote in "'\"":
        if quote not in key and "\\" not in key:
            return F.try_variant_get(node, f"$[{quote}{key}{quote}]", data_type)
    members = F.try_variant_get(node, "$", "map<string,variant>")
    return F.try_variant_get(F.try_element_at(members, F.lit(key)), "$", data_type)


def value(raw: Column, key: str, data_type: str) -> Column:
    """A top-level value cast to a type; null when absent or not castable."""
    return _member(parsed(raw), key, data_type)


def has_key(raw: Column, key: str) -> Column:
    """Whether the object has the top-level key, a JSON null counting as present."""
    return F.coalesce(F.array_contains(F.json_object_keys(raw), key), F.lit(False))


def contains(raw: Column, pattern: Any) -> Column:
    """Whether the JSON contains the pattern: objects by key, arrays by element, scalars by type and value."""
    return F.coalesce(_contains(parsed(raw), pattern), F.lit(False))


def _contains(node: Column, pattern: Any) -> Column:
    if isinstance(pattern, dict):
        test = F.to_json(node).startswith("{")
        for key, part in pattern.items():
            test = test & _contains(_member(node, key, "variant"), part)
        return test
    if isinstance(pattern, list):
        items = F.try_variant_get(node, "$", "array<variant>")
        test = F.to_json(node).startswith("[")
        for part in pattern:
            test = test & _some(items, part)
        return test
    text = F.to_json(node)
    if isinstance(pattern, bool) or pattern is None or isinstance(pattern, str):
        return text == F.lit(json.dumps(pattern, ensure_ascii=False))
    if abs(pattern) < _EXACT:
        same = F.try_variant_get(node, "$", "decimal(38,18)") == F.lit(Decimal(str(pattern))).cast("decimal(38,18)")
    else:
        same = F.try_variant_get(node, "$", "double") == F.lit(float(pattern))
    return text.rlike(r"^[-0-9]") & same


def _some(items: Column, part: Any) -> Column:
    return F.exists(items, lambda item: F.coalesce(_contains(item, part), F.lit(False)))
