"""Checks of model answers against a document schema, compiled once and run per answer.

The check is plain Python because it runs inside the batch function, right behind the call whose
answer it judges: an answer that fails is a failed call and may be asked for again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Collection, Mapping, Sequence
from typing import Any

from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructType

from ..schemas import DEFAULTS, DOCUMENT, POST_DOMAINS, REQUIRED, ROLE_DOMAINS

# (value, place in the answer, faults) -> value as it is stored; faults are added to the list.
Part = Callable[[Any, str, list[str]], Any]
_MISSING = object()


class BadAnswer(ValueError):
    """The answer of a model does not fit the document schema; names every fault."""


def _kind(value: Any) -> str:
    names = {dict: "object", list: "list", tuple: "list", str: "text", bool: "flag", int: "number", float: "number"}
    return "null" if value is None else names.get(type(value), type(value).__name__)


def _text(allowed: Sequence[str] | None, nullable: bool) -> Part:
    known = frozenset(allowed or ())

    def check(value, place, faults):
        if value is None and nullable:
            return None
        if not isinstance(value, str):
            faults.append(f"{place}: {_kind(value)} instead of text")
        elif allowed is not None and value not in known:
            faults.append(f"{place}: {value!r} is not allowed")
        return value

    return check


def _number(nullable: bool) -> Part:
    """Numbers, and texts that spell one."""

    def check(value, place, faults):
        if value is None and nullable:
            return None
        try:
            number = float(value) if isinstance(value, (int, float, str)) else math.nan
        except (ValueError, OverflowError):
            number = math.nan
        if not math.isfinite(number):
            faults.append(f"{place}: {_kind(value)} instead of a number")
            return value
        return number if isinstance(value, (str, bool)) else value

    return check


def _list(element: Part) -> Part:
    def check(value, place, faults):
        if not isinstance(value, (list, tuple)):
            faults.append(f"{place}: {_kind(value)} instead of a list")
            return value
        return [element(v, f"{place}[{i}]", faults) for i, v in enumerate(value)]

    return check


def _object(fields: Mapping[str, tuple[Part, Any]], complete: bool) -> Part:
    """``fields``: the check of a field, and what a missing one stands for (``_MISSING``: it must be there)."""

    def check(value, place, faults):
        if not isinstance(value, Mapping):
            faults.append(f"{place or 'answer'}: {_kind(value)} instead of an object")
            return value
        out = {} if complete else dict(value)
        for name, (part, default) in fields.items():
            inner = f"{place}.{name}" if place else name
            if name in value:
                out[name] = part(value[name], inner, faults)
            elif default is _MISSING:
                faults.append(f"{inner}: missing")
            elif complete:
                # A copy that its own part has completed: defaults of inner objects come with it.
                out[name] = part(default() if callable(default) else default, inner, faults)
        return out

    return check


def _part(
    kind: DataType, path: str, domains: Mapping[str, Sequence[str]], required: Collection[str],
    defaults: Mapping[str, str], complete: bool,
) -> tuple[Part, Any]:
    if isinstance(kind, StructType):
        fields = {
            f.name: _part(f.dataType, f"{path}.{f.name}" if path else f.name, domains, required, defaults, complete)
            for f in kind.fields
        }
        return _object(fields, complete), dict
    if isinstance(kind, ArrayType):
        element, _ = _part(kind.elementType, path, domains, {path, *required}, defaults, complete)
        return _list(element), list
    if not isinstance(kind, (StringType, DoubleType)):
        raise TypeError(f"no check for {kind.simpleString()} at {path}")
    allowed = domains.get(path)
    nullable = path not in required and allowed is None
    default = _MISSING if path in required else None if allowed is None else defaults.get(path, "unstated")
    return (_text(allowed, nullable) if isinstance(kind, StringType) else _number(nullable)), default


def compile_check(
    schema: StructType,
    domains: Mapping[str, Sequence[str]],
    required: Collection[str] = (),
    defaults: Mapping[str, str] = {},
    complete: bool = False,
) -> Callable[[Any], dict]:
    """A function that returns a good answer and raises ``BadAnswer`` for another one.

    ``domains`` and ``required`` name fields by dotted paths, lists without index. Objects and lists
    must not be null, fields with a domain neither; other fields may be null or missing unless they are
    required. Fields that the schema does not know are ignored. With ``complete`` the answer comes
    back with all fields of the schema and no other, missing ones filled in: by the default of their
    domain, ``unstated`` if none is named, by empty objects and lists, by null.
    """
    part, _ = _part(schema, "", domains, required, defaults, complete)

    def check(answer: Any) -> dict:
        faults: list[str] = []
        checked = part(answer, "", faults)
        if faults:
            raise BadAnswer("; ".join(faults))
        return checked

    return check


def document_check(complete: bool = False) -> Callable[[Any], dict]:
    """The check of extracted documents, with the closed domains of posts and roles."""
    domains = {**POST_DOMAINS, **{f"roles.{f}": d for f, d in ROLE_DOMAINS.items()}}
    return compile_check(DOCUMENT, domains, REQUIRED, DEFAULTS, complete)
