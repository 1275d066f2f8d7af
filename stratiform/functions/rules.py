"""Declarative predicates: dictionaries of column, op and value compiled to one boolean Column.

A rule's result is never null. Null never matches, but for `is_null`; numeric operators read text as a number and want a finite one.
On an array column any item may match, except that `ne`, `not_in` and `is_null` want all of them to; items that are null
are left out first, and an empty or all-null array counts as null. A column that the table lacks never matches.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPS = ("eq", "ne", "in", "not_in", "contains", "icontains", "regex", "lt", "lte", "gt", "gte", "is_null", "not_null")
_LISTS = ("in", "not_in")
_BARE = ("is_null", "not_null")
_ALL = ("ne", "not_in")


def number(c: Column) -> Column:
    """A finite double, else null."""
    d = c.cast("string").try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def scalar(c: Column, op: str, value=None) -> Column:
    if op == "eq":
        test = c == F.lit(value)
    elif op == "ne":
        test = c != F.lit(value)
    elif op in _LISTS:
        test = c.isin(list(value)) if op == "in" else ~c.isin(list(value))
    elif op == "contains":
        test = F.contains(c.cast("string"), F.lit(str(value)))
    elif op == "icontains":
        test = F.contains(F.lower(c.cast("string")), F.lit(str(value).lower()))
    elif op == "regex":
        test = c.cast("string").rlike(str(value))
    elif op in ("lt", "lte", "gt", "gte"):
        n, v = number(c), F.lit(float(value))
        test = {"lt": n < v, "lte": n <= v, "gt": n > v, "gte": n >= v}[op]
    elif op == "is_null":
        return c.isNull()
    elif op == "not_null":
        return c.isNotNull()
    else:
        raise ValueError(f"unknown operator {op!r}")
    return F.coalesce(test, F.lit(False))


def rule(df: DataFrame, r: Mapping) -> Column:
    name, op, value = r["column"], r["op"], r.get("value")
    if name not in df.columns:
        return F.lit(False)
    c = F.col(f"`{name}`")
    if not isinstance(df.schema[name].dataType, T.ArrayType):
        return scalar(c, op, value)
    items = F.filter(c, lambda x: x.isNotNull())
    filled = F.coalesce(F.size(items) > 0, F.lit(False))
    if op in _BARE:
        return ~filled if op == "is_null" else filled
    test = F.forall if op in _ALL else F.exists
    return filled & F.coalesce(test(items, lambda x: scalar(x, op, value)), F.lit(False))


def combined(df: DataFrame, rules: Sequence[Mapping], logic: str = "and") -> Column:
    return reduce((lambda a, b: a & b) if logic == "and" else (lambda a, b: a | b), [rule(df, r) for r in rules])


def validated(group: Mapping, field: str = "rules") -> dict:
    """The group with logic filled in; ValueError on anything that could not run."""
    rules = group.get("rules")
    if not isinstance(rules, Sequence) or isinstance(rules, str) or not rules:
        raise ValueError(f"{field}: rules must be a list with at least one rule")
    logic = group.get("logic", "and" if len(rules) == 1 else None)
    if logic not in ("and", "or"):
        raise ValueError(f"{field}: several rules need logic 'and' or 'or'")
    for r in rules:
        if not isinstance(r, Mapping) or not isinstance(r.get("column"), str) or not r["column"].strip():
            raise ValueError(f"{field}: a rule needs a column")
        op = r.get("op")
        if op not in OPS:
            raise ValueError(f"{field}: unknown operator {op!r}")
        if op in _BARE:
            continue
        if "value" not in r:
            raise ValueError(f"{field}: {op} needs a value")
        if (op in _LISTS) != isinstance(r["value"], (list, tuple)):
            raise ValueError(f"{field}: {op} needs {'a list' if op in _LISTS else 'a single value'}")
        if op == "regex":
            re.compile(r["value"])
        if op in ("lt", "lte", "gt", "gte"):
            float(r["value"])
    return {**group, "rules": list(rules), "logic": logic}


def keep_mask(df: DataFrame, group: Mapping) -> Column:
    """Which rows a keep or discard group retains; with keep_null also those where a ruled column is null."""
    group = validated(group)
    if group.get("kind") not in ("keep", "discard"):
        raise ValueError("kind must be 'keep' or 'discard'")
    mask = combined(df, group["rules"], group["logic"])
    if group["kind"] == "discard":
        mask = ~mask
    if group.get("keep_null"):
        for name in dict.fromkeys(r["column"] for r in group["rules"]):
            mask = mask | rule(df, {"column": name, "op": "is_null"})
    return mask


def filtered(df: DataFrame, groups: Sequence[Mapping], on_missing: str = "skip") -> DataFrame:
    """Groups one after the other. A group that names an absent column is skipped, an error, or matches nothing (false)."""
    for group in groups:
        absent = [r["column"] for r in group["rules"] if r["column"] not in df.columns]
        if absent and on_missing == "raise":
            raise ValueError(f"columns {absent} are missing")
        if absent and on_missing == "skip":
            continue
        df = df.filter(keep_mask(df, group))
    return df


def from_values(filters: Mapping[str, Sequence]) -> list[dict]:
    """{column: values} as keep groups."""
    return [{"kind": "keep", "rules": [{"column": c, "op": "in", "value": list(v)}], "logic": "and"} for c, v in filters.items()]


def from_arguments(arguments: Sequence[str], config: Sequence[Mapping] = ()) -> list[dict]:
    """`column=a,b` arguments as keep groups; columns that config names already keep config's groups."""
    taken = {r["column"] for g in config for r in g["rules"]}
    out = [dict(g) for g in config]
    for argument in arguments:
        name, sign, values = argument.partition("=")
        if not sign or not name.strip():
            raise ValueError(f"not column=value: {argument!r}")
        if name.strip() not in taken:
            out += from_values({name.strip(): [v.strip() for v in values.split(",") if v.strip()]})
    return out


def blank(c: Column) -> Column:
    """Null or only white space."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def searched(df: DataFrame, text: str, columns: Sequence[str] | None = None, how: str = "contains", case: bool = False) -> DataFrame:
    """Rows in which any of the columns contains, equals or matches the text."""
    names = columns or df.columns
    tests = []
    for name in names:
        c = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
        if how == "regex":
            tests.append(c.rlike(text if case else f"(?i){text}"))
            continue
        c, t = (c, text) if case else (F.lower(c), text.lower())
        tests.append(F.contains(c, F.lit(t)) if how == "contains" else c == t)
    return df.filter(reduce(lambda a, b: a | b, tests))
