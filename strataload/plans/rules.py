"""Cleansing and de-identification rules as one chain of projections.

Each (order, set) step replaces the columns it has a rule for, adds new ones and
passes the others on.  Rule text may come from a named class with placeholders
``<element_name:$1>`` and ``<alias:$1>``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.audit import AUDIT_COLUMNS
from strataload.operators.lookup import prefix_lookup
from strataload.plans.mapping import LAST
from strataload.schema import reorder, standard_names
from strataload.sources.scan import active_rows, latest_per_key

RULE_KINDS = ("element", "lookup", "custom")


@dataclass(frozen=True)
class RuleClass:
    """A reusable rule text; a blank source makes it the generic one."""

    name: str
    sql: str
    source: str = ""
    lookup_arg: str = ""
    full_load_join: str = ""


@dataclass(frozen=True)
class Rule:
    """``element`` gives a column, ``lookup`` a left join, ``custom`` a function
    on the whole frame (a recode).

    ``source`` is a comma list of the sources that the rule is for, blank for all.
    ``lookup`` names the table to join (blank: the one called like ``alias``) and
    ``lookup_arg`` prepares it, ``k:v;k:v`` with the keys ``filter`` (SQL), ``columns``
    and ``keys`` (comma lists), ``pattern`` (its column of ``*`` patterns, matched
    against the rule's column) and ``sep`` (the rule's column is a list).
    """

    kind: str
    column: str = ""
    sql: str = ""
    rule_class: str = ""
    source: str = ""
    parameters: str = ""
    lookup: str = ""
    alias: str = ""
    lookup_arg: str = ""
    full_load_join: str = ""
    order: int = 0
    set: int = LAST
    apply: Callable[[DataFrame], DataFrame] | None = None


def split_args(text: str) -> dict[str, str]:
    """``k:v;k:v`` as a dict."""
    pairs = (item.split(":", 1) for item in text.split(";") if item.strip())
    return {k.strip(): v.strip() for k, v in pairs}


LOOKUP_ARGS = ("filter", "columns", "keys", "pattern", "sep")


def _sources(rule: Rule) -> list[str]:
    return [s.strip() for s in rule.source.split(",") if s.strip()]


def for_source(rules: Sequence[Rule], source: str) -> list[Rule]:
    """The rules of one source: those for all sources and those that list it.

    A rule for several sources comes back as a rule for this one, so that it takes the
    class of this source.
    """
    if not source:
        return list(rules)
    mine = [r for r in rules if not _sources(r) or source in _sources(r)]
    return [replace(r, source=source) for r in mine]


def _class_of(rule: Rule, classes: Sequence[RuleClass]) -> RuleClass | None:
    """The class for one of the rule's sources, else the generic one."""
    named = {c.source: c for c in classes if c.name == rule.rule_class}
    found = next((named[s] for s in _sources(rule) if s in named), None) or named.get("")
    if rule.rule_class and found is None:
        raise KeyError(f"rule class {rule.rule_class!r} is not defined")
    return found


def expand(rule: Rule, classes: Sequence[RuleClass], table: str) -> Rule:
    """Fill in the class text and its placeholders.

    Without parameters ``$1`` of ``element_name`` is the rule's own column and
    the aliases are the table and the lookup alias.
    """
    found = _class_of(rule, classes)
    text = rule.sql or (found.sql if found else "")
    values = {
        "element_name": [rule.column],
        "alias": [table, rule.alias],
    }
    for key, names in split_args(rule.parameters).items():
        values[key] = [
            {"primary_alias": table, "lookup_alias": rule.alias, "default": rule.column}.get(n.strip(), n.strip())
            for n in names.split(",")
        ]

    def fill(match: re.Match) -> str:
        names, position = values[match.group(1)], int(match.group(2))
        return names[position - 1]

    return replace(
        rule,
        sql=re.sub(r"<(\w+):\$(\d+)>", fill, text),
        lookup_arg=rule.lookup_arg or (found.lookup_arg if found else ""),
        full_load_join=rule.full_load_join or (found.full_load_join if found else ""),
    )


def prepared_lookup(
    table: DataFrame,
    mode: str,
    join_type: str = "",
    keys: Sequence[str] = (),
    where: str = "",
    columns: Sequence[str] = (),
) -> DataFrame:
    """Scope, filter and narrow a lookup before it is joined.

    A full load reads the latest row per key, active rows or everything
    (``date_based`` keeps the validity columns); other loads read active rows.  A
    table without ``is_active`` has no history and is read as it is.
    """
    kind = join_type.strip().lower()
    if "is_active" in table.columns and (mode != "full" or kind == "active"):
        out = active_rows(table)
    elif kind == "latest_record":
        out = latest_per_key(table, keys)
    else:
        out = table
    if where:
        out = out.filter(where)
    if columns:
        extra = ["add_date", "delete_date"] if kind == "date_based" else []
        out = out.selectExpr(*dict.fromkeys([*columns, *extra])).distinct()
    return out


def _join_text(rule: Rule, table: str, mode: str) -> str:
    if mode == "full" and rule.full_load_join.strip().lower() == "date_based":
        return f"{rule.sql} and {table}.add_date between {rule.alias}.add_date and {rule.alias}.delete_date"
    return rule.sql


def rule_lookup(df: DataFrame, rule: Rule, lookups: Mapping[str, DataFrame], mode: str) -> DataFrame:
    """The right side of a lookup rule: scoped, filtered, narrowed, patterns resolved."""
    args = split_args(rule.lookup_arg)
    unknown = set(args) - set(LOOKUP_ARGS)
    if unknown:
        raise ValueError(f"unknown lookup arguments {sorted(unknown)} of rule {rule.alias!r}")
    lists = {k: [c.strip() for c in args.get(k, "").split(",") if c.strip()] for k in ("columns", "keys")}
    table = lookups[rule.lookup or rule.alias]
    side = prepared_lookup(table, mode, rule.full_load_join, lists["keys"], args.get("filter", ""), lists["columns"])
    if "pattern" in args:
        side = prefix_lookup(df, rule.column, side, args["pattern"], args.get("sep"))
    return side


def _step(df: DataFrame, rules: Sequence[Rule], lookups: Mapping[str, DataFrame], table: str, mode: str) -> DataFrame:
    for rule in rules:
        if rule.kind == "custom":
            df = rule.apply(df)
    out = df.alias(table)
    for rule in rules:
        if rule.kind == "lookup":
            side = rule_lookup(df, rule, lookups, mode)
            out = out.join(side.alias(rule.alias), F.expr(_join_text(rule, table, mode)), "left")
    new = {r.column.lower(): F.expr(r.sql).alias(r.column.lower()) for r in rules if r.kind == "element"}
    if not new:
        return df
    kept = [new.pop(c.lower(), F.col(f"{table}.{c}")) for c in df.columns]
    return out.select(*kept, *new.values())


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    lookups: Mapping[str, DataFrame],
    table: str,
    classes: Sequence[RuleClass] = (),
    mode: str = "active",
    distinct: bool = False,
    names: Mapping[str, str] | None = None,
    source: str = "",
) -> DataFrame:
    """All rule steps of a table; ``names`` renames to standard names at the end.

    With ``source`` only the rules for that source are applied.
    """
    steps: dict[tuple[int, int], list[Rule]] = {}
    for rule in sorted(for_source(rules, source), key=lambda r: (r.order, r.set)):
        if rule.kind not in RULE_KINDS:
            raise ValueError(f"unknown rule kind {rule.kind!r}")
        steps.setdefault((rule.order, rule.set), []).append(expand(rule, classes, table))
    out = df
    for group in steps.values():
        out = _step(out, group, lookups, table, mode)
    out = reorder(out, [c for c in df.columns if c not in AUDIT_COLUMNS], AUDIT_COLUMNS)
    if distinct:
        out = out.distinct()
    return standard_names(out, names) if names else out
