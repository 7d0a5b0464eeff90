"""Diagnosis-code predicates built from the catalogue.

Ranges compare string prefixes under Spark's binary string order, so 'F1' is
inside F00..F99 while 'F9X', 'f32' and a dotted 'S72.0' are not.

Each predicate is rendered as one SQL expression and handed to ``F.expr``:
Catalyst gets the same plan as from chained ``Column`` calls, and building a
query costs one call per group instead of dozens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regstat.catalogue import CodeGroup, MainDiagnosis, PrefixRange, PrefixSet, ServiceSpec


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_sql(code: str, rule: PrefixRange | PrefixSet) -> str:
    if isinstance(rule, PrefixRange):
        spans = [(rule.lo, rule.hi)]
    else:
        spans = [(v, v) for v in rule.values]
    if any(len(hi) != rule.width for _, hi in spans):
        raise ValueError(f"upper bounds of {rule} must have the rule's width")
    return "(" + " OR ".join(f"({code} >= {_lit(lo)} AND {code} < {_lit(_next(hi))})" for lo, hi in spans) + ")"


def _next(prefix: str) -> str:
    """The least string above every string that starts with ``prefix``. A
    comparison with it is a plain column predicate, so parquet skips row
    groups by it; ``substring(code, 1, n) <= prefix`` is the same test."""
    return prefix[:-1] + chr(ord(prefix[-1]) + 1)


def group_predicate_sql(code: str, group: CodeGroup) -> str:
    """SQL text: the code (a column name) belongs to the group."""
    return "(" + " OR ".join(_rule_sql(code, r) for r in group.rules) + ")"


def group_predicate(code: str, group: CodeGroup) -> Column:
    """Boolean: the code belongs to the group (NULL code -> NULL)."""
    return F.expr(group_predicate_sql(code, group))


def group_flag(code: str, group: CodeGroup) -> Column:
    """0/1 integer flag, never NULL (a NULL code gives 0)."""
    return F.expr(f"CASE WHEN {group_predicate_sql(code, group)} THEN 1 ELSE 0 END")


def group_flags(code: str, groups) -> list[Column]:
    return [group_flag(code, g).alias(g.name) for g in groups]


def cohort_predicate(code: str, spec: ServiceSpec) -> Column:
    """The code is relevant to the service: it falls in any of its groups."""
    return F.expr(cohort_predicate_sql(code, spec))


def group_flag_sql(code: str, group: CodeGroup) -> str:
    return f"CASE WHEN {group_predicate_sql(code, group)} THEN 1 ELSE 0 END AS {group.name}"


def cohort_predicate_sql(code: str, spec: ServiceSpec) -> str:
    return "(" + " OR ".join(group_predicate_sql(code, g) for g in spec.groups) + ")"


def main_diagnosis_sql(sel: MainDiagnosis) -> str:
    """SQL text of the main-diagnosis selector: plain column predicates, so
    parquet receives them as pushed filters."""
    if sel.kind == "type":
        nos = ", ".join(str(n) for n in sel.code_nos)
        return f"(code_type = {sel.code_type} AND code_no IN ({nos}))"
    if sel.kind == "axis":
        return f"(axis = {sel.axis} AND condition = {sel.condition})"
    raise ValueError(f"unknown selector kind {sel.kind!r}")


def main_diagnosis(sel: MainDiagnosis) -> Column:
    return F.expr(main_diagnosis_sql(sel))
