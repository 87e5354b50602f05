"""DuckDB SQL of the totals of every rule of the catalog over the stand-in tables.

Each family's counts are written out here on their own, from a rule's parameters alone. A rule that reads a column which
no stand-in has is a skipped one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from freightlens.operators.rules import RuleSpec

from . import oracle as o
from .standins import TABLES

#: The columns of each stand-in: what its SQL names, but types of casts.
COLUMNS = {name: set(re.findall(r"\bAS ([A-Z][A-Z0-9_]+)\b", sql)) - {"STRING", "DOUBLE", "TIMESTAMP"} for name, sql in TABLES.items()}
_ROUTE = "^([A-Z]{3}[0-9]{5})([A-Z]{3}[0-9]{5})$"


class NotThere(Exception):
    """A column that no stand-in has."""


def has(table: str, *columns: str) -> None:
    for c in columns:
        if table not in COLUMNS or c not in COLUMNS[table]:
            raise NotThere(f"{table}.{c}")


def counts(source: str, checked: str, failed: str) -> str:
    return f"SELECT count(*) FILTER ({checked}) AS n, count(*) FILTER (({checked}) AND ({failed})) AS f FROM {source}"


def _one_row(r: RuleSpec) -> str:
    c = r["column"]
    has(r.table, c)
    there, n = o.there(c), o.num(c)
    if r.family == "completeness":
        return counts(r.table, "true", f"NOT {there}")
    if r.family == "validity_regex":
        return counts(r.table, there, f"NOT regexp_matches({c}, '^(?:{r['pattern']})')")
    if r.family == "validity_datetime":
        return counts(r.table, there, f"TRY_CAST({c} AS TIMESTAMP) IS NULL")
    if r.family == "validity_integer":
        return counts(r.table, there, f"{n} IS NULL OR {n} <> {o.half_even(n)}")
    if r.family == "validity_in_set":
        return counts(r.table, there, f"{o.norm(c)} NOT IN ({', '.join(repr(x) for x in r['allowed'])})")
    return counts(r.table, f"{n} IS NOT NULL", f"{n} < 0")


def _conditional(r: RuleSpec) -> str:
    c, d = r["column"], r["condition_column"]
    has(r.table, c, d)
    if "condition_regex" in r.params:
        holds = f"regexp_matches({o.key(d)}, '{r['condition_regex']}')"
    elif r.get("condition_mode") == "not_null":
        holds = o.there(d)
    else:
        holds = f"upper({o.key(d)}) = '{r.get('condition_value', 'Y')}'"
    return counts(r.table, holds, f"NOT {o.there(c)}")


def _keys(r: RuleSpec) -> str:
    table, column, part = r["reference_table"], r["reference_column"], r.get("reference_component")
    has(table, column)
    if part:
        return f"(SELECT regexp_extract({o.norm(column)}, '{_ROUTE}', {1 if part == 'origin' else 2}) FROM {table})"
    return f"(SELECT {o.norm(column)} FROM {table} WHERE {o.there(column)})"


def _reference(r: RuleSpec) -> str:
    c = r["column"]
    has(r.table, c)
    if r.family == "non_negative_not_in_reference":
        has(r.table, r["cnote_column"])
        return counts(r.table, f"{o.num(c)} IS NOT NULL", f"{o.num(c)} < 0 OR {o.norm(r['cnote_column'])} IN {_keys(r)}")
    if r.family == "reference_conditional_completeness":
        has(r.table, r["condition_column"])
        return counts(f"{r.table} WHERE {o.norm(r['condition_column'])} IN {_keys(r)}", "true", f"NOT {o.there(c)}")
    odd = f"NOT regexp_matches({o.norm(c)}, '^[A-Za-z0-9]+$') OR " if r.family == "reference_format" else ""
    return counts(f"{r.table} WHERE {o.there(c)}", "true", f"{odd}{o.norm(c)} NOT IN {_keys(r)}")


def _unique(r: RuleSpec) -> str:
    has(r.table, *r["columns"])
    there = " AND ".join(f"{c} IS NOT NULL" for c in r["columns"])
    return counts(f"(SELECT count(*) OVER (PARTITION BY {', '.join(r['columns'])}) AS m FROM {r.table} WHERE {there})", "true", "m > 1")


def _pair(r: RuleSpec, one: str = "left", two: str = "right") -> tuple[str, str, str]:
    a, b = r[f"{one}_table"], r[f"{two}_table"]
    ka, kb = (r.get(f"{s}_join_key") or r["join_key"] for s in (one, two))
    x, y = r[f"{one}_column"], r[f"{two}_column"]
    has(a, ka, x)
    has(b, kb, y)
    right = b
    if latest := r.get("right_latest_by"):
        has(b, latest)
        right = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {kb} ORDER BY {latest} DESC NULLS LAST, {', '.join(f'{c} ASC NULLS FIRST' for c in sorted(COLUMNS[b]))}) AS rn FROM {b}) WHERE rn = 1)"
    return f"{a} AS a JOIN {right} AS b ON a.{ka} IS NOT DISTINCT FROM b.{kb}", f"a.{x}", f"b.{y}"


def _pairs(r: RuleSpec) -> str:
    source, x, y = _pair(r, "start", "end") if r.family == "timeliness" else _pair(r)
    both, n = f"{x} IS NOT NULL AND {y} IS NOT NULL", int(r.get("prefix_length", 3))
    there = f"{o.there(x)} AND {o.there(y)}"
    if r.family == "pair_consistency":
        return counts(source, both, f"CAST({x} AS VARCHAR) <> CAST({y} AS VARCHAR)")
    if r.family == "prefix_match":
        return counts(source, there, f"left({o.key(x)}, {n}) <> left({o.key(y)}, {n})")
    if r.family == "suffix_after_prefix_match":
        return counts(source, there, f"{o.key(x)}[{n + 1}:] <> {o.key(y)}[{n + 1}:]")
    if r.family == "timeliness":
        return counts(source, both, f"{x} > {y}")
    x, y = o.num(x), o.num(y)
    if r.family == "rounded_pair_consistency":
        return counts(source, f"{x} IS NOT NULL AND {y} IS NOT NULL", f"{o.half_even(x)} <> {o.half_even(y)}")
    g = r["duplicate_key"]
    has(r["left_table"], g)
    rows = f"SELECT a.{g} AS g, {x} AS x, {y} AS y FROM {source} WHERE {o.there(f'a.{g}')}"
    over = "OVER (PARTITION BY g)"
    judged = f"SELECT *, count(*) {over} > 1 AND min(round_even(x, 0)) {over} = max(round_even(x, 0)) {over} AND max(round_even(x, 0)) {over} > {r['duplicate_threshold']} AS s FROM ({rows}) WHERE x IS NOT NULL AND y IS NOT NULL"
    return counts(f"(SELECT x, y FROM ({judged}) WHERE NOT s UNION ALL SELECT sum(x), sum(y) FROM ({judged}) WHERE s GROUP BY g)", "true", "round_even(x, 0) <> round_even(y, 0)")


def _path(r: RuleSpec, first: str) -> tuple[str, Callable[[str], str]]:
    """The joins of a path, and a column of it by name: that of the first table that has it."""
    tables = [r[first]]
    source = f"{r[first]} AS t0"

    def column(name: str) -> str:
        for k, t in enumerate(tables):
            if name in COLUMNS.get(t, ()):
                return f"t{k}.{name}"
        raise NotThere(f"{tables[-1]}.{name}")

    has(r[first])
    for k, step in enumerate(r.get("joins", []), 1):
        has(tables[-1], step["left_on"])
        has(step["table"], step["right_on"])
        source += f" JOIN {step['table']} AS t{k} ON {column(step['left_on'])} IS NOT DISTINCT FROM t{k}.{step['right_on']}"
        tables.append(step["table"])
    return source, column


def _paths(r: RuleSpec) -> str:
    source, column = _path(r, "left_table")
    if r.family == "bridged_timeliness":
        x, y = column(r["start_column"]), column(r["end_column"])
        if r.get("aggregate_by_cnote"):
            k = column(r["cnote_column"])
            source, x, y = f"(SELECT min({x}) AS x, min({y}) AS y FROM {source} WHERE {o.there(k)} GROUP BY {k})", "x", "y"
        return counts(source, f"{x} IS NOT NULL AND {y} IS NOT NULL", f"{x} > {y}")
    x, y = column(r["left_column"]), column(r["right_column"])
    if r.get("decimals") is not None:
        x, y = o.num(x), o.num(y)
        return counts(source, f"{x} IS NOT NULL AND {y} IS NOT NULL", f"{o.half_even(x)} <> {o.half_even(y)}")
    part = f"substr({o.key(x)}, {r['substring_start'] + 1}, {r['substring_length']})" if r.family == "bridged_substring_match" else o.key(x)
    return counts(source, f"{o.there(x)} AND {o.there(y)}", f"{part} <> {o.key(y)}")


def _sums(r: RuleSpec) -> str:
    master, key = r["master_table"], r["master_key"]
    value = r.get("master_value_column") or r.get("master_count_column") or r["master_column"]
    has(master, key, value)
    if r.family == "count_consistency":
        has(r["child_table"], r["child_key"], r["count_column"])
        details = f"SELECT {r['child_key']} AS k, count(DISTINCT {r['count_column']}) AS s FROM {r['child_table']} GROUP BY 1"
    else:
        source, column = _path(r, "detail_table")
        found = f"sum({o.num(column(r['detail_value_column']))})" if r.family == "aggregate_sum_consistency" else f"count(DISTINCT {column(r['detail_count_column'])})"
        details = f"SELECT {column(r['detail_key'])} AS k, {found} AS s FROM {source} GROUP BY 1"
    x, s = o.num(value), "s"
    if r.family == "aggregate_sum_consistency":
        x, s = o.half_even(x), o.half_even("s")
    return counts(f"{master} JOIN ({details}) AS d ON {key} = d.k", f"{o.num(value)} IS NOT NULL AND s IS NOT NULL", f"{x} <> {s}")


def _sequence(r: RuleSpec) -> str:
    has("CMS_MFCNOTE", "MFCNOTE_NO", "MFCNOTE_MAN_NO", "MFCNOTE_CRDATE")
    has("CMS_MANIFEST", "MANIFEST_NO", "MANIFEST_CODE")
    events = f"SELECT MFCNOTE_NO AS k, {o.norm('MANIFEST_CODE')} AS c, MFCNOTE_CRDATE AS t FROM CMS_MFCNOTE JOIN CMS_MANIFEST ON MFCNOTE_MAN_NO IS NOT DISTINCT FROM MANIFEST_NO WHERE MFCNOTE_NO IS NOT NULL"
    times = f"(SELECT max(t) FILTER (c = '1') AS om, min(t) FILTER (c = '2') AS t0, max(t) FILTER (c = '2') AS t1, min(t) FILTER (c = '3') AS im, count(t) FILTER (c = '2') AS m, count(DISTINCT t) FILTER (c = '2') AS d FROM ({events}) GROUP BY k)"
    if r["mode"] == "om_before_tm":
        return counts(times, "om IS NOT NULL AND t0 IS NOT NULL", "om > t0")
    if r["mode"] == "im_after_tm":
        return counts(times, "t1 IS NOT NULL AND im IS NOT NULL", "im < t1")
    return counts(times, "m > 1 OR (t1 IS NOT NULL AND im IS NOT NULL)", "m > d OR coalesce(t1 > im, false)")


def _transit(r: RuleSpec) -> str:
    source = "CMS_DSMU JOIN CMS_MSMU ON DSMU_NO IS NOT DISTINCT FROM MSMU_NO JOIN CMS_MFBAG ON DSMU_BAG_NO IS NOT DISTINCT FROM MFBAG_NO"
    return counts(source, f"{o.there('DSMU_BAG_ORIGIN')} AND {o.there('MSMU_ORIGIN')} AND left({o.key('DSMU_BAG_ORIGIN')}, 3) <> left({o.key('MSMU_ORIGIN')}, 3)", f"NOT contains(upper({o.key('MFBAG_MAN_NO')}), 'TM')")


#: The catalog's families.
SQL_OF: dict[str, Callable[[RuleSpec], str]] = {
    **dict.fromkeys(("completeness", "validity_regex", "validity_datetime", "validity_integer", "validity_in_set", "non_negative"), _one_row),
    **dict.fromkeys(("reference_format", "value_in_reference", "non_negative_not_in_reference", "reference_conditional_completeness"), _reference),
    **dict.fromkeys(("pair_consistency", "prefix_match", "suffix_after_prefix_match", "rounded_pair_consistency", "duplicate_aware_weight_consistency", "timeliness"), _pairs),
    **dict.fromkeys(("bridged_timeliness", "bridged_pair_consistency", "bridged_substring_match"), _paths),
    **dict.fromkeys(("aggregate_sum_consistency", "aggregate_count_consistency", "count_consistency"), _sums),
    "conditional_completeness": _conditional, "uniqueness": _unique, "manifest_code_sequence": _sequence, "transit_manifest_required_for_origin_mismatch": _transit,
}


def totals_sql(rules: Iterable[RuleSpec]) -> str:
    """(index_code, rule_family, table_name, total_checked, total_failed, result_rows, status) of each rule."""
    parts, skipped = [], []
    for r in rules:
        facts = f"'{r.code}' AS index_code, '{r.family}' AS rule_family, '{r.table}' AS table_name"
        try:
            if r.table not in COLUMNS:
                raise NotThere(r.table)
            parts.append(f"SELECT {facts}, n, f FROM ({SQL_OF[r.family](r)})")
        except NotThere:
            skipped.append(f"SELECT {facts}, -1 AS n, 0 AS f")
    every = "\nUNION ALL ".join(parts + skipped)
    return f"SELECT index_code, rule_family, table_name, greatest(n, 0) AS total_checked, f AS total_failed, greatest(n, 0) AS result_rows, CASE WHEN n < 0 THEN 'SKIPPED' WHEN n = 0 THEN 'NO_ROWS' WHEN f > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({every})"
