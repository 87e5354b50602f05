"""The 28 rule families. Each builds, from tables and parameters, what a rule checks.

A check is a row that the rule looked at, PASS or FAIL: (document_id, status, variable_1, variable_2). Joins of rules
match null keys to null keys; a value is present if it isn't null or blank.

Most families give a RowRule: a condition on the rows of a frame, which is a table, a pair or path of tables, or sums of
one. Rules of one frame share its scans and joins. A LookupRule holds a value against reference keys, a KeyRule asks
whether a row's key occurs again; all rules of either kind share one join (see fuse.py). Beside its builder each family
declares which columns of which tables it reads, and which of them a result names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.values import key, moment, normal, number, present, rounded, shown, shown_moment

Tables = Callable[[str], DataFrame]
CHECKS = ("document_id", "status", "variable_1", "variable_2")


@dataclass(frozen=True)
class RuleSpec:
    """A rule of the catalog. shipment_column names the document id of its checks."""

    code: str
    family: str
    table: str
    params: dict[str, Any] = field(default_factory=dict)
    element: str = ""
    indicator: str = ""
    description: str = ""
    issue: str = ""
    main_impact: str = ""
    impact_details: str = ""
    enabled: bool = True

    def __getitem__(self, name: str) -> Any:
        return self.params[name]

    def get(self, name: str, default: Any = None) -> Any:
        return self.params.get(name, default)


class Frames:
    """Tables by name, and the frames that are made of them, each made once for all rules that look at it."""

    def __init__(self, tables: Tables):
        self.tables, self.made = tables, {}

    def __call__(self, name: str) -> DataFrame:
        return self.of(("table", name), lambda: self.tables(name))

    def of(self, what: tuple, make: Callable[[], DataFrame]) -> DataFrame:
        if what not in self.made:
            self.made[what] = make()
        return self.made[what]


@dataclass(frozen=True)
class RowRule:
    """A check of each row of a frame where `eligible` holds."""

    frame: tuple
    document: Column
    eligible: Column
    failed: Column
    one: Column
    two: Column


@dataclass(frozen=True)
class LookupRule:
    """A check of each row of a table where `eligible` holds, by whether `value` is among the keys of `sources`.

    sources: (table, column, as text rather than as a normalised value). known, unknown: whether rows fail whose value is
    there or isn't; None: such rows aren't checked.
    """

    table: str
    document: Column
    eligible: Column
    value: Column
    sources: tuple[tuple[str, str, bool], ...]
    known: Column | None
    unknown: Column | None
    one: Column
    two: Column


@dataclass(frozen=True)
class KeyRule:
    """A check of each row of a table whose key columns aren't null: it fails if another row has the same."""

    table: str
    document: Column
    columns: tuple[Column, ...]


Built = RowRule | LookupRule | KeyRule | DataFrame
#: The columns that a family reads, as (table, column); those without which its rules can't run.
Reads = Callable[[RuleSpec], Iterable[tuple[str | None, str | None]]]


@dataclass(frozen=True)
class Family:
    build: Callable[[Frames, RuleSpec], Built]
    reads: Reads
    about: tuple[str, ...]

    def needs(self, rule: RuleSpec) -> dict[str, set[str]]:
        """The columns that a rule can't do without by table, its own table among them."""
        out: dict[str, set[str]] = {rule.table: set()}
        for table, column in self.reads(rule):
            if table:
                out.setdefault(table, set()).update([column] if column else [])
        return out

    def names(self, rule: RuleSpec) -> list[str]:
        """The columns that a rule's results are about."""
        found = [x for name in self.about for x in (rule.get(name) if isinstance(rule.get(name), list) else [rule.get(name)])]
        return list(dict.fromkeys(str(x) for x in found if x))


FAMILIES: dict[str, Family] = {}


def family(name: str, reads: Reads, about: str = ""):
    def register(build):
        FAMILIES[name] = Family(build, reads, tuple(about.split()))
        return build

    return register


def as_checks(rows: DataFrame, document: Column, failed: Column, one: Column, two: Column) -> DataFrame:
    return rows.select(shown(document).alias("document_id"), F.when(failed, "FAIL").otherwise("PASS").alias("status"), shown(one).alias("variable_1"), shown(two).alias("variable_2"))


def _blank() -> Column:
    return F.lit("")


def document_of(rows: DataFrame, rule: RuleSpec) -> Column:
    """The rule's document column under any of the names that joins give it, else the empty text."""
    name = rule.get("cnote_column") or rule.get("left_join_key") or "CNOTE_NO"
    for candidate in (name, f"{name}_left", f"{name}_right", f"{name}_start", f"{name}_end", "cnote_no"):
        if candidate in rows.columns:
            return F.col(candidate)
    return _blank()


# Rules that look at one row.


def own(*params: str) -> Reads:
    """Columns of the rule's table that parameters name."""
    return lambda rule: [(rule.table, rule.get(p)) for p in params]


def _row(frames: Frames, rule: RuleSpec, eligible: Column, failed: Column, one: Column, two: Column | None = None) -> RowRule:
    return RowRule(("table", rule.table), document_of(frames(rule.table), rule), eligible, failed, one, _blank() if two is None else two)


@family("completeness", own("column"), "column")
def completeness(frames, rule):
    value = F.col(rule["column"])
    return _row(frames, rule, F.lit(True), ~present(value), value)


@family("conditional_completeness", own("column", "condition_column"), "column")
def conditional_completeness(frames, rule):
    value, condition = F.col(rule["column"]), F.col(rule["condition_column"])
    if rule.get("condition_regex"):
        holds = key(condition).rlike(rule["condition_regex"])
    elif rule.get("condition_mode") == "not_null":
        holds = present(condition)
    else:
        holds = F.upper(key(condition)) == str(rule.get("condition_value", "Y")).upper()
    return _row(frames, rule, holds, ~present(value), value, condition)


def anchored(pattern: str) -> str:
    """A pattern that must match from the start. Digits are those of ASCII."""
    return f"^(?:{pattern})".replace(r"\d", "[0-9]")


@family("validity_regex", own("column"), "column")
def validity_regex(frames, rule):
    value = F.col(rule["column"])
    return _row(frames, rule, present(value), ~value.cast("string").rlike(anchored(rule["pattern"])), value, F.lit(rule["pattern"]))


@family("validity_datetime", own("column"), "column")
def validity_datetime(frames, rule):
    value = F.col(rule["column"])
    return _row(frames, rule, present(value), moment(value).isNull(), value)


@family("validity_integer", own("column"), "column")
def validity_integer(frames, rule):
    value = F.col(rule["column"])
    n = number(value)
    return _row(frames, rule, present(value), n.isNull() | (n != F.bround(n)), value)


@family("validity_in_set", own("column"), "column")
def validity_in_set(frames, rule):
    value, allowed = F.col(rule["column"]), sorted(str(x) for x in rule["allowed"])
    return _row(frames, rule, present(value), ~normal(value).isin(*[re.sub(r"\.0+$", "", x) for x in allowed]), value, F.lit(",".join(allowed)))


@family("non_negative", own("column"), "column")
def non_negative(frames, rule):
    value = F.col(rule["column"])
    n = number(value)
    return _row(frames, rule, n.isNotNull(), n < 0, value, F.lit("0"))


# Rules that look a value up, or a row's key among the others.


def reference_source(rule: RuleSpec) -> list[tuple[str | None, str | None]]:
    if rule.get("references"):
        return [(r["table"], r["column"]) for r in rule["references"]]
    component = {"origin": "__origin_component", "destination": "__destination_component"}.get(rule.get("reference_component"))
    return [(rule.get("reference_table"), component or rule.get("reference_column"))]


def own_and_reference(*params: str) -> Reads:
    return lambda rule: [*own(*params)(rule), *reference_source(rule)]


def with_route_parts(reference: DataFrame, route: str = "DROURATE_CODE") -> DataFrame:
    """The route reference with the places that its codes are made of; malformed codes have none."""
    from freightlens.functions.classes import route_parts

    origin, destination, _ = route_parts(normal(F.col(route)))
    return reference.withColumn("__origin_component", origin).withColumn("__destination_component", destination)


def _lookup(frames: Frames, rule: RuleSpec, eligible: Column, value: Column, known: Column | None, unknown: Column | None, one: Column, two: Column) -> LookupRule:
    sources = tuple((t, c, False) for t, c in reference_source(rule))
    return LookupRule(rule.table, document_of(frames(rule.table), rule), eligible, value, sources, known, unknown, one, two)


@family("reference_conditional_completeness", own_and_reference("column", "condition_column"), "column")
def reference_conditional_completeness(frames, rule):
    value, condition = F.col(rule["column"]), F.col(rule["condition_column"])
    return _lookup(frames, rule, present(condition), normal(condition), ~present(value), None, value, condition)


@family("value_in_reference", own_and_reference("column"), "column")
def value_in_reference(frames, rule):
    value = F.col(rule["column"])
    return _lookup(frames, rule, present(value), normal(value), F.lit(False), F.lit(True), value, F.lit(rule["reference_table"]))


@family("reference_format", own_and_reference("column"), "column")
def reference_format(frames, rule):
    value = F.col(rule["column"])
    return _lookup(frames, rule, present(value), normal(value), ~normal(value).rlike("^[A-Za-z0-9]+$"), F.lit(True), value, F.lit(rule["reference_table"]))


@family("non_negative_not_in_reference", own_and_reference("column"), "column")
def non_negative_not_in_reference(frames, rule):
    value = F.col(rule["column"])
    document = document_of(frames(rule.table), rule)
    return _lookup(frames, rule, number(value).isNotNull(), normal(document), F.lit(True), number(value) < 0, value, F.lit(rule["reference_table"]))


@family("integrity_orphan", lambda r: [(r.get("child_table"), r.get("child_column")), (r.get("parent_table"), r.get("parent_column"))], "child_column parent_column")
def integrity_orphan(frames, rule):
    value, sources = F.col(rule["child_column"]), ((rule["parent_table"], rule["parent_column"], True),)
    return LookupRule(rule["child_table"], document_of(frames(rule["child_table"]), rule), present(value), value.cast("string"), sources, F.lit(False), F.lit(True), value, F.lit(rule["parent_table"]))


@family("uniqueness", lambda r: [(r.table, c) for c in r.get("columns", [])], "columns")
def uniqueness(frames, rule):
    """Keys are counted before any shuffle of rows; only those that occur again are joined back, so a key of many rows (a blank, say) is split like any skewed join."""
    rows = frames(rule.table)
    return KeyRule(rule.table, document_of(rows, rule), tuple(F.col(c) + 0.0 if dict(rows.dtypes)[c] in ("double", "float") else F.col(c) for c in rule["columns"]))


# Rules over pairs and paths of tables.


#: Rows without a key meet in cells of a grid: so many parts of the left side, so many rows of the right side a part.
LEFT_PARTS, RIGHT_ROWS = 16, 4096


def gridded(left: DataFrame, right: DataFrame, lk: str, rk: str, few: bool) -> tuple[DataFrame, DataFrame]:
    """Both sides with _cell, which is part of the join's key: one cell for rows with a key, a grid for those without.

    m rows without a key on one side and n on the other make m x n pairs. Each of the right side's rows is in one column
    of the grid, each of the left side's in one row; so a task gets a cell's pairs, not all. If the right side has none,
    the left side's are dropped before they move. few: the right side has at most one.
    """
    n = F.lit(1) if few else right.where(F.col(rk).isNull()).agg(F.count(F.lit(1)).alias("n")).scalar()
    columns = F.ceil(n / F.lit(RIGHT_ROWS))
    apart, number = F.array(F.lit(-1).cast("long")), F.monotonically_increasing_id()
    here = F.transform(F.col("_columns"), lambda c: c * LEFT_PARTS + F.col("_row"))
    l = left.withColumn("_columns", F.when(F.col(lk).isNotNull() | (columns < 1), F.array().cast("array<long>")).otherwise(F.sequence(F.lit(0).cast("long"), columns - 1))).withColumn("_row", number % LEFT_PARTS)
    l = l.withColumn("_cell", F.explode(F.when(F.col(lk).isNotNull(), apart).otherwise(here))).drop("_columns", "_row")
    r = right.withColumn("_column", F.when(F.col(rk).isNull(), number % F.greatest(columns, F.lit(1).cast("long"))))
    there = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(LEFT_PARTS - 1).cast("long")), lambda row: F.col("_column") * LEFT_PARTS + row)
    r = r.withColumn("_cell", F.explode(F.when(F.col(rk).isNotNull(), apart).otherwise(there))).drop("_column")
    return l, r


def suffixed(left: DataFrame, right: DataFrame, on: tuple[str, str], suffixes: tuple[str, str], few: bool = False) -> DataFrame:
    """An inner join that matches null keys; columns that both sides have get the suffixes, a shared key is one column. few: at most one row of the right side has no key."""
    shared = (set(left.columns) & set(right.columns)) - ({on[0]} if on[0] == on[1] else set())
    l = left.select(*(F.col(f"`{c}`").alias(c + suffixes[0] if c in shared else c) for c in left.columns))
    lk = on[0] + suffixes[0] if on[0] in shared else on[0]
    r = right.select(*(F.col(f"`{c}`").alias("_right_key" if c == on[1] and on[0] == on[1] else c + suffixes[1] if c in shared else c) for c in right.columns))
    rk = "_right_key" if on[0] == on[1] else on[1] + suffixes[1] if on[1] in shared else on[1]
    l, r = gridded(l, r, lk, rk, few)
    r = r.withColumnRenamed("_cell", "_right_cell")
    joined = l.join(r, l[lk].eqNullSafe(r[rk]) & (l["_cell"] == r["_right_cell"]))
    return joined.drop("_right_key", "_cell", "_right_cell")


def latest_rows(rows: DataFrame, on: str, latest: str) -> DataFrame:
    """A row for each key, the latest; an aggregate, so that rows of a key (or without one) are reduced before they move. Ties: the smallest row."""
    when, names = moment(F.col(latest)), sorted(rows.columns)
    seconds = F.unix_date(when.cast("date")) * 86_400 + F.hour(when) * 3_600 + F.minute(when) * 60  # no time zone is asked
    row = F.struct(when.isNull().alias("_none"), (-seconds).alias("_back"), (-F.extract(F.lit("SECOND"), when)).alias("_second"), *(F.col(f"`{c}`") for c in names))
    return rows.groupBy(F.col(on).alias("_on")).agg(F.min(row).alias("_row")).select(*(F.col(f"_row.`{c}`").alias(c) for c in rows.columns))


def keys_of_pair(rule: RuleSpec, sides: tuple[str, str]) -> tuple[str | None, str | None]:
    return tuple(rule.get(f"{side}_join_key") or rule.get("join_key") for side in sides)


def of_pair(*more: str, sides: tuple[str, str] = ("left", "right")) -> Reads:
    """The values and keys of two tables; more: columns of the left table that parameters name."""

    def reads(rule: RuleSpec):
        out = [(rule.get(f"{side}_table"), c) for side, k in zip(sides, keys_of_pair(rule, sides), strict=True) for c in (rule.get(f"{side}_column"), k)]
        return [*out, (rule.get(f"{sides[1]}_table"), rule.get("right_latest_by")), *((rule.get(f"{sides[0]}_table"), rule.get(p)) for p in more)]

    return reads


def pair_frame(frames: Frames, rule: RuleSpec, sides: tuple[str, str] = ("left", "right")) -> tuple[tuple, DataFrame, Column, Column]:
    """A pair's frame, its rows, and the values of both sides."""
    on, names, latest = keys_of_pair(rule, sides), [rule[f"{s}_table"] for s in sides], rule.get("right_latest_by")
    if None in on:
        raise ValueError("a rule over a pair of tables needs the join keys of both sides")
    what = ("pair", *names, on, sides, latest)

    def make() -> DataFrame:
        right = frames(names[1])
        right = latest_rows(right, on[1], latest) if latest else right
        return suffixed(frames(names[0]), right, on, tuple(f"_{s}" for s in sides), few=bool(latest))

    rows = frames.of(what, make)
    left, right = (side_of(rows, rule[f"{s}_column"], s) for s in sides)
    return what, rows, left, right


def side_of(rows: DataFrame, column: str, side: str) -> Column:
    return F.col(column if column in rows.columns else f"{column}_{side}")


def steps_of(rule: RuleSpec) -> tuple[tuple[str, str, str], ...]:
    return tuple((s["table"], s["left_on"], s["right_on"]) for s in rule.get("joins", []))


def of_path(first: str, *last: str, start: str = "left_table") -> Reads:
    """The keys of a path of tables, a column of its first and columns of its last table."""

    def reads(rule: RuleSpec):
        at, out = rule.get(start), [(rule.get(start), rule.get(first))]
        for table, left_on, right_on in steps_of(rule):
            out += [(at, left_on), (table, right_on)]
            at = table
        return [*out, *((at, rule.get(c)) for c in last)]

    return reads


def path_frame(frames: Frames, rule: RuleSpec, start: str = "left_table") -> tuple[tuple, DataFrame]:
    """The tables of a path joined in turn; where names clash the earlier table keeps the plain one. Paths share what they begin with."""
    what = ("table", rule[start])
    rows = frames(rule[start])
    for table, left_on, right_on in steps_of(rule):
        what = ("path", what, table, left_on, right_on)
        rows = frames.of(what, lambda rows=rows, t=table, on=(left_on, right_on): suffixed(rows, frames(t), on, ("", f"_{t.lower()}")))
    return what, rows


@family("pair_consistency", of_pair(), "left_column right_column")
def pair_consistency(frames, rule):
    what, rows, left, right = pair_frame(frames, rule)
    return RowRule(what, document_of(rows, rule), left.isNotNull() & right.isNotNull(), left.cast("string") != right.cast("string"), left, right)


@family("prefix_match", of_pair(), "left_column right_column")
def prefix_match(frames, rule):
    what, rows, left, right = pair_frame(frames, rule)
    n = int(rule.get("prefix_length", 3))
    return RowRule(what, document_of(rows, rule), present(left) & present(right), F.substring(key(left), 1, n) != F.substring(key(right), 1, n), key(left), key(right))


@family("suffix_after_prefix_match", of_pair(), "left_column right_column")
def suffix_after_prefix_match(frames, rule):
    what, rows, left, right = pair_frame(frames, rule)
    tail = lambda c: F.substring(key(c), int(rule.get("prefix_length", 3)) + 1, 2**31 - 1)
    return RowRule(what, document_of(rows, rule), present(left) & present(right), tail(left) != tail(right), key(left), key(right))


@family("rounded_pair_consistency", of_pair(), "left_column right_column")
def rounded_pair_consistency(frames, rule):
    what, rows, left, right = pair_frame(frames, rule)
    l, r, n = number(left), number(right), int(rule.get("decimals", 0))
    return RowRule(what, document_of(rows, rule), l.isNotNull() & r.isNotNull(), rounded(l, n) != rounded(r, n), l, r)


@family("duplicate_aware_weight_consistency", of_pair("duplicate_key"), "left_column right_column")
def duplicate_aware_weight_consistency(frames, rule):
    """Groups of one repeated weight above the threshold compare their sums, other rows compare one by one.

    A group's least and greatest weight, number and sums are one aggregate; rows of groups that are compared by their
    sums are taken out by an anti join with these, which Spark splits where a group has many rows.
    """
    _, rows, left, right = pair_frame(frames, rule)
    group, n = rule["duplicate_key"], int(rule.get("decimals", 0))
    rows = rows.withColumn("_left", number(left)).withColumn("_right", number(right)).where(F.col("_left").isNotNull() & F.col("_right").isNotNull() & present(F.col(group)))
    rows = rows.withColumn("_rounded", rounded(F.col("_left"), n))
    facts = rows.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_n"), F.min("_rounded").alias("_least"), F.max("_rounded").alias("_most"), F.sum("_left").alias("_l"), F.sum("_right").alias("_r"))
    sums = facts.where((F.col("_n") > 1) & (F.col("_least") == F.col("_most")) & (F.col("_most") > float(rule.get("duplicate_threshold", 50))))
    direct = rows.join(sums.select(F.col("_group").alias("_summed")), F.col(group) == F.col("_summed"), "left_anti")
    direct = as_checks(direct, document_of(direct, rule), F.col("_rounded") != rounded(F.col("_right"), n), F.col("_left"), F.col("_right"))
    return direct.unionByName(as_checks(sums, F.col("_group"), rounded(F.col("_l"), n) != rounded(F.col("_r"), n), F.col("_l"), F.col("_r")))


@family("bridged_pair_consistency", of_path("left_column", "right_column"), "left_column right_column")
def bridged_pair_consistency(frames, rule):
    what, rows = path_frame(frames, rule)
    left, right = F.col(rule["left_column"]), F.col(rule["right_column"])
    if rule.get("decimals") is not None:
        n = int(rule["decimals"])
        return RowRule(what, document_of(rows, rule), number(left).isNotNull() & number(right).isNotNull(), rounded(number(left), n) != rounded(number(right), n), left, right)
    return RowRule(what, document_of(rows, rule), present(left) & present(right), key(left) != key(right), left, right)


@family("bridged_substring_match", of_path("left_column", "right_column"), "left_column right_column")
def bridged_substring_match(frames, rule):
    what, rows = path_frame(frames, rule)
    left, right = F.col(rule["left_column"]), F.col(rule["right_column"])
    part = F.substring(key(left), int(rule["substring_start"]) + 1, int(rule["substring_length"]))
    return RowRule(what, document_of(rows, rule), present(left) & present(right), part != key(right), key(left), key(right))


# Rules over sums and counts of details.


def _master(*params: str) -> Reads:
    return lambda rule: [(rule.get("master_table"), rule.get(p)) for p in ("master_key", *params)]


def _details(column: str) -> Reads:
    """The keys of the path to the details, the last of them in its last table, and the column that is added up or counted (in a longer path any table may have it)."""
    return lambda rule: [*of_path("", "detail_key", start="detail_table")(rule), *([] if rule.get("joins") else [(rule.get("detail_table"), rule.get(column))])]


def _found(frames: Frames, rule: RuleSpec, what: tuple, rows: DataFrame, on: str, found: Column) -> tuple[tuple, DataFrame]:
    """A master's rows with what was found in its details."""
    make = lambda: frames(rule["master_table"]).join(rows.where(F.col(on).isNotNull()).groupBy(F.col(on).alias("_key")).agg(found.alias("_found")), F.col(rule["master_key"]) == F.col("_key"))
    what = ("found", rule["master_table"], rule["master_key"], what, on)
    return what, frames.of(what, make)


def _compared(what: tuple, rows: DataFrame, rule: RuleSpec, column: str, decimals: int | None = None) -> RowRule:
    master, found = number(F.col(column)), F.col("_found")
    failed = master != found if decimals is None else rounded(master, decimals) != rounded(found, decimals)
    return RowRule(what, document_of(rows, rule), master.isNotNull() & found.isNotNull(), failed, master, found)


@family("aggregate_sum_consistency", lambda r: [*_master("master_value_column")(r), *_details("detail_value_column")(r)], "master_value_column detail_value_column")
def aggregate_sum_consistency(frames, rule):
    what, rows = path_frame(frames, rule, "detail_table")
    what, rows = _found(frames, rule, (what, "sum", rule["detail_value_column"]), rows, rule["detail_key"], F.sum(number(F.col(rule["detail_value_column"]))))
    return _compared(what, rows, rule, rule["master_value_column"], int(rule.get("decimals", 0)))


@family("aggregate_count_consistency", lambda r: [*_master("master_count_column")(r), *_details("detail_count_column")(r)], "master_count_column detail_count_column")
def aggregate_count_consistency(frames, rule):
    what, rows = path_frame(frames, rule, "detail_table")
    what, rows = _found(frames, rule, (what, "count", rule["detail_count_column"]), rows, rule["detail_key"], F.countDistinct(rule["detail_count_column"]))
    return _compared(what, rows, rule, rule["master_count_column"])


@family("count_consistency", lambda r: [*_master("master_column")(r), (r.get("child_table"), r.get("child_key")), (r.get("child_table"), r.get("count_column"))], "child_column parent_column")
def count_consistency(frames, rule):
    what, rows = _found(frames, rule, (rule["child_table"], "count", rule["count_column"]), frames(rule["child_table"]), rule["child_key"], F.countDistinct(rule["count_column"]))
    return _compared(what, rows, rule, rule["master_column"])


# Rules over times and sequences.


def listed(columns: dict[str, str]) -> Reads:
    """Columns by table that a family reads without a parameter."""
    return lambda _: [(t, c) for t, names in columns.items() for c in names.split()]


@family("transit_manifest_required_for_origin_mismatch", listed({"CMS_DSMU": "DSMU_NO DSMU_BAG_NO DSMU_BAG_ORIGIN", "CMS_MSMU": "MSMU_NO MSMU_ORIGIN", "CMS_MFBAG": "MFBAG_NO MFBAG_MAN_NO"}))
def transit_manifest_required_for_origin_mismatch(frames, rule):
    def make() -> DataFrame:
        rows = suffixed(frames("CMS_DSMU"), frames("CMS_MSMU"), ("DSMU_NO", "MSMU_NO"), ("_x", "_y"))
        return suffixed(rows, frames("CMS_MFBAG"), ("DSMU_BAG_NO", "MFBAG_NO"), ("_x", "_y"))

    one, two, manifest = key(F.col("DSMU_BAG_ORIGIN")), key(F.col("MSMU_ORIGIN")), key(F.col("MFBAG_MAN_NO"))
    frames.of(("transit",), make)
    return RowRule(("transit",), F.col("MFBAG_NO"), (one != "") & (two != "") & (F.substring(one, 1, 3) != F.substring(two, 1, 3)), ~F.upper(manifest).contains("TM"), F.concat(one, F.lit(" / "), two), manifest)


def _in_order(what: tuple, document: Column, start: Column, end: Column) -> RowRule:
    return RowRule(what, document, start.isNotNull() & end.isNotNull(), start > end, shown_moment(start), shown_moment(end))


@family("timeliness", of_pair(sides=("start", "end")), "start_column end_column")
def timeliness(frames, rule):
    what, rows, start, end = pair_frame(frames, rule, ("start", "end"))
    return _in_order(what, document_of(rows, rule), moment(start), moment(end))


@family("bridged_timeliness", of_path("start_column", "end_column"), "start_column end_column")
def bridged_timeliness(frames, rule):
    what, rows = path_frame(frames, rule)
    document, start, end = document_of(rows, rule), moment(F.col(rule["start_column"])), moment(F.col(rule["end_column"]))
    group = rule.get("first_start_group")
    if rule.get("aggregate_by_cnote") == "earliest":
        if group:
            raise ValueError("a rule takes the earliest times of shipments or the first start of groups")
        what = (what, "earliest", rule.get("cnote_column"), rule["start_column"], rule["end_column"])
        frames.of(what, lambda: rows.where(present(document)).groupBy(document.cast("string").alias("cnote_no")).agg(F.min(start).alias("_start"), F.min(end).alias("_end")))
        return _in_order(what, F.col("cnote_no"), F.col("_start"), F.col("_end"))
    if group:
        # The first row of a group is the least of an aggregate, so that rows (of no group, too) are reduced before they move.
        first = F.struct(start.isNull().alias("_a"), start.alias("_start"), end.isNull().alias("_b"), end.alias("_end"), document.alias("_document"))
        what = (what, "first", rule.get("cnote_column"), rule["start_column"], rule["end_column"], group)
        frames.of(what, lambda: rows.groupBy(F.col(group).alias("_group")).agg(F.min(first).alias("_first")).select("_first.*"))
        return _in_order(what, F.col("_document"), F.col("_start"), F.col("_end"))
    return _in_order(what, document, start, end)


def table_of(column: str) -> str:
    """The table whose columns are named like this one."""
    return f"CMS_{column.split('_')[0]}"


def _manifest_sequence_reads(rule: RuleSpec):
    when, code = rule.get("date_column", "MANIFEST_CRDATE"), rule.get("manifest_code_column", "MANIFEST_CODE")
    document = rule.get("cnote_column", "MFCNOTE_NO")
    return [("CMS_MFCNOTE", "MFCNOTE_NO"), ("CMS_MFCNOTE", "MFCNOTE_MAN_NO"), ("CMS_MANIFEST", "MANIFEST_NO"), ("CMS_MANIFEST", code), (rule.get("date_table") or table_of(when), when), (table_of(document), document)]


@family("manifest_code_sequence", _manifest_sequence_reads)
def manifest_code_sequence(frames, rule):
    """One aggregate per shipment over outbound (1), transit (2) and inbound (3) manifest times."""
    code, when, document = rule.get("manifest_code_column", "MANIFEST_CODE"), rule.get("date_column", "MANIFEST_CRDATE"), rule.get("cnote_column", "MFCNOTE_NO")

    def make() -> DataFrame:
        rows = suffixed(frames("CMS_MFCNOTE"), frames("CMS_MANIFEST"), ("MFCNOTE_MAN_NO", "MANIFEST_NO"), ("_mfcnote", "_manifest"))
        of = lambda c: F.when(normal(F.col(code)) == c, moment(F.col(when)))
        return rows.where(F.col(document).isNotNull()).groupBy(F.col(document).alias("_key")).agg(
            F.max(of("1")).alias("om"), F.min(of("2")).alias("tm_first"), F.max(of("2")).alias("tm_last"), F.min(of("3")).alias("im"),
            F.count(of("2")).alias("n"), F.countDistinct(of("2")).alias("n_times"),
        )

    om, tm_first, tm_last, im = (F.col(c) for c in ("om", "tm_first", "tm_last", "im"))
    late = F.coalesce(tm_last > im, F.lit(False))
    eligible, failed, one, two = {
        "om_before_tm": (om.isNotNull() & tm_first.isNotNull(), om > tm_first, om, tm_first),
        "tm_sequence_before_im": ((F.col("n") > 1) | (tm_last.isNotNull() & im.isNotNull()), (F.col("n") > F.col("n_times")) | late, tm_last, im),
        "im_after_tm": (tm_last.isNotNull() & im.isNotNull(), late, tm_last, im),
    }[rule["mode"]]
    what = ("sequence", code, when, document)
    frames.of(what, make)
    return RowRule(what, F.col("_key"), eligible, failed, shown_moment(one), shown_moment(two))


def _inbound_reads(rule: RuleSpec):
    columns = {
        "CMS_MFCNOTE": "MFCNOTE_NO MFCNOTE_MAN_NO", "CMS_MANIFEST": f"MANIFEST_NO {rule.get('manifest_code_column', 'MANIFEST_CODE')} {rule.get('manifest_date_column', 'MANIFEST_DATE')}", "CMS_DHICNOTE": "DHICNOTE_NO DHICNOTE_CNOTE_NO",
        "CMS_RDSJ": "RDSJ_HVI_NO RDSJ_HVO_NO", "CMS_DSJ": "DSJ_HVO_NO DSJ_NO", "CMS_MSJ": f"MSJ_NO {rule.get('msj_date_column', 'MSJ_SIGNDATE')}",
    }
    return listed(columns)(rule)


@family("cnote_im_manifest_before_msj", _inbound_reads)
def cnote_im_manifest_before_msj(frames, rule):
    code, inbound_date, signed_date = rule.get("manifest_code_column", "MANIFEST_CODE"), rule.get("manifest_date_column", "MANIFEST_DATE"), rule.get("msj_date_column", "MSJ_SIGNDATE")
    wanted = str(rule.get("manifest_code", "3"))

    def make() -> DataFrame:
        rows = suffixed(frames("CMS_MFCNOTE"), frames("CMS_MANIFEST"), ("MFCNOTE_MAN_NO", "MANIFEST_NO"), ("_x", "_y"))
        rows = rows.where((normal(F.col(code)) == wanted) & F.col("MFCNOTE_NO").isNotNull())
        inbound = rows.groupBy(F.col("MFCNOTE_NO").alias("_key")).agg(F.min(moment(F.col(inbound_date))).alias("_start"))
        rows = suffixed(frames("CMS_DHICNOTE"), frames("CMS_RDSJ"), ("DHICNOTE_NO", "RDSJ_HVI_NO"), ("_x", "_y"))
        rows = suffixed(rows, frames("CMS_DSJ"), ("RDSJ_HVO_NO", "DSJ_HVO_NO"), ("_x", "_y"))
        rows = suffixed(rows, frames("CMS_MSJ"), ("DSJ_NO", "MSJ_NO"), ("_x", "_y"))
        signed = rows.where("DHICNOTE_CNOTE_NO IS NOT NULL").groupBy(F.col("DHICNOTE_CNOTE_NO").alias("_key")).agg(F.min(moment(F.col(signed_date))).alias("_end"))
        return inbound.join(signed, "_key")

    what = ("inbound", code, inbound_date, signed_date, wanted)
    frames.of(what, make)
    return _in_order(what, F.col("_key"), F.col("_start"), F.col("_end"))
