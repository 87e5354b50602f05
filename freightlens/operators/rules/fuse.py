"""Many rules in few scans and joins.

A catalog has hundreds of rules; a scan or join for each would read a table dozens of times. Rules fall into groups:

* Rules over the rows of one frame (a table, a pair or path of tables, sums of one) become arrays of checks that are
  exploded, so the frame is scanned and joined once. They go in chunks, so that the generated code of one projection
  stays small enough to be compiled.
* Rules that look values up: each table gives narrow rows (rule, reference, value, what the check would show), all tables'
  rows meet the keys of all references in one join, and each reference table is scanned once for its keys.
* Rules on keys that occur again: narrow rows (rule, key), counted before any row moves, and joined back.
* Other rules have a plan of their own.

Where rules are only counted there are more groups, each of which is run by itself: look-ups by reference, keys by table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from freightlens.functions.values import normal, shown

from .families import FAMILIES, Built, Frames, KeyRule, LookupRule, RowRule, RuleSpec, Tables

CHUNK = 24
#: Groups that are counted at once.
COUNTERS = 4
#: What puts a frame that several plans read somewhere, and gives it back; without one it is planned anew each time.
Keep = Callable[[DataFrame], DataFrame]


@dataclass
class Group:
    """Rules that share a plan."""

    rules: list[RuleSpec]
    plan: Callable[[], DataFrame]
    #: (code, total_checked, total_failed) where they needn't be counted from the checks; of look-ups, of one reference.
    counts: Callable[[], DataFrame] | None = None


def _status(failed: Column) -> Column:
    return F.when(failed, "FAIL").otherwise("PASS")


def _exploded(rows: DataFrame, structs: list[Column], chunk: int) -> DataFrame:
    """The structs of each row that aren't null, as rows."""
    parts = [rows.select(F.explode(F.array(*structs[at : at + chunk])).alias("c")).where("c IS NOT NULL").select("c.*") for at in range(0, len(structs), chunk)]
    return reduce(DataFrame.unionByName, parts)


def fused(rows: DataFrame, rules: list[tuple[RuleSpec, RowRule]], chunk: int = CHUNK) -> DataFrame:
    """(code, document_id, status, variable_1, variable_2) of rules over one frame."""

    def one(code: str, r: RowRule) -> Column:
        return F.when(r.eligible, F.struct(F.lit(code).alias("code"), shown(r.document).alias("document_id"), _status(r.failed).alias("status"), shown(r.one).alias("variable_1"), shown(r.two).alias("variable_2")))

    return _exploded(rows, [one(rule.code, r) for rule, r in rules], chunk)


def _tallied(checks: DataFrame) -> DataFrame:
    return checks.groupBy("code").agg(F.count(F.lit(1)).alias("total_checked"), F.count_if(F.col("status") == "FAIL").alias("total_failed"))


def fused_counts(rows: DataFrame, rules: list[tuple[RuleSpec, RowRule]], chunk: int = CHUNK) -> DataFrame:
    """(code, total_checked, total_failed) of rules over one frame: sums of its rows, none of which becomes checks."""

    def of(own: list[tuple[RuleSpec, RowRule]]) -> DataFrame:
        sums = [c for k, (_, r) in enumerate(own) for c in (F.count_if(r.eligible).alias(f"_n{k}"), F.count_if(r.eligible & r.failed).alias(f"_f{k}"))]
        each = [F.struct(F.lit(rule.code).alias("code"), F.col(f"_n{k}").alias("total_checked"), F.col(f"_f{k}").alias("total_failed")) for k, (rule, _) in enumerate(own)]
        return rows.agg(*sums).select(F.explode(F.array(*each)).alias("c")).select("c.*").where("total_checked > 0")

    return reduce(DataFrame.unionByName, [of(rules[at : at + chunk]) for at in range(0, len(rules), chunk)])


def _references(frames: Frames, references: dict[tuple, int]) -> DataFrame:
    """(_reference, _ref) of each row of all references; each of their tables is scanned once."""
    by_table: dict[str, list[tuple[int, str, bool]]] = {}
    for sources, number in references.items():
        for table, column, as_text in sources:
            by_table.setdefault(table, []).append((number, column, as_text))
    parts = []
    for table, wanted in by_table.items():
        keys = [F.struct(F.lit(n).alias("_reference"), (F.col(c).cast("string") if as_text else normal(F.col(c))).alias("_ref")) for n, c, as_text in wanted]
        parts.append(frames(table).select(F.explode(F.array(*keys)).alias("k")).select("k.*"))
    return reduce(DataFrame.unionByName, parts).where("_ref <> ''")


def reference_keys(frames: Frames, references: dict[tuple, int]) -> DataFrame:
    """(_reference, _ref): the different keys of all references."""
    return _references(frames, references).distinct()


def looked_up(frames: Frames, rules: list[tuple[RuleSpec, LookupRule]], keep: Keep = lambda df: df, chunk: int = CHUNK) -> DataFrame:
    """The checks of all rules that look values up, by one join."""
    references = {r: k for k, r in enumerate(dict.fromkeys(r.sources for _, r in rules))}
    by_table: dict[str, list[Column]] = {}
    for rule, r in rules:
        status = [(F.lit(None).cast("string") if f is None else _status(f)).alias(name) for f, name in ((r.known, "_known"), (r.unknown, "_unknown"))]
        row = F.struct(F.lit(rule.code).alias("code"), F.lit(references[r.sources]).alias("_number"), r.value.alias("_value"), shown(r.document).alias("document_id"), *status, shown(r.one).alias("variable_1"), shown(r.two).alias("variable_2"))
        by_table.setdefault(r.table, []).append(F.when(r.eligible, row))
    rows = reduce(DataFrame.unionByName, [_exploded(frames(t), structs, chunk) for t, structs in by_table.items()])
    keys = keep(reference_keys(frames, references))
    rows = rows.join(keys, (F.col("_number") == F.col("_reference")) & (F.col("_value") == F.col("_ref")), "left")
    rows = rows.withColumn("status", F.when(F.col("_ref").isNotNull(), F.col("_known")).otherwise(F.col("_unknown"))).where("status IS NOT NULL")
    return rows.select("code", "document_id", "status", "variable_1", "variable_2")


def looked_up_counts(frames: Frames, rules: list[tuple[RuleSpec, LookupRule]], chunk: int = CHUNK) -> DataFrame:
    """(code, total_checked, total_failed) of rules that look values up in one reference.

    Rows and keys meet in one aggregate by value: rows are counted before they move, so that a value of many rows is one
    there, and nothing is joined.
    """

    def of(own: list[tuple[RuleSpec, LookupRule]]) -> DataFrame:
        by_table: dict[str, list[Column]] = {}
        sums = {}
        for k, (_, r) in enumerate(own):
            sides = {"_known": r.known, "_unknown": r.unknown}
            failed = [F.lit(False if f is None else f).alias(name) for name, f in sides.items()]
            by_table.setdefault(r.table, []).append(F.when(r.eligible, F.struct(F.lit(k).alias("_rule"), r.value.alias("_value"), *failed)))
            here = F.col("_rule") == k
            sums |= {f"{name}{of}{k}": F.count_if(here if of == "_n" else here & F.col(name)) for name, f in sides.items() if f is not None for of in ("_n", "_f")}
        rows = reduce(DataFrame.unionByName, [_exploded(frames(t), structs, chunk) for t, structs in by_table.items()])
        keys = _references(frames, {own[0][1].sources: 0}).select(F.col("_ref").alias("_value"), F.lit(True).alias("_there"))
        values = rows.unionByName(keys, allowMissingColumns=True).groupBy("_value").agg(F.max("_there").alias("_there"), *(c.alias(n) for n, c in sums.items()))

        def total(what: str, k: int) -> Column:
            found = F.coalesce("_there", F.lit(False))
            side = [F.when(found if name == "_known" else ~found, F.col(f"{name}{what}{k}")) for name in ("_known", "_unknown") if f"{name}{what}{k}" in sums]
            return F.coalesce(F.sum(F.coalesce(*side, F.lit(0))), F.lit(0))

        counts = values.agg(*(total(what, k).alias(f"{what}{k}") for k in range(len(own)) for what in ("_n", "_f")))
        each = [F.struct(F.lit(rule.code).alias("code"), F.col(f"_n{k}").alias("total_checked"), F.col(f"_f{k}").alias("total_failed")) for k, (rule, _) in enumerate(own)]
        return counts.select(F.explode(F.array(*each)).alias("c")).select("c.*").where("total_checked > 0")

    return reduce(DataFrame.unionByName, [of(rules[at : at + chunk]) for at in range(0, len(rules), chunk)])


def _key_of(rule: RuleSpec, r: KeyRule) -> tuple[Column, list[Column], list[Column]]:
    """Whether a row has the key, its parts as text, and the columns that tell it apart."""
    texts = [c.cast("string") for c in r.columns]
    return reduce(Column.__and__, [c.isNotNull() for c in r.columns]), texts, [F.lit(rule.code).alias("code"), F.array(*texts).alias("_key")]


def _keys(frames: Frames, rules: list[tuple[RuleSpec, KeyRule]], chunk: int) -> DataFrame:
    """(code, _key) of each row that has the key."""
    bare: dict[str, list[Column]] = {}
    for rule, r in rules:
        there, _, row = _key_of(rule, r)
        bare.setdefault(r.table, []).append(F.when(there, F.struct(*row)))
    return reduce(DataFrame.unionByName, [_exploded(frames(t), structs, chunk) for t, structs in bare.items()])


def occurring_again(frames: Frames, rules: list[tuple[RuleSpec, KeyRule]], chunk: int = CHUNK) -> DataFrame:
    """The checks of all rules on keys: keys are counted before any shuffle of rows, only those that occur again are joined back."""
    full: dict[str, list[Column]] = {}
    for rule, r in rules:
        there, texts, row = _key_of(rule, r)
        full.setdefault(r.table, []).append(F.when(there, F.struct(*row, shown(r.document).alias("document_id"), F.concat_ws("|", *texts).alias("variable_1"))))
    keys = _keys(frames, rules, chunk)
    again = keys.groupBy("code", "_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("code").alias("_code"), F.col("_key").alias("_again"))
    rows = reduce(DataFrame.unionByName, [_exploded(frames(t), structs, chunk) for t, structs in full.items()])
    rows = rows.join(again, (F.col("code") == F.col("_code")) & (F.col("_key") == F.col("_again")), "left")
    return rows.select("code", "document_id", _status(F.col("_again").isNotNull()).alias("status"), "variable_1", F.lit("").alias("variable_2"))


def occurring_again_counts(frames: Frames, rules: list[tuple[RuleSpec, KeyRule]], chunk: int = CHUNK) -> DataFrame:
    """(code, total_checked, total_failed) of all rules on keys: from the keys' numbers, no row is joined back."""
    rows = _keys(frames, rules, chunk).groupBy("code", "_key").agg(F.count(F.lit(1)).alias("_n"))
    return rows.groupBy("code").agg(F.sum("_n").alias("total_checked"), F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("total_failed"))


def _by(rules: list[tuple[RuleSpec, LookupRule | KeyRule]], what: str) -> list[list[tuple]]:
    """The rules by an attribute of what they build."""
    out: dict[object, list[tuple]] = {}
    for rule, r in rules:
        out.setdefault(getattr(r, what), []).append((rule, r))
    return list(out.values())


def groups(tables: Tables, rules: Iterable[RuleSpec], errors: dict[str, str] | None = None, keep: Keep = lambda df: df, counted: bool = False) -> list[Group]:
    """The rules by what they share. errors: rules that can't be planned are put there and don't stop the rest. counted: groups are run by themselves, so look-ups and keys are some groups each."""
    frames = tables if isinstance(tables, Frames) else Frames(tables)
    by_frame: dict[tuple, list[tuple[RuleSpec, RowRule]]] = {}
    lookups, keys, out = [], [], []
    for rule in rules:
        try:
            built: Built = FAMILIES[rule.family].build(frames, rule)
            if isinstance(built, RowRule):
                by_frame.setdefault(built.frame, []).append((rule, built))
            elif isinstance(built, LookupRule):
                lookups.append((rule, built))
            elif isinstance(built, KeyRule):
                keys.append((rule, built))
            else:
                out.append(Group([rule], lambda b=built, r=rule: b.select(F.lit(r.code).alias("code"), "*")))
        except Exception as e:  # noqa: BLE001  a rule that can't be planned is reported, others go on
            if errors is None:
                raise
            errors[rule.code] = str(e)
    out = [Group([r for r, _ in own], lambda f=frame, o=own: fused(frames.made[f], o), lambda f=frame, o=own: fused_counts(frames.made[f], o)) for frame, own in by_frame.items()] + out
    for own in _by(lookups, "sources") if counted else filter(None, [lookups]):
        out.append(Group([r for r, _ in own], lambda o=own: looked_up(frames, o, keep), lambda o=own: looked_up_counts(frames, o)))
    for own in _by(keys, "table") if counted else filter(None, [keys]):
        out.append(Group([r for r, _ in own], lambda o=own: occurring_again(frames, o), lambda o=own: occurring_again_counts(frames, o)))
    return out


def plan_checks(tables: Tables, rules: Iterable[RuleSpec], errors: dict[str, str] | None = None, keep: Keep = lambda df: df, each: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame | None:
    """(code, document_id, status, variable_1, variable_2) of all rules as one plan. each: what is done with each group's checks.

    If a group fails its rules are tried one by one, and those that fail are put in errors.
    """
    parts = []
    for group in groups(tables, rules, errors, keep):
        try:
            parts.append(each(group.plan()))
        except Exception as e:  # noqa: BLE001
            if errors is None:
                raise
            if len(group.rules) == 1:
                errors[group.rules[0].code] = str(e).splitlines()[0]
                continue
            alone = [plan_checks(tables, [rule], errors, keep, each) for rule in group.rules]
            parts += [x for x in alone if x is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def counted_checks(tables: Tables, rules: Iterable[RuleSpec], errors: dict[str, str], threads: int = COUNTERS) -> list[Row]:
    """(code, total_checked, total_failed) of the rules that have checks, a row a rule.

    Groups are run one after another, as many at once as there are threads, so that what one moves can be deleted before
    others move theirs. If a group fails its rules are tried one by one, and those that fail are put in errors.
    """
    frames, planning = tables if isinstance(tables, Frames) else Frames(tables), Lock()

    def rows_of(group: Group) -> list[Row]:
        try:
            with planning:
                made = group.counts() if group.counts else _tallied(group.plan())
            return made.collect()
        except Exception as e:  # noqa: BLE001
            if len(group.rules) == 1:
                errors[group.rules[0].code] = str(e).splitlines()[0]
                return []
            with planning:
                alone = [g for rule in group.rules for g in groups(frames, [rule], errors, counted=True)]
            return [row for g in alone for row in rows_of(g)]

    with ThreadPoolExecutor(threads) as pool:
        return [row for rows in pool.map(rows_of, groups(frames, rules, errors, counted=True)) for row in rows]


def compile_rule(tables: Tables, rule: RuleSpec) -> DataFrame:
    """A rule's checks (document_id, status, variable_1, variable_2)."""
    return plan_checks(tables, [rule]).drop("code")
