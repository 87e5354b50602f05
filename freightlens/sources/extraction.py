"""Extraction of a run's tables by waves: what depends on nothing more than is done runs at the same time.

A wave has the scopes that can be derived from those of the waves before, and the tables whose scopes are derived. Its
members are written by a bounded number of threads, so their jobs overlap. One that fails keeps back only what depends
on it; the manifest has its error, and a later call resumes where this one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from freightlens.plans.scopes import ANCHOR, SAME, SCOPES, ScopeGraph, SourceTable, waves

from .runs import Run, rows_written, write_table


class ExtractionError(RuntimeError):
    """Some tables failed; the others are written and can be resumed from."""


@dataclass(frozen=True)
class Task:
    """A scope's keys, or a table, and the scopes that it needs."""

    name: str
    table: SourceTable | None
    needs: frozenset[str]


def plan_waves(specs: Iterable[SourceTable], limited: bool = False) -> list[list[Task]]:
    """The tasks by wave. limited: the anchor has a bound on its rows, so it waits for its keys."""
    specs = list(specs)
    real = lambda s: SAME.get(s, s)
    need = {t: "CNOTE" if t is ANCHOR and limited else real(t.scope) if t.scope else "" for t in specs}
    at = {s: k for k, wave in enumerate(waves(set(need.values()) - {""})) for s in wave}
    out: list[list[Task]] = [[] for _ in range(max(at.values(), default=-1) + 2)]
    for s, k in sorted(at.items()):
        out[k].append(Task(s, None, frozenset(real(step.parent) for step in SCOPES.get(s, ()))))
    for t, scope in need.items():
        out[at[scope] + 1 if scope else 0].append(Task(t.name, t, frozenset({scope} - {""})))
    return [wave for wave in out if wave]


def extract(run: Run, graph: ScopeGraph, specs: Iterable[SourceTable], exclude: Callable[[str], Iterable[str]] = lambda _: (), resume: bool = True, reuse: Run | None = None, count_scopes: bool = False, workers: int = 4, strict: bool = True, **how) -> dict[str, str]:
    """Writes the restricted tables. Returns what was done with each: written, kept (finished before), reused (a reference of an earlier run), failed, waiting (for a scope that failed).

    Each scope's keys are derived once and written to the run's folder; tables and further scopes read them there. The
    manifest has each table's wave and times. strict: failures are raised once all else is done.
    """
    done: dict[str, str] = {}
    errors: dict[str, str] = {}
    spark = run.spark

    def kept(scope: str, keys: DataFrame) -> DataFrame:
        path = f"{run.path}/_scopes/{scope.lower()}"
        if not (resume and rows_written(spark, path) is not None):
            write_table(keys, path)
        return spark.read.schema(keys.schema).parquet(path)

    graph.store = graph.store or kept

    def table(spec: SourceTable) -> tuple[str, dict]:
        path = f"{run.path}/{spec.name.lower()}"
        if resume and (n := rows_written(spark, path)) is not None:
            return "kept", {"path": path, "rows": n}
        if spec.stage == "reference" and reuse and spec.name in reuse.tables and rows_written(spark, reuse.tables[spec.name]["path"]) is not None:
            return "reused", {k: reuse.tables[spec.name][k] for k in ("path", "rows")}
        return "written", {"path": path, "rows": write_table(graph.restricted(spec.name, exclude=exclude(spec.name)), path, **how)}

    def scope(name: str) -> tuple[str, dict]:
        keys = graph.keys(name)
        return "derived", {"rows": keys.count()} if count_scopes else {}

    def attempt(task: Task) -> tuple[Task, str, dict, str]:
        began = datetime.now(timezone.utc).isoformat()
        try:
            what, facts = table(task.table) if task.table else scope(task.name)
        except Exception as e:  # noqa: BLE001  a table that fails doesn't stop the others
            return task, "failed", {}, str(e).splitlines()[0] if str(e) else type(e).__name__
        return task, what, facts | {"started": began, "ended": datetime.now(timezone.utc).isoformat()}, ""

    failed_scopes: set[str] = set()
    with ThreadPoolExecutor(workers) as pool:
        for k, wave in enumerate(plan_waves(specs, graph.limit is not None)):
            ready = [t for t in wave if not t.needs & failed_scopes]
            for t in wave:
                if t not in ready:
                    errors[t.name] = f"waits for {', '.join(sorted(t.needs & failed_scopes))}"
                    if t.table:
                        done[t.name] = "waiting"
                    else:
                        failed_scopes.add(t.name)
            for task, what, facts, why in pool.map(attempt, ready):
                if why:
                    errors[task.name] = why
                    if not task.table:
                        failed_scopes.add(task.name)
                if task.table:
                    done[task.name] = what
                    if not why:
                        run.tables[task.name] = facts | {"wave": k}
                elif count_scopes and not why:
                    run.scopes[task.name] = facts["rows"]
    run.failed = errors
    run.save(complete=not errors)
    if errors and strict:
        raise ExtractionError(f"{len(errors)} tables or scopes failed: {errors}")
    return done
