"""python -m freightlens {window,extract,spine,links,rules,mart,publish} --config FILE [--run PATH]: the steps of a run.

The configuration names the source (`parquet: folder` or `jdbc: url, user, password`), `root` of the runs, `window`,
`run_id`, and optionally `limit`, `tables`, `exclude` (columns by table), `workers` (tables extracted at a time), `texts`
(a JSON file of rules' texts by code), `carrier` (the company's name in them), `target`, where publish puts its tables,
and `order` (their physical sort keys). `window` prints a run's dates and folder. An S3 store is set up from S3_ENDPOINT,
S3_ACCESS_KEY, S3_SECRET_KEY and S3_REGION.
"""

from __future__ import annotations

import argparse
import json
import os
import warnings
from datetime import date

from pyspark.sql import SparkSession

from freightlens.operators.links import build_links
from freightlens.operators.mart import build_mart
from freightlens.operators.rules import run_rules
from freightlens.operators.rules.catalog import load
from freightlens.operators.rules.families import with_route_parts
from freightlens.operators.spine import build_spine, judged_quality, quality_counts
from freightlens.plans.scopes import SOURCES, ScopeGraph, selected
from freightlens.plans.windows import DateWindow
from freightlens.sources.config import load_config, truth, use_object_store
from freightlens.sources.extraction import extract
from freightlens.sources.publishing import publish
from freightlens.sources.readers import JdbcTable, TableCatalog, demo_tables, read_parquet
from freightlens.sources.runs import Run, Store, write_results


def source(spark: SparkSession, config: dict) -> TableCatalog:
    if "jdbc" in config:
        options = {k: str(v) for k, v in config["jdbc"].items() if k != "url"}
        return TableCatalog({n: JdbcTable(spark, config["jdbc"]["url"], n, **options) for n in SOURCES})
    return TableCatalog({n: (lambda n=n: read_parquet(spark, f"{config['parquet']}/{n.lower()}")) for n in SOURCES})


def rule_tables(tables: TableCatalog):
    return lambda n: with_route_parts(tables(n)) if n == "CMS_DROURATE" else tables(n)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="freightlens", description=__doc__)
    p.add_argument("step", choices=["window", "extract", "spine", "links", "rules", "mart", "publish", "demo"])
    p.add_argument("--config")
    p.add_argument("--run", help="the folder of a run that was extracted")
    p.add_argument("--no-strict", action="store_true")
    p.add_argument("--fail-on-skipped", action="store_true")
    p.add_argument("--isolate", action="store_true", help="try each rule by itself")
    a = p.parse_args(args)
    spark = spark or SparkSession.builder.appName("freightlens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    how = {"strict": not a.no_strict, "fail_on_skipped": a.fail_on_skipped, "isolate": a.isolate}
    if a.step == "demo":
        tables = demo_tables(spark)
        run_rules(spark, rule_tables(tables), load(), tables.available, **how).summary.where("status <> 'SKIPPED'").orderBy("index_code").show(500, False)
        return
    use_object_store(spark, os.environ)
    config = load_config(a.config) if a.config else {}
    if a.step in ("window", "extract"):
        window = DateWindow.resolve(config["window"])
        run = Run(spark, config["root"], window, str(config.get("run_id", date.today())), date.fromisoformat(str(config.get("extract_date", date.today()))))
    if a.step == "window":
        print(json.dumps({"start": str(window.start), "end": str(window.end), "run_id": run.run_id, "path": run.path}))
        return
    if a.step == "extract":
        graph = ScopeGraph(source(spark, config["source"]), window, limit=config.get("limit"), ahead=int(config.get("ahead", 30)), back=int(config.get("back", 0)), guards=truth(config.get("guards", True)))
        gone = config.get("exclude", {})
        extract(run, graph, selected(config.get("tables")), lambda t: gone.get(t, []), reuse=Run.open(spark, config["reuse"]) if config.get("reuse") else None, workers=int(config.get("workers", 4)))
        print(run.path)
        return
    run = Run.open(spark, a.run)
    tables = run.catalog()
    if a.step == "spine":
        rows = run.tables["CMS_CNOTE"]["rows"]
        raw = TableCatalog({k: (lambda p=v["path"]: read_parquet(spark, p)) for k, v in run.tables.items()})
        quality = quality_counts()
        n = run.add("CMS_CNOTE_TRANSFORMED", build_spine(raw), derived=True, observed=quality)
        found = judged_quality(n, quality["unknown"], rows)
        for what in found["wrong"]:
            warnings.warn(what, stacklevel=1)
        print(found)
        if n != rows:
            raise ValueError("the spine and the anchor differ in rows")
    elif a.step == "links":
        run.add("DOCUMENT_CNOTE_LINKS", build_links(tables, tables.available), derived=True)
    elif a.step == "rules":
        texts = json.loads(Store(spark).read(config["texts"])) if config.get("texts") else None
        edges = tables("DOCUMENT_CNOTE_LINKS") if tables.available("DOCUMENT_CNOTE_LINKS") else None
        found = run_rules(spark, rule_tables(tables), load(texts, config.get("carrier", "Carrier")), tables.available, edges, work=f"{run.path}/_work", **how)
        for name, df in (("governance_results", found.results), ("governance_result_cnotes", found.links), ("governance_rule_summary", found.summary)):
            if df is not None:
                write_results(df, f"{run.path}/{name}")
        found.forget()
    elif a.step == "mart":
        if run.add("UNIFIED_SHIPMENTS", build_mart(tables), derived=True) != run.tables["CMS_CNOTE"]["rows"]:
            raise ValueError("the mart and the anchor differ in rows")
    else:
        frames = {n.lower(): read_parquet(spark, v["path"]) for n, v in {**run.tables, **run.derived}.items()}
        publish(spark, frames, config["target"], audit=f"{config['target']}/mart_load_runs", run_id=run.run_id, skip=config.get("skip", []), order=config.get("order"))
    run.save()


if __name__ == "__main__":
    main()
