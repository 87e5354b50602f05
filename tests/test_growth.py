"""What grows with the tables: rows that plans move or write, and rows that would meet in one task."""

import re

from freightlens.operators.links import PATHS, build_links
from freightlens.operators.rules.runner import enriched
from freightlens.plans.queries import _BAGS
from freightlens.plans.standins import Standins

SF = "/root/testdata/sf0.001"


def exchanged(df, capsys):
    """What each exchange of a plan carries."""
    capsys.readouterr()
    df.explain("formatted")
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", capsys.readouterr().out)


def test_no_row_carries_its_rules_texts_through_a_shuffle(spark, capsys):
    t = Standins(spark, SF)
    checks = spark.createDataFrame([("COMP1J3", "B1", "PASS", "1.5", "")], "code string, document_id string, status string, variable_1 string, variable_2 string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        carried = exchanged(enriched(checks, _BAGS, build_links(t, t.available), t("CMS_CNOTE")), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert carried and not [c for c in carried if "issue_description" in c or "logic_description" in c]


def test_no_row_carries_its_document_twice(spark, capsys):
    """A direct row has one number on its way to its shipment, and distinct links lie where their join has put them."""
    t = Standins(spark, SF)
    checks = spark.createDataFrame([("COMP1J3", "B1", "PASS", "1.5", ""), ("COMP1B12", "C7", "FAIL", "", "")], "code string, document_id string, status string, variable_1 string, variable_2 string")
    linked = spark.createDataFrame([("CMS_MFBAG", "B1", "C5"), ("cms_mfbag ", "B1", "C5"), ("CMS_MFBAG", "B1", "C9")], "source_table string, document_id string, cnote_no string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alone = [[c.split("#")[0] for c in x.split(", ")] for x in exchanged(enriched(checks, _BAGS, None, t("CMS_CNOTE")), capsys)]
        found = enriched(checks, _BAGS, linked, t("CMS_CNOTE"))
        edges = [x for x in exchanged(found, capsys) if "_linked" in x and "_table" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [c for c in alone if "status" in c] == [["code", "_shipment", "status", "variable_1", "variable_2"]]
    assert len(edges) == 2  # by shipment, then by document
    rows = sorted((r.index_code, r.document_id, r.cnote_no, r.document_no) for r in found.collect())
    assert rows == [("COMP1B12", "C7", "C7", ""), ("COMP1J3", "B1", "C5", "B1"), ("COMP1J3", "B1", "C9", "B1")]


def test_links_move_once_and_places_are_not_sorted_before_they_move(spark, capsys):
    """Of the line items one shuffle, by shipment; of the shipments' places one that carries neither their type nor a first row of each task."""
    from freightlens.plans.queries import QUERIES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        carried = [[c.split("#")[0] for c in x.split(", ")] for x in exchanged(QUERIES["result_enrichment"](spark, SF), capsys)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {tuple(c) for c in carried if {"MFCNOTE_NO", "_linked", "document_id"} & set(c)} == {("_of_document", "_linked")}
    assert {tuple(c) for c in carried if "cnote_no" in c} == {("cnote_no", "cnote_origin", "cnote_destination", "cnote_service_code")}


def test_few_checks_and_many_meet_the_same_links(spark, monkeypatch):
    """Checks that are broadcast to links and those that are shuffled: repeated links, numbers of no shipment, blank ones, documents without links, repeated shipments."""
    from freightlens.operators.rules import runner

    checks = spark.createDataFrame([("COMP1J3", d, "PASS", "1", "") for d in ("B1", "B1", " B2 ", "B3", "B4", "", None)] + [("COMP1B12", d, "FAIL", "", "") for d in ("C1", "C9", "", None)], "code string, document_id string, status string, variable_1 string, variable_2 string")
    links = spark.createDataFrame([("CMS_MFBAG", "B1", "C1"), ("cms_mfbag ", "B1", " C1"), ("CMS_MFBAG", "B1", "C2"), ("CMS_MFBAG", "B2", "C2"), ("CMS_MFBAG", "B3", "C7"), ("CMS_MFBAG", "B3", ""), ("CMS_MANIFEST", "B4", "C1")], "source_table string, document_id string, cnote_no string")
    shipments = spark.createDataFrame([("C1", "SUB10000", "CGK10000", "YES"), (" C1", "BDO10000", "CGK10000", "YES"), ("C2", None, "CGK10000", "x"), (None, "CGK1", "CGK1", "REG"), ("", "CGK1", "CGK1", "REG")], "CNOTE_NO string, CNOTE_ORIGIN string, CNOTE_DESTINATION string, CNOTE_SERVICES_CODE string")
    found = {}
    for most in (0, 100_000):
        monkeypatch.setattr(runner, "MOST_CHECKS", most)
        rows = enriched(checks, _BAGS, links, shipments).collect()
        found[most] = sorted((r.index_code, r.document_id, r.cnote_no, r.document_no, r.cnote_origin, r.origin_region, r.cnote_service_code, r.shipment_type) for r in rows)
    assert found[0] == found[100_000]
    one, two = ("BDO10000", "Jawa Barat", "YES", "Domestic"), ("", "Other", "Other", "Unknown")
    none = ("", "", "", "")
    assert found[0] == sorted(
        [("COMP1B12", "C1", "C1", "", *one), ("COMP1B12", "C9", "", "C9", *none)] + [("COMP1B12", "", "", "", *none)] * 2 + [("COMP1J3", "B1", "C1", "B1", *one), ("COMP1J3", "B1", "C2", "B1", *two)] * 2
        + [("COMP1J3", "B2", "C2", "B2", *two), ("COMP1J3", "B3", "", "B3", *none), ("COMP1J3", "B4", "", "B4", *none)] + [("COMP1J3", "", "", "", *none)] * 2
    )


def test_ids_do_not_move_to_be_counted(spark, monkeypatch, capsys):
    """Different ids are counted by bits, in any order, with repeated ones and other forms."""
    from freightlens.operators.rules import runner
    from freightlens.plans import run_queries
    from freightlens.plans.queries import QUERIES

    numbers = [*range(1, 70_001), 5, 70_000]
    given = spark.createDataFrame([(f"R{n:012d}",) for n in numbers] + [("x",), ("x",), ("R1",)], "result_id string").repartition(3)
    monkeypatch.setattr(run_queries, "run_rules", lambda *a, **how: runner.RunResult(None, given, None, given))
    found = QUERIES["result_ids"](spark, SF)
    assert [tuple(r) for r in found.collect()] == [(70_005, 70_002, "R000000000001", "x")]
    monkeypatch.setattr(run_queries, "run_rules", lambda *a, **how: runner.RunResult(None, given.where("result_id = 'none'"), None, given))
    assert [tuple(r) for r in QUERIES["result_ids"](spark, SF).collect()] == [(0, 0, None, None)]
    capsys.readouterr()
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert re.findall(r"hashpartitioning\((\w+)", plan.split("Subqueries")[0])[0].startswith(("_groupingexpression", "bucket"))


def test_only_links_of_the_rules_tables_are_followed(spark, capsys):
    t = Standins(spark, SF)
    asked = []
    names = lambda n: asked.append(n) or t(n)
    own = build_links(names, t.available, sources={"CMS_MFBAG"})
    assert set(asked) == {"CMS_MFCNOTE", "CMS_CNOTE"}
    both = build_links(t, t.available, paths=PATHS).where("source_table = 'CMS_MFBAG'")
    assert sorted(own.collect()) == sorted(both.collect())
    assert len(exchanged(own, capsys)) < 5


def test_published_results_read_links_of_their_rules_alone(spark, monkeypatch):
    from freightlens.plans import run_queries
    from freightlens.plans.queries import QUERIES

    found = []
    build = run_queries.links.build_links
    monkeypatch.setattr(run_queries.links, "build_links", lambda *a, **how: found.append(how) or build(*a, **how))
    for name in ("results_published", "result_enrichment"):
        QUERIES[name](spark, SF)
    assert [set(how.get("sources") or ()) for how in found] == [{"CMS_MFBAG", "CMS_CNOTE"}] * 2


def test_shipments_without_a_number_or_an_order_are_spread(spark, capsys):
    """No exchange of the orders' stage, nor of the mart, is by a key that is null for many rows."""
    from freightlens.operators import mart

    t = Standins(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = mart.orders_stage(t, mart.zones(t))
        capsys.readouterr()
        rows.explain("formatted")
        plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Left keys \[\d+\]: \[(\w+)#\d+\]", plan)
    assert keys.count("_spread") == 1 and "CNOTE_NO" not in keys
    assert "CNOTE_DATE" not in "".join(re.findall(r"Input \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(APICUST_CNOTE_NO", plan))
    alone = rows.where("CNOTE_NO IS NULL")
    assert alone.select("_spread").distinct().count() == alone.count() > 1
    assert rows.drop("_spread").count() == t("CMS_CNOTE").count()


def test_results_are_written_without_what_follows_from_them(spark, tmp_path):
    """Neither a rule's texts nor a shipment's regions nor its number a second time are in files; results have them when read."""
    from freightlens.operators.rules import run_rules

    t = Standins(spark, SF)
    result = run_rules(spark, t, _BAGS, t.available, links=build_links(t, t.available, sources={"CMS_MFBAG"}), work=f"file://{tmp_path}")
    placed = [c for c in (set(spark.read.parquet(str(f)).columns) for f in {p.parent for p in tmp_path.rglob("*.parquet")}) if "_place" in c]
    assert placed == [{"code", "_document", "status", "variable_1", "variable_2", "cnote_no", "cnote_origin", "cnote_destination", "cnote_service_code", "shipment_type", "_place"}]
    row = result.results.where("index_code = 'COMP1J3' AND cnote_no <> ''").first()
    assert row.issue_description == "Mandatory Field - Blank" and row.origin_region and row.document_no.startswith("B") and row.level == "bag"
    row = result.results.where("index_code = 'COMP1B12' AND cnote_no <> ''").first()
    assert row.document_no == "" and row.stage == "" and row.table_name == "CMS_CNOTE"


def test_a_summary_alone_writes_no_checks(spark, tmp_path):
    """Totals of a few rules of each kind, as a run with results counts them, and what is left in the work folder."""
    from freightlens.operators.rules import run_rules
    from freightlens.plans.queries import CATALOG, by_code

    t = Standins(spark, SF)
    rules = by_code(CATALOG, "COMP1B12", "VALD1B6", "UNIQ1B74", "UNIQ2I1", "ACCU6B6", "COMP2P6", "TIME1I9 (OM)", "CONS3J3", "CONS3K5", "COMP1B18")
    sizes, found = [], []
    for only in (False, True):
        work = tmp_path / str(only)
        result = run_rules(spark, t, rules, t.available, work=f"file://{work}", summary_only=only)
        found.append(sorted(result.summary.collect()))
        sizes.append(sum(f.stat().st_size for f in work.rglob("*.parquet")))
        assert (result.checks is None) == only == (result.results is None)
    assert found[0] == found[1] and len({r.status for r in found[0]}) > 2
    assert sizes[1] < sizes[0] / 2


def test_the_catalog_s_totals_are_counted_without_results(spark, monkeypatch):
    from freightlens.operators.rules import runner
    from freightlens.plans import run_queries
    from freightlens.plans.queries import QUERIES

    asked = []
    monkeypatch.setattr(run_queries, "run_rules", lambda *a, **how: asked.append(how) or runner.RunResult(None, None, None, spark.range(0).selectExpr(*(f"'' AS {c}" for c in runner.SUMMARY_COLUMNS))))
    QUERIES["rules_of_catalog"](spark, SF)
    assert asked == [{"summary_only": True}]


def test_sorted_parts_have_as_many_ranges_as_files(spark, tmp_path):
    from freightlens.sources.runs import write_table

    rows = spark.range(1000).selectExpr("id % 97 AS a", "id AS b")
    assert write_table(rows, str(tmp_path / "t"), rows_per_file=100, order=["a", "b"]) == 1000
    ranges = {p.name.split("-")[1] for p in (tmp_path / "t").glob("part-*")}
    assert len(ranges) >= 8


def test_no_stage_moves_for_its_users_zones(spark, capsys):
    from freightlens.operators import mart

    t = Standins(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        capsys.readouterr()
        mart.build_mart(t).explain("formatted")
        plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.findall(r"hashpartitioning\([^)]*(?:USER|UID)", plan)


def test_counted_groups_leave_no_shuffle_files(spark, tmp_path):
    """A summary's groups run one after another, and their shuffle files are gone when it is there; a run of its own session's setting is as before."""
    import time

    from freightlens.operators.rules import run_rules
    from freightlens.plans.queries import CATALOG, by_code

    t = Standins(spark, SF)
    rules = by_code(CATALOG, "UNIQ1B74", "UNIQ2I1", "COMP2P6", "CONS1B12", "TIME1I9 (OM)")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {str(f) for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    spark.range(1000).groupBy("id").count().count()  # a query of another's, whose files stay
    before = files()
    summary = run_rules(spark, t, rules, t.available, work=f"file://{tmp_path}", summary_only=True).summary
    for _ in range(40):
        if not (left := files() - before):
            break
        time.sleep(0.25)
    assert before and not left and {r.status for r in summary.collect()} <= {"PASS", "FAIL"}
    spark.range(1000).groupBy("id").count().count()
    assert files() - before  # the setting holds for the summary alone
