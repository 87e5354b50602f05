"""Classes, windows, scopes, the spine, links and contexts on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freightlens.functions.classes import branch_region, delivery_category, route_parts, service_bucket, shipment_scope
from freightlens.functions.events import first_value
from freightlens.functions.values import present, rounded, whole
from freightlens.operators.links import build_links
from freightlens.operators.rules.catalog import by_code, load
from freightlens.operators.rules.runner import enriched
from freightlens.operators.spine import ADDED, build_spine, quality_of
from freightlens.plans.scopes import SOURCES, ScopeGraph, closure, selected, waves
from freightlens.plans.windows import DateWindow
from freightlens.sources.readers import TableCatalog
from freightlens.streaming import first_events_stream, scoped_stream


def catalog(spark, **frames):
    made = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in frames.items()}
    return TableCatalog({k: (lambda v=v: v) for k, v in made.items()})


def test_scopes_of_places(spark):
    rows = [("CGK10000", "CGK10209", "Intracity"), ("CGK10000", "CGK20000", "Intercity"), ("CGK10000", "BKI10044", "Domestic"), ("CGK", "BKI10044", "Unknown"), ("CGKA0000", "BKI10044", "Unknown"), (None, "BKI10044", "Domestic"), (" cgk10000", "CGK10001", "Intracity")]
    df = spark.createDataFrame(rows, "a string, b string, want string")
    assert all(r.got == r.want for r in df.select("want", shipment_scope(F.col("a"), F.col("b")).alias("got")).collect())
    rows = [("Direct", "Domestic", "Direct Domestic"), ("Transit", "Domestic", "Transit Domestic"), ("Direct", "Intracity", "Intracity"), ("Transit", "Intercity", "Intercity"), ("Direct", "Unknown", "Unknown")]
    df = spark.createDataFrame(rows, "a string, b string, want string")
    assert all(r.got == r.want for r in df.select("want", delivery_category(F.col("a"), F.col("b")).alias("got")).collect())


def test_lookups_and_values(spark):
    df = spark.createDataFrame([("CGK10000", "YES19", "AAA10000BBB20000"), ("bdo", "jtr-heavy", "BADCODE"), (None, "BAD", None), ("ZZ", None, "")], "place string, service string, route string")
    got = df.select(branch_region(F.col("place")), service_bucket(F.col("service")), *route_parts(F.col("route"))).collect()
    assert [tuple(r) for r in got] == [("Jakarta", "YES", "AAA10000", "BBB20000", True), ("Jawa Barat", "JTR", "", "", False), ("Other", "Other", None, None, False), ("Other", "Other", "", "", False)]
    df = spark.createDataFrame([("3.0", 2.5), ("3.7", 3.5), ("x", -0.5), (" \t", None)], "s string, d double")
    got = df.select(whole(F.col("s")), rounded(F.col("d"), 0), present(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(3, 2.0, True), (4, 4.0, True), (None, -0.0, True), (None, None, False)]
    df = spark.createDataFrame([(1, None, 1), (1, "a", 3), (1, "b", None), (2, None, 1)], "k int, v string, t int")
    assert {r.k: r.x for r in df.groupBy("k").agg(first_value("v", "t").alias("x")).collect()} == {1: "a", 2: None}


def test_windows():
    assert DateWindow.resolve({"anchor": "2026-03", "months": 2}) == DateWindow(dt.date(2026, 3, 1), dt.date(2026, 5, 1))
    assert DateWindow.resolve({"mode": "explicit", "start": "2026-03-15", "end": "2026-04-01"}).label() == "window_start=2026-03-15/window_end=2026-04-01"
    assert DateWindow.resolve({}, dt.date(2026, 12, 31)).end == dt.date(2027, 1, 1)
    with pytest.raises(ValueError):
        DateWindow(dt.date(2026, 1, 1), dt.date(2026, 1, 1))


def test_scope_closure():
    assert closure({"MMBAG", "SMU", "MSJ", "COST_MANIFEST", "HOV_RSHEET", "DRSHEET_PRA", "DSTATUS"}) >= {"CNOTE", "MANIFEST", "MFBAG", "DMBAG", "HVI", "RDSJ_HVO"}
    assert waves({"SMU"}) == [{"CNOTE"}, {"MANIFEST"}, {"MFBAG"}, {"DMBAG"}, {"SMU"}]
    assert len(SOURCES) == 44 and [s.name for s in selected(["cms_msj", "CMS_CNOTE"])] == ["CMS_CNOTE", "CMS_MSJ"]
    with pytest.raises(ValueError):
        selected(["NONE"])


def scoped(spark):
    day = dt.datetime
    return catalog(
        spark,
        CMS_CNOTE=("CNOTE_NO string, CNOTE_DATE timestamp_ntz", [("C1", day(2026, 5, 1)), ("C2", day(2026, 5, 31, 23)), ("C3", day(2026, 6, 1)), (None, day(2026, 5, 2))]),
        CMS_MFCNOTE=("MFCNOTE_NO string, MFCNOTE_MAN_NO string, MFCNOTE_BAG_NO string, MFCNOTE_CRDATE timestamp_ntz", [("C1", "M1", "B1", day(2026, 5, 2)), ("C1", "M1", None, day(2026, 8, 2)), ("C3", "M3", "B3", day(2026, 6, 2))]),
        CMS_MFBAG=("MFBAG_NO string, MFBAG_MAN_NO string, MFBAG_CRDATE timestamp_ntz, SECRET string", [("B7", "M1", day(2026, 5, 9), "s"), ("B8", "M9", day(2026, 5, 9), "s")]),
        ORA_ZONE=("ZONE_CODE string", [("Z",)]),
    )


def test_scopes(spark):
    graph = ScopeGraph(scoped(spark), DateWindow(dt.date(2026, 5, 1), dt.date(2026, 6, 1)))
    keys = lambda s, g=graph: sorted(r.k for r in g.keys(s).collect())
    assert keys("CNOTE") == ["C1", "C2"] and keys("MANIFEST") == ["M1"] and keys("MFBAG") == ["B1", "B7"]
    assert graph.restricted("CMS_MFCNOTE").count() == 1
    assert ScopeGraph(scoped(spark), graph.window, guards=False).restricted("CMS_MFCNOTE").count() == 2
    assert graph.restricted("CMS_MFBAG", exclude=["secret"]).columns == ["MFBAG_NO", "MFBAG_MAN_NO", "MFBAG_CRDATE"]
    assert graph.restricted("ORA_ZONE").count() == 1
    assert keys("CNOTE", ScopeGraph(scoped(spark), graph.window, limit=1)) == ["C1"]
    with pytest.raises(ValueError):
        ScopeGraph(scoped(spark), graph.window, limit=0)
    with pytest.raises(ValueError):
        graph.restricted("ORA_ZONE", exclude=["ZONE_CODE"])


def test_spine_has_the_anchors_rows(spark):
    t0 = dt.datetime(2026, 5, 1)
    at = lambda h: t0 + dt.timedelta(hours=h)
    pair = lambda d, m, date: {d[0]: (f"{d[1]} string, {d[2]} string", [("X1", "C1"), ("X2", "C1")]), m[0]: (f"{m[1]} string, {date} timestamp_ntz", [("X1", at(5)), ("X2", at(3))])}
    frames = {
        "CMS_CNOTE": ("CNOTE_NO string, CNOTE_CRDATE timestamp_ntz, CNOTE_ORIGIN string, CNOTE_DESTINATION string", [("C1", at(0), "CGK10000", "BDO10000"), ("C2", at(0), "CGK10000", "CGK10001"), (None, None, None, None)]),
        **pair(("CMS_DRCNOTE", "DRCNOTE_NO", "DRCNOTE_CNOTE_NO"), ("CMS_MRCNOTE", "MRCNOTE_NO"), "MRCNOTE_DATE"),
        **pair(("CMS_DHI_HOC", "DHI_NO", "DHI_CNOTE_NO"), ("CMS_MHI_HOC", "MHI_NO"), "MHI_APPROVE_DATE"),
        **pair(("CMS_DRSHEET", "DRSHEET_NO", "DRSHEET_CNOTE_NO"), ("CMS_MRSHEET", "MRSHEET_NO"), "MRSHEET_DATE"),
        "CMS_MFCNOTE": ("MFCNOTE_NO string, MFCNOTE_MAN_NO string, MFCNOTE_BAG_NO string", [("C1", "M1", "B1"), ("C1", "M2", "B1")]), "CMS_MANIFEST": ("MANIFEST_NO string, MANIFEST_CODE string", [("M1", "3.0"), ("M2", "3")]),
        "CMS_MFBAG": ("MFBAG_NO string, MFBAG_CRDATE timestamp_ntz", [("B1", at(6))]), "CMS_DHICNOTE": ("DHICNOTE_CNOTE_NO string, DHICNOTE_TDATE timestamp_ntz", []),
        "CMS_DHOCNOTE": ("DHOCNOTE_CNOTE_NO string, DHOCNOTE_NO string, DHOCNOTE_TDATE timestamp_ntz", [("C1", "O1", at(7))]), "CMS_MHOCNOTE": ("MHOCNOTE_NO string, MHOCNOTE_DATE timestamp_ntz", [("O1", at(8))]),
        "CMS_CNOTE_POD": ("CNOTE_POD_NO string, CNOTE_POD_DATE timestamp_ntz", [("C1", at(27))]),
    }
    spine = build_spine(catalog(spark, **frames))
    assert spine.columns == ["CNOTE_NO", "CNOTE_CRDATE", "CNOTE_ORIGIN", "CNOTE_DESTINATION", *ADDED]
    rows = {r.CNOTE_NO: r for r in spine.collect()}
    one = rows["C1"]
    assert (one.delivery_category, one.transit_manifest_count, one.handover_count, one.sla_total_hours) == ("Transit Domestic", 2, 5, 24.0)
    assert (one.total_duration_hour_to_manifest, one.total_duration_hour_to_handover, one.total_duration_hour_to_runsheet) == (3.0, 2.0, -5.0)
    assert (rows["C2"].delivery_type, rows["C2"].delivery_category, rows["C2"].sla_total_hours) == ("Direct", "Intracity", None)
    assert rows[None].shipment_scope == "Domestic" and quality_of(spine, 3)["wrong"] == []


def linked(spark):
    return catalog(
        spark, CMS_CNOTE=("CNOTE_NO string, CNOTE_ORIGIN string, CNOTE_DESTINATION string, CNOTE_SERVICES_CODE string", [(f"CNOTE{k}", "CGK10000", "BDO10000", "REGULAR") for k in range(1, 7)]),
        CMS_MFCNOTE=("MFCNOTE_NO string, MFCNOTE_MAN_NO string, MFCNOTE_BAG_NO string", [("CNOTE1", "MAN1", "BAG1"), ("CNOTE2", "MAN1", " BAG1 "), ("OUTSIDE", "MAN1", "BAG1"), ("CNOTE1", None, " ")]),
        CMS_DMBAG=("DMBAG_NO string, DMBAG_BAG_NO string", [("MB1", "BAG1")]), CMS_MMBAG=("MMBAG_NO string", [("MB1",)]), CMS_DSMU=("DSMU_NO string, DSMU_BAG_NO string", [("SMU1", "MB1")]), CMS_MSMU=("MSMU_NO string", [("SMU1",)]),
        CMS_DRSHEET=("DRSHEET_NO string, DRSHEET_CNOTE_NO string", [("RS1", "CNOTE2")]), CMS_DHICNOTE=("DHICNOTE_NO string, DHICNOTE_CNOTE_NO string", [("HIC1", "CNOTE3")]), CMS_DHI_HOC=("DHI_NO string, DHI_CNOTE_NO string", [("MHI1", "CNOTE4")]),
        CMS_DHOCNOTE=("DHOCNOTE_NO string, DHOCNOTE_CNOTE_NO string", [("HOC1", "CNOTE5")]), CMS_DHOUNDEL_POD=("DHOUNDEL_NO string, DHOUNDEL_CNOTE_NO string", [("UND1", "CNOTE6")]),
        CMS_RDSJ=("RDSJ_NO string, RDSJ_HVO_NO string, RDSJ_HVI_NO string", [("RDSJ1", "HOC1", "HIC1")]), CMS_DSJ=("DSJ_NO string, DSJ_HVO_NO string", [("MSJ1", "HOC1")]), CMS_MSJ=("MSJ_NO string", [("MSJ1",)]),
    )


def test_links(spark):
    t = linked(spark)
    got = {(r.document_type, r.document_id, r.cnote_no) for r in build_links(t, t.available).collect()}
    bags = {(kind, doc, c) for kind, doc in (("MFBAG", "BAG1"), ("DMBAG", "BAG1"), ("DMBAG", "MB1"), ("MMBAG", "MB1"), ("MANIFEST", "MAN1"), ("DSMU", "SMU1"), ("MSMU", "SMU1")) for c in ("CNOTE1", "CNOTE2")}
    assert got == bags | {("MFCNOTE", "CNOTE1", "CNOTE1"), ("MFCNOTE", "CNOTE2", "CNOTE2"), ("MRSHEET", "RS1", "CNOTE2"), ("MHICNOTE", "HIC1", "CNOTE3"), ("MHI_HOC", "MHI1", "CNOTE4"), ("MHOCNOTE", "HOC1", "CNOTE5"), ("MHOUNDEL_POD", "UND1", "CNOTE6"), ("DSJ", "MSJ1", "CNOTE3"), ("MSJ", "MSJ1", "CNOTE3"), ("RDSJ", "RDSJ1", "CNOTE5")}


def test_enrichment(spark):
    t = linked(spark)
    rules = by_code(load(), "COMP1J3", "COMP1B12", "COMP1H1", "COMP1O1")
    checks = spark.createDataFrame([("COMP1J3", "BAG1", "PASS", "", ""), ("COMP1J3", "BAG9", "FAIL", "", ""), ("COMP1B12", "CNOTE1", "PASS", "", ""), ("COMP1O1", "CNOTE4", "PASS", "", ""), ("COMP1O1", "OUTSIDE", "PASS", "", "")], "code string, document_id string, status string, variable_1 string, variable_2 string")
    rows = enriched(checks, rules, build_links(t, t.available), t("CMS_CNOTE")).collect()
    got = sorted((r.index_code, r.document_no, r.cnote_no, r.level, r.stage, r.link_method) for r in rows)
    assert got == [
        ("COMP1B12", "", "CNOTE1", "cnote", "", "direct_cnote"), ("COMP1J3", "BAG1", "CNOTE1", "bag", "2. Manifest", "cms_mfbag_bridge"), ("COMP1J3", "BAG1", "CNOTE2", "bag", "2. Manifest", "cms_mfbag_bridge"),
        ("COMP1J3", "BAG9", "", "bag", "2. Manifest", "cms_mfbag_bridge"), ("COMP1O1", "", "CNOTE4", "bag", "4. Runsheet", "direct_cnote_value"), ("COMP1O1", "OUTSIDE", "", "bag", "4. Runsheet", "direct_cnote_value"),
    ]
    one = next(r for r in rows if r.cnote_no == "CNOTE1")
    assert (one.cnote_service_code, one.origin_region, one.destination_region, one.shipment_type) == ("REG", "Jakarta", "Jawa Barat", "Domestic")


def test_stream_of_child_rows(spark, tmp_path):
    schema = "k0 string, t timestamp_ntz"
    rows = [("C1", dt.datetime(2026, 5, 3)), ("C1", dt.datetime(2026, 5, 2)), ("C9", dt.datetime(2026, 5, 2)), ("C1", dt.datetime(2026, 9, 1))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    keys = spark.createDataFrame([("C1",)], "k string")
    stream = spark.readStream.schema("k0 string, t timestamp").parquet(str(tmp_path / "in"))
    found = first_events_stream(scoped_stream(stream, keys, "k0", "t", DateWindow(dt.date(2026, 5, 1), dt.date(2026, 6, 1))), "k0", "t")
    q = found.writeStream.format("memory").queryName("first_events").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.k0, r.first_time, r.n) for r in spark.table("first_events").collect()] == [("C1", dt.datetime(2026, 5, 2), 2)]
