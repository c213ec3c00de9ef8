"""The engine's operators on small hand-made fixtures: empties, nulls, ties and boundaries."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartsift.functions import geometry, names, parsing
from chartsift.operators import composites, curve_types, extract, figures, fit, islands, metrics, naming, review, rules, splits, ticks, validate
from chartsift.plans import batch
from chartsift.sources import documents, part_lists
from chartsift.streaming import status as streaming


def column(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


CASES = [
    (parsing.numeric, {"650": 650.0, "1,234.5 V": 1234.5, "10 ~ 20": 10.0, "5 @ 3A": 5.0, "1_000": 1000.0, "": None, " - ": None, "N/A": None, "null": None, "None": None, "abc": None, "inf": None, "nan": None, "4d": None, None: None, "3.": 3.0}),
    (parsing.voltage, {"650 V": 650.0, "1.2kV": 1200.0, "500mV": 0.5, "±20V": 20.0, "-5 V": -5.0, "20": 20.0, "x": None, None: None}),
    (parsing.current, {"49A (Tc)": 49.0, "200mA (Ta)": 0.2, "13.5A (Ta), 22A (Tc)": 13.5, "22A (Tc), 13.5A (Ta)": 13.5, "22A (Tc), 3A (Tc)": 22.0, "?": None, "": None}),
    (parsing.power, {"164W (Tc)": 164.0, "400mW (Ta)": 0.4}),
    (parsing.rdson_mohm, {"79mOhm @ 13.2A, 15V": 79.0, "0.5 Ohm": 500.0, "250 uOhm": 0.25, "250 µΩ": 0.25, "3.2mΩ": 3.2, "8m℧": 8.0, "12": 12.0, "7 mW": 7.0, ".. mOhm": None, "": None}),
    (parsing.capacitance, {"1621 pF @ 400 V": 1621.0, "2.4nF": 2400.0, "1uF": 1e6, "1µF": 1e6, "12": None}),
    (parsing.charge, {"59 nC @ 15 V": 59.0, "1.2uC": 1200.0, "300pC": 0.3, "7": None}),
    (parsing.energy, {"1.2mJ @ 400V, 40A": 1.2, "500uJ": 0.5, "2J": 2000.0, "5": 5.0}),
    (parsing.timing, {"35ns @ 400V": 35.0, "1.5us": 1500.0, "100ps": 0.1, "9": 9.0}),
    (parsing.thermal_resistance, {"0.65 °C/W": 0.65, "1.1 K/W": 1.1, "2": 2.0, "": None}),
    (parsing.price, {"$15.51": 15.51, "1,015.5": 1015.5, "ask": None, "$": None}),
    (parsing.exponent_value, {"10 3": 1000.0, "10³": 1000.0, "10-2": 0.01, "103": None, "x": None}),
    (parsing.tick_value, {"0,5": 0.5, "−3": -3.0, "103": 1000.0, "100": 100.0, "10^2": 100.0, "1E3": 1000.0, "10-2": 0.01, "x": None}),
    (names.model_name, {"IRF1404-ND": "IRF1404", " X-trdkr ": "X", "A-DKR": "A", "A-NDB": "A-NDB"}),
    (names.file_name, {"a/b (c) d\\e": "a_b_c_d_e", "__x__": "x"}),
    (names.sheet_url, {"//a.b/c": "https://a.b/c", " - ": None, "": None, "http://x": "http://x"}),
    (names.device, {"IRF1__fig.png": "IRF1", "a/b/IRF2.v1.png": "IRF2.v1", "plain": "plain"}),
    (names.family, {"BSC123": "BSC-BSZ", "irfz44": "IRFZ", "2N7002": "2N7002", "IAUCN04": "IAU"}),
    (names.band_label, {" Max. ": "max", "98 %": "max", "2%": "min", "typ": "typ", "typical": None}),
    (names.microamp_label, {"ID = 250 µA": 250.0, "I_D=1mA": 1000.0, "ID = 2A": 2e6, "VD = 2A": None}),
    (names.outline_flag, {"Package Outline": True, "5 mm wide": True, "RDS [mm]": False, "dimensions vs. vgs": False, None: False}),
    (naming.temperature, {"TJ = 25 C": 25.0, "-40 °C": -40.0, "25C": None, "Tj=150°C": 150.0}),
]


@pytest.mark.parametrize("f,cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_cells(spark, f, cases):
    got = column(spark, f, list(cases))
    for (text, want), have in zip(cases.items(), got):
        assert have == want or (isinstance(want, float) and have is not None and math.isclose(have, want, rel_tol=1e-12)), (text, have, want)


def test_ranges_times_and_units(spark):
    got = column(spark, parsing.temperature_range, ["-40 C ~ 175 C (TJ)", "150°C (TJ)", "", None, "hot"])
    assert [(r.low, r.high) for r in got] == [(-40.0, 175.0), (None, 150.0), (None, None), (None, None), (None, None)]
    assert column(spark, lambda c: parsing.tick_value(c, True), ["10 ms", "1us", "5s", "3"]) == [0.01, 1e-6, 5.0, 3.0]
    rows = [(1, 2.0, "kV", "V"), (2, 3.0, "Ω", "mOhm"), (3, 1.0, "furlong", "V"), (4, None, "V", "V"), (5, 5.0, "mV ", "V")]
    df = spark.createDataFrame(rows, "i int, v double, u string, t string")
    assert {r.i: r.normalized for r in parsing.normalize_units(df, "v", "u", "t").collect()} == {1: 2000.0, 2: 3000.0, 3: None, 4: None, 5: 0.005}
    with pytest.raises(Exception, match="unknown target"):
        parsing.normalize_units(df.withColumn("t", F.lit("parsec")), "v", "u", "t").collect()


def test_part_list_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text('﻿"Mfr Part #",Mfr,"Drain to Source Voltage (Vdss)","Rds On (Max) @ Id, Vgs",Price,"Operating Temperature",Ignored\nIRF1-ND,Infineon,650 V,79mOhm @ 13A,$1.50,-40 C ~ 175 C,x\n-,St,1 V,,,,\nB2-DKR,,garbage,?,ask,150 C,y\n', encoding="utf-8")
    kept, skipped = part_lists.read_csv(spark, f"file://{tmp_path}/p.csv", "Si-MOSFET")
    rows = kept.collect()
    assert [(r.ModelName, r.manufacturer, r.Vdss, r.Rdson, r.Cost, r.Tjmin, r.Tjmax) for r in rows] == [("IRF1", "Infineon", 650.0, 79.0, 1.5, -40.0, 175.0), ("B2", None, None, None, None, None, 150.0)]
    assert skipped.count() == 1 and part_lists.read_csv(spark, f"file://{tmp_path}/p.csv", "Si-MOSFET", 1)[0].count() == 1
    assert part_lists.find_column(["VDSS ", "vdss"], "Vdss", "Si-MOSFET") == "VDSS " and part_lists.find_column(["x"], "Vdss", "IGBT") is None
    with pytest.raises(ValueError):
        part_lists.parse_rows(spark.createDataFrame([("a",)], "Price string"), "IGBT")


def test_documents_and_scoring(spark, tmp_path):
    line = lambda t, *b: {"text": t, "bounding_box": dict(zip(("x1", "y1", "x2", "y2"), b))}
    good = {"figures": [{"index": 1, "page": 2, "caption": "Typical Capacitance", "ocr_lines": [line("Ciss", 5, 5, 9, 9), line("Vds [V]", 40, 92, 60, 96), line("capacitance C [pF]", 2, 20, 6, 70)]}, {"index": 2, "page": 2, "caption": None, "ocr_lines": []}]}
    for d, body in (("A", json.dumps(good)), ("B", "{broken"), ("C", '{"tables": []}')):
        (tmp_path / d).mkdir()
        (tmp_path / d / "full_extraction.json").write_text(body)
    f = documents.read_figures(spark, f"file://{tmp_path}/*/full_extraction.json")
    assert {(r.device, r.error) for r in f.select("device", "error").collect()} == {("A", None), ("B", "no figures"), ("C", "no figures")}
    assert [r.device for r in documents.discover_devices(spark, f"file://{tmp_path}").collect()] == ["A", "B", "C"]
    figs = f.where("error IS NULL").withColumns({"width": F.lit(100.0), "height": F.lit(100.0)})
    made = spark.createDataFrame([("cap", "caption", None, "typical capacitance", 3.0), ("cap", "axis", "y", "capacitance", 0.0), ("cap", "axis", "x", "vds", 0.0), ("cap", "phrase", None, "ciss", 2.0), ("cap", "phrase", None, "gate charge", -3.0), ("other", "axis", "x", "pf", 0.0)], "curve_type string, source string, axis string, keyword string, weight double")
    got = {(r.figure_id, r.curve_type): r.score for r in rules.score(rules.figure_lines(figs, ["figure_id"]), made, ["figure_id"], figs.select("figure_id")).collect()}
    assert got == {("A:2:1", "cap"): 10.0, ("A:2:2", "cap"): 0.0, ("A:2:1", "other"): 0.5, ("A:2:2", "other"): 0.0}


def test_classification_boundaries(spark):
    rows = [(1, "a", 7.0), (1, "b", 0.0), (2, "a", 5.0), (2, "b", 3.0), (3, "a", 5.0), (3, "b", 3.5), (4, "a", 0.0), (5, "a", 6.5), (6, "b", 4.0), (6, "a", 4.0), (7, "a", 4.9)]
    s = spark.createDataFrame(rows, "g int, f string, score double")
    got = {r.g: (r.f, r.margin, r.status) for r in rules.classify(s, ["g"], "f", complete=F.lit(False)).collect()}
    assert got == {1: ("a", 7.0, "matched"), 2: ("a", 2.0, "quarantined"), 3: ("a", 1.5, "quarantined"), 4: ("a", 0.0, "no_match"), 5: ("a", 6.5, "quarantined"), 6: ("a", 0.0, "quarantined"), 7: ("a", 4.9, "quarantined")}
    assert {r.g: r.status for r in rules.classify(s, ["g"], "f").collect()}[2] == "matched"
    c = spark.createDataFrame([(1, 5, 8.0, "quarantined"), (1, 6, 8.0, "matched"), (1, 7, 9.0, "no_match"), (2, 1, 1.0, "no_match")], "d int, p int, score double, status string")
    assert [(r.d, r.p) for r in rules.best_of_group(c, ["d"], ["p"]).collect()] == [(1, 6)]


def test_annotations_and_images(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<annotations><image id="1" name="f.png" width="10" height="20"><polyline label="c" points="1,2;3,4.5"><attribute name="curve_name">Ciss</attribute></polyline><polygon label="c" points="0,0;1,0;1,1"><attribute name="curve_name">TODO</attribute></polygon><box label="b" xtl="1"/></image><image id="2" name="g.png" width="1" height="1"><polyline label="c" points="1,x"><attribute name="curve_name"> </attribute></polyline></image></annotations>')
    rows = {r.id: r for r in documents.strip_shapes(documents.read_annotations(spark, f"file://{tmp_path}/a.xml")).collect()}
    assert [(s.type, s.points, s.curve_name) for s in rows[1].shapes] == [("polyline", [1.0, 2.0, 3.0, 4.5], "Ciss")] and rows[1].removed == 1
    assert rows[2].violations == ["polyline: empty curve_name"] and rows[1].violations == []
    png = bytes.fromhex("89504e470d0a1a0a0000000d49484452000001000000008008060000")
    got = spark.createDataFrame([(png,), (b"%PDF-" + b"x" * 100,), (b"%PDF",), (None,)], "c binary").select(documents.png_size(F.col("c")).alias("s"), documents.pdf_ok(F.col("c")).alias("p")).collect()
    assert (got[0].s.width, got[0].s.height) == (256, 128) and [r.p for r in got] == [False, True, False, None] and got[1].s is None
    files = spark.createDataFrame([("/a/x.png", 1), ("/b/DEV/figures/y.png", 0), ("/c/x.png", 0)], "path string, rank int")
    want = spark.createDataFrame([("x.png",), ("DEV__y.png",), ("z",)], "name string")
    assert {r.name: r.path for r in documents.resolve(want, files).collect()} == {"x.png": "/c/x.png", "DEV__y.png": "/b/DEV/figures/y.png", "z": None}


def test_geometry(spark):
    z = spark.createDataFrame([(0, 10, 5, 60), (40, 90, 80, 95), (40, 40, 60, 60), (5, 5, 5, 9), (0, 10, 5, 19)], "x1 int, y1 int, x2 int, y2 int")
    assert [r[0] for r in z.select(geometry.zone(*[F.col(c) for c in z.columns], F.lit(100), F.lit(100))).collect()] == ["y", "x", None, None, None]
    assert column(spark, geometry.shoelace, [[0.0, 0.0, 2.0, 0.0, 2.0, 2.0, 0.0, 2.0], [], [1.0]], "array<double>") == [4.0, 0.0, 0.0]
    assert column(spark, geometry.upper_median, [[3, 1, 2, 4], [5], []], "array<int>") == [3, 5, None]
    d = spark.createDataFrame([(10.0, 2.0, 0.0, False), (4.0, 2.0, 0.0, True), (1.0, 0.0, 0.0, False), (9999.0, 1.0, 0.0, True)], "p double, m double, b double, l boolean")
    assert [r[0] for r in d.select(geometry.pixel_to_data(F.col("p"), F.col("m"), F.col("b"), F.col("l"))).collect()] == [5.0, 100.0, None, 1e12]
    assert d.select(geometry.data_to_pixel(F.lit(-1.0), F.lit(1.0), F.lit(0.0), F.lit(True))).first()[0] is None


def plain_nms(items):
    kept = []
    for s, o, cells, y, a, b in sorted(items, key=lambda d: (-d[0], d[1])):
        twin = False
        for _, _, c2, y2, a2, b2 in kept:
            u = len(set(cells) | set(c2))
            iou = len(set(cells) & set(c2)) / u if u else 0
            short = min(b - a, b2 - a2)
            ov = (min(b, b2) - max(a, a2)) / short if short > 0 and min(b, b2) > max(a, a2) else 0
            twin = twin or iou >= 0.5 or (abs(y - y2) <= 6 and ov >= 0.7)
        if not twin:
            kept.append((s, o, cells, y, a, b))
    return [k[1] for k in kept]


def test_nms_matches_a_loop(spark):
    rnd = random.Random(3)
    groups = []
    for g in range(12):
        items = []
        for o in range(rnd.randint(0, 12)):
            a = rnd.randint(0, 30)
            items.append((rnd.choice([0.5, 0.7, 0.9, rnd.random()]), o, list(range(a, a + rnd.randint(0, 10))), float(rnd.randint(0, 20)), float(a), float(a + rnd.randint(0, 10))))
        groups.append((g, items))
    df = spark.createDataFrame(groups, "g int, items array<struct<score:double,ord:bigint,cells:array<bigint>,mean_y:double,x1:double,x2:double>>")
    got = {r.g: r.k for r in df.select("g", F.transform(geometry.nms(F.col("items")), lambda d: d["ord"]).alias("k")).collect()}
    assert got == {g: plain_nms(i) for g, i in groups}


def test_islands(spark):
    p = spark.createDataFrame([(1, i, i in (0, 1, 4, 5, 6, 9)) for i in range(10)], "g int, i int, on boolean")
    assert sorted((r.start, r.stop, r.n) for r in islands.runs(p, ["g"], "i", "on").collect()) == [(0, 1, 2), (4, 6, 3), (9, 9, 1)]
    spans = spark.createDataFrame([(1, 0, 10), (1, 39, 50), (1, 80, 90), (1, 121, 130), (1, 2, 3)], "g int, a int, b int")
    assert sorted((r.a, r.b) for r in islands.merge_gaps(spans, ["g"], "a", "b", 30).collect()) == [(0, 50), (80, 90), (121, 130)]
    h = spark.createDataFrame([(1, i, m, -float(i)) for i, m in enumerate([0.1, 0.3, 0.3, 0.2, 0.4, 0.1])], "g int, i int, m double, l double")
    rows = islands.early_stop(h, ["g"], "i", "m", 2).orderBy("i").collect()
    assert [(r.best_at, r.stop) for r in rows] == [(0, False), (1, False), (1, False), (1, True), (4, False), (4, False)]
    assert [r.diverges for r in islands.divergence(h, ["g"], "i", "l", "m").orderBy("i").collect()] == [False, False, False, True, False, True]
    assert column(spark, lambda c: islands.anchored_run(c, 1.0), [[1.0, 1.5, 2.0, 2.5, 3.6], [], [5.0]], "array<double>") == [3, 0, 1]


def test_fits():
    x = np.arange(10.0)
    y = 3 * x + 5
    y[4] = 400
    s, b, keep = fit.pruned_line(x, y)
    assert math.isclose(s, 3) and math.isclose(b, 5) and 4 not in keep
    lin = fit.axis(np.array([0.0, 50, 100, 150]), np.array([10.0, 110, 210, 310]))
    assert not lin["log"] and math.isclose(lin["slope"], 2) and lin["inliers"] == 4
    log = fit.axis(np.array([0.1, 1, 10, 100]), np.array([300.0, 200, 100, 0]))
    assert log["log"] and math.isclose(log["slope"], -100)
    assert fit.axis(np.array([1.0]), np.array([2.0])) is None and fit.axis(np.array([3.0, 3.0]), np.array([0.0, 100.0])) is None
    assert fit.near_twins(np.array([99.0, 100.0, 7.0]), np.array([10.0, 12.0, 40.0]))[0].tolist() == [100.0, 7.0]
    t = np.logspace(-4, 1, 12)
    f = fit.foster(t, 2.5 * (1 - np.exp(-t / 0.02)))
    assert math.isclose(f["r"], 2.5, rel_tol=1e-4) and math.isclose(f["tau"], 0.02, rel_tol=1e-3) and f["r_squared"] > 0.9999
    assert fit.foster(t[:5], t[:5]) is None
    assert fit.pair_rows([(1.0, 0), (2.0, 50)], [(0.1, 5), (0.2, 48), (0.3, 300)]) == [(1.0, 0.1), (2.0, 0.2)] and fit.pair_rows([(1.0, 0)], [(0.1, 0)]) == []


def test_fits_in_spark(spark):
    rows = [("a", v, 2 * v + 10) for v in (0.0, 50.0, 100.0)] + [("b", 1.0, 0.0)] + [("c", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, value double, pixel double")
    got = fit.fit_axes(df, ["k"]).collect()
    assert [(r.k, round(r.slope, 9), r.log, r.inliers) for r in got] == [("a", 2.0, False, 3)]
    p = spark.createDataFrame([(1, i, float(i), 3.0 * i) for i in range(5)] + [(1, 9, 2.0, 500.0)], "g int, i int, x double, y double")
    assert [(r.g, r.inliers) for r in fit.ransac_sql(p, ["g"]).collect()] == [(1, 5)]
    r = spark.createDataFrame([("f", "r", 1.0, 0.0), ("f", "r", 2.0, 50.0), ("f", "tau", 0.1, 5.0), ("f", "tau", 0.2, 48.0)], "f string, column string, value double, y double")
    assert [(p.r, p.tau) for p in fit.printed_pairs(r, ["f"]).first().pairs] == [(1.0, 0.1), (2.0, 0.2)]
    g = spark.createDataFrame([(12, 1.0, 5.0, None, 2.0, 0.9), (3, 1.0, 5.0, None, 2.0, 0.9), (12, 5.0, 1.0, None, 2.0, 0.9), (12, 1.0, 500.0, None, 2.0, 0.9), (12, 1.0, 5.0, 0.1, 2.0, 0.9), (12, 1.0, 5.0, 2.0, 2.0, 0.1)], "n int, l double, r double, k double, f double, q double")
    assert [x[0] for x in g.select(fit.thermal_gate(*[F.col(c) for c in g.columns])).collect()] == [None, "too few points", "implausible rise", "implausible level", "scale differs from the printed resistance", "poor fit"]


def test_ticks(spark):
    lines = [("0 50 100", 40, 90, 90, 95), ("-10", 2, 90, 6, 95), ("10³", 2, 10, 8, 14), ("102", 2, 30, 8, 34), ("101", 2, 50, 8, 54), ("0", 2, 60, 8, 64), ("text", 50, 50, 60, 55), ("", 0, 0, 1, 1)]
    df = spark.createDataFrame([(1, *map(lambda v: float(v) if not isinstance(v, str) else v, r), 100.0, 100.0) for r in lines], "f int, text string, x1 double, y1 double, x2 double, y2 double, width double, height double")
    got = sorted((r.axis, r.value, r.pixel) for r in ticks.numeric_ticks(df, ["f"]).collect())
    assert got == [("x", -10.0, 4.0), ("x", 0.0, 40.0), ("x", 50.0, 65.0), ("x", 100.0, 90.0), ("y", 10.0, 52.0), ("y", 100.0, 32.0), ("y", 1000.0, 12.0)]
    z = spark.createDataFrame([(1, 0.0), (1, 1.0), (1, 10.0), (2, 0.0), (2, 1.0), (2, 5.0)], "f int, value double")
    assert sorted((r.f, r.value) for r in ticks.drop_stray_zero(z, ["f"]).collect()) == [(1, 1.0), (1, 10.0), (2, 0.0), (2, 1.0), (2, 5.0)]


def test_ticks_on_the_borders_of_zones(spark):
    rows = [(1, "7", 480.0, 295.0), (1, "8", 480.0, 294.0), (1, "9", 680.0, 495.0), (1, "11", 681.0, 495.0)]
    df = spark.createDataFrame([(f, t, x, y, x + 40, y + 10, 1000.0, 1000.0) for f, t, x, y in rows], "f int, text string, x1 double, y1 double, x2 double, y2 double, width double, height double")
    assert sorted((r.axis, r.value) for r in ticks.dual_side_ticks(df, ["f"]).collect()) == [("x", 8.0), ("y", 11.0)]


def test_naming(spark):
    pts = spark.createDataFrame([("f", c, float(x), float(10 + 20 * c)) for c in (0, 1) for x in range(0, 100, 10)], "f string, curve int, px double, py double")
    lab = lambda *rows: spark.createDataFrame([("f", i, t, x, y) for i, (t, x, y) in enumerate(rows)], "f string, label int, text string, lx double, ly double")
    run = lambda kind, *rows: {r.curve: r.curve_name for r in naming.by_labels(lab(*rows), pts, ["f"], kind).collect()}
    assert run("rdson_vs_tj", ("max", 50.0, 12.0)) == {0: "rdson_max", 1: "rdson_typ"}
    assert run("rdson_vs_tj", ("max", 50.0, 12.0), ("98 %", 50.0, 31.0)) == {}
    assert run("vgsth_vs_tj", ("max", 50.0, 12.0)) == {}
    assert run("vgsth_vs_tj", ("max", 50.0, 12.0), ("typ", 50.0, 29.0)) == {0: "vgsth_max", 1: "vgsth_typ"}
    assert run("vgsth_vs_tj", ("max", 50.0, 20.0), ("typ", 50.0, 29.0)) == {}
    assert run("vgsth_vs_tj", ("ID = 250 uA", 50.0, 12.0), ("ID = 1mA", 50.0, 29.0)) == {0: "vgsth_id_250uA", 1: "vgsth_id_1000uA"}
    assert run("if_vs_vsd", ("TJ = 25 C", 5.0, 12.0), ("150°C", 5.0, 29.0)) == {0: "if_tj_25c", 1: "if_tj_150c"}
    assert run("if_vs_vsd", ("TJ = 25 C", 5.0, 12.0), ("150°C, 98%", 5.0, 29.0)) == {}
    count = lambda kind, *rows: [r.expected for r in naming.expected_count(lab(*rows), ["f"], kind).collect()]
    assert count("vgsth_vs_tj", ("max", 0.0, 0.0), ("min", 0.0, 0.0)) == [2] and count("vgsth_vs_tj", ("max", 0.0, 0.0), ("ID=1mA", 0.0, 0.0)) == [None] and count("vgsth_vs_tj", ("max", 0.0, 0.0), ("98%", 0.0, 0.0)) == [None]
    c = spark.createDataFrame([(1, 0, 5.0), (1, 1, 2.0), (1, 2, 5.0), (2, 0, 1.0)], "f int, curve int, y double")
    assert {(r.f, r.curve): r.curve_name for r in splits.name_by_position(c, ["f"], "y", "curve", naming.CAPACITANCE).collect()} == {(1, 1): "Ciss", (1, 0): "Coss", (1, 2): "Crss", (2, 0): None}


def test_extraction_gates(spark):
    item = lambda s, o, y: (s, o, [o * 100 + i for i in range(5)], y, 0.0, 10.0)
    cal = (None, 1.0, 0.0, 2.0, 0.0, False, False)
    pts = lambda *o: [(i, [(4.0, 1.0), (6.0, 2.0)]) for i in o]
    rows = [
        ("ok", [item(0.9, 0, 50.0), item(0.8, 1, 10.0)], pts(0, 1), cal), ("few", [item(0.9, 0, 1.0)], pts(0), cal), ("dup", [item(0.9, 0, 50.0), item(0.8, 1, 10.0), item(0.7, 2, 11.0)], pts(0, 1, 2), cal),
        ("many", [item(0.9, 0, 50.0), item(0.8, 1, 10.0), item(0.7, 2, 90.0)], pts(0, 1, 2), cal), ("empty", [item(0.9, 0, 50.0), item(0.8, 1, 10.0)], pts(0), cal), ("flat", [item(0.9, 0, 50.0), item(0.8, 1, 10.0)], pts(0, 1), (None, 0.0, 0.0, 2.0, 0.0, False, False)),
    ]
    schema = "device string, items array<struct<score:double,ord:bigint,cells:array<bigint>,mean_y:double,x1:double,x2:double>>, points array<struct<ord:bigint,pts:array<struct<row:double,col:double>>>>, calibration struct<plot_bbox:struct<left:double,right:double,top:double,bottom:double>,x_slope:double,x_intercept:double,y_slope:double,y_intercept:double,x_log:boolean,y_log:boolean>"
    df = spark.createDataFrame(rows, schema).withColumns({"curve_type": F.lit("capacitance_vs_vds"), "source_image": F.lit("f.png")})
    got = {r.device: r for r in extract.process(df, ["a", "b"], F.lit("pF")).collect()}
    assert {d: r.review_reason for d, r in got.items()} == {"ok": None, "few": "too few curves", "dup": None, "many": "too many curves", "empty": "empty curve", "flat": "no calibration"}
    assert [(c.curve_name, c.confidence, [(p.x, p.y) for p in c.points]) for c in got["ok"].curves] == [("a", 0.8, [(1.0, 2.0), (2.0, 3.0)]), ("b", 0.9, [(1.0, 2.0), (2.0, 3.0)])]
    assert got["dup"].duplicates_removed == 1 and got["few"].units is None and got["few"].curves[0].curve_name == "unnamed_0"
    assert {r.review_reason for r in extract.process(df.where("device = 'ok'"), ["a", "b"]).collect()} == {"units_undetected"}


def test_validators(spark):
    ok = ("D", "capacitance_vs_vds", "f.png", "ok", None, 0, (None, 1.0, 0.0, 1.0, 0.0, False, False), "pF", [("Ciss", 0.5, [(1.0, 2.0)]), ("Coss", 1.0, [(1.0, 2.0)]), ("Crss", 0.0, [(1.0, 2.0)])])
    alter = lambda **k: tuple(k.get(n, v) for n, v in zip(("device", "curve_type", "image", "status", "reason", "dup", "cal", "units", "curves"), ok))
    cases = [
        (ok, None), (alter(device=" "), "device missing"), (alter(status="odd"), "unknown status"), (alter(status="needs_review"), "needs_review without a reason"), (alter(reason="x"), "ok with a review reason"), (alter(dup=-1), "duplicates_removed invalid"),
        (alter(curves=None), "curves missing"), (alter(curves=[("a", 0.1, []), ("a", 0.1, [])]), "duplicate curve names"), (alter(curves=[("a", 1.5, [])]), "confidence outside [0, 1]"), (alter(curves=[("a", float("nan"), [])]), "confidence outside [0, 1]"),
        (alter(curves=[("a", 0.5, [(float("inf"), 1.0)])]), "point not finite"), (alter(cal=None), "ok without calibration"), (alter(cal=(None, None, 0.0, 1.0, 0.0, False, False)), "calibration incomplete"),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, " + documents.RESULT)
    assert [r[0] for r in df.orderBy("i").select(validate.result_violation()).collect()] == [w for _, w in cases]
    f = df.where("i IN (0, 7)").orderBy("i").select(validate.final_violation(F.col("curve_type"), F.transform("curves", lambda c: c["curve_name"]), F.col("units"), F.col("calibration").isNotNull()))
    assert [r[0] for r in f.collect()] == [None, "missing: Ciss, Coss, Crss"]
    img = spark.createDataFrame([(1, 10, 10), (1, 10, 10)], "id int, width int, height int")
    ann = spark.createDataFrame([(1, 1, 1, [[0.0] * 6], 2.0, [0.0, 0.0, 1.0, 1.0], {"curve_name": "a"}), (2, 9, 2, [[0.0]], 0.0, [50.0, 0.0, 1.0, 1.0], {})], "id int, image_id int, category_id int, segmentation array<array<double>>, area double, bbox array<double>, attributes map<string,string>")
    got = sorted((r.kind, r.id) for r in validate.coco_violations(img, ann, spark.createDataFrame([(1, "c")], "id int, name string")).collect())
    assert got == [("area", 2), ("category missing", 2), ("curve_name", 2), ("image id", 1), ("image missing", 2), ("ring", 2)]


def test_splits(spark):
    sizes = {"BSC-BSZ": 60, "A": 12, "B": 11, "C": 10, "D": 9, "E": 8, "F": 7}
    out = splits.group_split(sizes)
    assert out == splits.group_split(dict(reversed(sizes.items()))) and out["BSC-BSZ"] == "train" and set(out.values()) == set(splits.SIDES)
    with pytest.raises(ValueError):
        splits.group_split({"A": 1, "B": 2})
    with pytest.raises(ValueError):
        splits.group_split({"A": 100, "B": 2, "C": 2})
    s = spark.createDataFrame([("A", 5), ("B", 2), ("C", 9), ("D", 2)], "f string, n int")
    side = lambda **k: sorted(r.f for r in splits.smallest_first(s, "f", "n", **k).where("side = 'val'").collect())
    assert side(count=2) == ["B", "D"] and side(target=8) == ["A", "B", "D"] and side(target=0) == []
    files = spark.createDataFrame([(n,) for n in ("latest.pth", "iter_9.pth", "iter_10.pth", "best_x_iter_3.pth", "notes.txt")], "name string")
    assert {r.name: r.action for r in splits.retention(files).collect()} == {"latest.pth": "keep", "iter_9.pth": "delete", "iter_10.pth": "keep", "best_x_iter_3.pth": "keep"}
    c = spark.createDataFrame([(1, [100.0, 300.0, 305.0, 390.0])], "g int, c array<double>")
    assert c.select(splits.centre_out(F.col("c"), F.lit(600.0), 150.0)).first()[0] == [300.0]


def test_review_and_batch(spark, tmp_path):
    st = spark.createDataFrame([("d::c", "approve", "2024-01-01"), ("e::c", "reject", "2024-01-01")], "key string, decision string, decided_at string")
    assert {r.key: r.decision for r in review.upsert(st, spark.createDataFrame([("d::c", "reject", "2024-01-02"), ("e::c", "approve", "2023-01-01")], st.schema)).collect()} == {"d::c": "reject", "e::c": "reject"}
    cal = (None, 1.0, 0.0, 1.0, 0.0, False, False)
    curves = [(n, 0.9, [(1.0, 2.0)]) for n in ("Ciss", "Coss", "Crss")]
    dev = [(d, "capacitance_vs_vds") for d in ("fin", "rej", "pen", "rev", "noc", "nor", "bad")]
    res = [(d, "capacitance_vs_vds", "f", "needs_review" if d == "rev" else "ok", "why" if d == "rev" else None, 0, cal, None if d == "bad" else "pF", curves) for d in ("fin", "rej", "pen", "rev", "bad")]
    out = batch.run(
        spark.createDataFrame(dev, "device string, curve_type string"), spark.createDataFrame([(d, t, "no_match" if d == "noc" else "matched", None) for d, t in dev], "device string, curve_type string, status string, reason string"),
        spark.createDataFrame(res, documents.RESULT), spark.createDataFrame([(f"{d}::capacitance_vs_vds", x, "1") for d, x in (("fin", "approve"), ("rej", "reject"), ("bad", "approve"))], "key string, decision string, decided_at string"),
    )
    assert {r.device: (r.status, r.reason) for r in out.collect()} == {"fin": ("finalized", None), "rej": ("rejected", None), "pen": ("pending_review", None), "rev": ("needs_review", "why"), "noc": ("failed_classification", "no figure"), "nor": ("failed_extraction", "no result"), "bad": ("needs_review", "no units")}
    batch.write(out, f"file://{tmp_path}/b")
    assert {r.status: r.n for r in spark.read.json(f"file://{tmp_path}/b/batch_summary").collect()} == {"finalized": 1, "rejected": 1, "pending_review": 1, "needs_review": 2, "failed_classification": 1, "failed_extraction": 1}
    assert spark.read.json(f"file://{tmp_path}/b/followup_queue").count() == 5
    with pytest.raises(ValueError):
        documents.write_results(spark.createDataFrame([(None, "c", "f", "ok", None, 0, cal, "pF", curves)], documents.RESULT), f"file://{tmp_path}/r")
    documents.write_results(spark.createDataFrame(res, documents.RESULT), f"file://{tmp_path}/r")
    b = spark.createDataFrame([("ok", 0.7), ("ok", 0.69), ("ok", None), ("needs_review", 1.0)], "s string, c double")
    assert [r[0] for r in b.select(review.bucket(F.col("s"), F.col("c"))).collect()] == ["confident", "low_confidence", "low_confidence", "needs_review"]


def test_figures(spark):
    doc = spark.createDataFrame([(1, [([(" A ", [1.9, 2.0, 3.0, 2.0, 3.0, 4.0, 1.9, 4.0]), ("  ", None)],), ([("B", [1.0])],)])], "d int, pages array<struct<lines:array<struct<text:string,boundingBox:array<double>>>>>")
    assert [(r.text, tuple(r.box)) for r in figures.ocr_lines(doc, ["d"]).orderBy("pos").collect()] == [("A", (1, 2, 3, 4)), ("B", (0, 0, 0, 0))]
    box = spark.createDataFrame([([1.0, 1.0, 2.0, 1.0, 2.0, 3.0, 1.0, 3.0],), ([1.0],)], "p array<double>").select(figures.region_box(F.col("p"), F.lit(405), F.lit(5000))).collect()
    assert tuple(box[0][0]) == (190, 190, 405, 610) and box[1][0] is None
    reg = spark.createDataFrame([(1, 0, 0, 0, 10, 10), (1, 1, 10, 0, 20, 10)], "f int, region int, x1 int, y1 int, x2 int, y2 int")
    lines = spark.createDataFrame([(1, "edge", 9, 1, 11, 3), (1, "right", 12, 1, 14, 3)], "f int, text string, x1 int, y1 int, x2 int, y2 int")
    assert sorted((r.text, r.region, r.x1) for r in figures.assign_lines(reg, lines, ["f"]).collect()) == [("edge", 0, 9), ("edge", 1, 0), ("right", 1, 2)]
    cell = lambda t, r, c, s: (1, t, r, c, s)
    tab = [cell(0, 0, 0, "Parameter"), cell(0, 0, 1, "Symbol"), cell(0, 0, 2, "Typ."), cell(0, 0, 3, "Max."), cell(0, 0, 4, "Unit"), cell(0, 1, 0, "Junction to ambient"), cell(0, 1, 1, "RthJA"), cell(0, 1, 3, "62"), cell(0, 1, 4, "K/W"), cell(0, 2, 0, "Junction to case"), cell(0, 2, 1, "RthJC"), cell(0, 2, 2, "0,4"), cell(0, 2, 3, "0,6"), cell(0, 2, 4, "°C/W")]
    got = figures.thermal_rows(spark.createDataFrame(tab, "d int, tbl int, row int, col int, text string"), ["d"]).collect()
    assert [(r.typ, r["max"], r.rth, r.rth_source) for r in got] == [(0.4, 0.6, 0.6, "max")]
    u = spark.createDataFrame([(1, "C [pF]", 1.0, 3.0, 100.0), (1, "nF", 80.0, 90.0, 100.0), (2, "pF", 1.0, 2.0, 100.0), (2, "nF", 1.0, 2.0, 100.0), (3, "x", 1.0, 2.0, 100.0)], "f int, text string, x1 double, x2 double, width double")
    assert {r.f: r.unit for r in figures.single_unit(u, ["f"], {"pF": "pF", "nF": "nF"}).collect()} == {1: "pF", 2: None, 3: None}


def test_metrics(spark):
    t = spark.createDataFrame([("i", "a", [1, 2, 3, 4]), ("i", "b", [9]), ("j", "a", [1])], "image string, curve string, cells array<int>")
    p = spark.createDataFrame([("i", 0.9, [1, 2]), ("i", 0.4, [9]), ("k", 0.9, [1])], "image string, score double, cells array<int>")
    assert {r.curve: (r.matched, r.total) for r in metrics.detection_recall(t, p, "image", "curve").collect()} == {"a": (1, 2), "b": (0, 1)}
    d = metrics.dedup_summary(spark.createDataFrame([("a", 2, 3, 2), ("b", 2, 2, 1), ("c", 1, 1, 1)], "image string, gt_count int, raw_count int, dedup_count int")).first()
    assert (d.images, d.raw_exact, d.dedup_exact, d.removed, d.worse, d.better) == (3, 2, 2, 2, ["b"], ["a"])
    ap = metrics.average_precision(spark.createDataFrame([(1, 0.9, True), (2, 0.8, False), (3, 0.7, True)], "ord int, score double, hit boolean"), 2).first().ap
    assert math.isclose(ap, (51 * 1.0 + 50 * 2 / 3) / 101)


def test_streams_agree_with_batches(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e.repartition(4).write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = streaming.latest_decisions(s, "user_id", ["ts", "event_id"], ["event_type"]).writeStream.outputMode("complete").format("memory").queryName("latest").start()
    q.processAllAvailable()
    q.stop()
    want = {(r.user_id, r.event_id) for r in review.latest(e, ["user_id"], [F.desc("ts"), F.desc("event_id")]).collect()}
    assert {(r.user_id, r.event_id) for r in spark.table("latest").collect()} == want
    q = streaming.write_once(s, f"{tmp_path}/out", f"{tmp_path}/ck").start()
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == e.count()
    q = streaming.status_counts(s, late="10000 days").writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT sum(n) FROM counts").first()[0] == e.count()


def test_annotation_tables(spark, tmp_path):
    from chartsift.sources import annotations

    shapes = "array<struct<type:string,points:array<double>,curve_name:string>>"
    img = spark.createDataFrame([(3, "a.png", 10, 10, [("polygon", [0.0, 0.0, 4.0, 0.0, 4.0, 2.0], "Ciss"), ("polygon", [1.0, 1.0, 2.0, 1.0, 2.0, 2.0], "Coss")]), (5, "b.png", 9, 9, [])], f"id int, name string, width int, height int, shapes {shapes}")
    images, ann, cats = annotations.to_coco(img)
    assert [(r.id, r.image_id, r.area, r.bbox, r.attributes["curve_name"]) for r in ann.collect()] == [(1, 3, 4.0, [0.0, 0.0, 4.0, 2.0], "Ciss"), (2, 3, 0.5, [1.0, 1.0, 1.0, 1.0], "Coss")]
    assert images.count() == 2 and annotations.to_coco(img, keep_empty=False)[0].count() == 1 and validate.coco_violations(images, ann, cats).count() == 0
    merged, twice = annotations.merge([img, img])
    assert [r.id for r in merged.orderBy("id").collect()] == [1, 2] and [r.name for r in twice.collect()] == ["a.png"]
    annotations.write_xml(img, f"file://{tmp_path}/x")
    back = documents.read_annotations(spark, f"file://{tmp_path}/x").orderBy("id").collect()
    assert [(r.id, [(s.curve_name, s.points) for s in r.shapes]) for r in back] == [(3, [("Ciss", [0.0, 0.0, 4.0, 0.0, 4.0, 2.0]), ("Coss", [1.0, 1.0, 2.0, 1.0, 2.0, 2.0])]), (5, [])]


def test_command_line(spark, tmp_path):
    from chartsift.__main__ import main

    (tmp_path / "p.csv").write_text("Part Number,Price\nA1,$2\n,\n")
    assert main(["ingest", f"file://{tmp_path}/p.csv", "IGBT", f"file://{tmp_path}/o"]) == 0
    assert spark.read.parquet(f"{tmp_path}/o/devices").first().Cost == 2.0 and spark.read.parquet(f"{tmp_path}/o/skipped").count() == 1
    (tmp_path / "n.txt").write_text("A1__x.png\n")
    assert main(["split", f"file://{tmp_path}/n.txt", f"file://{tmp_path}/s"]) == 1


def plain_cuts(white, length, least):
    """The rule of ``composites.white_cuts`` as a loop over one axis."""
    bands, i = [], 0
    while i < length:
        j = i
        while j < length and white[j] >= 0.995:
            j += 1
        if j > i:
            if bands and i - bands[-1][1] < 30:
                bands[-1][1] = j
            else:
                bands.append([i, j])
        i = max(j, i + 1)
    margin = int(length * 0.12)
    places = [a + (b - a) // 3 for a, b in bands if b - a >= 5]
    out = []
    for c in sorted((c for c in places if margin <= c <= length - margin), key=lambda c: (abs(c - length / 2), c)):
        edges = [0, *sorted([*out, c]), length]
        if len(out) < min(length // least - 1, 3) and all(b - a >= least for a, b in zip(edges, edges[1:])):
            out.append(c)
    return sorted(out) if length >= 2 * least else []


def test_white_cuts_are_those_of_a_loop(spark):
    draw = random.Random(5)
    rows, want, sizes = [], {}, []
    for f in range(40):
        w, h = draw.randrange(150, 1300), draw.randrange(120, 700)
        sizes.append((f, float(w), float(h)))
        for axis, length, least in (("x", w, 200), ("y", h, 150)):
            white = [0.5] * length
            for _ in range(draw.randrange(0, 9)):
                a = draw.randrange(length)
                for i in range(a, min(length, a + draw.randrange(1, 40))):
                    white[i] = draw.choice((1.0, 1.0, 1.0, 1.0, 0.995))
            rows += [(f, axis, i, v) for i, v in enumerate(white)]
            cut = plain_cuts(white, length, least)
            if cut:
                want[f, axis] = cut
    profile = spark.createDataFrame(rows, "f int, axis string, i int, white double")
    got = composites.white_cuts(profile, spark.createDataFrame(sizes, "f int, width double, height double"), ["f"]).collect()
    assert {(r.f, r.axis): list(r.cuts) for r in got} == want and len(want) > 10


def test_composites_split_by_titles_or_are_suspect(spark):
    fig = [("d", 0, 900.0, 300.0, None, False, False), ("d", 1, 900.0, 300.0, "Pair", False, False), ("d", 2, 300.0, 300.0, "One", None, None), ("d", 3, 900.0, 300.0, "Box", True, False), ("d", 4, 0.0, 300.0, "Typical Characteristics", False, False)]
    f = spark.createDataFrame(fig, "d string, n int, width double, height double, caption string, package_outline boolean, parted boolean")
    line = [("d", 0, 0, "Fig. 7 left", 100, 10, 200, 20), ("d", 0, 1, "VDS (V)", 150, 280, 250, 290), ("d", 0, 2, "Gate charge (nC)", 650, 280, 750, 290), ("d", 1, 0, "nothing", 0, 0, 9, 9), ("d", 2, 0, "x", 0, 0, 9, 9), ("d", 3, 0, "x", 0, 0, 9, 9), ("d", 4, 0, "x", 0, 0, 9, 9)]
    lines = spark.createDataFrame(line, "d string, n int, pos int, text string, x1 int, y1 int, x2 int, y2 int")
    profile = spark.createDataFrame([("d", n, "x", i, 0.6 if n == 0 else 0.2) for n in (0, 1) for i in range(900)], "d string, n int, axis string, i int, white double")
    got = [tuple(r) for r in composites.split(f, lines, profile, ["d"], "n").orderBy("n").select("n", "source_index", "region", "caption", "x1", "x2", "ocr_text", "suspect").collect()]
    assert got == [
        (0, 0, 0, "Fig. 7 left", 0, 450, ["Fig. 7 left", "VDS (V)"], False), (1, 0, 1, "Unknown (sub 2)", 450, 900, ["Gate charge (nC)"], False), (2, 1, None, "Pair", 0, 900, ["nothing"], True),
        (3, 2, None, "One", 0, 300, ["x"], False), (4, 3, None, "Box", 0, 900, ["x"], False), (5, 4, None, "Typical Characteristics", 0, 0, ["x"], False),
    ]
    assert composites.split(f.limit(0), lines.limit(0), profile.limit(0), ["d"], "n").count() == 0


def test_batches_add_to_train_and_val_and_leave_test(spark, tmp_path):
    img = lambda *r: spark.createDataFrame(list(r), "id int, file string")
    note = lambda *r: spark.createDataFrame(list(r), "id int, image_id int, label string")
    sides = {"train": (img((5, "a"), (9, "b")), note((1, 9, "b1"), (2, 5, "a1"))), "val": (img((5, "v")), note((3, 77, "lost"))), "test": (img((1, "t")), note((1, 1, "t1")))}
    new = spark.createDataFrame([(5, "n1", "F"), (6, "n2", "F"), (7, "n3", "G")], "id int, file string, family string")
    out = splits.merge_batch(sides, new, note((1, 5, "n1a"), (2, 7, "n3a"), (3, 50, "lost")), count=1)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(out["train"][0]) == [(1, "a"), (2, "b"), (3, "n1"), (4, "n2")] and rows(out["train"][1]) == [(1, 2, "b1"), (2, 1, "a1"), (3, 3, "n1a")]
    assert rows(out["val"][0]) == [(1, "v"), (2, "n3")] and rows(out["val"][1]) == [(1, 2, "n3a")]
    manifest = splits.write_sides(out, f"file://{tmp_path}/s")
    assert {(r.side, r.kind): r.n for r in manifest.collect()}["test", "annotations"] == 1 and splits.digest(img((1, "t"))) == splits.digest(spark.read.parquet(f"file://{tmp_path}/s/test/images"))
    assert splits.digest(img((1, "t"))) != splits.digest(img((1, "u"))) and splits.digest(img((1, "t"))) != splits.digest(img((1, "t"), (1, "t"), (1, "t")))


def test_review_state_is_saved_whole_and_loaded_tolerantly(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    state = spark.createDataFrame([("b::c", "reject", "2"), ("a::c", "approve", "1")], review.STATE)
    review.save_state(state, path)
    assert sorted(tuple(r) for r in review.load_state(spark, path).collect()) == [("a::c", "approve", "1"), ("b::c", "reject", "2")]
    for bad in ([("a", "approve", "1")], [("a::c", "perhaps", "1")], [("a::c", "reject", "1"), ("a::c", "approve", "1")], [(None, "reject", "1")]):
        with pytest.raises(ValueError):
            review.save_state(spark.createDataFrame(bad, review.STATE), path)
    assert review.load_state(spark, path).count() == 2 and review.load_state(spark, f"{path}_none").count() == 0
    for i, text in enumerate(("{", "[1]", '{"a::b": 3}', '{"a": {"decision": "approve"}}', '{"a::b": {"decision": "x"}}', "")):
        (tmp_path / f"f{i}").write_text(text)
        assert review.load_state(spark, f"file://{tmp_path}/f{i}").count() == 0


def test_routes_gates_and_twins(spark):
    assert column(spark, lambda c: curve_types.route(c)["reason"], ["id_vs_vgs", "vgs_vs_qg", "zth_vs_time", None]) == [None, "no extractor", "unregistered", "unregistered"]
    with pytest.raises(KeyError, match="rdson_vs_tj"):
        curve_types.extraction_spec("zth_vs_time")
    assert curve_types.extraction_spec("rdson_vs_tj") == ("classical", 0.5, (1, 2))
    assert column(spark, extract.clamp_confidence, [1.5, -2.0, 0.25, None], "double") == [1.0, 0.0, 0.25, 0.0]
    assert column(spark, lambda c: validate.implausible_rdson(c, F.lit(0.01), F.lit(3.0)), ["normalized", "mOhm", "Ohm", "V", None]) == ["implausible on-resistance in normalized", "implausible on-resistance in mOhm", None, None, None]
    pixels = spark.createDataFrame([(f, x, y) for f, n in ((1, 18), (2, 19)) for x in range(3) for y in range(n)], "f int, x int, y int")
    assert {r.f: r.merged for r in validate.merged_lines(pixels, ["f"]).collect()} == {1: False, 2: True}
    items = "array<struct<score:double,ord:bigint,cells:array<bigint>,mean_y:double,x1:double,x2:double>>"
    d = spark.createDataFrame([(t, [(0.9, 1, [1, 2, 3], 0.0, 0.0, 9.0), (0.8, 2, [1, 2], 0.0, 0.0, 9.0), (0.7, 3, [8], 0.0, 0.0, 9.0)]) for t in ("zth_vs_time", "id_vs_vgs", None)], f"t string, items {items}")
    assert [(r.x.removed, len(r.x["items"])) for r in d.select(extract.without_twins(F.col("t"), F.col("items")).alias("x")).collect()] == [(1, 2), (0, 3), (0, 3)]


def test_consensus_deals_groups_by_their_triples(spark):
    p = spark.createDataFrame([(g, i, float(i), 3.0 * i + (200.0 if i == g % 7 else 0.0)) for g in range(60) for i in range(7)], "g int, i int, x double, y double")
    tasks = [n for n in fit.dealt(p, ["g"], 70).rdd.mapPartitions(lambda rows: [len({r.g for r in rows})]).collect()]
    assert len(tasks) == 30 and sum(tasks) == 60 and max(tasks) <= 10
    assert fit.dealt(p.limit(0), ["g"], 70).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = [sorted(tuple(r) for r in fit.ransac_sql(p, ["g"], n).collect()) for n in (70, 10**9)]
    assert found[0] == found[1] and [(r[0], r[4]) for r in found[0]] == [(g, 6) for g in range(60)]


def test_scores_are_summed_in_tasks_of_so_many_lines(spark):
    made = spark.createDataFrame(curve_types.rule_rows(), curve_types.RULE)
    lines = spark.range(0, 3000, 1, 1).select("id", F.lit("caption").alias("source"), F.lit(None).cast("string").alias("zone"), F.when(F.col("id") % 2 == 0, "Typical Capacitance").otherwise("Transfer Characteristics").alias("text"))
    df = rules.score(lines, made, ["id"], each=100)
    above, below = df._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")
    assert df.rdd.getNumPartitions() == 30 and above.count("Exchange") == 1 and "Aggregate" in above and "Aggregate" not in below
    rows = sorted(map(tuple, df.collect()))
    assert len(rows) == 3000 and rows == sorted(map(tuple, rules.score(lines, made, ["id"]).collect()))


def test_numbers_are_given_range_by_range(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, *range(40)]), draw.choice("abc"), i) for i in range(500)]
    parts = [spark.createDataFrame(rows[:200], "a int, b string, c int"), spark.createDataFrame(rows[200:], "a int, b string, c int")]
    df = splits.renumber(parts, ["a", "b", "c"], each=10)
    want = sorted([(0, *r) for r in rows[:200]] + [(1, *r) for r in rows[200:]], key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3]))
    assert [(r.part, r.a, r.b, r.c) for r in sorted(df.collect(), key=lambda r: r.new_id)] == want and sorted(r.new_id for r in df.collect()) == list(range(1, 501))
    assert max(df.select("new_id").rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()) < 100
    assert all(r.new_id == i + 1 for i, r in enumerate(splits.renumber(parts, ["c"]).orderBy("part", "c").collect()))


def test_batches_are_merged_range_by_range_with_equal_numbers(spark):
    img = lambda ids: spark.createDataFrame([(i, f"f{i}") for i in ids], "id int, file string")
    notes = spark.createDataFrame([(None if i % 11 == 0 else i % 37, i % 60, f"n{i % 5}") for i in range(300)], "id int, image_id int, label string")
    new = spark.createDataFrame([(i, f"f{i}", f"F{i % 4}") for i in range(40, 58)], "id int, file string, family string")
    sides = {"train": (img(range(0, 30)), notes), "val": (img(range(30, 40)), notes), "test": (img([1]), notes)}
    some, whole = (splits.merge_batch(sides, new, notes, count=2, each=n) for n in (7, 10**6))
    for side, size in (("train", 200), ("val", 90)):
        for kind in (0, 1):
            rows = sorted(map(tuple, some[side][kind].collect()))
            assert rows == sorted(map(tuple, whole[side][kind].collect())) and [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert len(rows) == size


def test_cells_are_searched_once(spark):
    """One search finds number and unit; ohms are searched by their three sizes in turn."""
    df = spark.createDataFrame([("1.2 kV",)], "c string")
    for f, n in ((parsing.voltage, 1), (parsing.rdson_mohm, 3), (parsing.capacitance, 1), (parsing.charge, 1), (parsing.price, 0)):
        assert df.select(f(F.col("c")).alias("x"))._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == n, f
    assert column(spark, parsing.voltage, ["±±3.kV", "7\tmV", "7 mmV", "8 V\n"]) == [3000.0, 0.007, 7.0, 8.0]
    assert column(spark, parsing.rdson_mohm, ["1.2.3 mOhm", "3 Ohm 2 mΩ", ". W"]) == [None, 2.0, None] and column(spark, parsing.capacitance, ["2 kF", "3 µF"]) == [None, 3e6]
