"""Hand-typed cases, one rule or one trap each."""

import itertools
import math
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from terrasheaf.functions import geo, ids, lines, text
from terrasheaf.operators import catalog, diff, graph, match, places, quality, routes, search, spatial
from terrasheaf.plans import load_all, registry
from terrasheaf.plans.places import nest
from terrasheaf.plans.registry import QUERIES
from terrasheaf.sources import readers, sinks


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


# --- text and ids ----------------------------------------------------------


@pytest.mark.parametrize(
    "raw, pack, query",
    [
        ("Café  São-Paulo 12", "cafe sao paulo 12", "cafe sao paulo 12"),
        ("A™ Bar", "atm bar", "aTM bar"),  # the two normal forms differ on compatibility letters
        ("  ", "", ""),
        ("Straße", "straße", "straße"),
    ],
)
def test_normal_forms(spark, raw, pack, query):
    df = spark.createDataFrame([(raw,)], "s string")
    got = df.select(text.normalize_text(F.col("s")), text.normalize_text(F.col("s"), "query")).first()
    assert tuple(got) == (pack, query)


def test_null_and_space_cleaning(spark):
    df = spark.createDataFrame([(None,), (" a \tb\x1cc ",)], "s string")
    assert [r[0] for r in df.select(text.clean_text(F.col("s"))).collect()] == ["", "a b c"]


def test_normalize_text_query_returns_every_document(spark, tmp_path):
    texts = ["plain Text", "Café 1", "日本 語!", "Straße Ωmega", "Привет, мир", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def fold(value):
        letters = [c for c in unicodedata.normalize("NFKD", value or "") if not unicodedata.combining(c)]
        return " ".join("".join(c.lower() if c.isalnum() else " " for c in letters).split())

    assert rows(QUERIES["normalize_text"](spark, str(tmp_path))) == [(k, fold(x)) for k, x in enumerate(texts)]


def test_edge_scan_keeps_windows_without_edges(spark):
    docs = ['{"index": 3, "complete": true, "truncated": false, "returned": 0, "edges": []}', "no json",
            '{"index": 4, "complete": true, "truncated": false, "returned": 1, "edges": [{"graphId": 9}]}']
    got = readers.parse_edge_scan(spark.createDataFrame([(d,) for d in docs], "line string"))
    assert rows(got, "window_index", "whole", "graph_id") == [(3, True, None), (4, True, 9), (None, False, None)]


def test_tokens_are_distinct_and_long_enough_and_cut_only_if_asked(spark):
    df = spark.createDataFrame([("aa b aa cc dd ee ff gg hh",)], "s string")
    assert df.select(text.query_tokens(F.col("s"), 6)).first()[0] == ["aa", "cc", "dd", "ee", "ff", "gg"]
    assert len(df.select(text.query_tokens(F.col("s"))).first()[0]) == 7


def test_dense_ids_do_not_depend_on_the_number_of_parts(spark):
    df = spark.createDataFrame([(i * 7 % 50, f"k{i}") for i in range(50)], "ord long, k string")
    wide = rows(ids.dense_ids(df, "ord", ["k"]), "id", "k")
    assert wide == rows(ids.dense_ids(df, "ord", ["k"], parts=7), "id", "k")
    assert sorted(r[0] for r in wide) == list(range(1, 51))


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_prefix_sums_against_a_plain_loop(spark, parts):
    # One group holds most rows, so that it lies in many parts; another has no key.
    data = [("big" if i % 5 else None if i % 10 else f"g{i}", (i * 37) % 101, i, (i * 7) % 11 - 3.0) for i in range(400)]
    df = spark.createDataFrame(data, "g string, a int, b int, v double")
    got = rows(ids.prefix_sums(df, ["g"], ["a", "b"], "s", F.col("v"), parts), "g", "a", "b", "s")
    want = [(g, a, b, float(sum(v for h, c, d, v in data if h == g and (c, d) < (a, b)))) for g, a, b, _ in data]
    assert got == sorted(want, key=repr)
    assert ids.prefix_sums(df.limit(0), ["g"], ["a"], "s").count() == 0


def test_fingerprint_of_nothing_is_that_of_the_empty_text(spark):
    got = spark.range(1).select(ids.fingerprint_lines(F.array().cast("array<string>"))).first()[0]
    assert got == "sha256:e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


# --- places and search -----------------------------------------------------


def feature(ord, pid, name, **kw):
    base = dict(
        ord=ord, pid=pid, name=name, freeform="Street 1", postcode="1", locality="Town", region="TOWN", country="", lon="12.5", lat="46.5",
        conf="0.5", status="open", basic="cafe", prim="coffee", hier1="food", hier2="coffee", alt1="", legacy_prim="old", legacy_alt="older",
        s1_provider="p", s1_dataset="d", s1_record="r", s1_conf="0.9", s2_provider="z", s2_record="y", s2_conf="", has_address=True, has_position=True,
    )
    return {**base, **kw}


def feed(spark, *items):
    return nest(spark.createDataFrame([tuple(i.values()) for i in items], list(items[0])))


def test_blank_country_passes_and_other_country_does_not(spark):
    f = feed(spark, feature(1, "a", "A"), feature(2, "b", "B", country="it"), feature(3, "c", "C", country="DE"), feature(4, "d", " "))
    assert rows(places.place_records(f, "IT"), "place_id") == [("a",), ("b",)]


def test_address_drops_case_insensitive_repeats(spark):
    assert rows(places.place_records(feed(spark, feature(1, "a", "A"))), "address") == [("Street 1, 1, Town",)]


def test_first_line_wins_but_its_duplicate_still_adds_dimensions(spark):
    f = feed(spark, feature(1, "a", "First"), feature(2, "a", "Second", locality="Other", basic="bar", alt1="pub"))
    r = places.place_records(f)
    accepted = places.place_dedup(r)
    assert rows(accepted, "name") == [("First",)]
    dims = places.build_dimensions(r, accepted)
    assert {x[0] for x in rows(dims["address_contexts"], "locality")} == {"Town", "Other"}
    names = {x[0] for x in rows(dims["search_categories"], "name")}
    assert "bar" in names and "pub" not in names  # alternates only of accepted rows


def test_first_seen_order_gives_the_ids(spark):
    f = feed(spark, feature(5, "a", "A", basic="x", prim="y"), feature(3, "b", "B", basic="z", prim=""))
    r = places.place_records(f)
    got = dict(rows(places.build_dimensions(r, places.place_dedup(r))["search_categories"], "name", "id"))
    assert got["z"] == 1 and got["old"] == 2 and got["x"] > got["old"]


def test_missing_id_uses_name_and_position(spark):
    assert rows(places.place_records(feed(spark, feature(1, "", "Näme X"))), "place_id") == [("name x:46.500000:12.500000",)]


PLACES = "place_id string, name_norm string, address_norm string"


def brute(queries, table):
    out = set()
    for qid, q in queries:
        toks = list(dict.fromkeys(t for t in q.split(" ") if len(t) >= 2))[:6]
        for pid, n, a in table:
            if any(t in n or t in a for t in (toks or [q])):
                out.add((qid, pid))
    return sorted(out)


WORD = st.text("abc", min_size=1, max_size=4)
PHRASE = st.lists(WORD, min_size=1, max_size=4).map(" ".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PHRASE, min_size=1, max_size=5), st.lists(st.tuples(PHRASE, PHRASE), min_size=1, max_size=8))
def test_token_candidates_equal_brute_force(spark, texts, table):
    queries = [(i, q) for i, q in enumerate(texts) if len(q) >= 2]
    if not queries:
        return
    places_rows = [(f"p{i}", n, a) for i, (n, a) in enumerate(table)]
    q = spark.createDataFrame([(i, t, "", None, None) for i, t in queries], "query_id long, text string, category string, lat double, lon double")
    got = search.token_candidates(search.prepare_queries(q), spark.createDataFrame(places_rows, PLACES))
    assert rows(got, "query_id", "place_id") == brute(queries, places_rows)


def test_half_an_origin_gives_no_answer(spark):
    q = spark.createDataFrame([(1, "abc", "", 46.0, None), (2, "abc", "", None, None)], "query_id long, text string, category string, lat double, lon double")
    assert rows(search.prepare_queries(q), "query_id") == [(2,)]


# --- geometry --------------------------------------------------------------


def test_haversine_against_python(spark):
    a = (46.1, 12.2, 46.3, 12.9)
    p = [math.radians(x) for x in a]
    h = math.sin((p[2] - p[0]) / 2) ** 2 + math.cos(p[0]) * math.cos(p[2]) * math.sin((p[3] - p[1]) / 2) ** 2
    got = spark.range(1).select(geo.haversine_m(*[F.lit(x) for x in a])).first()[0]
    assert got == pytest.approx(2 * 6371008.8 * math.asin(math.sqrt(h)), abs=1e-6)


SQUARE = [("r", 0, False, 0, 0, 10, 0), ("r", 0, False, 10, 0, 10, 10), ("r", 0, False, 10, 10, 0, 10), ("r", 0, False, 0, 10, 0, 0)]
HOLE = [("r", 1, True, 4, 4, 6, 4), ("r", 1, True, 6, 4, 6, 6), ("r", 1, True, 6, 6, 4, 6), ("r", 1, True, 4, 6, 4, 4)]


def outline(spark, scale=1.0):
    data = [(r, n, h, *[float(v) * scale for v in xy]) for r, n, h, *xy in SQUARE + HOLE]
    return spark.createDataFrame(data, "region_id string, ring_no int, is_hole boolean, ax double, ay double, ex double, ey double")


@pytest.mark.parametrize(
    "lon, lat, inside, strictly",
    [(1, 1, True, True), (5, 5, False, False), (0, 5, True, False), (4, 5, True, False), (11, 5, False, False), (10, 10, True, False), (2, 4, True, True)],
)
def test_outline_counts_as_inside_and_hole_does_not(spark, lon, lat, inside, strictly):
    p = spark.createDataFrame([(1, float(lat), float(lon))], "id long, lat double, lon double")
    got = rows(spatial.points_in_polygon(p, outline(spark)), "strictly")
    assert got == ([(strictly,)] if inside else [])


def test_metres_outside_counts_the_part_beyond_and_in_the_hole(spark):
    shape = [(5.0 * 0.001, -2.0 * 0.001), (5.0 * 0.001, 12.0 * 0.001)]  # west to east through the hole
    df = spark.createDataFrame([(1, shape)], "graph_id long, shape array<struct<lat:double,lon:double>>")
    got = spatial.metres_outside(df, outline(spark, 0.001)).first()["outside_m"]
    assert got == pytest.approx(6 * 0.001 * 111320 * math.cos(math.radians(0.005)), rel=1e-6)


def test_nearest_outline_is_exact_far_away(spark):
    far = spark.createDataFrame([(1, 30.0, 5.0, 30.0, 5.0), (2, 10.5, 5.0, 10.5, 5.0)], "k long, ax double, ay double, ex double, ey double")
    got = dict(rows(spatial.nearest_outline(far, outline(spark), "k"), "k", "outline_m"))
    k = math.cos(math.radians(5))
    assert got[1] == pytest.approx(20 * k * 111320) and got[2] == pytest.approx(0.5 * k * 111320)


def test_boundary_samples_lie_on_both_sides(spark):
    seg = outline(spark, 0.1).withColumn("seq", F.monotonically_increasing_id())
    s = spatial.boundary_samples(seg, 25000.0)
    flat = s.select("sample", "offset_m", "inside_point.lat", "inside_point.lon").withColumn("id", F.monotonically_increasing_id())
    n = flat.count()
    assert n > 20
    assert spatial.points_in_polygon(flat, outline(spark, 0.1)).count() == n


def test_boundary_samples_need_an_adjoining_area(spark):
    seg = outline(spark, 0.1).withColumn("seq", F.monotonically_increasing_id())
    whole = spatial.boundary_samples(seg, 25000.0)
    # An area to the east of the square (x from 1 to 2), and one far away.
    def box(name, x, y):
        corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
        return [(name, 0, False, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1])]

    areas = spark.createDataFrame(
        box("east", 1.0, 0.0) + box("far", 50.0, 50.0), "region_id string, ring_no int, is_hole boolean, ax double, ay double, ex double, ey double"
    )

    def kept(*pairs):
        return rows(spatial.boundary_samples(seg, 25000.0, 8500.0, areas, spark.createDataFrame(pairs, "region_id string, neighbour_id string")), "sample", "offset_m")

    every = rows(whole, "sample", "offset_m", "outside_point.lat", "outside_point.lon")
    want = sorted(((i, o) for i, o, lat, lon in every if 1 <= lon <= 2 and 0 <= lat <= 1), key=repr)
    assert 0 < len(want) < len(every)
    assert kept(("r", "east"), ("r", "far")) == want and kept(("r", "far")) == [] and len(kept(("other", "east"))) == len(every)


SHAPE = "struct<lat:double,lon:double>"


def test_projection_skips_degenerate_parts_and_keeps_first_tie(spark):
    shape = [(0.0, 0.0), (0.0, 0.0), (0.0, 0.001), (0.0, 0.002)]
    df = spark.createDataFrame([(shape,)], f"s array<{SHAPE}>").withColumn("p", lines.project_on_line(F.lit(0.0), F.lit(0.001), F.col("s"), 111195.0))
    r = df.select("p.*").first()
    assert (r["segment"], round(r["fraction"], 6)) == (1, 1.0) and r["along"] == pytest.approx(111.195)


def overlap_case(spark, **kw):
    base = dict(
        access=1025, x_lat=46.0, x_lon=12.0, app_lat=46.0, app_lon=11.9999, layer=0, bridge=False, tunnel=False, r_access=1, r_layer=0, r_bridge=False, r_tunnel=False,
        r_shape=[(46.0, 11.9998), (46.0, 12.0)],
    )
    base.update(kw)
    schema = (
        "access long, x_lat double, x_lon double, app_lat double, app_lon double, layer int, bridge boolean, tunnel boolean,"
        f"r_access long, r_layer int, r_bridge boolean, r_tunnel boolean, r_shape array<{SHAPE}>"
    )
    return match.directed_overlap(spark.createDataFrame([tuple(base.values())], schema)).first()["status"]


CM = 1 / 111320 / math.cos(math.radians(46)) / 100


@pytest.mark.parametrize(
    "change, status",
    [
        ({}, match.ENDS_AT_X),
        ({"r_shape": [(46.0, 11.9998), (46.0, 12.0005)]}, match.MATCHED),
        ({"r_shape": [(46.0, 12.0), (46.0, 11.9998)]}, "REJECTED_OPPOSITE_DIRECTED_SHAPE"),
        ({"r_access": 2}, "REJECTED_NO_SHARED_VEHICLE_MODE"),
        ({"app_lat": None}, "UNRESOLVED_SOURCE_APPROACH_MISSING"),
        ({"r_layer": 1}, "UNRESOLVED_NATIVE_LEVEL_OR_STRUCTURE_CONFLICT"),
        ({"r_shape": [(46.0001, 11.9998), (46.0001, 12.0)]}, "UNRESOLVED_NO_DIRECTED_SOURCE_OVERLAP"),
        ({"r_shape": [(46.0, 12.0), (46.0, 12.0)]}, "UNRESOLVED_B_GEOMETRY_DEGENERATE"),
        ({"app_lon": 12.0 - 60 * CM}, match.ENDS_AT_X),  # short edge with centimetre agreement
        ({"app_lon": 12.0 - 40 * CM}, "UNRESOLVED_NO_DIRECTED_SOURCE_OVERLAP"),  # too short to prove anything
    ],
)
def test_directed_overlap_verdicts(spark, change, status):
    assert overlap_case(spark, **change) == status


# --- graph -----------------------------------------------------------------


def edges(spark, *items):
    return spark.createDataFrame(items, "graph_id long, way_id long, lat double, lon double, inner_lat double, inner_lon double")


def test_every_peer_is_kept_and_nothing_is_collapsed(spark):
    a = edges(spark, (1, 5, 46.0, 12.0, 46.1, 12.1), (2, 5, 46.0, 12.0, 46.1, 12.1), (3, 6, 46.0, 12.0, 46.1, 12.1))
    b = edges(spark, (7, 5, 46.0, 12.0, 46.1, 12.1), (8, 5, 46.0, 12.0, 46.1, 12.1))
    assert rows(graph.physical_peers(a, b, "p", "f", "t"), "from_graph_id", "to_graph_id") == [(1, 7), (1, 8), (2, 7), (2, 8)]
    assert rows(graph.unpaired_edges(a, b), "side", "graph_id") == [("from", 3)]


def test_physical_key_rounds_half_to_even(spark):
    k = graph.physical_key(edges(spark, (1, 1, 0.0000025, 0.0000035, 0.0, 0.0))).first()
    assert (k["k_lat"], k["k_lon"]) == (2, 4)


ADJ = "source_id long, end_node long, way_id long, forward_access long, deadend boolean, opposing_id long, end_lat double, end_lon double, outgoing array<struct<graph_id:long,forward_access:long>>"


def test_census_keeps_the_reverse_edge_out(spark):
    adj = spark.createDataFrame(
        [
            (1, 9, 1, 1025, True, 2, 0.0, 0.0, [(2, 1025)]),
            (3, 9, 1, 1025, False, 4, 0.0, 0.0, [(4, 1025), (5, 1)]),
        ],
        ADJ,
    )
    got = rows(graph.terminal_census(adj), "graph_id", "mode", "status")
    assert got == [(1, "auto", "TERMINAL"), (1, "motorcycle", "TERMINAL"), (3, "auto", "CONTINUES"), (3, "motorcycle", "STRANDED")]


def test_predecessors_stop_at_cut_cycle_depth_and_budget(spark):
    net = spark.createDataFrame(
        [(1, 10, 11, 101), (2, 12, 10, 102), (3, 13, 12, 103), (4, 11, 12, 104), (5, 14, 10, 105)], "graph_id long, start_node long, end_node long, opposing_id long"
    )
    final = spark.createDataFrame([(1,)], "graph_id long")
    cut = spark.createDataFrame([(5,)], "graph_id long")
    got = rows(graph.predecessor_paths(final, net, cut, depth=3), "status", "depth", "edge_id")
    assert ("CROSSES_CUT", 1, 5) in got and ("CYCLE", 3, 1) in got and ("PREDECESSOR", 2, 3) in got
    few = rows(graph.predecessor_paths(final, net, cut, depth=3, budget=1), "status")
    assert ("BUDGET_EXHAUSTED",) in few


def test_terminal_modes_use_all_outgoing(spark):
    src = spark.createDataFrame([(1, 1025), (2, 1025), (3, 1)], "graph_id long, access long")
    out = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1024)], "source_id long, option_access long")
    assert rows(graph.terminal_modes(src, out), "graph_id", "terminal_modes") == [(1, 1024), (2, 0), (3, 1)]


# --- routes, catalogue, diffs ----------------------------------------------


def test_diverse_proposals_equal_the_greedy_loop(spark):
    pts = [(f"i{n:03d}", 46.0 + (n * 37 % 50) * 0.002, 12.0 + (n * 53 % 50) * 0.002) for n in range(300)]
    df = spark.createDataFrame(pts, "id string, lat double, lon double")
    a, b = (46.0, 12.0), (46.1, 12.1)

    def dist(p, q):
        p, q = [math.radians(v) for v in p], [math.radians(v) for v in q]
        h = math.sin((q[0] - p[0]) / 2) ** 2 + math.cos(p[0]) * math.cos(q[0]) * math.sin((q[1] - p[1]) / 2) ** 2
        return 2 * 6371008.8 * math.asin(math.sqrt(h))

    want, used = [], {}
    for _d, i, lat, lon in sorted((round(dist(a, (la, lo)) + dist((la, lo), b), 9), i, la, lo) for i, la, lo in pts):
        cell = (math.floor(lat / 0.015), math.floor(lon / 0.015))
        if used.get(cell, 0) < 2 and len(want) < 9:
            used[cell] = used.get(cell, 0) + 1
            want.append(i)
    assert sorted(want) == [r[0] for r in rows(routes.diverse_proposals(df, a, b, 9), "id")]


def test_diverse_proposals_look_beyond_a_dense_cell(spark):
    dense = spark.range(1000).selectExpr("concat('a', lpad(id, 4, '0')) as id", "46.001d as lat", "12.001d as lon")
    far = spark.createDataFrame([("b1", 46.2, 12.2), ("b2", 46.3, 12.3), ("b3", 46.4, 12.4)], "id string, lat double, lon double")
    got = routes.diverse_proposals(dense.union(far), (46.0, 12.0), (46.0, 12.0), 4)
    assert rows(got, "id") == [("a0000",), ("a0001",), ("b1",), ("b2",)]


def test_layer_coverage_query_returns_border_ways(spark, monkeypatch):
    load_all()
    # An outline along latitude 46; ways 1 and 2 lie on it, way 3 far off, way 4 far off but of a major class,
    # way 5 on it but of a class that is no road, like a footpath.
    ways_ = [
        (1, "SMALL", 46.0, 46.0), (2, "PROMO", 46.0, 46.0), (3, "SMALL", 46.5, 46.5), (4, "ECONOMY", 46.5, 46.5), (5, "LARGE", 46.0, 46.0), (9, "SMALL", 46.0004, 46.0004),
    ]
    made = {
        "v_way_a": spark.createDataFrame([(i, c, la0, 12.01, la1, 12.02) for i, c, la0, la1 in ways_], "way_id long, road_class string, la0 double, lo0 double, la1 double, lo1 double"),
        "v_poly": spark.createDataFrame([("ra", 12.0, 46.0, 12.1, 46.0)], "region_id string, ax double, ay double, ex double, ey double"),
    }
    monkeypatch.setattr(registry.Tables, "__call__", lambda self, name: made[name])
    monkeypatch.setattr(registry.Tables, "sql", lambda self, body: pytest.fail(body))
    got = rows(QUERIES["layer_coverage"](spark, "none"), "way_id", "categories", "present")
    assert got == [(1, "BORDER", True), (2, "BORDER,MAJOR", True), (4, "MAJOR", True), (9, "BORDER", False)]


def test_footpaths_are_no_required_roads(spark):
    features = spark.createDataFrame(
        [(1, "footway"), (2, "residential"), (3, "motorway"), (4, None), (None, "motorway"), (5, "cycleway"), (5, "service")], "way_id long, highway string"
    )
    near = spark.createDataFrame([(1,), (2,), (4,), (5,)], "way_id long")
    got = diff.required_roads(features, ["motorway"], near).select("way_id", "highway", F.array_join("categories", ",").alias("c"))
    assert rows(got, "way_id", "highway", "c") == [(2, "residential", "BORDER"), (3, "motorway", "MAJOR"), (5, "service", "BORDER")]


def test_cover_keeps_only_sources_with_new_cells(spark):
    cells = [("r", "own", 9, True, 0, x) for x in range(3)] + [("r", "leaf", 1, False, 0, x) for x in (2, 3, 4)] + [("r", "giant", 5, False, 0, x) for x in range(5)]
    df = spark.createDataFrame(cells, "region_id string, source_id string, size_order int, is_primary boolean, cy long, cx long")
    assert rows(catalog.source_cover(df), "source_id", "selected") == [("giant", False), ("leaf", True), ("own", True)]


def test_ancestry_stops_at_cycles_and_drops_containers(spark):
    df = spark.createDataFrame(
        [("europe", "", None), ("italy", "europe", "it"), ("nord", "italy", None), ("a", "b", None), ("b", "a", None), ("x", "gone", None)], "id string, parent string, iso string"
    )
    got = {r[0]: tuple(r[1:]) for r in rows(catalog.region_ancestry(df), "id", "canonical_id", "country_id", "country_iso")}
    assert got["nord"] == ("italy/nord", "italy", "IT") and got["a"][0] == "b/a" and got["x"][0] == "gone/x" and got["europe"][0] == "europe"


def test_way_diff_ignores_drawing_direction(spark):
    a = [(1, "p", [(46.0, 12.0), (46.1, 12.1)]), (2, "p", [(46.0, 12.0), (46.2, 12.1)])]
    b = [(1, "p", [(46.1, 12.1), (46.0, 12.0)]), (2, "q", [(46.0, 12.0), (46.2, 12.1)]), (3, "p", [(1.0, 1.0), (2.0, 2.0)])]
    sig = lambda d: diff.way_signatures(spark.createDataFrame(d, f"way_id long, klass string, shape array<{SHAPE}>"), ["klass"])
    assert rows(diff.diff_ways(sig(a), sig(b))) == [(1, "unchanged"), (2, "changed"), (3, "added")]


# --- one broken rule at a time ---------------------------------------------

GRAPH_PACK = dict(file_name="g.tar", size_bytes=10, sha256="a" * 64, tile_count=1, graph_fp="sha256:" + "a" * 64, buffer_km=25.0, actual_size=10, actual_sha256="a" * 64)


@pytest.mark.parametrize(
    "change, code",
    [
        ({}, None),
        ({"file_name": "g.zip"}, "file_name"),
        ({"size_bytes": 11}, "size_mismatch"),
        ({"actual_sha256": "b" * 64}, "sha_mismatch"),
        ({"graph_fp": "x"}, "graph_fingerprint"),
        ({"tile_count": 2}, "tile_count"),
        ({"buffer_km": 0.0}, "buffer"),
    ],
)
def test_graph_pack_rules(spark, change, code):
    row = {"pack_id": "g", **GRAPH_PACK, **change}
    m = spark.createDataFrame([tuple(row.values())], "pack_id string, file_name string, size_bytes long, sha256 string, tile_count long, graph_fp string, buffer_km double, actual_size long, actual_sha256 string")
    t = spark.createDataFrame([("g", "0/1.gph")], "pack_id string, path string")
    s = spark.createDataFrame([("g", "p", 1, "a" * 64)], "pack_id string, source_id string, size_bytes long, sha256 string")
    r = spark.createDataFrame([("g", "border", True)], "pack_id string, kind string, passed boolean")
    assert [x["code"] for x in quality.check_graph_pack(m, t, s, r).collect()] == ([code] if code else [])


def test_rank_rules_catch_gap_repeat_and_order(spark):
    def codes(ranks):
        df = spark.createDataFrame([("g", r, k) for r, k in ranks], "g string, rank long, k long")
        return {x["code"] for x in routes.rank_contiguity(df, "g", "rank", ["k"], F.col("k")).collect()}

    assert codes([(0, 1), (1, 2), (2, 2)]) == set()
    assert codes([(0, 1), (2, 2)]) == {"rank_not_contiguous"}
    assert codes([(0, 1), (0, 2)]) == {"rank_not_contiguous"}
    assert codes([(0, 5), (1, 2)]) == {"order_broken"}


# --- files -----------------------------------------------------------------


def test_place_reader_keeps_bad_lines_as_rows(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"id":"x","properties":{"names":{"primary":"N"}}}\n\nnot json\n', encoding="utf-8")
    got = rows(readers.read_place_features(spark, str(tmp_path)), "id", "broken")
    assert got == [("x", False), (None, True)]


def test_road_reader_resolves_every_way_id_form(spark, tmp_path):
    geom = '"geometry":{"type":"LineString","coordinates":[[12,46],[12.1,46.1]]}'
    lines_ = [f'\x1e{{"id":7,"properties":{{}},{geom}}}', f'{{"id":"w8","properties":{{}},{geom}}}', f'{{"properties":{{"@id":"w9"}},{geom}}}', f'{{"id":"w0","properties":{{}},{geom}}}']
    (tmp_path / "r.geojsonseq").write_text("\n".join(lines_), encoding="utf-8")
    assert rows(readers.read_road_features(spark, str(tmp_path)), "way_id") == [(7,), (8,), (9,)]


def test_polygon_reader_closes_rings_and_drops_tiny_ones(spark, tmp_path):
    (tmp_path / "r.poly").write_text("name\n1\n 0 0\n 1 0\n 1 1\nEND\n!2\n 0.1 0.1\n 0.2 0.1\nEND\nEND\n", encoding="utf-8")
    got = rows(readers.read_polygons(spark, str(tmp_path)), "ring_no", "is_hole", "seq", "ax", "ay", "ex", "ey")
    assert got == [(0, False, 0, 0.0, 0.0, 1.0, 0.0), (0, False, 1, 1.0, 0.0, 1.0, 1.0), (0, False, 2, 1.0, 1.0, 0.0, 0.0)]


def test_artifact_inventory_reads_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"schema":"known","version":1,"roads":[1,2]}')
    (tmp_path / "b.json").write_text("{")
    (tmp_path / "c.json").write_text('{"schema":"known","pad":"' + "x" * 200 + '"}')
    got = readers.artifact_inventory(spark, str(tmp_path), ["known"], ["roads"], max_bytes=100)
    assert sorted((r["state"], r["oversize"]) for r in got.collect()) == [("INVALID", False), ("MATCH", False), ("MATCH", True)]


def test_tile_inventory_reads_files(spark, tmp_path):
    d = tmp_path / "tiles" / "2" / "000" / "818"
    d.mkdir(parents=True)
    (d / "660.gph").write_bytes(b"x")
    r = readers.tile_file_inventory(spark, str(tmp_path / "tiles")).first()
    assert (r["level"], r["tile_index"], r["min_lat"], r["problem"]) == (2, 818660, 52.0, None)


def test_a_written_version_is_never_replaced(spark, tmp_path):
    t = {"places": spark.range(3)}
    base = sinks.write_pack(t, str(tmp_path), "r", "v1")
    assert sinks.read_pack(spark, base, ["places"])["places"].count() == 3
    with pytest.raises(sinks.VersionExists):
        sinks.write_pack(t, str(tmp_path), "r", "v1")


def test_search_limit_is_an_argument_and_order_stays(spark):
    n = 300
    p = spark.createDataFrame([(f"p{i:03d}", f"cafe {i}", "street", i / 300.0, 46.0, 12.0) for i in range(n)], "place_id string, name_norm string, address_norm string, confidence double, latitude double, longitude double")
    q = search.prepare_queries(spark.createDataFrame([(1, "cafe", "", None, None)], "query_id long, text string, category string, lat double, lon double"))
    got = sorted(search.retrieve_topk_v1(q, p, limit=240).collect(), key=lambda r: r["pos"])
    assert len(got) == 240 and [r["place_id"] for r in got[:2]] == ["p299", "p298"]
    assert list(itertools.islice((r["pos"] for r in got), 3)) == [1, 2, 3]
    assert search.retrieve_topk_v1(q, p).count() == n


def test_search_scores_every_candidate(spark):
    # The best score sits behind more nearer matches than any former cut kept.
    n = 4200
    rows = [(f"p{i:04d}", f"cafe {i}", "street", f"cafe {i}", "street", 0.5, 46.0 + i * 1e-4, 12.0) for i in range(n)]
    rows.append(("best", "cafe", "street", "cafe", "street", 0.1, 46.9, 12.0))
    p = spark.createDataFrame(rows, "place_id string, name_norm string, address_norm string, name string, address string, confidence double, latitude double, longitude double")
    p = p.selectExpr("*", "'OPEN' as operating_status", "'x' as basic_category", "'x' as taxonomy_primary")
    q = search.prepare_queries(spark.createDataFrame([(1, "cafe", "", 46.0, 12.0)], "query_id long, text string, category string, lat double, lon double"))
    bridge = spark.createDataFrame([], "place_id string, category_id long, relation int, ordinal int")
    cats = spark.createDataFrame([], "id long, name string, name_norm string")
    best = search.rank_v2(search.retrieve_topk_v2(q, p, bridge, cats), q, p, limit=1).first()
    assert best["place_id"] == "best"
    with pytest.raises(ValueError):
        search.rank_v2(search.retrieve_topk_v2(q, p, bridge, cats), q, p, limit=0)


def test_shared_folder_is_refused_on_a_cluster(monkeypatch):
    from types import SimpleNamespace as N

    from terrasheaf import session

    cluster = N(
        conf=N(get=lambda *_: None),
        sparkContext=N(getConf=lambda: N(get=lambda *_: None), master="spark://host:7077"),
    )
    with pytest.raises(RuntimeError):
        session.shared_dir(cluster)


def test_each_pack_gets_its_own_counts(spark):
    identity = spark.createDataFrame(
        [(r, "v1", "p", "d", "c", "1.2.3", "a" * 64, "x") for r in ("north", "south")],
        "region_id string, pack_version string, provider string, data_release string, client string, client_version string, input_sha256 string, coverage string",
    )
    counts = spark.createDataFrame(
        [("north", "v1", 5, 4, 3, 2), ("south", "v1", 7, 0, 1, 0)],
        "region_id string, pack_version string, record_count long, categorized_count long, structured_address_count long, source_identified_count long",
    )
    made = places.pack_manifest(counts, identity)
    assert rows(made, "region_id", "record_count", "category_search") == [("north", 5, True), ("south", 7, False)]
    ranks = spark.createDataFrame([], "query_id long, rank int, title string, address string, score long")
    orphans = spark.createDataFrame([("south", "v1", 9)], "region_id string, pack_version string, category_id long")
    found = places.validate_pack(made, counts, orphans, ranks, ranks)
    assert {r for r in rows(found, "subject", "code") if r[0] == "north"} == set()
    assert ("south", "orphan_category_links") in rows(found, "subject", "code")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.floats(-3, 3, allow_nan=False) | st.integers(-3, 3).map(float)] * 4), min_size=1, max_size=20))
def test_line_cells_hold_every_point_of_the_line(spark, segments):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(segments)], "i int, ax double, ay double, ex double, ey double")
    for size, grow in ((0.25, 0.0), (0.1, 0.07)):
        got: dict[int, set] = {}
        for r in spatial.line_cells(df, size, (F.col("ax"), F.col("ay")), (F.col("ex"), F.col("ey")), grow, grow).collect():
            assert (r["cy"], r["cx"]) not in got.setdefault(r["i"], set())
            got[r["i"]].add((r["cy"], r["cx"]))
        for i, (ax, ay, ex, ey) in enumerate(segments):
            for k in range(401):
                x, y = ax + (ex - ax) * k / 400, ay + (ey - ay) * k / 400
                for dx, dy in ((0, 0), (grow, 0), (0, -grow), (-grow, grow)):
                    assert (math.floor((y + dy * 0.999) / size), math.floor((x + dx * 0.999) / size)) in got[i]
            rows_, columns = abs(ey - ay) / size + 2 + 2 * grow / size, abs(ex - ax) / size + 2 + 2 * grow / size
            # In proportion to the length: every row adds its own width and what it shares with the next.
            assert len(got[i]) <= columns + rows_ * (3 + 4 * grow / size * (1 + 0.5 * abs(ex - ax) / max(abs(ey - ay), 1e-9)) if abs(ey - ay) > 1e-9 else columns)


def test_a_long_diagonal_takes_cells_by_its_length(spark):
    df = spark.createDataFrame([(12.0, 46.0, 13.0, 47.0)], "ax double, ay double, ex double, ey double")
    cells = spatial.line_cells(df, 0.0005, (F.col("ax"), F.col("ay")), (F.col("ex"), F.col("ey")))
    assert 2000 <= cells.count() <= 3 * 2001  # its box has four million


def star(random_, x, y, low, high, n):
    """Corners of a jagged ring around (x, y)."""
    turn = [(2 * math.pi * k / n, random_.uniform(low, high)) for k in range(n)]
    return [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in turn]


@pytest.mark.parametrize("leaf, deepest", [(32, 12), (3, 12), (2, 2)])
def test_quadtree_against_plain_even_odd(spark, leaf, deepest, monkeypatch):
    import random

    r = random.Random(5)
    rings = {
        ("a", 0, False): star(r, 1.3, 0.4, 1.0, 1.9, 300), ("a", 1, True): star(r, 1.3, 0.4, 0.2, 0.6, 60), ("a", 2, False): star(r, -3.2, -1.1, 0.5, 0.9, 40),
        ("a", 3, True): star(r, -3.2, -1.1, 0.1, 0.3, 9), ("b", 0, False): star(r, 1.0, 0.0, 2.5, 2.6, 25), ("b", 1, False): [(4.0, 4.0), (4.0001, 4.0), (4.0001, 4.0001), (4.0, 4.0001)],
    }
    data = [(*key, *a, *b) for key, pts in rings.items() for a, b in zip(pts, pts[1:] + pts[:1])]
    segments = spark.createDataFrame(data, "region_id string, ring_no int, is_hole boolean, ax double, ay double, ex double, ey double")
    corners = [p for pts in rings.values() for p in pts[::7]]
    points = [(r.uniform(-5, 5), r.uniform(-4, 5)) for _ in range(1500)] + corners + [(float(x), float(y)) for x in range(-4, 5) for y in range(-3, 5)]
    points += [(4.0 + r.uniform(-0.0001, 0.0002), 4.0 + r.uniform(-0.0001, 0.0002)) for _ in range(60)]
    df = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(points)], "id int, lat double, lon double")
    tree = spatial.region_quadtree
    monkeypatch.setattr(spatial, "region_quadtree", lambda s, n: tree(s, n, deepest))
    got = {(x["id"], x["region_id"]): x["strictly"] for x in spatial.points_in_polygon(df, segments, leaf=leaf).collect()}

    def odd(pts, x, y):
        return sum((ay > y) != (ey > y) and x < ax + (y - ay) * (ex - ax) / (ey - ay) for (ax, ay), (ex, ey) in zip(pts, pts[1:] + pts[:1])) % 2 == 1

    for i, (x, y) in enumerate(points):
        for region in "ab":
            own = {k: pts for k, pts in rings.items() if k[0] == region}
            corner = [k for k, pts in own.items() if (x, y) in pts]
            if corner:  # a corner is on the outline, whatever the crossings say
                assert got[i, region] is False
                continue
            inside = any(odd(p, x, y) for k, p in own.items() if not k[2]) and not any(odd(p, x, y) for k, p in own.items() if k[2])
            assert ((i, region) in got) == inside, (x, y, region)
    if deepest == 12:
        cells, sizes = tree(segments, leaf)
        assert max(x["n"] for x in cells.select(F.size("pieces").alias("n")).collect()) <= leaf and (len(sizes) > 3) == (leaf == 3)
        assert cells.groupBy("region_id", "level", "cy", "cx").count().filter("count > 1").count() == 0


def test_quadtree_of_no_outline_and_points_without_place(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 5.0, None), (3, 1.0, 1.0), (3, 1.0, 1.0)], "id int, lat double, lon double")
    assert rows(spatial.points_in_polygon(df, outline(spark)), "id") == [(3,), (3,)]
    assert spatial.points_in_polygon(df, outline(spark).limit(0)).count() == 0
