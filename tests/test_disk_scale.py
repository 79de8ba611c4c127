"""Rows move once, or not at all where they lie together already."""

import math
import random
import re

from pyspark.sql import functions as F

from terrasheaf.functions import lines as L
from terrasheaf.operators import graph as G, match as M, quality as Q, spatial as X
from terrasheaf.plans import graph as PG, match as PM
from terrasheaf.plans.registry import Tables

SMALL = "/root/testdata/sf0.001"


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _apart(p, q, r):
    k = math.cos(math.radians(p[1]))
    dx, dy, x, y = (r[0] - q[0]) * k, r[1] - q[1], (p[0] - q[0]) * k, p[1] - q[1]
    t = max(0.0, min(1.0, (x * dx + y * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
    return 111320.0 * math.hypot(x - t * dx, y - t * dy)


def _roads(spark):
    """Points at and around lines: short and long ones, with many vertices, across cells, one without a coordinate."""
    r = random.Random(5)
    lines = [[(12 + r.uniform(0, 0.02), 46 + r.uniform(0, 0.02))] for _ in range(60)]
    for i, line in enumerate(lines):
        for _ in range(1 + i % 7):
            step = 0.02 if i % 9 == 0 else 0.0004
            line.append((line[-1][0] + r.uniform(-step, step), line[-1][1] + r.uniform(-step, step)))
    points = []
    for i in range(600):
        a, b = (line := lines[i % 60])[k := r.randrange(len(line) - 1)], line[k + 1]
        f = r.random()
        points.append((i, a[1] + (b[1] - a[1]) * f + r.uniform(-5e-5, 5e-5), a[0] + (b[0] - a[0]) * f + r.uniform(-5e-5, 5e-5), i % 3))
    rows = [(i, 1, False, False, f"n{i}", [(y, x) for x, y in line]) for i, line in enumerate(lines)]
    rows += [(70, 1, False, False, "n", [(46.0, None), (46.01, 12.0)]), (71, 1, False, False, "n", [])]
    shapes = spark.createDataFrame(rows, "graph_id long, forward_access long, is_shortcut boolean, is_transit boolean, name string, shape array<struct<lat:double,lon:double>>")
    want = {}
    for s, y, x, _ in points:
        for k, line in enumerate(lines):
            if (d := min(_apart((x, y), *seg) for seg in zip(line, line[1:]))) <= 4.0:
                want[s, k] = d
    return spark.createDataFrame(points, "source_id long, x_lat double, x_lon double, kind int"), shapes, lines, want


def test_a_pair_at_a_point_meets_once_and_carries_its_columns(spark):
    points, shapes, lines, want = _roads(spark)
    met = M.edges_at_point(points, shapes, of_point=["kind"], of_edge=["name", "shape"])
    assert exchanges(met) <= 2  # the two sides of the search, and nothing after it
    got = met.collect()
    assert len(got) == len(want) == len({(r["source_id"], r["receiver_id"]) for r in got})
    for r in got:
        assert math.isclose(r["distance_m"], want[r["source_id"], r["receiver_id"]], rel_tol=1e-9, abs_tol=1e-9)
        assert r["kind"] == r["source_id"] % 3 and r["name"] == f"n{r['receiver_id']}"
        assert [(p["lon"], p["lat"]) for p in r["shape"]] == lines[r["receiver_id"]]
    plain = {(r["source_id"], r["receiver_id"]) for r in M.edges_at_point(points, shapes).collect()}
    assert plain == set(want)


def test_a_long_line_is_copied_by_its_length(spark):
    shape = [(46.0, 12.0), (46.2, 12.2)]
    df = spark.createDataFrame([(1, shape)], "k int, shape array<struct<lat:double,lon:double>>")
    assert X.shape_cells(df, 0.002, 0.00004).count() < 450  # its box has over 10,000


def test_edges_of_a_node_are_gathered_for_all_that_end_there(spark):
    edges = spark.createDataFrame(
        [(1, 2, 10, 20, 1025), (2, 1, 20, 10, 1025), (3, 4, 20, 30, 1), (4, 3, 30, 20, None), (5, 6, 40, 10, 1024), (6, 5, 10, 40, 0), (None, 1, 20, 50, 1024), (7, None, 50, 20, 5)],
        "graph_id long, opposing_id long, start_node long, end_node long, forward_access long",
    )
    own = edges.withColumnRenamed("forward_access", "access")
    e, o = edges.alias("e"), edges.alias("o")
    options = e.join(o, F.col("e.end_node") == F.col("o.start_node")).filter("o.graph_id <> e.opposing_id")
    options = options.select(F.col("e.graph_id").alias("source_id"), F.col("o.graph_id").alias("option_id"), F.col("o.forward_access").alias("option_access"))
    want = {r["graph_id"]: r["terminal_modes"] for r in G.terminal_modes(own.filter("graph_id is not null"), options).collect()}
    gathered = G.terminal_modes(own.filter("graph_id is not null"), G.options_by_node(edges))
    assert {r["graph_id"]: r["terminal_modes"] for r in gathered.collect()} == want


def test_edges_of_both_graphs_meet_where_they_lie(spark):
    t = Tables(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(t("v_ab")) == 0
        assert exchanges(PM._candidates(t, PG.sources(t))) == 1  # the few that end, and not the edges
        ends = PG.roots(t)
        assert exchanges(t.starting_at("v_optb", ends)) == 3  # the ids, and both sides at their nodes
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_samples_of_a_tail_become_counts_where_its_pairs_are(spark):
    r = random.Random(11)
    line = lambda n: [(46 + r.uniform(0, 2e-4), 12 + r.uniform(0, 2e-4)) for _ in range(n)]
    rows = []
    for k, receivers in enumerate([1, 2, 64, 65, 200, 3]):
        shape = line(4)
        rows += [(k, shape, line(2 + i % 3)) for i in range(receivers)]
    rows += [(7, None, line(2)), (8, line(3), None), (None, line(3), line(3))]
    kind = "array<struct<lat:double,lon:double>>"
    df = spark.createDataFrame(rows, f"source_id long, shape {kind}, r_shape {kind}").repartition(5)
    each = df.select("source_id", F.posexplode(L.tail_gaps(F.col("shape"), F.col("r_shape"))).alias("i", "gap")).groupBy("source_id", "i").agg(F.min("gap").alias("gap"))
    want = each.groupBy("source_id").agg(F.count("i").alias("n"), F.count_if(F.col("gap") <= M.COLOCATED).alias("c"), F.max("gap").alias("m"))
    got = M.tail_coverage(df)
    assert exchanges(got) == 2  # the pairs, and a row for each batch
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_pairs_that_lie_by_source_do_not_move(spark):
    t = Tables(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(M.tail_coverage(PM.ab_pairs(t), laid_by=["gid"])) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_options_of_the_second_hop_are_chosen_before_they_move(spark, monkeypatch):
    ids = "graph_id long, access long, terminal_modes long"
    roots = spark.createDataFrame([(1, 1025, 0), (2, 1025, 0), (9, 1, 0)], ids)
    ok, kind = "ALLOWED_NATIVE_IMMEDIATE", "source_id long, option_id long, option_access long, shortcut boolean, transit boolean, via_hierarchy boolean, car string, motorcycle string"
    hop = lambda a, b, access=1025, **k: (a, b, access, k.get("shortcut", False), False, k.get("via", False), k.get("car", ok), ok)
    options = [hop(1, 3), hop(1, 4, shortcut=True), hop(2, 5), hop(9, 3), hop(3, 6), hop(3, 7, car="DENIED"), hop(3, 8, via=True), hop(5, 6, 1024), hop(5, 10), *[hop(100 + i, 6) for i in range(50)]]
    sources = spark.createDataFrame([(6, 1025, 1025), (7, 1025, 1), (8, 1025, 1025), (10, 1025, 1025), (11, 1, 0)], ids)
    tiles = spark.createDataFrame([(i,) for i in (3, 4, 5, 6, 7, 8)], "tile_id long")
    scope = spark.createDataFrame([(i,) for i in (6, 7, 8, 10)], "graph_id long")
    links = spark.createDataFrame([(9,)], "root_id long")
    options = spark.createDataFrame(options, kind)
    want = [(1, 3, 6, 1025), (2, 5, 6, 1024)]
    out = G.two_hop_recovery(roots, links, options, sources, tiles, scope)
    assert sorted(map(tuple, out.collect())) == want
    own = options.join(roots.select(F.col("graph_id").alias("source_id")), "source_id", "left_semi")
    assert sorted(map(tuple, G.two_hop_recovery(roots, links, options, sources, tiles, scope, of_roots=own).collect())) == want
    moved = []
    monkeypatch.setattr(G, "stage", lambda df, label: moved.append((label, df.count())) or df)
    G.two_hop_recovery(roots, links, options, sources, tiles, scope)
    assert moved == [("first-hop", 2)]


def test_pieces_are_flagged_where_their_shape_is(spark):
    r = random.Random(2)
    rows = []
    for i in range(300):
        x, y = 12 + r.uniform(-0.02, 0.05), 46 + r.uniform(-0.02, 0.05)
        rows.append((i, i // 3, [(y, x), (y + r.uniform(-0.02, 0.02), x + r.uniform(-0.02, 0.02)), (y + r.uniform(-0.02, 0.02), x)]))
    rows.append((None, None, [(None, None), (None, None)]))
    shapes = spark.createDataFrame(rows, "graph_id long, g long, shape array<struct<lat:double,lon:double>>")
    ring = [(12.0, 46.0), (12.0301, 46.0007), (12.0317, 46.0313), (12.0103, 46.0201), (12.0003, 46.0307), (12.0, 46.0)]
    outline = [("r", 0, False, *a, *b) for a, b in zip(ring, ring[1:])]
    segments = spark.createDataFrame(outline, "region_id string, ring_no int, is_hole boolean, ax double, ay double, ex double, ey double")
    want = {row["graph_id"]: row["outside_m"] for row in X.metres_outside(shapes, segments).collect()}
    out = X.metres_outside(shapes, segments, laid_by="g")
    got = {row["graph_id"]: row["outside_m"] for row in out.collect()}
    assert out.columns == ["graph_id", "outside_m"] and got.keys() == want.keys() and any(want.values())
    for k, metres in want.items():
        assert got[k] == metres or math.isclose(got[k], metres, rel_tol=1e-9, abs_tol=1e-9)


def test_repeated_options_are_counted_where_they_meet_their_references(spark):
    cat = spark.createDataFrame([(1, 10, 46.0, 12.0, 1, "x")], "source_id long, end_node long, x_lat double, x_lon double, modes long, correlation string")
    kind = "source_id long, option_id long, modes long, relation string, evidence string"
    options = spark.createDataFrame([(1, 5, 1, "r", "e"), (1, 5, 1, "r", "e"), (1, 6, 1, "r", "e")], kind)
    refs = spark.createDataFrame([(1, 5, 1, "r", "e"), (1, 6, 1, "r", "e")], kind)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.audit_catalog(cat, cat, options, refs, spark.createDataFrame([], "source_id long, receiver_id long"), cat.select("source_id"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"hashpartitioning\(source_id#\w+, option_id#", plan)) == 2  # options and references, once each
        assert [tuple(r) for r in out.collect()] == [("1", "option_repeated")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
