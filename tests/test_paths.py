"""Reverse paths against a plain search, with repeated ids and a budget that only some finals exceed."""

import random

from pyspark.sql import functions as F

from terrasheaf.operators import graph

NET = "graph_id long, start_node long, end_node long, opposing_id long"


def plain(finals, edges, cut, depth, budget):
    """The same rows hop by hop over all finals."""
    fan = {}
    for _, s, _, _ in edges:
        fan[s] = fan.get(s, 0) + (s is not None)
    open_, used, out = [(f, (f,)) for f in finals], dict.fromkeys(finals, 0), []
    for hop in range(1, depth + 1):
        seen = {}
        for f, path in open_:
            for i, s, _, opp in edges:
                if i != path[-1] or s is None:
                    continue
                for j, _, e, _ in edges:
                    if e == s and opp is not None and j != opp:
                        if j in path:
                            out.append((f, j, hop, "CYCLE", (*path, j)))
                        else:
                            seen.setdefault(f, []).append((*path, j))
        open_ = []
        for f, paths in seen.items():
            for k, p in enumerate(sorted(paths), used[f] + 1):
                status = "BUDGET_EXHAUSTED" if k > budget else "CROSSES_CUT" if p[-1] in cut else "PREDECESSOR"
                out.append((f, p[-1], hop, status, p))
                if status == "PREDECESSOR":
                    open_.append((f, p))
            used[f] += len(paths)
        open_ = [(f, p) for f, p in open_ if used[f] <= budget]
    return sorted(out + [(f, p[-1], depth, "DEPTH_REACHED", p) for f, p in open_])


def test_paths_equal_a_plain_search_for_any_budget(spark):
    r = random.Random(5)
    edges = [(i, r.randrange(9), r.randrange(9), (i + 1) if r.random() < 0.9 else None) for i in range(24)]
    edges += [edges[3], (30, None, 2, 31), (31, 4, None, 30)]
    finals, cut = [1, 3, 5, 30, 31], {2, 7, 11}
    net = spark.createDataFrame(edges, NET)
    for budget in (2, 25, 4096):
        got = graph.predecessor_paths(
            spark.createDataFrame([(f,) for f in finals], "graph_id long"), net, spark.createDataFrame([(x,) for x in [*cut, 2]], "graph_id long"), 3, budget
        )
        assert sorted((*x[:4], tuple(x[4])) for x in got.collect()) == plain(finals, edges, cut, 3, budget), budget


def test_paths_within_the_budget_are_not_sorted_and_move_once_a_hop(spark):
    net = spark.range(40).select(
        F.col("id").alias("graph_id"), (F.col("id") % 20).alias("start_node"), ((F.col("id") + 1) % 20).alias("end_node"), (F.col("id") + 100).alias("opposing_id")
    )
    got = graph.predecessor_paths(net.select("graph_id"), net, net.filter("graph_id = 3").select("graph_id"), 3)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
