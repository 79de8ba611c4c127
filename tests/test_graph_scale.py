"""Graph queries move the columns and edges that they need and write no joined table of all edges."""

import os

from pyspark.sql import functions as F

from terrasheaf.plans import graph as PG, load_all, match as PM
from terrasheaf.plans.registry import QUERIES, Tables
from terrasheaf.session import shared_dir

load_all()


def tables(spark, tmp_path):
    rows = [(k // 4, k % 7 + 1, k * 13 % 90, k % 10, 1.0) for k in range(900)] + [(3, None, 5, 1, 1.0), (None, 2, 5, 1, 1.0), (70, 2, None, 1, 1.0)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double")
    df.write.parquet(f"{tmp_path}/lineitem.parquet")
    return Tables(spark, str(tmp_path))


def test_edges_are_worked_out_and_not_written(spark, tmp_path):
    t = tables(spark, tmp_path)
    before = set(os.listdir(shared_dir(spark)))
    got = {(r["root_id"], r["option_id"]) for r in QUERIES["root_options"](spark, str(tmp_path)).collect()}
    new = {n.rsplit("-", 1)[0] for n in set(os.listdir(shared_dir(spark))) - before}
    assert "stage-v_seg" in new and not any(n.startswith(("stage-v_edges", "stage-v_out")) for n in new)
    whole = t("v_opts").join(PG.roots(t).filter("(access & ~terminal_modes) <> 0").select(F.col("graph_id").alias("source_id")), "source_id")
    assert got and got == {(r["source_id"], r["option_id"]) for r in whole.collect()}


def test_rows_that_start_at_some_edges_are_all_of_theirs(spark, tmp_path):
    t = tables(spark, tmp_path)
    ids = t("v_edges_b").filter("gid % 3 = 0").select("graph_id")
    want = t("v_optb").join(ids.withColumnRenamed("graph_id", "predecessor_id"), "predecessor_id", "left_semi")
    got = t.starting_at("v_optb", ids)
    assert got.columns == want.columns and got.count() == want.count() > 0 and not got.exceptAll(want).count()


def test_candidates_take_no_join_with_all_shapes(spark, tmp_path):
    t = tables(spark, tmp_path)
    text = PM._candidates(t)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join ") == 2  # edges with edges, and with what leaves them
    ended = PG.sources(t).filter("(terminal_modes & 1025) <> 0 and graph_id is not null")
    assert {r["source_id"] for r in PM.candidates(t).collect()} == {r["graph_id"] for r in ended.collect()} != set()


def test_receivers_carry_what_is_read_of_them(spark, tmp_path):
    t = tables(spark, tmp_path)
    assert PG.adjacency(t, "b").columns == ["source_id", "opposing_id", "end_node", "outgoing"]
    assert PG.adjacency(t).columns[1:-1] == t("v_edges_a").columns[1:]
