"""Shape of the physical plans: no pair products, filters and columns reach the scan."""

import pytest

from terrasheaf.operators import search
from terrasheaf.plans import load_all
from terrasheaf.plans.registry import QUERIES
from terrasheaf.sources import sinks

load_all()
SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "token_candidates", "retrieve_topk_v2", "rank_v1", "physical_peers", "crossing_proposals", "nearby_incoming", "window_edges", "points_in_polygon",
        "cut_crossings", "edges_at_point", "tile_boundary", "diff_ways", "diff_tiles", "layer_coverage", "select_terminals", "source_cover", "check_matrix", "window_parity",
    ],
)
def test_no_pair_product(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["retrieve_topk_v1"](spark, SF))


def test_census_needs_no_shuffle_of_its_own(spark):
    from terrasheaf.operators.graph import terminal_census

    schema = "source_id long, end_node long, way_id long, forward_access long, deadend boolean, opposing_id long, end_lat double, end_lon double, outgoing array<struct<graph_id:long,forward_access:long>>"
    assert "Exchange" not in plan(terminal_census(spark.createDataFrame([], schema)))


def test_box_reaches_the_parquet_scan(spark, tmp_path):
    places = spark.range(100).selectExpr("cast(id as string) id", "45.0 + id * 0.01D latitude", "12.0 + id * 0.01D longitude", "'x' name")
    base = sinks.write_pack({"places": places}, str(tmp_path), "r", "v1", {"places": ["latitude", "longitude"]})
    got = search.bbox_filter(sinks.read_pack(spark, base, ["places"])["places"], 45.5, 12.5, 10.0).select("id")
    text = plan(got)
    assert "GreaterThanOrEqual(latitude" in text and "name" not in text.split("ReadSchema")[1]


def test_matches_move_no_row_after_they_are_laid_out(spark):
    from terrasheaf.operators import match

    attributes = ", ".join(f"{p}_{n}" + (" boolean" if n in ("bridge", "tunnel") else " int") for p in "pn" for n in ("class", "use", "layer", "bridge", "tunnel"))
    candidates = spark.createDataFrame([(k, 1025, 46.0, 12.0) for k in range(40)], "source_id long, modes long, x_lat double, x_lon double")
    overlaps = spark.createDataFrame(
        [(k, 100 + k % 7, match.ENDS_AT_X if k % 2 else match.MATCHED, 1) for k in range(30)], "source_id long, receiver_id long, status string, common_modes long"
    )
    turn = (1, "ALLOWED_NATIVE_IMMEDIATE", "DENIED", 46.0, 12.0, 1, 1, 0, False, False, 1, 1, 0, False, False)
    options = spark.createDataFrame(
        [(100 + k, 200 + k, *turn) for k in range(5)], f"predecessor_id long, option_id long, option_access long, car string, motorcycle string, start_lat double, start_lon double, {attributes}"
    )
    found = match.correlate(candidates, overlaps, options)
    for name in ("options", "unknowns", "status"):
        assert "Exchange" not in plan(found[name]), name
    status = {r["source_id"]: r for r in found["status"].collect()}
    assert len(status) == 40 and status[35]["status"] == "NO_PROVEN_CORRESPONDING_B_DIRECTION"
    assert (status[1]["n_predecessors"], status[1]["n_options"], status[1]["n_unknown"]) == (1, 1, 0)
    assert (status[5]["n_predecessors"], status[5]["n_options"], status[5]["n_unknown"]) == (1, 0, 1)
    assert (status[2]["n_inside"], status[2]["n_options"]) == (1, 1)
    assert found["options"].count() == sum(r["n_options"] for r in status.values()) and found["unknowns"].count() == 4
