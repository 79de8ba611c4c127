"""Batched measures of tails give what the column expressions give, odd shapes included."""

from pyspark.sql import functions as F

from terrasheaf.functions import lines as L
from terrasheaf.operators import match

POINT = "array<struct<lat:double,lon:double>>"
ROWS = [
    (1, [(46.0, 12.0), (46.00005, 12.0), (46.00005, 12.0), (46.0002, 12.0001)], [(46.0, 12.0), (46.00005, 12.0), (46.0002, 12.0001)]),
    (2, [(46.0, 12.0), (46.00002, 12.0)], [(46.0003, 12.0), (46.0, 12.0), (45.9, 12.0)]),
    (3, [(46.0, 12.0)], [(46.0, 12.0), (46.0, 12.0)]),
    (4, [(46.0, 12.0), (None, 12.0), (46.00003, 12.00001)], [(46.0, 12.0), (None, 12.0), (46.00002, 12.0), (46.00004, 12.0)]),
    (5, [(None, 12.0), (46.0, 12.0)], None),
    (6, None, [(46.0, 12.0), (46.1, 12.0)]),
]


def pairs(spark):
    return spark.createDataFrame([(i, i + 10, s, r) for i, s, r in ROWS], f"source_id long, receiver_id long, shape {POINT}, r_shape {POINT}")


def test_batched_gaps_equal_projections_of_the_samples(spark):
    p = F.transform(L.tail_samples(F.col("shape")), lambda s: L.project_on_line(s["lat"], s["lon"], F.col("r_shape"))["metres"])
    got = {r[0]: r for r in pairs(spark).select("source_id", L.tail_gaps(F.col("shape"), F.col("r_shape")), p, L.tail_samples(F.col("shape"))).collect()}
    for i, gaps, want, points in got.values():
        assert (gaps is None) == (want is None)
        for a, b in zip(gaps or [], want or [], strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6), i
    assert len(got[1][3]) == 11 and got[1][3][0] == (46.0002, 12.0001) and got[6][3] is None
    assert [tuple(x) for x in got[3][3]] == [(46.0, 12.0)] * 2 and tuple(got[5][3][-1]) == (None, 12.0)
    assert len(got[2][3]) == 3 and abs(got[2][3][1]["lat"] - 46.00001) < 1e-9


def test_tails_are_measured_in_batches_and_keep_their_verdicts(spark):
    out = match.tail_direction(pairs(spark))
    assert "transform(" not in out._jdf.queryExecution().optimizedPlan().toString()  # no lambda a sample
    got = {r["source_id"]: (r["samples"], r["matched"], r["state"].split("_")[0] + r["state"][-5:]) for r in out.collect()}
    assert got[2] == (3, 3, "SAMPLED_ONLY") and got[1][:2] == (11, 11) and got[3] == (2, 0, "INSUFFICIENTERLAP") and got[5][1] == 0 and got[6][:2] == (None, None)
    states = {r["source_id"]: r["state"] for r in out.collect()}
    assert states[1].endswith("ALIGNED_ONLY") and states[2].endswith("OPPOSED_ONLY") and states[6].startswith("AMBIGUOUS")
    cover = {r["source_id"]: (r["samples"], r["covered"], r["max_gap_m"]) for r in match.tail_coverage(pairs(spark)).collect()}
    assert cover[1][:2] == (11, 11) and cover[3] == (2, 0, None) and 6 not in cover and cover[5][1] == 0


def test_many_rows_in_a_small_file_are_not_broadcast(spark, tmp_path):
    from terrasheaf.plans.registry import Tables

    spark.range(600_000).selectExpr("id as p_partkey", "'the same long text in each of the rows' as p_name").repartition(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(600_000).selectExpr("id as c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    t = Tables(spark, str(tmp_path))
    text = t("customer").join(t("part"), F.col("c_custkey") == F.col("p_partkey"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_two_places_equal_their_projections(spark):
    """Places and length of an overlap, worked out by batch, are what the column expressions give."""
    places = [(46.00003, 12.00002, 46.0, 12.0), (46.00003, None, 46.0, 12.0001), (46.1, 12.0, None, 12.0), (None, 12.0, 46.0, 12.0), (float("nan"), 12.0, 46.0, 12.0)]
    rows = [(i * 10 + k, *p, r) for i, s, r in ROWS for k, p in enumerate(places)] + [(100 + i, *places[0], s) for i, s, _ in ROWS]
    df = spark.createDataFrame(rows, f"id long, x_lat double, x_lon double, app_lat double, app_lon double, r_shape {POINT}")
    c, scale = F.col, 111320.0
    plain = [
        *[L.project_on_line(c("x_lat"), c("x_lon"), c("r_shape"), scale, c("x_lat"))[n] for n in ("metres", "along")],
        *[L.project_on_line(c("app_lat"), c("app_lon"), c("r_shape"), scale, c("x_lat"))[n] for n in ("metres", "along")],
        L.planar_length(c("r_shape"), c("x_lat"), scale),
    ]
    both = L.two_places((c("x_lat"), c("x_lon")), (c("app_lat"), c("app_lon")), c("r_shape"), scale)
    got = df.select("id", both, F.struct(*[p.alias(f"c{k}") for k, p in enumerate(plain)])).collect()
    assert len(got) == len(rows)
    for i, new, old in got:
        for a, b in zip(new, old, strict=True):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6 or (a != a and b != b)), (i, new, old)
    extra = [F.lit(1).cast("long").alias(n) for n in ("access", "r_access")] + [F.lit(0).alias(n) for n in ("layer", "r_layer")]
    extra += [F.lit(False).alias(n) for n in ("bridge", "tunnel", "r_bridge", "r_tunnel")]
    plan = match.directed_overlap(df.select("*", *extra))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambdafunction" not in plan
