"""Work on a word that every place holds, or on a region of many anchors, is dealt to many tasks."""

from pyspark.sql import functions as F

from terrasheaf.operators import search
from terrasheaf.plans import load_all
from terrasheaf.plans.registry import QUERIES

load_all()

PLACES = "place_id string, name_norm string, address_norm string"


def test_places_of_one_word_are_dealt_to_many_tasks(spark):
    places = spark.createDataFrame([(f"p{i}", f"nation {i}", "street") for i in range(400)] + [(None, "nation", "")], PLACES)
    asked = spark.createDataFrame([(q, "nation", "", None, None) for q in range(3)], "query_id long, text string, category string, lat double, lon double")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        pairs = search._token_pairs(search.prepare_queries(asked), places).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted((r["query_id"], r["place_id"] or "") for r in pairs) == sorted((q, p) for q in range(3) for p in ["", *(f"p{i}" for i in range(400))])
    by_task = {}
    for r in pairs:
        by_task[r["task"]] = by_task.get(r["task"], 0) + 1
    assert max(by_task.values()) < len(pairs) / 2


def test_pairs_of_one_region_are_made_by_many_tasks(spark, tmp_path):
    spark.range(40).selectExpr("id as s_suppkey", "1 as s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    found = QUERIES["check_matrix"](spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    want = []
    for mode in ("auto", "motorcycle"):
        for f, t in ((f, t) for f in range(40) for t in range(40) if f % 3 and t % 4 and f != t and (f + t) % 13):
            code = ["reachable_fields" if (f + t) % 7 == 0 else "", "unreachable_fields" if (f + t) % 11 == 0 else "", "inconclusive_fields" if (f + t) % 5 == 0 else ""][(f + t) % 3]
            want += [(f"r1:{mode}:{f}:{t}", code)] if code else []
        want.append((f"r1:{mode}", "pair_count"))
    assert sorted((r["subject"], r["code"]) for r in found.collect()) == sorted(want)
