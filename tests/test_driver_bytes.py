"""What passes through the driver stays bounded."""

from pyspark.sql import functions as F

from adspark.operators.keys import lookup_join
from adspark.plans import catalog, reports

SF = "/root/testdata/sf0.001"


def plan_after_run(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_lookup_is_not_broadcast(spark, tmp_dir):
    """60,000 names: under 10 MB by Spark's estimate, so it would choose a broadcast by itself."""
    spark.range(60_000).selectExpr("concat('Campaign_', id) AS name", "id").write.parquet(f"{tmp_dir}/dim")
    fact = spark.range(100).select(F.concat(F.lit("Campaign_"), (F.col("id") * 601).cast("string")).alias("name"))
    joined = lookup_join(fact, spark.read.parquet(f"{tmp_dir}/dim"), "name")
    assert "BroadcastHashJoin" not in plan_after_run(joined)
    assert [r["id"] for r in joined.orderBy("id").collect()] == [i * 601 for i in range(100)]
    few = lookup_join(fact, spark.read.parquet(f"{tmp_dir}/dim").where("id < 1000"), "name")
    assert "BroadcastHashJoin" in plan_after_run(few)


def test_clicks_and_users_are_not_broadcast(spark, tmp_dir):
    spark.range(60_000).selectExpr("CAST(id AS STRING) AS impression_id", "id AS click_id", "id % 9 AS user_id",
                                   "TIMESTAMP_NTZ'2024-01-02 00:00:00' AS click_timestamp").write.parquet(f"{tmp_dir}/clicks")
    clicks = spark.read.parquet(f"{tmp_dir}/clicks")
    j = reports.join_clicks(clicks.select("impression_id", "user_id"), clicks)
    assert j.where("click_id = CAST(impression_id AS BIGINT)").count() == 60_000
    assert "BroadcastHashJoin" not in plan_after_run(j)
    top = reports.top_users_clicks({"impression_clicks": clicks, "users": spark.read.parquet(f"{tmp_dir}/clicks").select("user_id")},
                                   "2024-01-01", "2024-01-03", 2)
    assert [tuple(r) for r in top.collect()] == [(0, 6667), (1, 6667)]
    assert "BroadcastHashJoin" not in plan_after_run(top)


def test_resolved_events_are_looked_up_once(spark):
    """Every later table reads the stored resolved events."""
    w = catalog.warehouse(spark, SF)
    assert "Join" not in w["ad_events"]._jdf.queryExecution().optimizedPlan().toString()
    again = catalog.events_view(w)
    assert again.columns == w["ad_events"].columns
    assert again.exceptAll(w["ad_events"]).isEmpty() and again.count() == w["ad_events"].count()
