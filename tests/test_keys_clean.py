from pyspark.sql import Window
from pyspark.sql import functions as F

from adspark.operators.clean import exact_dedup, key_dedup_first, normalize_campaigns, normalize_events
from adspark.operators.keys import dense_ids, keep_one, sized_broadcast
from adspark.sources.csv import RAW_EVENT_COLUMNS


def test_dense_ids_equal_global_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(((F.col("id") * 7919) % 5000).alias("k"),
                                                      (F.col("id") % 13).alias("g"))
    got = dense_ids(df, ["g", "k"], "rid")
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("g", "k")))
    assert got.select("g", "k", "rid").exceptAll(want.select("g", "k", "rid")).count() == 0
    assert got.count() == 5000


def test_keep_one_first_and_last(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, o int, v string")
    first = {r["k"]: r["v"] for r in keep_one(df, ["k"], ["o"]).collect()}
    last = {r["k"]: r["v"] for r in keep_one(df, ["k"], ["o"], last=True).collect()}
    assert first == {"a": "y", "b": "z"} and last == {"a": "x", "b": "z"}


def test_sized_broadcast_bound(spark):
    small = spark.range(10)
    assert "broadcast" in small.hint("broadcast")._jdf.queryExecution().logical().toString().lower()
    plan_small = sized_broadcast(small, 100, max_bytes=0)._jdf.queryExecution().logical().toString().lower()
    plan_big = sized_broadcast(small, 5, max_bytes=0)._jdf.queryExecution().logical().toString().lower()
    plan_est = sized_broadcast(small, 5)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in plan_est  # the optimizer's estimate alone proves it small
    assert "broadcast" in plan_small and "broadcast" not in plan_big


def test_sized_broadcast_counts_bytes(spark):
    wide = spark.range(50).selectExpr("id", "repeat('x', 100000) AS t")  # few rows, 5 MB of text
    hinted = lambda df: "resolvedhint" in df._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(sized_broadcast(wide, max_bytes=0))
    assert not hinted(sized_broadcast(wide, max_bytes=0, max_memory=1_000_000))
    large = spark.range(1 << 24)  # an estimate of 128 MB is not even counted
    assert not hinted(sized_broadcast(large, max_rows=1 << 30, max_memory=1 << 40))


def _raw_event(eid, ts, cost="1.5", clicked="False", click_ts=None, campaign="Campaign_1"):
    row = dict.fromkeys(RAW_EVENT_COLUMNS)
    row.update(EventID=eid, AdvertiserName=" Adv ", CampaignName=campaign, UserID="7", Device="Mobile",
               Location="USA", Timestamp=ts, AdCost=cost, WasClicked=clicked, ClickTimestamp=click_ts,
               CampaignTargetingInterest=" Travel", CampaignTargetingCountry="USA ")
    return tuple(row[c] for c in RAW_EVENT_COLUMNS)


def raw_events(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_EVENT_COLUMNS))


def test_dedup_exact_and_keep_first(spark):
    rows = [_raw_event("1", "2024-01-01 10:00:00"), _raw_event("1", "2024-01-01 10:00:00"),
            _raw_event("2", "2024-01-02 10:00:00"), _raw_event("2", "2024-01-01 09:00:00", cost="9")]
    df = raw_events(spark, rows)
    assert exact_dedup(df).count() == 3
    kept = {r["EventID"]: (r["Timestamp"], r["AdCost"]) for r in key_dedup_first(df).collect()}
    assert kept == {"1": ("2024-01-01 10:00:00", "1.5"), "2": ("2024-01-01 09:00:00", "9")}


def test_normalize_events_lenient(spark):
    rows = [_raw_event("1", "not-a-date", cost="abc", clicked="maybe"),
            _raw_event("2", "2024-01-01 10:00:00", cost="", clicked="True", click_ts="2024-01-01 10:00:30"),
            _raw_event("3", "2024-01-01 11:00:00", cost="NA", clicked="")]
    got = {r["event_id"]: r for r in normalize_events(raw_events(spark, rows)).collect()}
    assert got["1"]["ts"] is None and got["1"]["ad_cost"] is None and got["1"]["was_clicked"] is None
    assert got["2"]["was_clicked"] is True and got["2"]["click_ts"] is not None and got["2"]["ad_cost"] is None
    assert got["3"]["ad_cost"] is None and got["3"]["was_clicked"] is None
    assert got["2"]["advertiser_name"] == "Adv" and got["2"]["targeting_country"] == "USA"


def test_normalize_campaigns(spark):
    cols = ["CampaignID", "AdvertiserName", "CampaignName", "CampaignStartDate", "CampaignEndDate",
            "TargetingCriteria", "AdSlotSize", "Budget", "RemainingBudget"]
    df = spark.createDataFrame([("1", "A", "C1", "2024-01-01", "bad", "Age 25-34, Travel, India", "300x250", "100",
                                 "x")], ", ".join(f"{c} string" for c in cols))
    r = normalize_campaigns(df).first()
    assert (r["age_from"], r["age_to"], r["interest"], r["country"]) == (25, 34, "Travel", "India")
    assert r["campaign_end_date"] is None and r["remaining_budget"] is None and float(r["budget"]) == 100.0
