from pyspark.sql import functions as F

from adspark.functions.parsing import GENDERS
from adspark.operators import model, quality
from adspark.operators.clean import normalize_campaigns, normalize_events, normalize_users
from adspark.sources.csv import RAW_CAMPAIGN_COLUMNS, RAW_USER_COLUMNS
from tests.test_keys_clean import _raw_event, raw_events


def _campaigns(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_CAMPAIGN_COLUMNS))


def _users(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_USER_COLUMNS))


def small_star(spark):
    ev = normalize_events(raw_events(spark, [
        _raw_event("1", "2024-01-01 10:00:00", campaign="Shared"),
        _raw_event("2", "2024-01-01 11:00:00", clicked="True", click_ts="2024-01-01 11:00:30", campaign="Solo"),
        _raw_event("3", "2024-01-01 12:00:00", campaign="Missing"),
    ]).withColumn("Location", F.when(F.col("EventID") == "3", "Atlantis").otherwise(F.col("Location"))))
    ca = normalize_campaigns(_campaigns(spark, [
        ("10", "Adv", "Shared", "2024-01-01", "2024-02-01", "Age 18-24, Travel, USA", "300x250", "100", "10"),
        ("11", "Other Adv", "Shared", "2024-01-01", "2024-02-01", "Age 18-24, Food, Peru", "300x250", "0", "0"),
        ("12", "Adv", "Solo", "2024-01-01", "2024-02-01", "Everyone", "728x90", "50", "5"),
        ("13", "Ghost", "Orphan", "2024-01-01", "2024-02-01", "Age 30-40, Food, USA", "728x90", "50", "5"),
    ]))
    us = normalize_users(_users(spark, [("7", "30", "Unknown", "USA", "Travel, ,Food ", "2023-05-01"),
                                        ("8", "0", "Female", "Nowhere", None, "x")]))
    # 'Ghost' is not an advertiser: drop it from the dimension inputs to exercise C18
    ca_for_dim = ca.where(F.col("advertiser_name") != "Ghost")
    adv = model.dim_advertisers(ev, ca_for_dim)
    return ev, ca, us, adv


def test_star_lookups_and_rejects(spark):
    ev, ca, us, adv = small_star(spark)
    countries = model.dim_countries(ev, us)
    interests = model.dim_interests(ev, us)
    assert [r["country_name"] for r in countries.orderBy("country_id").collect()] == ["Nowhere", "USA"]
    assert [r["interest_name"] for r in interests.orderBy("interest_id").collect()] == ["Food", "Travel"]
    camps, rejects = model.build_campaigns(ca, adv, interests, countries)
    by_id = {r["campaign_id"]: r for r in camps.collect()}
    assert set(by_id) == {10, 11, 12}
    assert by_id[11]["targeting_country_id"] == 0  # Peru unknown -> 0 (T3)
    assert by_id[12]["targeting_age_from"] is None  # 'Everyone'
    assert [r["key"] for r in rejects.collect()] == ["13"]
    resolved = model.resolve_events(ev, model.campaign_lookup(ca), countries)
    got = {r["event_id"]: (r["campaign_id"], r["location_id"]) for r in resolved.collect()}
    assert got["1"][0] == 11  # duplicate name: highest CampaignID wins (T4)
    assert got["3"] == (None, 0)  # unknown campaign and location
    imps = model.build_impressions(resolved)
    clicks = model.build_clicks(resolved)
    assert imps.count() == 2 and [tuple(r) for r in clicks.select("click_id", "impression_id").collect()] == [(1, "2")]


def test_users_and_bridge(spark):
    ev, ca, us, adv = small_star(spark)
    countries = model.dim_countries(ev, us)
    interests = model.dim_interests(ev, us)
    users = {r["user_id"]: r for r in model.build_users(us, countries).collect()}
    assert users[7]["gender"] == "Other" and users[8]["gender"] == "Female"
    pairs = model.build_users_interests(us, interests).count()
    assert pairs == 2


def test_checks(spark):
    ev, ca, us, adv = small_star(spark)
    countries = model.dim_countries(ev, us)
    users = model.build_users(us, countries)
    assert [r["user_id"] for r in quality.check_range(users, "age", ["user_id"], 1, 120).collect()] == [8]
    assert quality.check_enum(us, "gender", GENDERS, ["user_id"]).count() == 1
    assert quality.check_not_null(ev, ["ts", "campaign_name"], ["event_id"]).count() == 0
    dup = quality.check_unique(ca, ["campaign_name"]).collect()
    assert [(r["campaign_name"], r["copies"]) for r in dup] == [("Shared", 2)]
    ci = spark.createDataFrame([("a",), ("A",)], "n string")
    assert quality.check_unique(ci, ["n"]).count() == 0
    assert quality.check_unique(ci, ["n"], collation="UNICODE_CI").count() == 1
    orphans = quality.check_fk(ca.select("campaign_id", "advertiser_name"), "advertiser_name", adv,
                               "advertiser_name", ["campaign_id"])
    assert [r["campaign_id"] for r in orphans.collect()] == [13]
    docs = spark.createDataFrame([(1, [(None, 1)]), (2, [("x", 1)])], "id int, arr array<struct<a:string,b:int>>")
    assert [r["id"] for r in quality.check_array_elements(docs, "arr", ["a", "b"], ["id"]).collect()] == [1]


def test_delete_propagation(spark):
    parents = spark.createDataFrame([(1,), (2,)], "p int")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, 2)], "c int, p int")
    grand = spark.createDataFrame([(100, 10), (101, 11), (102, 12)], "g int, c int")
    kids, grandkids = quality.cascade_delete(parents.where("p = 2"), [(child, "p", "c"), (grand, "c", "g")])
    assert sorted(r["c"] for r in kids.collect()) == [10]
    assert sorted(r["g"] for r in grandkids.collect()) == [100]
    nulled = quality.set_null_delete(child, "p", parents.where("p = 2"))
    assert sorted((r["c"], r["p"]) for r in nulled.collect()) == [(10, 1), (11, None), (12, None)]
