"""Constraints in one pass, deletes through the whole key graph, ids that stay."""

import os

import pytest
from pyspark.sql import functions as F

from adspark.operators import constraints as C
from adspark.sources import keymap, versions


def star(spark):
    t = spark.createDataFrame
    money = "decimal(18,4)"
    imp = t([("i1", 10, 1, "Mobile", 1, "2024-01-01", 1.0, 2.0, 0.0), ("i2", 11, 2, "Watch", 9, None, 1.0, 12345.5, 0.0),
             ("i3", None, 3, None, None, "2024-01-01", None, None, None), ("i3", 10, 1, "Mobile", 2, "2024-01-02", 1.0, 1.0, 1.0)],
            "impression_id string, campaign_id int, user_id int, device string, location_id int, ts string, bid_amount double, "
            "ad_cost double, ad_revenue double")
    imp = imp.withColumn("impression_timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts")
    for c in ("bid_amount", "ad_cost", "ad_revenue"):
        imp = imp.withColumn(c, F.col(c).cast(money))
    camp = t([(10, 1, "c10", "2024-01-01", "2024-02-01", 1, 20, 1, 1, "s", 5.0, 1.0),
              (11, 1, "c10", "2024-01-01", "2024-02-01", 0, None, 7, 2, "s" * 51, 99999999999.0, 1.0),
              (12, 5, None, None, "2024-02-01", 1, 20, None, None, "s", None, None)],
             "campaign_id int, advertiser_id int, campaign_name string, campaign_start_date string, campaign_end_date string, "
             "targeting_age_from int, targeting_age_to int, targeting_interest_id int, targeting_country_id int, ad_slot_size "
             "string, budget double, remaining_budget double")
    camp = camp.withColumn("budget", F.col("budget").cast("decimal(18,2)")).withColumn("remaining_budget", F.col("remaining_budget").cast("decimal(18,2)"))
    return {
        "countries": t([(1, "A"), (2, "B"), (3, "B"), (4, "x" * 256)], "country_id int, country_name string"),
        "interests": t([(1, "I")], "interest_id int, interest_name string"),
        "users": t([(1, 20, "Male", 1), (2, 0, "?", 5), (3, None, None, None)], "user_id int, age int, gender string, country_id int"),
        "advertisers": t([(1, "adv"), (2, None)], "advertiser_id int, advertiser_name string"),
        "campaigns": camp,
        "users_interests": t([(1, 1), (1, 1), (8, 1), (2, 4)], "user_id int, interest_id int"),
        "ad_impressions": imp,
        "ad_clicks": t([(1, "i1", None), (2, "i1", "2024-01-01"), (3, "zz", "2024-01-01")],
                       "click_id int, impression_id string, ts string")
        .withColumn("click_timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts"),
    }


def test_every_rule_of_every_table(spark):
    got = sorted((r["table"], r["key"], r["rule"]) for r in C.violations(star(spark)).collect())
    assert got == sorted([
        ("countries", "B", "unique:country_name"), ("countries", "4", "length:country_name"),
        ("users", "2", "range:age"), ("users", "2", "enum:gender"), ("users", "2", "fk:country_id"),
        ("advertisers", "2", "not_null:advertiser_name"),
        ("campaigns", "1|c10", "unique:advertiser_id,campaign_name"), ("campaigns", "11", "range:targeting_age_from"),
        ("campaigns", "11", "fk:targeting_interest_id"), ("campaigns", "11", "length:ad_slot_size"), ("campaigns", "11", "type:budget"),
        ("campaigns", "12", "fk:advertiser_id"), ("campaigns", "12", "not_null:campaign_name"),
        ("campaigns", "12", "not_null:campaign_start_date"),
        ("users_interests", "1|1", "unique:user_id,interest_id"), ("users_interests", "8|1", "fk:user_id"),
        ("users_interests", "2|4", "fk:interest_id"),
        ("ad_impressions", "i2", "enum:device"), ("ad_impressions", "i2", "fk:location_id"),
        ("ad_impressions", "i2", "not_null:impression_timestamp"), ("ad_impressions", "i2", "type:ad_cost"),
        ("ad_impressions", "i3", "not_null:campaign_id"), ("ad_impressions", "i3", "unique:impression_id"),
        ("ad_clicks", "1", "not_null:click_timestamp"), ("ad_clicks", "i1", "unique:impression_id"),
        ("ad_clicks", "3", "fk:impression_id")])


def test_rules_are_counted_while_the_rows_are_written(spark, tmp_dir):
    tables = star(spark)
    rows, seen = C.observed(tables, "ad_impressions", C.STAR["ad_impressions"])
    rows.write.parquet(tmp_dir + "/t")
    counts = seen.get
    assert counts["rows"] == 4 and counts["enum:device"] == 1 and counts["fk:campaign_id"] == 0 and counts["not_null:campaign_id"] == 1
    assert spark.read.parquet(tmp_dir + "/t").count() == 4 and rows.columns == tables["ad_impressions"].columns


def test_a_table_is_scanned_once(spark):
    plan = C.row_violations(star(spark), "users", C.STAR["users"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2  # the users and their countries


def test_deletes_reach_every_table(spark):
    t = spark.createDataFrame
    after = C.delete_rows(star(spark), {"countries": t([(1,), (9,)], "country_id int"), "advertisers": t([(5,), (5,)], "advertiser_id int"),
                                        "users": t([(2,)], "user_id int"), "interests": t([(4,)], "interest_id int")})
    keys = lambda name, *cols: sorted((tuple(r) for r in after[name].select(*cols).collect()), key=repr)
    assert keys("countries", "country_id") == [(2,), (3,), (4,)]
    assert keys("users", "user_id", "country_id") == [(1, None), (3, None)]
    assert keys("campaigns", "campaign_id", "targeting_country_id", "targeting_interest_id") == \
        [(10, None, 1), (11, 2, 7), (12, None, None)]  # no advertiser 5 has been deleted
    assert keys("users_interests", "user_id", "interest_id") == [(1, 1), (1, 1), (8, 1)]
    assert keys("ad_impressions", "impression_id", "location_id") == sorted([("i1", None), ("i3", None), ("i3", 2)], key=repr)
    assert keys("ad_clicks", "click_id") == [(1,), (2,), (3,)]
    after = C.delete_rows(star(spark), {"advertisers": t([(1,)], "advertiser_id int")})
    assert keys("campaigns", "campaign_id") == [(12,)]
    assert keys("ad_impressions", "impression_id") == [("i3",)] and keys("ad_clicks", "click_id") == [(3,)]  # zz has no parent


def test_ids_stay_over_three_loads(spark, tmp_dir):
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    got = lambda df: {r["name"]: r["id"] for r in df.collect()}
    assert got(keymap.extend(spark, tmp_dir, names("m", "c", "c", None), ["name"], "id")) == {"c": 1, "m": 2}
    assert got(keymap.extend(spark, tmp_dir, names("a", "z", "m"), ["name"], "id")) == {"c": 1, "m": 2, "a": 3, "z": 4}
    assert got(keymap.extend(spark, tmp_dir, names("z", "b"), ["name"], "id")) == {"c": 1, "m": 2, "a": 3, "z": 4, "b": 5}
    assert got(keymap.extend(spark, tmp_dir, names(), ["name"], "id")) == got(keymap.read(spark, tmp_dir))


def test_a_dying_load_gives_no_ids(spark, tmp_dir, monkeypatch):
    rows = spark.createDataFrame([("b", 2), ("a", 3)], "name string, at int")
    keymap.extend(spark, tmp_dir, rows, ["name"], "id", ["at", "name"])
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *x: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            keymap.extend(spark, tmp_dir, rows.union(spark.createDataFrame([("d", 1)])), ["name"], "id", ["at", "name"])
    more = spark.createDataFrame([("c", 5), ("a", 1), ("x", 4)], "name string, at int")
    got = {r["name"]: (r["id"], r["at"]) for r in keymap.extend(spark, tmp_dir, more, ["name"], "id", ["at", "name"]).collect()}
    assert got == {"b": (1, 2), "a": (2, 3), "x": (3, 4), "c": (4, 5)}


def test_parts_of_a_map_are_merged(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(keymap, "MOST_PARTS", 2)
    for n in range(4):
        keymap.extend(spark, tmp_dir, spark.createDataFrame([(f"n{n}",)], "name string"), ["name"], "id")
    _, content = versions.newest(spark, tmp_dir)
    assert len(content["parts"]) <= 2 and content["high"] == 4
    assert sorted(map(tuple, keymap.read(spark, tmp_dir).collect())) == [(f"n{n}", n + 1) for n in range(4)]
    versions.expire(spark, tmp_dir, 1)
    assert len(os.listdir(tmp_dir + "/parts")) == len(content["parts"]) and keymap.read(spark, tmp_dir).count() == 4
