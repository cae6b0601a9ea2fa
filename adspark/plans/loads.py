"""Load-stage jobs over the driver's tables: raw scans, cleaning, modelling, checks,
keyed writes, staged publish, report sink and the streaming counters.

Each function reads the raw bridge (``sources.bridge``) or the published clean
tables (``plans.catalog``), so its work grows with the input.  Paths for written
intermediates are fresh folders under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.functions.parsing import DEVICES, GENDERS, clean_list, coerce_enum, iso_or_epoch, list_keep_blanks, \
    zero_default
from adspark.operators import constraints, documents, merge, model, quality, rollups
from adspark.operators.clean import exact_dedup, key_dedup_first, normalize_campaigns, normalize_events, null_tokens
from adspark.plans import reports
from adspark.plans.catalog import warehouse
from adspark.plans.documents import day_sequence, document_report
from adspark.plans.rollups import wide_report
from adspark.session import scratch_path
from adspark.sources import bridge, keyed, keymap
from adspark.sources.csv import RAW_EVENT_COLUMNS, first_n, read_raw
from adspark.sources.layout import write_ordered
from adspark.sources.sinks import flatten_for_text, manifest_counts, publish_tables, upsert_partitions, write_clustered, \
    write_report, write_table


def _fresh(spark: SparkSession, what: str) -> str:
    return scratch_path(spark, f"{what}/{uuid.uuid4().hex[:12]}")


# ---- A: scans -----------------------------------------------------------------------
def csv_load_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A6: write the raw events as CSV with the columns in another order, scan them
    back as text bound by header name, then type them."""
    path = _fresh(spark, "csv")
    raw = bridge.raw_ad_events(spark, sf_dir)
    raw.select(*reversed(raw.columns)).write.option("header", True).csv(path)
    typed = normalize_events(read_raw(spark, path, RAW_EVENT_COLUMNS))
    return typed.select("event_id", "user_id", "ts", F.col("ad_cost").cast("double").alias("ad_cost"), "was_clicked")


def first_n_events(spark: SparkSession, sf_dir: str, n: int = 5000) -> DataFrame:
    """A2: the first ``n`` clean events in (timestamp, event id) order."""
    ev = warehouse(spark, sf_dir)["events_clean"].select("event_id", "ts", "user_id")
    return first_n(ev, n, ["ts", "event_id"])


# ---- C: cleaning ----------------------------------------------------------------------
def _dirty(spark, sf_dir):
    return bridge.raw_ad_events(spark, sf_dir, dirty=True)


_ID_COLS = ["EventID", "CampaignName", "UserID", "Device"]


def exact_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_dirty(spark, sf_dir)).select(*_ID_COLS)


def key_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_dedup_first(_dirty(spark, sf_dir)).select(*_ID_COLS)


def key_dedup_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 over CSV files: of events that come twice with different values the one that stands
    first in the files stays (files written in the order of a hash, copies apart)."""
    raw = _dirty(spark, sf_dir).distinct()
    copies = raw.withColumn("copy", F.explode(F.when(F.col("EventID").cast("bigint") % 7 == 0, F.array(F.lit(0), F.lit(1)))
                                              .otherwise(F.array(F.lit(0)))))
    copies = copies.withColumn("Device", F.when(F.col("copy") == 1, F.lit("Other")).otherwise(F.col("Device"))) \
        .withColumn("place", F.md5(F.concat_ws(":", "EventID", F.col("copy").cast("string"))))
    path = _fresh(spark, "copies")
    copies.repartitionByRange("place").sortWithinPartitions("place").drop("copy", "place") \
        .write.option("header", True).csv(path)
    return key_dedup_first(read_raw(spark, path, RAW_EVENT_COLUMNS, file_order=True)).select(*_ID_COLS)


def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3-C6, C15, C16 on the dirty events."""
    typed = normalize_events(_dirty(spark, sf_dir), extra={"ts_iso_or_epoch": iso_or_epoch("Timestamp")})
    return typed.select("event_id", "ts", "click_ts", F.col("ad_cost").cast("double").alias("ad_cost"),
                        zero_default(F.col("ad_cost").cast("double"), 0.0).alias("cost_or_zero"),
                        "was_clicked", "ts_iso_or_epoch")


def parse_targeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = warehouse(spark, sf_dir)["campaigns_clean"]
    return c.select("campaign_id", "age_from", "age_to", "interest", "country")


def explode_interests(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = warehouse(spark, sf_dir)["users_clean"]
    return u.select("user_id", F.explode(clean_list("interests")).alias("interest"))


def interest_array_keep_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = warehouse(spark, sf_dir)["users_clean"]
    arr = list_keep_blanks("interests")
    return u.select("user_id", F.array_join(arr, "|").alias("interests"), F.size(arr).alias("n_interests"))


def coerce_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = warehouse(spark, sf_dir)["users_clean"]
    return u.select("user_id", F.col("gender").alias("raw_gender"),
                    coerce_enum("gender", GENDERS, "Other").alias("gender"))


def _dims(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    ev, ca, us = w["events_clean"], w["campaigns_clean"], w["users_clean"]
    return w, ev, ca, us


def default_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: impression location -> country id, unknown and missing ones -> 0."""
    w, ev, ca, us = _dims(spark, sf_dir)
    countries = model.dim_countries(ev, us)
    r = model.resolve_events(bridge.dirty_clean(w, "events_clean"), model.campaign_lookup(ca), countries)
    return r.select(F.col("event_id").alias("impression_id"), "location_id")


def rejects_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an unknown campaign and campaigns with an unknown advertiser."""
    w, ev, ca, us = _dims(spark, sf_dir)
    adv = model.dim_advertisers(ev, ca)
    _, camp_rejects = model.build_campaigns(bridge.dirty_clean(w, "campaigns_clean"), adv, w["interests"], w["countries"])
    r = model.resolve_events(bridge.dirty_clean(w, "events_clean"), model.campaign_lookup(ca), w["countries"])
    ev_rejects = r.where(F.col("campaign_id").isNull()).select(
        F.lit("ad_events").alias("table"), F.col("event_id").alias("key"), F.lit("unknown campaign").alias("reason"))
    return camp_rejects.unionByName(ev_rejects)


# ---- D: modelling ---------------------------------------------------------------------
def dim_advertisers(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    return model.dim_advertisers(ev, ca)


def dim_countries(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    return model.dim_countries(ev, us)


def dim_interests(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    return model.dim_interests(ev, us)


def dim_campaigns(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    c, _ = model.build_campaigns(ca, w["advertisers"], w["interests"], w["countries"])
    return c.withColumn("budget", F.col("budget").cast("double")) \
        .withColumn("remaining_budget", F.col("remaining_budget").cast("double"))


def dim_users(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    return model.build_users(us, w["countries"])


def bridge_users_interests(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    return model.build_users_interests(us, w["interests"])


def fact_impressions(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    imp = model.build_impressions(model.resolve_events(ev, model.campaign_lookup(ca), w["countries"]))
    return imp.select(*[F.col(c).cast("double").alias(c) if c in ("bid_amount", "ad_cost", "ad_revenue") else c
                        for c in imp.columns])


def fact_clicks(spark, sf_dir):
    w, ev, ca, us = _dims(spark, sf_dir)
    return model.build_clicks(model.resolve_events(ev, model.campaign_lookup(ca), w["countries"]))


def fact_clicks_missing_flag(spark, sf_dir):
    """The clicks where a missing flag counts as clicked."""
    w, ev, ca, us = _dims(spark, sf_dir)
    r = model.resolve_events(bridge.dirty_clean(w, "events_clean"), model.campaign_lookup(ca), w["countries"])
    return model.build_clicks(r, missing_is_clicked=True)


def load_times(spark, sf_dir):
    """Rows of each star table, those without a load time, and how many loads they are from."""
    w = warehouse(spark, sf_dir)
    parts = [w[t].agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("created_at").isNull()).alias("missing"),
                      F.countDistinct("created_at").alias("loads"))
             for t in constraints.STAR if t not in ("countries", "interests")]
    return reduce(DataFrame.unionByName, parts)


# ---- E: checks ------------------------------------------------------------------------
def check_not_null(spark, sf_dir):
    """E1 on the dirty events: required time and cost."""
    typed = normalize_events(_dirty(spark, sf_dir))
    return quality.check_not_null(typed, ["ts", "ad_cost", "user_id", "campaign_name"], ["event_id"])


def check_unique(spark, sf_dir):
    """(l_orderkey, l_linenumber) as a composite key of lineitem."""
    li = bridge.read_table(spark, sf_dir, "lineitem")
    return quality.check_unique(li, ["l_orderkey", "l_linenumber"])


def check_range(spark, sf_dir):
    """User age in 1..120, targeting ages > 0, over a star that breaks them."""
    w = bridge.dirty_star(warehouse(spark, sf_dir))
    a = quality.check_range(w["users"], "age", ["user_id"], 1, 120)
    b = quality.check_range(w["campaigns"], "targeting_age_from", ["campaign_id"], 1) \
        .withColumnRenamed("campaign_id", "user_id")
    return a.unionByName(b).withColumnRenamed("user_id", "id")


def check_enum(spark, sf_dir):
    """Raw gender and device values outside their enums."""
    w = warehouse(spark, sf_dir)
    g = quality.check_enum(w["users_clean"], "gender", GENDERS, ["user_id"]) \
        .select(F.col("user_id").cast("string").alias("id"), "value", "rule")
    d = quality.check_enum(w["ad_impressions"], "device", DEVICES, ["impression_id"]) \
        .select(F.col("impression_id").alias("id"), "value", "rule")
    return g.unionByName(d)


def check_fk(spark, sf_dir):
    """E5 over a star that breaks its foreign keys."""
    w = bridge.dirty_star(warehouse(spark, sf_dir))
    parts = [
        quality.check_fk(w["users"], "country_id", w["countries"], "country_id", ["user_id"]),
        quality.check_fk(w["campaigns"], "advertiser_id", w["advertisers"], "advertiser_id", ["campaign_id"]),
        quality.check_fk(w["campaigns"], "targeting_interest_id", w["interests"], "interest_id", ["campaign_id"]),
        quality.check_fk(w["campaigns"], "targeting_country_id", w["countries"], "country_id", ["campaign_id"]),
        quality.check_fk(w["ad_impressions"], "campaign_id", w["campaigns"], "campaign_id", ["impression_id"]),
        quality.check_fk(w["ad_impressions"], "user_id", w["users"], "user_id", ["impression_id"]),
        quality.check_fk(w["ad_impressions"], "location_id", w["countries"], "country_id", ["impression_id"]),
        quality.check_fk(w["users_interests"], "user_id", w["users"], "user_id", ["user_id"]),
        quality.check_fk(w["users_interests"], "interest_id", w["interests"], "interest_id", ["user_id"]),
        quality.check_fk(w["ad_clicks"], "impression_id", w["ad_impressions"], "impression_id", ["click_id"]),
    ]
    return _union_key(parts)


def _union_key(parts):
    out = None
    for p in parts:
        k = [c for c in p.columns if c not in ("value", "rule")][0]
        p = p.select(F.col(k).cast("string").alias("id"), "value", "rule")
        out = p if out is None else out.unionByName(p)
    return out


def cascade_delete(spark, sf_dir, advertiser_id: int = 1):
    """Delete one advertiser; campaigns, impressions and clicks follow."""
    w = warehouse(spark, sf_dir)
    gone = w["advertisers"].where(F.col("advertiser_id") == advertiser_id).select("advertiser_id")
    camps, imps, clicks = quality.cascade_delete(gone, [
        (w["campaigns"], "advertiser_id", "campaign_id"),
        (w["ad_impressions"], "campaign_id", "impression_id"),
        (w["ad_clicks"], "impression_id", "click_id")])
    return camps.select(F.lit("campaigns").alias("table"), F.count(F.lit(1)).alias("rows")) \
        .unionByName(imps.select(F.lit("ad_impressions").alias("table"), F.count(F.lit(1)).alias("rows"))) \
        .unionByName(clicks.select(F.lit("ad_clicks").alias("table"), F.count(F.lit(1)).alias("rows")))


def set_null_delete(spark, sf_dir, country: str = "NATION_0"):
    """Delete one country; users keep their row with country_id NULL."""
    w = warehouse(spark, sf_dir)
    gone = w["countries"].where(F.col("country_name") == country).select("country_id")
    return quality.set_null_delete(w["users"], "country_id", gone).select("user_id", "country_id")


def check_fit(spark, sf_dir):
    """Raw event text that does not fit its typed column; names over VARCHAR(100)."""
    raw = null_tokens(exact_dedup(_dirty(spark, sf_dir)))  # blanks are missing values, not bad text
    types = {"Timestamp": "timestamp_ntz", "AdCost": "decimal(8,4)", "BidAmount": "decimal(8,4)", "UserID": "int"}
    return quality.check_fit(raw, "EventID", types, {"CampaignName": 100})


def check_array_elements(spark, sf_dir):
    """Session documents whose impressions miss a required field (every 150th has no
    campaign, every 170th no time)."""
    s = warehouse(spark, sf_dir)["ad_sessions"].withColumn("impressions", F.transform("impressions", lambda x: F.struct(
        x["impression_id"].alias("impression_id"),
        F.when(x["impression_id"].cast("bigint") % 150 != 0, x["campaign_id"]).alias("campaign_id"),
        F.when(x["impression_id"].cast("bigint") % 170 != 0, x["timestamp"]).alias("timestamp"), x["clicked"].alias("clicked"))))
    return quality.check_array_elements(s, "impressions", ["impression_id", "campaign_id", "timestamp", "clicked"],
                                        ["user_id", "device", "bucket"])


# ---- B: keyed writes, layout, publish, report -------------------------------------
def upsert_latest(spark, sf_dir):
    """The engagement log written as a day-partitioned table from a first batch,
    then a second, overlapping batch upserted into it (last write wins per
    (user_id, timestamp); only touched days are rewritten); the table is read back."""
    ev = warehouse(spark, sf_dir)["ad_events"]
    day = F.to_date("timestamp").alias("day")
    first = rollups.engagement_history(ev.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))
    second = rollups.engagement_history(ev.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")))
    path = _fresh(spark, "upsert")
    upsert_partitions(spark, path, first.select("*", day), ["user_id", "timestamp"], "day")
    upsert_partitions(spark, path, second.select("*", day), ["user_id", "timestamp"], "day")
    return spark.read.parquet(path).drop("day")


def counter_merge(spark, sf_dir):
    """Campaign-day counters from a morning batch and an afternoon batch, the
    afternoon batch delivered twice."""
    ev = warehouse(spark, sf_dir)["ad_events"]
    am = merge.tag_batch(rollups.campaign_day(ev.where(F.hour("ts") < 12)), 1)
    pm = merge.tag_batch(rollups.campaign_day(ev.where(F.hour("ts") >= 12)), 2)
    return merge.counter_merge(am.unionByName(pm).unionByName(pm), ["campaign_id", "date"], ["impressions", "clicks"])


def keyed_upsert(spark, sf_dir):
    """B4 on a stored keyed table: orders by key, three loads.  The second moves every third
    order to a partition whose name needs escaping, the third some to the null and the empty
    partition; a load that is sent twice changes nothing."""
    orders = bridge.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    root = _fresh(spark, "keyed")
    put = lambda rows, load: keyed.upsert(spark, root, rows, ["o_orderkey"], "o_orderstatus", batch_id=load)
    put(orders, "first")
    second = orders.where("o_orderkey % 3 = 0").selectExpr(
        "o_orderkey", "concat(o_orderstatus, ':/', CAST(o_orderkey % 2 AS STRING)) AS o_orderstatus", "o_totalprice + 1 AS o_totalprice")
    put(second, "second")
    put(orders.where("o_orderkey % 5 = 0").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 2 = 0 THEN '' END AS o_orderstatus", "o_totalprice + 2 AS o_totalprice"), "third")
    put(second, "second")
    return keyed.read(spark, root)


def ledger_counters(spark, sf_dir):
    """B5 on stored counters: the campaign-day counts of each six hours of the day are a
    batch; batches come out of order and the first two come again."""
    ev = warehouse(spark, sf_dir)["ad_events"]
    root = _fresh(spark, "counters")
    for part in (2, 0, 3, 2, 1, 0):
        delta = rollups.campaign_day(ev.where(F.floor(F.hour("ts") / 6) == part))
        keyed.add_counts(spark, root, f"hours-{part}", delta, ["campaign_id", "date"], ["impressions", "clicks"], "date")
    return keyed.read(spark, root)


def stable_names(spark, sf_dir):
    """D4 over three loads of growing event data: campaign names keep the number that their
    first load gave them."""
    ev = warehouse(spark, sf_dir)["events_clean"]
    root = _fresh(spark, "names")
    for until in ("2024-01-03", "2024-01-15", "2025-01-01"):
        names = ev.where(F.col("ts") < F.lit(until).cast("timestamp_ntz")).select("campaign_name")
        keymap.extend(spark, root, names, ["campaign_name"], "name_id")
    return keymap.read(spark, root).select("name_id", "campaign_name")


def stable_clicks(spark, sf_dir):
    """D5 over three loads: clicks are numbered by time within the load that brings them,
    after those of the loads before."""
    clicks = warehouse(spark, sf_dir)["ad_clicks"].select("impression_id", "click_timestamp")
    root = _fresh(spark, "clicks")
    for rest in ("CAST(impression_id AS BIGINT) % 3 = 1", "CAST(impression_id AS BIGINT) % 3 <> 2", "true"):
        keymap.extend(spark, root, clicks.where(rest), ["impression_id"], "click_id", ["click_timestamp", "impression_id"])
    return keymap.read(spark, root).select("click_id", "impression_id", "click_timestamp")


def star_violations(spark, sf_dir):
    """Every constraint of the eight tables over a star that breaks them."""
    return constraints.violations(bridge.dirty_star(warehouse(spark, sf_dir)))


def delete_graph(spark, sf_dir):
    """E6 + E7: countries, interests, advertisers and users are deleted; the rows of all eight
    tables that are left, with their references."""
    w = warehouse(spark, sf_dir)
    doomed = {name: w[name].select(key).where(f"{key} % {n} = 0") for name, key, n in
              (("countries", "country_id", 7), ("interests", "interest_id", 6), ("advertisers", "advertiser_id", 5),
               ("users", "user_id", 11))}
    after = constraints.delete_rows({name: w[name] for name in constraints.STAR}, doomed)
    listed = lambda columns: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    parts = [after[name].select(F.lit(name).alias("table"), listed(s.key).alias("key"),
                                (listed([r.column for r in s.references]) if s.references else F.lit("")).alias("refs"))
             for name, s in constraints.STAR.items()]
    return reduce(DataFrame.unionByName, parts)


def clustered_write(spark, sf_dir):
    """Region x day spend written in day partitions, clustered by region and spend, and
    read back."""
    path = _fresh(spark, "clustered")
    write_clustered(rollups.region_day_spend(warehouse(spark, sf_dir)["ad_events"]), path, ["day"],
                    [F.col("region"), F.desc("total_spend")])
    return spark.read.parquet(path).withColumn("total_spend", F.col("total_spend").cast("double"))


def ordered_lookup(spark, sf_dir, campaign_id: int, user_id: int):
    """A7 + B6: the impressions written in Z-order over campaign, user and time, and those of
    one campaign and of one user read back."""
    path = _fresh(spark, "ordered")
    imp = warehouse(spark, sf_dir)["ad_impressions"].select("impression_id", "campaign_id", "user_id", "impression_timestamp")
    write_ordered(imp, path, ["campaign_id", "user_id", "impression_timestamp"], bloom=["campaign_id", "user_id"])
    back = spark.read.parquet(path)
    return back.where(F.col("campaign_id") == campaign_id).select(F.lit("campaign").alias("of"), "*") \
        .unionByName(back.where(F.col("user_id") == user_id).select(F.lit("user").alias("of"), "*"))


def staged_publish(spark, sf_dir):
    """The star re-published from the clean tables, gated on foreign keys of the files
    written."""
    w, ev, ca, us = _dims(spark, sf_dir)
    star = model.build_star(ev, ca, us)
    checks = {
        "campaign_advertiser": lambda t: quality.check_fk(t["campaigns"], "advertiser_id", t["advertisers"], "advertiser_id",
                                                          ["campaign_id"]),
        "impression_campaign": lambda t: quality.check_fk(t["ad_impressions"], "campaign_id", t["campaigns"], "campaign_id",
                                                          ["impression_id"]),
    }
    root = _fresh(spark, "publish")
    publish_tables(spark, star.tables(), root, checks=checks)
    return manifest_counts(spark, root)


def report_sections(spark, sf_dir, start: str = "2024-01-01", end: str = "2024-01-30"):
    """B2 + B8: the SQL report written as one CSV per section; returns rows per section."""
    w = warehouse(spark, sf_dir)
    from adspark.plans import documents as H
    sections = dict(reports.sql_report(w, start, end))
    sections["All ad interactions for a sampled user"] = H.user_interactions(w["ad_sessions"])
    out = _fresh(spark, "report")
    paths = write_report(sections, out)
    parts = [spark.read.option("header", True).csv(p).select(F.lit(t).alias("section"))
             for t, p in paths.items()]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df.groupBy("section").agg(F.count(F.lit(1)).alias("rows"))


def _cells(df: DataFrame) -> F.Column:
    """A row's text: numbers with four places, anything else as it stands."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").try_cast("decimal(18,4)").cast("string"), F.col(f"`{c}`"), F.lit(""))
                              for c in df.columns])


def report_contents(spark, sf_dir, start: str, end: str, day: str, as_of: str):
    """B2 + B8: the three reports, all sections, written as CSV and read back line by line."""
    w = warehouse(spark, sf_dir)
    sections = {**reports.sql_report(w, start, end), **document_report(w["ad_sessions"], day), **wide_report(w, as_of)}
    parts = []
    for title, path in write_report(sections, _fresh(spark, "reports")).items():
        back = read_raw(spark, path)
        parts.append(back.select(F.lit(title).alias("section"), _cells(back).alias("cells")))
    return reduce(DataFrame.unionByName, parts)


def star_csv(spark, sf_dir):
    """B1: the eight star tables and the three normalised inputs written as CSV and read back
    line by line."""
    w = warehouse(spark, sf_dir)
    root, parts = _fresh(spark, "csv-star"), []
    for name in [*constraints.STAR, "events_clean", "campaigns_clean", "users_clean"]:
        df = w[name].drop("created_at")
        write_table(flatten_for_text(df), f"{root}/{name}", fmt="csv")
        back = read_raw(spark, f"{root}/{name}")
        parts.append(back.select(F.lit(name).alias("table"), _cells(back).alias("cells")))
    return reduce(DataFrame.unionByName, parts)


def session_days(spark, sf_dir):
    """H1 by day: day documents written and read back, every impression with its number in the
    user's day on the device."""
    path = _fresh(spark, "days")
    write_table(documents.build_session_days(warehouse(spark, sf_dir)["ad_events"], most=50), path, partition_by=["day"])
    return day_sequence(spark.read.parquet(path))


# ---- K: streaming ---------------------------------------------------------------------
def _campaign_of(spark, sf_dir):
    """Campaign name -> id, from the clean campaigns: of the load's tables the streams need no other."""
    return model.campaign_lookup(normalize_campaigns(bridge.raw_campaigns(spark, sf_dir)))


def stream_campaign_day(spark, sf_dir):
    """K1 + K2: the events file as a stream -> de-duplicated, windowed campaign-day
    counters (availableNow), read back as the latest row per window."""
    from adspark.streaming.counters import current_counters, run_campaign_day, events_file_stream
    run = _fresh(spark, "stream")
    q = run_campaign_day(spark, events_file_stream(spark, sf_dir), _campaign_of(spark, sf_dir),
                         run + "/out", run + "/checkpoint")
    q.awaitTermination()
    return current_counters(spark, run + "/out")


def stream_with_late(spark, sf_dir, root: str | None = None):
    """K1 + K2 without losses: events arrive in three parts, the stream runs after each.  Of the
    first ten days a tenth comes with the second part, of the days to the twentieth a tenth
    and copies of a seventh with the third; what is behind the watermark by then is in the
    late log.  Returns the counters and, by campaign and day, how many rows came late."""
    from adspark.streaming.counters import events_file_stream, read_counters, read_late, run_counted
    ev = bridge.read_table(spark, sf_dir, "events")
    lookup = _campaign_of(spark, sf_dir)
    root = root or _fresh(spark, "counted")
    first, second = "ts < TIMESTAMP_NTZ'2024-01-11'", "ts < TIMESTAMP_NTZ'2024-01-21'"
    arrivals = [f"{first} AND event_id % 10 <> 0",
                f"({first} AND event_id % 10 = 0) OR (NOT {first} AND {second} AND event_id % 10 <> 0)",
                f"(NOT {first} AND {second} AND (event_id % 10 = 0 OR event_id % 7 = 0)) OR NOT {second}"]
    for n, part in enumerate(arrivals):
        ev.where(part).write.parquet(f"{root}/in/events-{n}.parquet")
        run_counted(spark, events_file_stream(spark, f"{root}/in", files_per_batch=10_000), lookup, root).awaitTermination()
    late = (read_late(spark, root).join(lookup, "campaign_name").groupBy("campaign_id", F.to_date("ts").alias("date"))
            .agg(F.count(F.lit(1)).alias("late")))
    return (read_counters(spark, root).join(late, ["campaign_id", "date"], "full")
            .select("campaign_id", "date", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("impressions", "clicks", "late")]))
