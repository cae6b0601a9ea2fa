"""Star-schema modelling (D1-D12): dimensions with dense ids, name lookups, facts.

Dimensions are distinct names, numbered by ``keys.dense_ids`` (no global window) and
checkpointed, then joined to facts with a size-checked broadcast.  Facts never pass
through one task: impressions are a per-row projection plus broadcast lookups, clicks
a filter plus the distributed dense id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.functions.parsing import GENDERS, clean_list, coerce_enum, force_bool
from adspark.operators.keys import dense_ids, lookup_join
from adspark.session import materialize

STAR_TABLES = ["countries", "interests", "users", "advertisers", "campaigns",
               "users_interests", "ad_impressions", "ad_clicks"]


@dataclass
class Star:
    countries: DataFrame
    interests: DataFrame
    users: DataFrame
    advertisers: DataFrame
    campaigns: DataFrame
    users_interests: DataFrame
    ad_impressions: DataFrame
    ad_clicks: DataFrame
    rejects: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t) for t in STAR_TABLES}


def name_dimension(names: DataFrame, name_col: str, id_col: str, trim: bool = True) -> DataFrame:
    """Distinct, non-blank names numbered 1..n in name order."""
    n = F.trim(F.col("name")) if trim else F.col("name")
    distinct = names.select(n.alias(name_col)).where(F.col(name_col).isNotNull() & (F.col(name_col) != "")) \
        .distinct()
    dim = dense_ids(distinct, [name_col], id_col).select(F.col(id_col).cast("int").alias(id_col), name_col)
    return materialize(dim)


def dim_countries(events: DataFrame, users: DataFrame) -> DataFrame:
    """Targeting countries of events and user locations."""
    names = events.select(F.col("targeting_country").alias("name")) \
        .union(users.select(F.col("location").alias("name")))
    return name_dimension(names, "country_name", "country_id")


def dim_interests(events: DataFrame, users: DataFrame) -> DataFrame:
    """D3: targeting interests of events and every item of the users' interest lists."""
    names = events.select(F.col("targeting_interest").alias("name")) \
        .union(users.select(F.explode(clean_list("interests")).alias("name")))
    return name_dimension(names, "interest_name", "interest_id")


def dim_advertisers(events: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Advertiser names of events and campaigns."""
    names = events.select(F.col("advertiser_name").alias("name")) \
        .union(campaigns.select(F.col("advertiser_name").alias("name")))
    return name_dimension(names, "advertiser_name", "advertiser_id", trim=False)


def campaign_lookup(campaigns: DataFrame) -> DataFrame:
    """Campaign name -> campaign_id; a repeated name resolves to the highest
    CampaignID (an aggregate, so a hot name is reduced map-side)."""
    return campaigns.where(F.col("campaign_name").isNotNull() & F.col("campaign_id").isNotNull()) \
        .groupBy("campaign_name").agg(F.max("campaign_id").alias("campaign_id"))


def _id_of(dim: DataFrame, name_col: str, id_col: str, as_name: str, as_id: str) -> DataFrame:
    return dim.select(F.col(name_col).alias(as_name), F.col(id_col).alias(as_id))


def build_campaigns(campaigns: DataFrame, advertisers: DataFrame, interests: DataFrame,
                    countries: DataFrame, unknown_id: int | None = 0) -> tuple[DataFrame, DataFrame]:
    """Campaigns with advertiser, interest and country ids.

    Unknown interest / country -> ``unknown_id`` (0 as in the reference, T3; ``None``
    keeps NULL).  An unknown advertiser drops the campaign into the rejects (C18).
    """
    c = lookup_join(campaigns, _id_of(advertisers, "advertiser_name", "advertiser_id", "advertiser_name", "advertiser_id"),
                    "advertiser_name", "left")
    c = lookup_join(c, _id_of(interests, "interest_name", "interest_id", "interest", "targeting_interest_id"),
                    "interest", "left")
    c = lookup_join(c, _id_of(countries, "country_name", "country_id", "country", "targeting_country_id"),
                    "country", "left")
    default = F.lit(unknown_id).cast("int")
    good = c.where(F.col("advertiser_id").isNotNull()).select(
        "campaign_id", "advertiser_id", "campaign_name", "campaign_start_date", "campaign_end_date",
        "targeting_criteria", F.col("age_from").alias("targeting_age_from"),
        F.col("age_to").alias("targeting_age_to"),
        F.coalesce("targeting_interest_id", default).alias("targeting_interest_id"),
        F.coalesce("targeting_country_id", default).alias("targeting_country_id"),
        "ad_slot_size",
        F.coalesce("budget", F.lit(0).cast("decimal(12,2)")).alias("budget"),
        F.coalesce("remaining_budget", F.lit(0).cast("decimal(12,2)")).alias("remaining_budget"),
    )
    rejects = c.where(F.col("advertiser_id").isNull()).select(
        F.lit("campaigns").alias("table"), F.col("campaign_id").cast("string").alias("key"),
        F.lit("unknown advertiser").alias("reason"))
    return good, rejects


def build_users(users: DataFrame, countries: DataFrame, unknown_id: int | None = 0) -> DataFrame:
    """Users with gender coerced to the enum (C13) and a country id (C14)."""
    u = lookup_join(users, _id_of(countries, "country_name", "country_id", "location", "country_id"),
                    "location", "left")
    return u.select("user_id", "age", coerce_enum("gender", GENDERS, "Other").alias("gender"),
                    F.coalesce("country_id", F.lit(unknown_id).cast("int")).alias("country_id"),
                    "signup_date")


def build_users_interests(users: DataFrame, interests: DataFrame) -> DataFrame:
    """One row per (user, interest), blanks dropped, unknown names dropped."""
    pairs = users.select("user_id", F.explode(clean_list("interests")).alias("interest_name"))
    return lookup_join(pairs, interests, "interest_name", "inner").select("user_id", "interest_id").distinct()


def resolve_events(events: DataFrame, campaigns_lookup: DataFrame, countries: DataFrame,
                   advertisers: DataFrame | None = None, unknown_id: int | None = 0) -> DataFrame:
    """Attach campaign_id (by name, D6), location_id (C14) and, if given, advertiser_id.

    Rows whose campaign name is unknown keep ``campaign_id`` NULL; callers split them off
    into the rejects (C18).
    """
    e = lookup_join(events, campaigns_lookup, "campaign_name", "left")
    e = lookup_join(e, _id_of(countries, "country_name", "country_id", "location", "location_id"), "location", "left")
    e = e.withColumn("location_id", F.coalesce("location_id", F.lit(unknown_id).cast("int")))
    if advertisers is not None:
        e = lookup_join(e, _id_of(advertisers, "advertiser_name", "advertiser_id", "advertiser_name", "advertiser_id"),
                        "advertiser_name", "left")
    return e


def build_impressions(resolved: DataFrame) -> DataFrame:
    """One impression per event with a known campaign."""
    return resolved.where(F.col("campaign_id").isNotNull()).select(
        F.col("event_id").alias("impression_id"), "campaign_id", "user_id", "device", "location_id",
        F.col("ts").alias("impression_timestamp"), "bid_amount", "ad_cost", "ad_revenue")


def build_clicks(resolved: DataFrame, missing_is_clicked: bool = False) -> DataFrame:
    """D12 + D5: clicked events with a click time become clicks, numbered densely by
    (click_timestamp, impression_id).  A NULL flag counts as not clicked (T2), or with
    ``missing_is_clicked`` as clicked, as the reference's relational path reads it (C7)."""
    flag = force_bool("was_clicked") if missing_is_clicked else F.col("was_clicked")
    clicked = resolved.where(F.col("campaign_id").isNotNull() & flag
                             & F.col("click_ts").isNotNull()) \
        .select(F.col("event_id").alias("impression_id"), F.col("click_ts").alias("click_timestamp"))
    return dense_ids(clicked, ["click_timestamp", "impression_id"], "click_id") \
        .select("click_id", "impression_id", "click_timestamp")


def event_rejects(resolved: DataFrame) -> DataFrame:
    """Events whose campaign name is unknown."""
    return resolved.where(F.col("campaign_id").isNull()).select(
        F.lit("ad_events").alias("table"), F.col("event_id").alias("key"), F.lit("unknown campaign").alias("reason"))


def build_dimensions(events: DataFrame, campaigns: DataFrame, users: DataFrame, unknown_id: int | None = 0) -> dict[str, DataFrame]:
    """The star's tables without facts, and the campaigns' ``rejects``."""
    countries = dim_countries(events, users)
    interests = dim_interests(events, users)
    advertisers = dim_advertisers(events, campaigns)
    star_users = build_users(users, countries, unknown_id)
    star_campaigns, camp_rejects = build_campaigns(campaigns, advertisers, interests, countries, unknown_id)
    bridge = build_users_interests(users, interests)
    return {"countries": countries, "interests": interests, "users": star_users, "advertisers": advertisers,
            "campaigns": star_campaigns, "users_interests": bridge, "rejects": camp_rejects}


def build_star(events: DataFrame, campaigns: DataFrame, users: DataFrame, unknown_id: int | None = 0) -> Star:
    """Raw-cleaned inputs -> typed star + rejects, in the reference's dependency order."""
    dims = build_dimensions(events, campaigns, users, unknown_id)
    resolved = resolve_events(events, campaign_lookup(campaigns), dims["countries"], unknown_id=unknown_id)
    rejects = dims.pop("rejects").unionByName(event_rejects(resolved))
    return Star(**dims, ad_impressions=build_impressions(resolved), ad_clicks=build_clicks(resolved), rejects=rejects)
