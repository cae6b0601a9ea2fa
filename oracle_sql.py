"""DuckDB spellings of every registered query (the correctness oracle).

The CTEs below re-derive, in plain SQL over the driver's tables, what the Spark side
builds through the raw bridge, cleaning and star modelling: campaigns from ``part``,
impressions and clicks from ``events``, users from ``customer``.  Dense ids are
``row_number()`` over the name order; ratios use the same integer rounding.
"""

from __future__ import annotations

from adspark.sources.bridge import DIRTY_CLEAN, DIRTY_STAR  # the inputs' definition, not the engine's work

START, END, AS_OF, DAY = "2024-01-01", "2024-01-30", "2024-01-30", "2024-01-11"
ONE = {"campaign_id": 11, "advertiser_id": 3, "user_id": 7}  # of the lookups by id


def rr(num: str, den: str, digits: int = 2) -> str:
    """round(num/den, digits), half away from zero, through integer division."""
    s = 10 ** digits
    return (f"(CASE WHEN ({den}) > 0 THEN sign({num}) * ((abs({num}) * {2 * s} + ({den})) // (2 * ({den})))"
            f" / {float(s)}::DOUBLE END)")


def units(total: str) -> str:
    return f"CAST(({total}) * 10000 AS BIGINT)"


BASE = f"""
bc AS (
  SELECT CAST(p_partkey + 1 AS INTEGER) AS campaign_id, 'Campaign_' || CAST(p_partkey + 1 AS VARCHAR) AS campaign_name,
         p_brand AS advertiser_name, CAST(p_retailprice AS DECIMAL(12,2)) AS budget,
         CAST(round(p_retailprice * (p_partkey % 10) / 10, 2) AS DECIMAL(12,2)) AS remaining_budget,
         p_type AS interest, 'NATION_' || CAST(p_partkey % 25 AS VARCHAR) AS country, p_size,
         CAST(DATE '2024-01-01' + CAST(p_partkey % 10 AS INTEGER) AS DATE) AS start_date,
         CAST(DATE '2024-01-01' + CAST(p_partkey % 10 AS INTEGER) + CAST(p_size + 30 AS INTEGER) AS DATE) AS end_date,
         'Age ' || CAST(p_size AS VARCHAR) || '-' || CAST(p_size + 10 AS VARCHAR) || ', ' || p_type || ', NATION_'
           || CAST(p_partkey % 25 AS VARCHAR) AS targeting_criteria,
         CASE p_size % 3 WHEN 0 THEN '300x250' WHEN 1 THEN '728x90' ELSE '160x600' END AS ad_slot_size
  FROM part),
bu AS (
  SELECT CAST(c_custkey AS INTEGER) AS user_id, CAST(18 + c_custkey % 60 AS INTEGER) AS age,
         CASE c_custkey % 6 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Non-Binary' WHEN 3 THEN 'Other'
              WHEN 4 THEN 'Prefer not to say' ELSE 'Unknown' END AS raw_gender,
         n_name AS location, c_mktsegment || ', , ' || lower(c_mktsegment) AS interests,
         CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
be AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, e.event_id AS eid, CAST(json_extract(e.props, '$.k') AS BIGINT) AS k,
         CAST(e.user_id AS INTEGER) AS user_id,
         CASE e.event_id % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Desktop' ELSE 'Tablet' END AS device,
         n.n_name AS location, e.ts, e.event_type = 'click' AS was_clicked,
         CASE WHEN e.event_type = 'click' THEN e.ts + INTERVAL 30 SECOND END AS click_ts,
         CAST(e.value * 2 AS DECIMAL(8,4)) AS bid_amount,
         CAST(e.value AS DECIMAL(8,4)) AS ad_cost,
         CASE WHEN e.event_type = 'click' THEN CAST(round(e.value * 1.2, 2) AS DECIMAL(8,4)) ELSE CAST(0 AS DECIMAL(8,4)) END AS ad_revenue
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
ev AS (
  SELECT be.*, bc.campaign_id, bc.campaign_name, bc.advertiser_name, bc.interest AS campaign_interest,
         bc.country AS campaign_location
  FROM be LEFT JOIN bc ON bc.campaign_id = be.k + 1),
countries AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS country_id, name AS country_name FROM (
    SELECT DISTINCT trim(x) AS name FROM (SELECT campaign_location AS x FROM ev UNION ALL SELECT location FROM bu)
    WHERE trim(x) <> '')),
interests AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS interest_id, name AS interest_name FROM (
    SELECT DISTINCT trim(x) AS name FROM (
      SELECT campaign_interest AS x FROM ev
      UNION ALL SELECT unnest(string_split(interests, ',')) FROM bu)
    WHERE trim(x) <> '')),
advertisers AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS advertiser_id, name AS advertiser_name FROM (
    SELECT DISTINCT x AS name FROM (SELECT advertiser_name AS x FROM ev UNION ALL SELECT advertiser_name FROM bc)
    WHERE x IS NOT NULL)),
campaigns AS (
  SELECT bc.campaign_id, a.advertiser_id, bc.campaign_name, bc.start_date AS campaign_start_date,
         bc.end_date AS campaign_end_date, bc.targeting_criteria, bc.ad_slot_size, bc.budget, bc.remaining_budget,
         CAST(bc.p_size AS INTEGER) AS targeting_age_from, CAST(bc.p_size + 10 AS INTEGER) AS targeting_age_to,
         coalesce(i.interest_id, 0) AS targeting_interest_id, coalesce(c.country_id, 0) AS targeting_country_id
  FROM bc JOIN advertisers a ON a.advertiser_name = bc.advertiser_name
  LEFT JOIN interests i ON i.interest_name = bc.interest LEFT JOIN countries c ON c.country_name = bc.country),
ad_impressions AS (
  SELECT ev.event_id AS impression_id, ev.campaign_id, ev.user_id, ev.device,
         coalesce(c.country_id, 0) AS location_id, ev.ts AS impression_timestamp, ev.bid_amount, ev.ad_cost, ev.ad_revenue
  FROM ev LEFT JOIN countries c ON c.country_name = ev.location WHERE ev.campaign_id IS NOT NULL),
ad_clicks AS (
  SELECT row_number() OVER (ORDER BY click_ts, event_id) AS click_id, event_id AS impression_id, click_ts AS click_timestamp
  FROM ev WHERE was_clicked AND click_ts IS NOT NULL AND campaign_id IS NOT NULL),
users AS (
  SELECT user_id, age, CASE WHEN raw_gender IN ('Male','Female','Non-Binary','Other','Prefer not to say')
         THEN raw_gender ELSE 'Other' END AS gender, coalesce(c.country_id, 0) AS country_id, signup_date
  FROM bu LEFT JOIN countries c ON c.country_name = bu.location),
evx AS (
  SELECT ev.*, a.advertiser_id FROM ev LEFT JOIN advertisers a ON a.advertiser_name = ev.advertiser_name)
"""


def q(body: str) -> str:
    """BASE CTEs + body; a body starting with ',' adds CTEs of its own first."""
    return "WITH " + BASE + body


def W(col: str = "i.impression_timestamp") -> str:
    return f"{col} BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


ORACLE: dict[str, str] = {}

ORACLE["top_campaigns_ctr"] = q(f"""
SELECT c.campaign_id, c.campaign_name, COUNT(DISTINCT i.impression_id) AS impressions, COUNT(k.click_id) AS clicks,
       {rr('COUNT(k.click_id) * 100', 'COUNT(DISTINCT i.impression_id)')} AS ctr_percentage
FROM campaigns c JOIN ad_impressions i ON c.campaign_id = i.campaign_id
LEFT JOIN ad_clicks k ON i.impression_id = k.impression_id
WHERE {W()} GROUP BY c.campaign_id, c.campaign_name ORDER BY ctr_percentage DESC, c.campaign_id LIMIT 5""")

ORACLE["advertiser_spend"] = q(f"""
SELECT a.advertiser_id, a.advertiser_name, CAST(round(SUM(CAST(i.ad_cost AS DECIMAL(18,4))), 2) AS DOUBLE) AS total_spent
FROM advertisers a JOIN campaigns c ON a.advertiser_id = c.advertiser_id JOIN ad_impressions i ON c.campaign_id = i.campaign_id
WHERE {W()} GROUP BY a.advertiser_id, a.advertiser_name""")

ORACLE["campaign_cpc_cpm"] = q(f"""
SELECT c.campaign_id, c.campaign_name,
       {rr(units('SUM(CAST(i.ad_cost AS DECIMAL(18,4)))'), 'COUNT(k.click_id) * 10000')} AS avg_cpc,
       {rr(units('SUM(CAST(i.ad_cost AS DECIMAL(18,4)))'), 'COUNT(i.impression_id) * 10')} AS avg_cpm
FROM campaigns c JOIN ad_impressions i ON c.campaign_id = i.campaign_id
LEFT JOIN ad_clicks k ON i.impression_id = k.impression_id
WHERE {W()} GROUP BY c.campaign_id, c.campaign_name""")

ORACLE["top_locations_revenue"] = q(f"""
SELECT co.country_name AS user_location, CAST(round(SUM(CAST(i.ad_revenue AS DECIMAL(18,4))), 2) AS DOUBLE) AS total_revenue
FROM ad_impressions i JOIN ad_clicks k ON i.impression_id = k.impression_id
LEFT JOIN countries co ON co.country_id = i.location_id
WHERE {W()} GROUP BY co.country_name ORDER BY total_revenue DESC, user_location NULLS LAST LIMIT 10""")

ORACLE["top_users_clicks"] = q(f"""
SELECT u.user_id, COUNT(k.click_id) AS total_clicks
FROM users u JOIN ad_impressions i ON u.user_id = i.user_id JOIN ad_clicks k ON i.impression_id = k.impression_id
WHERE {W('k.click_timestamp')} GROUP BY u.user_id ORDER BY total_clicks DESC, u.user_id LIMIT 10""")

_B = "CAST(budget * 100 AS BIGINT)"
_R = "CAST(remaining_budget * 100 AS BIGINT)"
ORACLE["budget_spent"] = q(f"""
SELECT campaign_id, campaign_name, CAST(budget AS DOUBLE) AS budget, CAST(remaining_budget AS DOUBLE) AS remaining_budget,
       {rr(f'({_B} - {_R}) * 100', _B)} AS percent_spent
FROM campaigns WHERE {_B} > 0 AND ({_B} - {_R}) * 100 >= {_B} * 80""")

ORACLE["device_ctr"] = q(f"""
SELECT i.device, COUNT(DISTINCT i.impression_id) AS impressions, COUNT(k.click_id) AS clicks,
       {rr('COUNT(k.click_id) * 100', 'COUNT(DISTINCT i.impression_id)')} AS ctr_percentage
FROM ad_impressions i LEFT JOIN ad_clicks k ON i.impression_id = k.impression_id
WHERE {W()} GROUP BY i.device""")

ORACLE["campaign_performance"] = q(f"""
SELECT i.campaign_id, COUNT(DISTINCT i.impression_id) AS impressions, COUNT(DISTINCT k.click_id) AS clicks,
       coalesce({rr('COUNT(DISTINCT k.click_id) * 100', 'COUNT(DISTINCT i.impression_id)', 4)}, 0.0) AS ctr,
       CAST(SUM(CAST(i.ad_cost AS DECIMAL(18,4))) AS DOUBLE) AS ad_spend
FROM ad_impressions i LEFT JOIN ad_clicks k ON i.impression_id = k.impression_id GROUP BY i.campaign_id""")

ORACLE["advertiser_total_spend"] = q("""
SELECT c.advertiser_id, CAST(SUM(CAST(i.ad_cost AS DECIMAL(18,4))) AS DOUBLE) AS ad_spend
FROM ad_impressions i JOIN campaigns c ON c.campaign_id = i.campaign_id GROUP BY c.advertiser_id""")

ORACLE["user_engagements"] = q("""
SELECT i.user_id, c.advertiser_id, i.campaign_id, i.impression_id, k.click_id,
       i.impression_timestamp AS impression_time, k.click_timestamp AS click_time
FROM ad_impressions i JOIN ad_clicks k ON i.impression_id = k.impression_id JOIN campaigns c ON c.campaign_id = i.campaign_id
ORDER BY click_time DESC, k.click_id""")

# ---- I: rollups and their questions -------------------------------------------------
_I1 = """SELECT campaign_id, CAST(ts AS DATE) AS date, COUNT(was_clicked) AS impressions,
       CAST(coalesce(SUM(CAST(was_clicked AS INTEGER)), 0) AS BIGINT) AS clicks
FROM evx WHERE campaign_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL"""
_I2 = """SELECT CAST(ts AS DATE) AS day, user_id, COUNT(was_clicked) AS impressions,
       CAST(coalesce(SUM(CAST(was_clicked AS INTEGER)), 0) AS BIGINT) AS clicks
FROM evx WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL"""
_SPEND = "SUM(CAST(ad_cost AS DECIMAL(18,4)))"
_I3 = f"""SELECT CAST(ts AS DATE) AS day, advertiser_id, advertiser_name, {_SPEND} AS total_spend
FROM evx WHERE advertiser_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL"""
_I4 = f"""SELECT location AS region, advertiser_id, advertiser_name, {_SPEND} AS total_spend
FROM evx WHERE advertiser_id IS NOT NULL AND location IS NOT NULL GROUP BY ALL"""
_I5 = f"""SELECT location AS region, CAST(ts AS DATE) AS day, advertiser_id, advertiser_name, {_SPEND} AS total_spend
FROM evx WHERE advertiser_id IS NOT NULL AND location IS NOT NULL AND ts IS NOT NULL GROUP BY ALL"""
_I6 = """SELECT user_id, ts AS timestamp, advertiser_id, campaign_id,
       CASE WHEN coalesce(was_clicked, false) THEN 'click' ELSE 'impression' END AS action
FROM evx WHERE user_id IS NOT NULL AND ts IS NOT NULL AND campaign_id IS NOT NULL AND advertiser_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1"""


def _dbl(sql: str, col: str = "total_spend") -> str:
    return f"SELECT * REPLACE (CAST({col} AS DOUBLE) AS {col}) FROM ({sql})"


ORACLE["campaign_day"] = q(_I1)
ORACLE["user_day"] = q(_I2)
ORACLE["advertiser_day"] = q(_dbl(_I3))
ORACLE["region_spend"] = q(_dbl(_I4))
ORACLE["region_day_spend"] = q(_dbl(_I5))
ORACLE["engagement_history"] = q(_I6)
ORACLE["campaign_day_ctr"] = q(f"""SELECT campaign_id, date, impressions, clicks,
       coalesce({rr('clicks * 100', 'impressions')}, 0.0) AS ctr FROM ({_I1})""")
_LO = f"DATE '{AS_OF}' - INTERVAL 30 DAY"
ORACLE["top_advertisers_31d"] = q(f"""SELECT advertiser_id, CAST(round(SUM(total_spend), 2) AS DOUBLE) AS total_spend
FROM ({_I3}) WHERE day BETWEEN {_LO} AND DATE '{AS_OF}' GROUP BY advertiser_id
ORDER BY total_spend DESC, advertiser_id LIMIT 5""")
ORACLE["top_users_31d"] = q(f"""SELECT user_id, CAST(SUM(clicks) AS BIGINT) AS clicks
FROM ({_I2}) WHERE day BETWEEN {_LO} AND DATE '{AS_OF}' GROUP BY user_id ORDER BY clicks DESC, user_id LIMIT 10""")
ORACLE["top_region_advertisers"] = q(f"""SELECT * FROM (
  SELECT region, advertiser_id, total_spend,
         CAST(row_number() OVER (PARTITION BY region ORDER BY total_spend DESC, advertiser_id) AS INTEGER) AS rank
  FROM (SELECT region, advertiser_id, CAST(round(SUM(total_spend), 2) AS DOUBLE) AS total_spend
        FROM ({_I5}) WHERE day BETWEEN {_LO} AND DATE '{AS_OF}' GROUP BY region, advertiser_id))
WHERE rank <= 5""")
ORACLE["last_ads_seen"] = q(f""", hist AS ({_I6}),
recent AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC) AS r FROM hist QUALIFY r <= 50),
clicked AS (SELECT DISTINCT user_id, campaign_id FROM recent WHERE action = 'click')
SELECT x.user_id, x.rank, x.timestamp, x.campaign_id, x.advertiser_id,
       CASE WHEN c.user_id IS NOT NULL THEN 'Yes' ELSE 'No' END AS clicked
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY r) AS INTEGER) AS rank FROM recent WHERE action = 'impression') x
LEFT JOIN clicked c ON c.user_id = x.user_id AND c.campaign_id = x.campaign_id
WHERE x.rank <= 10""")



def _asof(daily: str, keys: str, total: str) -> str:
    """Totals of the 31 days that end with each day from the first to the last."""
    return f"""SELECT CAST(a.d AS DATE) AS as_of, {keys}, {total} AS total FROM (
      SELECT unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM ({daily})) a
      JOIN ({daily}) t ON t.day BETWEEN a.d - INTERVAL 30 DAY AND a.d GROUP BY a.d, {keys}"""


def _top_asof(totals: str, id_col: str, k: int, within: str = "") -> str:
    return f"""SELECT as_of, {within} rank, {id_col}, total FROM (SELECT *, CAST(row_number() OVER (
      PARTITION BY {within} as_of ORDER BY total DESC, {id_col}) AS INTEGER) AS rank FROM ({totals})) WHERE rank <= {k}"""


_CENTS = "CAST(round(SUM(total_spend), 2) AS DOUBLE)"
ORACLE["top_advertisers_asof"] = q(_top_asof(_asof(_I3, "advertiser_id", _CENTS), "advertiser_id", 5))
ORACLE["top_users_asof"] = q(_top_asof(_asof(_I2, "user_id", "CAST(SUM(clicks) AS BIGINT)"), "user_id", 10))
ORACLE["top_region_asof"] = q(_top_asof(_asof(_I5, "region, advertiser_id", _CENTS), "advertiser_id", 5, "region,"))

# H: documents ------------------------------------------------------------------------
_DOC = "(SELECT * FROM evx WHERE user_id IS NOT NULL AND campaign_id IS NOT NULL)"
ORACLE["ad_sessions"] = q(f"""SELECT user_id, device, min(ts) AS session_start, max(ts) AS session_end,
       COUNT(*) AS impressions, COUNT(*) FILTER (WHERE coalesce(was_clicked, false)) AS clicks,
       COUNT(click_ts) AS click_events, CAST(SUM(CAST(ad_cost AS DECIMAL(18,4))) AS DOUBLE) AS ad_cost
FROM {_DOC} GROUP BY user_id, device""")
ORACLE["user_documents"] = q("""SELECT user_id, age, raw_gender AS gender, location,
       CASE WHEN interests IS NULL OR trim(interests) = '' THEN ''
            ELSE array_to_string(list_transform(string_split(interests, ','), lambda x: trim(x)), '|') END AS interests,
       CASE WHEN interests IS NULL OR trim(interests) = '' THEN 0 ELSE CAST(len(string_split(interests, ',')) AS INTEGER) END AS n_interests,
       CAST(signup_date AS TIMESTAMP) AS signup_date, 0 AS total_impressions, 0 AS total_clicks FROM bu""")
ORACLE["user_interactions"] = q(f"""SELECT user_id, event_id AS impression_id, campaign_id, campaign_interest,
       campaign_location, campaign_name, advertiser_id, ts AS timestamp, location,
       CAST(bid_amount AS DOUBLE) AS bid_amount, CAST(ad_cost AS DOUBLE) AS ad_cost, CAST(ad_revenue AS DOUBLE) AS ad_revenue,
       coalesce(was_clicked, false) AS clicked, click_ts AS click_timestamp
FROM {_DOC} WHERE user_id = (
  SELECT user_id FROM (SELECT DISTINCT user_id, device FROM {_DOC})
  ORDER BY md5(concat_ws(':', CAST(user_id AS VARCHAR), device, '0')), user_id, device LIMIT 1)""")
ORACLE["last_sessions"] = q(f"""SELECT user_id, device, rank, session_start, session_end, clicks FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY session_end DESC, device) AS INTEGER) AS rank FROM (
    SELECT user_id, device, min(ts) AS session_start, max(ts) AS session_end,
           COUNT(*) FILTER (WHERE coalesce(was_clicked, false)) AS clicks FROM {_DOC} GROUP BY user_id, device))
WHERE rank <= 5""")
ORACLE["clicks_per_hour"] = q(f"""SELECT advertiser_id, campaign_id, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS clicks
FROM {_DOC} WHERE coalesce(was_clicked, false) AND ts >= TIMESTAMP '{DAY}' AND ts < TIMESTAMP '{DAY}' + INTERVAL 1 DAY
GROUP BY ALL""")
ORACLE["repeated_no_click"] = q(f"""SELECT user_id, campaign_id, COUNT(*) AS impressions FROM {_DOC}
GROUP BY user_id, campaign_id HAVING COUNT(*) >= 5 AND NOT bool_or(coalesce(was_clicked, false))""")
ORACLE["top_categories"] = q(f"""SELECT * FROM (
  SELECT user_id, category, clicks, CAST(row_number() OVER (PARTITION BY user_id ORDER BY clicks DESC, category) AS INTEGER) AS rank
  FROM (SELECT user_id, coalesce(campaign_interest, 'Unknown') AS category, COUNT(*) AS clicks
        FROM {_DOC} WHERE coalesce(was_clicked, false) GROUP BY ALL)) WHERE rank <= 3""")
ORACLE["top_categories_unknown"] = ORACLE["top_categories"].replace(
    "coalesce(campaign_interest, 'Unknown')", "CASE WHEN campaign_id % 5 = 0 THEN 'Unknown' ELSE coalesce(campaign_interest, 'Unknown') END")


# ---- A, C, D: scans, cleaning, modelling ------------------------------------------------
_TYPED = """SELECT CAST(e.event_id AS VARCHAR) AS event_id, CAST(e.user_id AS INTEGER) AS user_id, e.ts,
       CAST(CAST(e.value AS DECIMAL(8,4)) AS DOUBLE) AS ad_cost, e.event_type = 'click' AS was_clicked FROM events e"""
ORACLE["csv_load_by_header"] = _TYPED
ORACLE["first_n_events"] = q("SELECT event_id, ts, user_id FROM ev ORDER BY ts, event_id LIMIT 5000")
_DIRTY = """, dirty AS (
  SELECT event_id AS EventID, 'Campaign_' || CAST(k + 1 AS VARCHAR) AS CampaignName, CAST(user_id AS VARCHAR) AS UserID,
         device AS Device FROM be
  UNION ALL
  SELECT event_id, 'Campaign_' || CAST(k + 1 AS VARCHAR), CAST(user_id AS VARCHAR), device FROM be WHERE eid % 50 = 0)
"""
ORACLE["exact_dedup"] = q(_DIRTY + "SELECT DISTINCT * FROM dirty")
ORACLE["key_dedup_first"] = q(_DIRTY + "SELECT * FROM dirty QUALIFY row_number() OVER (PARTITION BY EventID) = 1")
ORACLE["key_dedup_file_order"] = q("""SELECT EventID, CampaignName, UserID, Device FROM (
  SELECT event_id AS EventID, 'Campaign_' || CAST(k + 1 AS VARCHAR) AS CampaignName, CAST(user_id AS VARCHAR) AS UserID,
         CASE WHEN copy = 1 THEN 'Other' ELSE device END AS Device,
         row_number() OVER (PARTITION BY event_id ORDER BY md5(event_id || ':' || CAST(copy AS VARCHAR))) AS r
  FROM be, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR eid % 7 = 0) WHERE r = 1""")
ORACLE["lenient_casts"] = q("""SELECT event_id, CASE WHEN eid % 89 = 0 THEN NULL ELSE ts END AS ts, click_ts,
       CASE WHEN eid % 97 = 0 THEN NULL ELSE CAST(ad_cost AS DOUBLE) END AS ad_cost,
       CASE WHEN eid % 97 = 0 THEN 0.0 ELSE CAST(ad_cost AS DOUBLE) END AS cost_or_zero,
       was_clicked, CASE WHEN eid % 89 = 0 THEN NULL ELSE ts END AS ts_iso_or_epoch FROM be""")
ORACLE["parse_targeting"] = q("""SELECT campaign_id, CAST(p_size AS INTEGER) AS age_from, CAST(p_size + 10 AS INTEGER) AS age_to,
       interest, country FROM bc""")
ORACLE["explode_interests"] = q("""SELECT user_id, trim(x) AS interest FROM (
  SELECT user_id, unnest(string_split(interests, ',')) AS x FROM bu) WHERE trim(x) <> ''""")
ORACLE["interest_array_keep_blanks"] = q("""SELECT user_id,
       CASE WHEN interests IS NULL OR trim(interests) = '' THEN ''
            ELSE array_to_string(list_transform(string_split(interests, ','), lambda x: trim(x)), '|') END AS interests,
       CASE WHEN interests IS NULL OR trim(interests) = '' THEN 0 ELSE CAST(len(string_split(interests, ',')) AS INTEGER) END AS n_interests
FROM bu""")
_GENDERS = "('Male', 'Female', 'Non-Binary', 'Other', 'Prefer not to say')"
ORACLE["coerce_gender"] = q(f"""SELECT user_id, raw_gender,
       CASE WHEN raw_gender IN {_GENDERS} THEN raw_gender ELSE 'Other' END AS gender FROM bu""")
_DIRTY_EV = f"""dev AS (SELECT event_id, eid, k, user_id, click_ts, {", ".join(
    f"{sql} AS {c}" for c, sql in DIRTY_CLEAN["events_clean"].items())}
  FROM (SELECT be.*, bc.campaign_name FROM be LEFT JOIN bc ON bc.campaign_id = be.k + 1))"""
_DIRTY_CA = f"""dca AS (SELECT campaign_id, {DIRTY_CLEAN["campaigns_clean"]["advertiser_name"]} AS advertiser_name FROM bc)"""
ORACLE["default_lookup"] = q(f""", {_DIRTY_EV}
SELECT event_id AS impression_id, coalesce(c.country_id, 0) AS location_id FROM dev LEFT JOIN countries c ON c.country_name = dev.location""")
ORACLE["rejects_unmatched"] = q(f""", {_DIRTY_EV}, {_DIRTY_CA}
SELECT 'ad_events' AS "table", event_id AS key, 'unknown campaign' AS reason FROM dev
WHERE campaign_name IS NULL OR campaign_name NOT IN (SELECT campaign_name FROM bc)
UNION ALL SELECT 'campaigns', CAST(campaign_id AS VARCHAR), 'unknown advertiser' FROM dca
WHERE advertiser_name NOT IN (SELECT advertiser_name FROM advertisers)""")
ORACLE["fact_clicks_missing_flag"] = q(f""", {_DIRTY_EV}
SELECT row_number() OVER (ORDER BY click_ts, event_id) AS click_id, event_id AS impression_id, click_ts AS click_timestamp
FROM dev WHERE coalesce(was_clicked, true) AND click_ts IS NOT NULL AND campaign_name IN (SELECT campaign_name FROM bc)""")
ORACLE["load_times"] = q(""", users_interests AS (SELECT DISTINCT x.user_id, i.interest_id FROM (
  SELECT user_id, trim(unnest(string_split(interests, ','))) AS name FROM bu) x JOIN interests i ON i.interest_name = x.name)
""" + " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS rows, CAST(0 AS BIGINT) AS missing, CAST(1 AS BIGINT) AS loads FROM {t}"""
                         for t in ("users", "advertisers", "campaigns", "users_interests", "ad_impressions", "ad_clicks")))
ORACLE["dim_advertisers"] = q("SELECT * FROM advertisers")
ORACLE["dim_countries"] = q("SELECT * FROM countries")
ORACLE["dim_interests"] = q("SELECT * FROM interests")
ORACLE["dim_campaigns"] = q("""SELECT campaign_id, advertiser_id, campaign_name, campaign_start_date, campaign_end_date,
       targeting_criteria, targeting_age_from, targeting_age_to, targeting_interest_id, targeting_country_id, ad_slot_size,
       CAST(budget AS DOUBLE) AS budget, CAST(remaining_budget AS DOUBLE) AS remaining_budget FROM campaigns""")
ORACLE["dim_users"] = q("SELECT * FROM users")
ORACLE["bridge_users_interests"] = q("""SELECT DISTINCT x.user_id, i.interest_id FROM (
  SELECT user_id, trim(unnest(string_split(interests, ','))) AS name FROM bu) x JOIN interests i ON i.interest_name = x.name""")
ORACLE["fact_impressions"] = q("""SELECT impression_id, campaign_id, user_id, device, location_id, impression_timestamp,
       CAST(bid_amount AS DOUBLE) AS bid_amount, CAST(ad_cost AS DOUBLE) AS ad_cost, CAST(ad_revenue AS DOUBLE) AS ad_revenue
FROM ad_impressions""")
ORACLE["fact_clicks"] = q("SELECT * FROM ad_clicks")

# ---- E: checks ------------------------------------------------------------------------
ORACLE["check_not_null"] = q("""SELECT event_id, 'not_null:ts' AS rule FROM be WHERE eid % 89 = 0
UNION ALL SELECT event_id, 'not_null:ad_cost' FROM be WHERE eid % 97 = 0""")
ORACLE["check_unique"] = """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies, 'unique:l_orderkey,l_linenumber' AS rule
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""
ORACLE["check_enum"] = q(f"""SELECT CAST(user_id AS VARCHAR) AS id, raw_gender AS value, 'enum:gender' AS rule FROM bu
WHERE raw_gender NOT IN {_GENDERS}
UNION ALL SELECT impression_id, device, 'enum:device' FROM ad_impressions
WHERE device NOT IN ('Mobile', 'Desktop', 'Tablet', 'Other')""")
ORACLE["cascade_delete"] = q("""SELECT 'campaigns' AS "table", COUNT(*) AS rows FROM campaigns WHERE advertiser_id <> 1
UNION ALL SELECT 'ad_impressions', COUNT(*) FROM ad_impressions
  WHERE campaign_id NOT IN (SELECT campaign_id FROM campaigns WHERE advertiser_id = 1)
UNION ALL SELECT 'ad_clicks', COUNT(*) FROM ad_clicks WHERE impression_id NOT IN (
  SELECT impression_id FROM ad_impressions WHERE campaign_id IN (SELECT campaign_id FROM campaigns WHERE advertiser_id = 1))""")
ORACLE["set_null_delete"] = q("""SELECT user_id, CASE WHEN country_id IN (
  SELECT country_id FROM countries WHERE country_name = 'NATION_0') THEN NULL ELSE country_id END AS country_id FROM users""")
ORACLE["check_fit"] = """SELECT CAST(event_id AS VARCHAR) AS EventID, 'bad' AS value, 'type:Timestamp' AS rule
FROM events WHERE event_id % 89 = 0"""
ORACLE["check_array_elements"] = q(f"""SELECT user_id, device, 0 AS bucket, 'elements:impressions' AS rule
FROM {_DOC} WHERE eid % 150 = 0 OR eid % 170 = 0 OR ts IS NULL GROUP BY user_id, device""")

# ---- B, K: keyed writes, layout, publish, streaming ---------------------------------------
ORACLE["upsert_latest"] = q(_I6)
ORACLE["counter_merge"] = q(_I1)
ORACLE["clustered_write"] = q(f"""SELECT region, advertiser_id, advertiser_name, CAST(total_spend AS DOUBLE) AS total_spend, day
FROM ({_I5})""")
ORACLE["ordered_lookup"] = q(f"""SELECT 'campaign' AS "of", impression_id, campaign_id, user_id, impression_timestamp
FROM ad_impressions WHERE campaign_id = {ONE['campaign_id']}
UNION ALL SELECT 'user', impression_id, campaign_id, user_id, impression_timestamp FROM ad_impressions WHERE user_id = {ONE['user_id']}""")
ORACLE["keyed_upsert"] = """SELECT o_orderkey,
       CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN o_orderstatus || ':/' || CAST(o_orderkey % 2 AS VARCHAR) ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 2 WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders"""
ORACLE["ledger_counters"] = q(_I1)
ORACLE["stable_names"] = q("""SELECT row_number() OVER (ORDER BY load, campaign_name) AS name_id, campaign_name FROM (
  SELECT campaign_name, min(CASE WHEN ts < TIMESTAMP '2024-01-03' THEN 1 WHEN ts < TIMESTAMP '2024-01-15' THEN 2 ELSE 3 END) AS load
  FROM ev WHERE campaign_name IS NOT NULL AND ts < TIMESTAMP '2025-01-01' GROUP BY campaign_name)""")
ORACLE["stable_clicks"] = q("""SELECT row_number() OVER (
  ORDER BY CASE CAST(impression_id AS BIGINT) % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END, click_timestamp, impression_id) AS click_id,
  impression_id, click_timestamp FROM ad_clicks""")

# ---- E: all constraints of a star that breaks them, deletes through all references -------------------
_BRIDGE = """users_interests AS (SELECT DISTINCT x.user_id, i.interest_id FROM (
  SELECT user_id, trim(unnest(string_split(interests, ','))) AS name FROM bu) x JOIN interests i ON i.interest_name = x.name)"""


def _dirty_star(name: str) -> str:
    changes = ", ".join(f"{sql} AS {c}" for c, sql in DIRTY_STAR[name].items())
    return f"d_{name} AS (SELECT {f'* REPLACE ({changes})' if changes else '*'} FROM {name})"


def _broken(table: str, key: str, rule: str, value: str, when: str, more: str = "") -> str:
    return (f"SELECT '{table}' AS \"table\", CAST({key} AS VARCHAR) AS key, '{rule}' AS rule, CAST({value} AS VARCHAR) AS value "
            f"FROM d_{table} t {more} WHERE {when}")


def _fk(table: str, key: str, column: str, parent: str, parent_key: str) -> str:
    return _broken(table, key, f"fk:{column}", column, f"{column} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM d_{parent} p WHERE p.{parent_key} = t.{column})")


def _twice(table: str, *columns: str) -> str:
    key = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return (f"SELECT '{table}', {key}, 'unique:{','.join(columns)}', CAST(count(*) AS VARCHAR) FROM d_{table} "
            f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in columns)} GROUP BY {', '.join(columns)} HAVING count(*) > 1")


_UI = "CAST(user_id AS VARCHAR) || '|' || CAST(interest_id AS VARCHAR)"
ORACLE["star_violations"] = q(f""", {_BRIDGE}, {", ".join(_dirty_star(n) for n in DIRTY_STAR)}
""" + " UNION ALL ".join([
    *[_broken(t, k, f"not_null:{c}", "NULL", f"{c} IS NULL") for t, k, c in (
        ("countries", "country_id", "country_name"), ("interests", "interest_id", "interest_name"),
        ("advertisers", "advertiser_id", "advertiser_name"), ("campaigns", "campaign_id", "advertiser_id"),
        ("campaigns", "campaign_id", "campaign_name"), ("campaigns", "campaign_id", "campaign_start_date"),
        ("campaigns", "campaign_id", "campaign_end_date"), ("ad_impressions", "impression_id", "campaign_id"),
        ("ad_impressions", "impression_id", "user_id"), ("ad_impressions", "impression_id", "impression_timestamp"),
        ("ad_clicks", "click_id", "impression_id"), ("ad_clicks", "click_id", "click_timestamp"))],
    *[_broken(t, k, f"length:{c}", c, f"length({c}) > {n}") for t, k, c, n in (
        ("countries", "country_id", "country_name", 255), ("interests", "interest_id", "interest_name", 255),
        ("advertisers", "advertiser_id", "advertiser_name", 255), ("campaigns", "campaign_id", "campaign_name", 100),
        ("campaigns", "campaign_id", "ad_slot_size", 50), ("ad_impressions", "impression_id", "impression_id", 50))],
    *[_broken(t, k, f"range:{c}", c, f"{c} <= 0") for t, k, c in (
        ("users", "user_id", "age"), ("campaigns", "campaign_id", "targeting_age_from"),
        ("campaigns", "campaign_id", "targeting_age_to"))],
    _broken("users", "user_id", "enum:gender", "gender", f"gender NOT IN {_GENDERS}"),
    _broken("ad_impressions", "impression_id", "enum:device", "device", "device NOT IN ('Mobile', 'Desktop', 'Tablet', 'Other')"),
    _broken("campaigns", "campaign_id", "type:budget", "CAST(budget AS DECIMAL(18,2))", "abs(budget) >= 10000000000"),
    _broken("campaigns", "campaign_id", "type:remaining_budget", "CAST(remaining_budget AS DECIMAL(18,2))",
            "abs(remaining_budget) >= 10000000000"),
    *[_broken("ad_impressions", "impression_id", f"type:{c}", f"CAST({c} AS DECIMAL(18,4))", f"abs({c}) >= 10000")
      for c in ("bid_amount", "ad_cost", "ad_revenue")],
    _fk("users", "user_id", "country_id", "countries", "country_id"),
    _fk("campaigns", "campaign_id", "advertiser_id", "advertisers", "advertiser_id"),
    _fk("campaigns", "campaign_id", "targeting_interest_id", "interests", "interest_id"),
    _fk("campaigns", "campaign_id", "targeting_country_id", "countries", "country_id"),
    _fk("users_interests", _UI, "user_id", "users", "user_id"), _fk("users_interests", _UI, "interest_id", "interests", "interest_id"),
    _fk("ad_impressions", "impression_id", "campaign_id", "campaigns", "campaign_id"),
    _fk("ad_impressions", "impression_id", "user_id", "users", "user_id"),
    _fk("ad_impressions", "impression_id", "location_id", "countries", "country_id"),
    _fk("ad_clicks", "click_id", "impression_id", "ad_impressions", "impression_id"),
    _twice("countries", "country_id"), _twice("countries", "country_name"), _twice("interests", "interest_id"),
    _twice("interests", "interest_name"), _twice("users", "user_id"), _twice("advertisers", "advertiser_id"),
    _twice("advertisers", "advertiser_name"), _twice("campaigns", "campaign_id"),
    _twice("campaigns", "advertiser_id", "campaign_name"), _twice("users_interests", "user_id", "interest_id"),
    _twice("ad_impressions", "impression_id"), _twice("ad_clicks", "click_id"), _twice("ad_clicks", "impression_id")]))

_DS = ", ".join(_dirty_star(n) for n in DIRTY_STAR)
ORACLE["check_range"] = q(f""", {_BRIDGE}, {_DS}
SELECT user_id AS id, CAST(age AS VARCHAR) AS value, 'range:age' AS rule FROM d_users WHERE age < 1 OR age > 120
UNION ALL SELECT campaign_id, CAST(targeting_age_from AS VARCHAR), 'range:targeting_age_from' FROM d_campaigns
WHERE targeting_age_from < 1""")
ORACLE["check_fk"] = q(f""", {_BRIDGE}, {_DS} SELECT key AS id, value, rule FROM (""" + " UNION ALL ".join([
    _fk("users", "user_id", "country_id", "countries", "country_id"),
    _fk("campaigns", "campaign_id", "advertiser_id", "advertisers", "advertiser_id"),
    _fk("campaigns", "campaign_id", "targeting_interest_id", "interests", "interest_id"),
    _fk("campaigns", "campaign_id", "targeting_country_id", "countries", "country_id"),
    _fk("users_interests", "user_id", "user_id", "users", "user_id"),
    _fk("users_interests", "user_id", "interest_id", "interests", "interest_id"),
    _fk("ad_impressions", "impression_id", "campaign_id", "campaigns", "campaign_id"),
    _fk("ad_impressions", "impression_id", "user_id", "users", "user_id"),
    _fk("ad_impressions", "impression_id", "location_id", "countries", "country_id"),
    _fk("ad_clicks", "click_id", "impression_id", "ad_impressions", "impression_id")]) + ")")

ORACLE["delete_graph"] = q(f""", {_BRIDGE},
co AS (SELECT * FROM countries WHERE country_id % 7 <> 0), ii AS (SELECT * FROM interests WHERE interest_id % 6 <> 0),
ad AS (SELECT * FROM advertisers WHERE advertiser_id % 5 <> 0), us AS (SELECT * FROM users WHERE user_id % 11 <> 0),
ca AS (SELECT * FROM campaigns WHERE advertiser_id IN (SELECT advertiser_id FROM ad)),
im AS (SELECT * FROM ad_impressions i WHERE campaign_id IN (SELECT campaign_id FROM ca)
       AND (user_id IN (SELECT user_id FROM us) OR user_id NOT IN (SELECT user_id FROM users))),
ck AS (SELECT * FROM ad_clicks WHERE impression_id IN (SELECT impression_id FROM im))
SELECT 'countries' AS "table", CAST(country_id AS VARCHAR) AS key, '' AS refs FROM co
UNION ALL SELECT 'interests', CAST(interest_id AS VARCHAR), '' FROM ii
UNION ALL SELECT 'advertisers', CAST(advertiser_id AS VARCHAR), '' FROM ad
UNION ALL SELECT 'users', CAST(user_id AS VARCHAR), CASE WHEN country_id > 0 AND country_id % 7 = 0 THEN '-' ELSE CAST(country_id AS VARCHAR) END FROM us
UNION ALL SELECT 'campaigns', CAST(campaign_id AS VARCHAR), CAST(advertiser_id AS VARCHAR) || '|' ||
  CASE WHEN targeting_interest_id > 0 AND targeting_interest_id % 6 = 0 THEN '-' ELSE CAST(targeting_interest_id AS VARCHAR) END || '|' ||
  CASE WHEN targeting_country_id > 0 AND targeting_country_id % 7 = 0 THEN '-' ELSE CAST(targeting_country_id AS VARCHAR) END FROM ca
UNION ALL SELECT 'users_interests', {_UI}, {_UI} FROM users_interests WHERE user_id % 11 <> 0 AND interest_id % 6 <> 0
UNION ALL SELECT 'ad_impressions', impression_id, CAST(campaign_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) || '|' ||
  CASE WHEN location_id > 0 AND location_id % 7 = 0 THEN '-' ELSE CAST(location_id AS VARCHAR) END FROM im
UNION ALL SELECT 'ad_clicks', CAST(click_id AS VARCHAR), impression_id FROM ck""")
ORACLE["staged_publish"] = q(" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM {t}" for t in
    ["countries", "interests", "users", "advertisers", "campaigns", "ad_impressions", "ad_clicks"])
    + """ UNION ALL SELECT 'users_interests', COUNT(*) FROM (SELECT DISTINCT x.user_id, i.interest_id FROM (
  SELECT user_id, trim(unnest(string_split(interests, ','))) AS name FROM bu) x
  JOIN interests i ON i.interest_name = x.name)""")
ORACLE["stream_campaign_day"] = q(_I1)


# ---- B2: report sections (rows per section) ------------------------------------------------
_SECTIONS = [
    ("Top 5 Campaigns by Click-Through Rate (CTR)", "top_campaigns_ctr"),
    ("Advertisers with Highest Spend", "advertiser_spend"),
    ("Cost Efficiency: Average CPC and CPM per Campaign", "campaign_cpc_cpm"),
    ("Top Locations by Total Ad Revenue from Clicks", "top_locations_revenue"),
    ("Top 10 Most Engaged Users by Clicks", "top_users_clicks"),
    ("Campaigns with > 80% Budget Spent", "budget_spent"),
    ("CTR Comparison Across Devices", "device_ctr"),
    ("All ad interactions for a sampled user", "user_interactions"),
]
ORACLE["report_sections"] = " UNION ALL ".join(
    f"SELECT '{title}' AS section, COUNT(*) AS rows FROM ({ORACLE[key]})" for title, key in _SECTIONS)

# lookups by id: the same questions for one entity
for _one, _all, _id in (("campaign_performance_one", "campaign_performance", "campaign_id"),
                        ("advertiser_spend_one", "advertiser_total_spend", "advertiser_id"),
                        ("user_engagements_one", "user_engagements", "user_id"),
                        ("last_ads_one", "last_ads_seen", "user_id")):
    ORACLE[_one] = f"SELECT * FROM ({ORACLE[_all]}) t WHERE {_id} = {ONE[_id]}"


# ---- B1, B2, B8: contents of the written files ---------------------------------------------
def _cells(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(
        f"coalesce(CAST(TRY_CAST(CAST({c} AS VARCHAR) AS DECIMAL(18,4)) AS VARCHAR), CAST({c} AS VARCHAR), '')" for c in columns) + ")"


_DOC_SECTIONS = [("All ad interactions for a sampled user", "user_interactions"),
                 ("Last 5 ad sessions of each user", "last_sessions"),
                 ("Ad clicks per hour and campaign on one day", "clicks_per_hour"),
                 ("Users who saw the same ad 5+ times without a click", "repeated_no_click"),
                 ("Top 3 ad categories of each user", "top_categories")]
_WIDE_SECTIONS = [("CTR per campaign and day", "campaign_day_ctr"), ("Top 5 advertisers by spend in 31 days", "top_advertisers_31d"),
                  ("Last 10 ads seen by each user", "last_ads_seen"), ("Top 10 users by clicks in 31 days", "top_users_31d"),
                  ("Top 5 advertisers by spend in each region in 31 days", "top_region_advertisers")]
_COLUMNS = {  # of the sections, in the order of the report
    "top_campaigns_ctr": "campaign_id campaign_name impressions clicks ctr_percentage",
    "advertiser_spend": "advertiser_id advertiser_name total_spent",
    "campaign_cpc_cpm": "campaign_id campaign_name avg_cpc avg_cpm", "top_locations_revenue": "user_location total_revenue",
    "top_users_clicks": "user_id total_clicks", "budget_spent": "campaign_id campaign_name budget remaining_budget percent_spent",
    "device_ctr": "device impressions clicks ctr_percentage",
    "user_interactions": "user_id impression_id campaign_id campaign_interest campaign_location campaign_name advertiser_id "
                         "timestamp location bid_amount ad_cost ad_revenue clicked click_events",
    "last_sessions": "user_id device rank session_start session_end clicks",
    "clicks_per_hour": "advertiser_id campaign_id hour clicks", "repeated_no_click": "user_id campaign_id impressions",
    "top_categories": "user_id category clicks rank", "campaign_day_ctr": "campaign_id date impressions clicks ctr",
    "top_advertisers_31d": "advertiser_id total_spend",
    "last_ads_seen": "user_id rank timestamp campaign_id advertiser_id clicked", "top_users_31d": "user_id clicks",
    "top_region_advertisers": "region advertiser_id total_spend rank",
}


def _section(key: str) -> str:
    if key == "user_interactions":  # click events are a list of documents, as JSON
        return (f"SELECT * EXCLUDE (click_timestamp), CASE WHEN click_timestamp IS NULL THEN '[]' ELSE '[{{\"click_timestamp\":\"' || "
                f"strftime(click_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || '\"}}]' END AS click_events FROM ({ORACLE[key]})")
    return ORACLE[key]


ORACLE["report_contents"] = " UNION ALL ".join(
    f"SELECT '{title}' AS section, {_cells(*_COLUMNS[key].split())} AS cells FROM ({_section(key)})"
    for title, key in [*_SECTIONS[:7], *_DOC_SECTIONS, *_WIDE_SECTIONS])

_STAR_COLUMNS = {
    "countries": "country_id country_name", "interests": "interest_id interest_name",
    "users": "user_id age gender country_id signup_date", "advertisers": "advertiser_id advertiser_name",
    "campaigns": "campaign_id advertiser_id campaign_name campaign_start_date campaign_end_date targeting_criteria "
                 "targeting_age_from targeting_age_to targeting_interest_id targeting_country_id ad_slot_size budget remaining_budget",
    "users_interests": "user_id interest_id",
    "ad_impressions": "impression_id campaign_id user_id device location_id impression_timestamp bid_amount ad_cost ad_revenue",
    "ad_clicks": "click_id impression_id click_timestamp",
}
ORACLE["star_csv"] = q(f""", {_BRIDGE}, events_clean AS (
  SELECT be.event_id, bc.advertiser_name, bc.campaign_name, bc.start_date, bc.end_date, bc.interest, bc.country, be.user_id, be.device,
         be.location, be.ts, be.click_ts, be.bid_amount, be.ad_cost, be.ad_revenue, bc.budget, bc.remaining_budget, be.was_clicked
  FROM be LEFT JOIN bc ON bc.campaign_id = be.k + 1)
""" + " UNION ALL ".join([
    *[f"SELECT '{t}' AS \"table\", {_cells(*c.split())} AS cells FROM {t}" for t, c in _STAR_COLUMNS.items()],
    f"""SELECT 'events_clean', {_cells(*'event_id advertiser_name campaign_name start_date end_date interest country user_id device location ts click_ts bid_amount ad_cost ad_revenue budget remaining_budget was_clicked'.split())} FROM events_clean""",
    f"""SELECT 'campaigns_clean', {_cells(*'campaign_id advertiser_name campaign_name start_date end_date targeting_criteria ad_slot_size budget remaining_budget p_size (p_size+10) interest country'.split())} FROM bc""",
    f"""SELECT 'users_clean', {_cells(*'user_id age raw_gender location interests signup_date'.split())} FROM bu"""]))

ORACLE["session_days"] = q(f"""SELECT user_id, device, CAST(ts AS DATE) AS day,
       row_number() OVER (PARTITION BY user_id, device, CAST(ts AS DATE) ORDER BY ts, event_id) AS seq, event_id AS impression_id
FROM {_DOC}""")

_F, _S = "ts < TIMESTAMP '2024-01-11'", "ts < TIMESTAMP '2024-01-21'"
ORACLE["stream_with_late"] = q(f""",
parts AS (SELECT 1 AS part, * FROM ev WHERE {_F} AND eid % 10 <> 0
  UNION ALL SELECT 2, * FROM ev WHERE ({_F} AND eid % 10 = 0) OR (NOT {_F} AND {_S} AND eid % 10 <> 0)
  UNION ALL SELECT 3, * FROM ev WHERE (NOT {_F} AND {_S} AND (eid % 10 = 0 OR eid % 7 = 0)) OR NOT {_S}),
marks AS (SELECT part + 1 AS part, floor(epoch(max(ts)))::BIGINT - 86400 AS mark FROM parts GROUP BY part),
seen AS (SELECT parts.*, coalesce(epoch(ts) < (SELECT max(m.mark) FROM marks m WHERE m.part <= parts.part), false) AS late FROM parts),
counted AS (SELECT * FROM seen WHERE NOT late QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY part) = 1),
c AS (SELECT campaign_id, CAST(ts AS DATE) AS date, COUNT(was_clicked) AS impressions,
       CAST(coalesce(SUM(CAST(was_clicked AS INTEGER)), 0) AS BIGINT) AS clicks FROM counted WHERE campaign_id IS NOT NULL GROUP BY ALL),
l AS (SELECT campaign_id, CAST(ts AS DATE) AS date, COUNT(*) AS late FROM seen WHERE late AND campaign_id IS NOT NULL GROUP BY ALL)
SELECT campaign_id, date, coalesce(impressions, 0) AS impressions, coalesce(clicks, 0) AS clicks, coalesce(late, 0) AS late
FROM c FULL JOIN l USING (campaign_id, date)""")
