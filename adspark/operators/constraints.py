"""The star's declared constraints (E1-E8), checked in one pass over each table, and deletes
carried through all its foreign keys (E6, E7).

``STAR`` lists every table's constraints, parents before children.  ``violations`` scans a
table once: all rules of a row are evaluated together, foreign keys by joins with the
parents' keys (broadcast where proven small), and each broken rule gives one row; uniqueness
is an aggregate of the same scan's rows.  ``observed`` counts the broken rules while the rows
are used for something else, at no pass of its own.  ``delete_rows`` walks the tables in the
same order: a table's rows go with what they belong to, or lose the reference.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adspark.functions.parsing import DEVICES, GENDERS
from adspark.operators.keys import lookup_side
from adspark.session import materialize

CASCADE, SET_NULL = "cascade", "set null"


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_key: str
    on_delete: str


@dataclass(frozen=True)
class Constraints:
    key: list[str]
    required: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)   # besides the key
    lengths: dict[str, int] = field(default_factory=dict)
    positive: list[str] = field(default_factory=list)
    enums: dict[str, list[str]] = field(default_factory=dict)
    fits: dict[str, str] = field(default_factory=dict)      # column -> type that must hold its values
    references: list[Reference] = field(default_factory=list)


# fixed values: the relational tables' constraints
STAR = {
    "countries": Constraints(["country_id"], ["country_name"], [["country_name"]], {"country_name": 255}),
    "interests": Constraints(["interest_id"], ["interest_name"], [["interest_name"]], {"interest_name": 255}),
    "users": Constraints(["user_id"], positive=["age"], enums={"gender": GENDERS},
                         references=[Reference("country_id", "countries", "country_id", SET_NULL)]),
    "advertisers": Constraints(["advertiser_id"], ["advertiser_name"], [["advertiser_name"]], {"advertiser_name": 255}),
    "campaigns": Constraints(
        ["campaign_id"], ["advertiser_id", "campaign_name", "campaign_start_date", "campaign_end_date"],
        [["advertiser_id", "campaign_name"]], {"campaign_name": 100, "ad_slot_size": 50},
        ["targeting_age_from", "targeting_age_to"], fits={"budget": "decimal(12,2)", "remaining_budget": "decimal(12,2)"},
        references=[Reference("advertiser_id", "advertisers", "advertiser_id", CASCADE),
                    Reference("targeting_interest_id", "interests", "interest_id", SET_NULL),
                    Reference("targeting_country_id", "countries", "country_id", SET_NULL)]),
    "users_interests": Constraints(
        ["user_id", "interest_id"],
        references=[Reference("user_id", "users", "user_id", CASCADE),
                    Reference("interest_id", "interests", "interest_id", CASCADE)]),
    "ad_impressions": Constraints(
        ["impression_id"], ["campaign_id", "user_id", "impression_timestamp"], lengths={"impression_id": 50},
        enums={"device": DEVICES},
        fits={"bid_amount": "decimal(8,4)", "ad_cost": "decimal(8,4)", "ad_revenue": "decimal(8,4)"},
        references=[Reference("campaign_id", "campaigns", "campaign_id", CASCADE),
                    Reference("user_id", "users", "user_id", CASCADE),
                    Reference("location_id", "countries", "country_id", SET_NULL)]),
    "ad_clicks": Constraints(["click_id"], ["impression_id", "click_timestamp"], [["impression_id"]],
                             references=[Reference("impression_id", "ad_impressions", "impression_id", CASCADE)]),
}


def _rules(spec: Constraints) -> list[tuple[str, Column, Column]]:
    """``(rule, condition of a break, value)`` for all rules of one row; a foreign key's
    parent stands in ``__parent_<n>``."""
    text = lambda c: F.col(c).cast("string")
    null = F.lit(None).cast("string")
    rules = [(f"not_null:{c}", F.col(c).isNull(), null) for c in dict.fromkeys([*spec.key, *spec.required])]
    rules += [(f"length:{c}", F.length(c) > n, text(c)) for c, n in spec.lengths.items()]
    rules += [(f"range:{c}", F.col(c) <= 0, text(c)) for c in spec.positive]
    rules += [(f"enum:{c}", ~F.col(c).isin(list(v)), text(c)) for c, v in spec.enums.items()]
    rules += [(f"type:{c}", F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), text(c)) for c, t in spec.fits.items()]
    rules += [(f"fk:{r.column}", F.col(r.column).isNotNull() & F.col(f"__parent_{n}").isNull(), text(r.column))
              for n, r in enumerate(spec.references)]
    return rules


def _with_parents(tables: dict[str, DataFrame], name: str, spec: Constraints) -> DataFrame:
    out = tables[name]
    for n, r in enumerate(spec.references):
        # a key that stands twice must not multiply its children
        parents = tables[r.parent].select(F.col(r.parent_key).alias(f"__parent_{n}")).distinct()
        out = out.join(lookup_side(parents), F.col(r.column) == F.col(f"__parent_{n}"), "left")
    return out


def _key(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])


def row_violations(tables: dict[str, DataFrame], name: str, spec: Constraints) -> DataFrame:
    """``table, key, rule, value``: each broken rule of each row, from one scan."""
    hits = F.array(*[F.when(broken, F.struct(F.lit(rule).alias("rule"), value.alias("value")))
                     for rule, broken, value in _rules(spec)])
    return (_with_parents(tables, name, spec)
            .select(_key(spec.key).alias("key"), F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h"))
            .select(F.lit(name).alias("table"), "key", "h.rule", "h.value"))


def key_violations(tables: dict[str, DataFrame], name: str, spec: Constraints) -> DataFrame:
    """The same columns for keys that stand more than once (``value``: how often); as in the
    database, a key with a null column is never a repeat."""
    parts = []
    for columns in [spec.key, *spec.unique]:
        copies = (tables[name].dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
                  .where("n > 1"))
        parts.append(copies.select(F.lit(name).alias("table"), _key(columns).alias("key"),
                                   F.lit("unique:" + ",".join(columns)).alias("rule"), F.col("n").cast("string").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def violations(tables: dict[str, DataFrame], spec: dict[str, Constraints] = STAR) -> DataFrame:
    """Every broken constraint of all tables."""
    return reduce(DataFrame.unionByName, [f(tables, name, s) for name, s in spec.items()
                                          for f in (row_violations, key_violations)])


def observed(tables: dict[str, DataFrame], name: str, spec: Constraints) -> tuple[DataFrame, Observation]:
    """The table's rows and, once they have been written or counted, how often each rule of
    a row is broken (``.get``), from that same pass."""
    seen = Observation(f"{name} rules")
    counts = [F.count_if(broken).alias(rule) for rule, broken, _ in _rules(spec)]
    rows = _with_parents(tables, name, spec).observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    return rows.select(*tables[name].columns), seen


def delete_rows(tables: dict[str, DataFrame], doomed: dict[str, DataFrame],
                spec: dict[str, Constraints] = STAR) -> dict[str, DataFrame]:
    """All tables after the rows with the keys in ``doomed`` (table -> its key column) are
    deleted: rows that belong to a deleted one go too, other references to it become null.

    Keys of deleted rows are written between the levels; they are joined by size, and a
    deleted key that many rows refer to is an ordinary (splittable) side of the join."""
    out, gone = {}, {}
    parents = {r.parent for s in spec.values() for r in s.references}
    for name, s in spec.items():
        rows = tables[name]
        dead = F.lit(False)
        nulled = {}
        for n, r in enumerate([r for r in s.references if r.parent in gone]):
            flag = f"__gone_{n}"
            rows = rows.join(lookup_side(gone[r.parent].select(F.col(r.parent_key).alias(flag))),
                             F.col(r.column) == F.col(flag), "left")
            if r.on_delete == CASCADE:
                dead = dead | F.col(flag).isNotNull()
            else:
                nulled[r.column] = F.when(F.col(flag).isNull(), F.col(r.column)).alias(r.column)
        if name in doomed:
            own = doomed[name].select(F.col(s.key[0]).alias("__own")).distinct()
            rows = rows.join(lookup_side(own), F.col(s.key[0]) == F.col("__own"), "left")
            dead = dead | F.col("__own").isNotNull()
        if name in parents and (name in doomed or any(r.parent in gone and r.on_delete == CASCADE for r in s.references)):
            gone[name] = materialize(rows.where(dead).select(s.key[0]).distinct())
        out[name] = rows.where(~dead).select(*[nulled.get(c, F.col(c)) for c in tables[name].columns])
    return out
