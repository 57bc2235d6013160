"""Data-quality rules of the gold tables (C1-C10), as stated by the reference's table definitions.

The reference declares these as database constraints but its publish step
replaces the constrained table with an unconstrained one, so they are never
enforced.  Here they are rule sets: ``publish(..., rules=...)`` refuses a
version that breaks one, and the pipeline's quality report counts
violations per table and rule.
"""

from __future__ import annotations

from strata.operators import quality as Q

# Fixed values that must equal the reference's (its table definitions):
# key columns, required columns, maximum text lengths and value ranges.
GOLD_RULES_SPEC = {
    "dim_player": {
        "key": ["player_id"],
        "not_null": ["player_name"],
        "max_length": {"player_name": 255, "position": 50, "nationality": 100, "foot": 20},
        "between": {"age": (14, 50), "overall_rating": (1, 99), "potential_rating": (1, 99)},
        "strictly_between": {"height_cm": (100, 250)},
        "non_negative": ["wage_eur"],
    },
    "dim_club": {
        "key": ["club_id"],
        "not_null": ["club_name"],
        "max_length": {"club_name": 255, "domestic_competition_id": 50},
        "between": {"average_age": (14, 50)},
        "non_negative": ["squad_size", "total_market_value"],
    },
    "dim_competition": {
        "key": ["competition_id"],
        "not_null": ["competition_name"],
        "max_length": {"competition_id": 50, "competition_name": 255, "country_name": 100,
                       "type": 50},
    },
    "fact_player_value": {
        "not_null": ["player_id", "player_name", "latest_market_value"],
        "max_length": {"player_name": 255, "position": 50, "nationality": 100,
                       "competition_name": 255, "league_country": 100, "foot": 20},
        "between": {"age": (14, 50), "overall_rating": (1, 99), "potential_rating": (1, 99)},
        "positive": ["latest_market_value"],
        "non_negative": ["total_goals", "total_assists", "total_appearances", "total_minutes",
                         "goals_per_game"],
    },
    "agg_value_by_position": {
        "max_length": {"position": 50},
        "non_negative": ["avg_market_value", "max_market_value", "player_count"],
    },
    "agg_value_by_league": {
        "max_length": {"competition_name": 255, "league_country": 100},
        "non_negative": ["avg_market_value", "max_market_value", "player_count"],
    },
    "agg_value_by_age": {
        "between": {"age": (14, 50)},
        "non_negative": ["avg_market_value", "player_count"],
    },
    "agg_top_players": {
        "max_length": {"player_name": 255, "position": 50, "nationality": 100,
                       "competition_name": 255},
        "non_negative": ["latest_market_value"],
    },
    "agg_value_by_nationality": {
        "max_length": {"nationality": 100},
        "non_negative": ["avg_market_value", "player_count"],
    },
}


def rule_specs(table: str, columns: list[str] | None = None) -> list[tuple]:
    """(name, kind, columns, params) per rule of a gold table, optionally only
    those whose columns are present."""
    spec = GOLD_RULES_SPEC[table]
    have = set(columns) if columns is not None else None

    def ok(*cols):
        return have is None or all(c in have for c in cols)

    out: list[tuple] = []
    if spec.get("key") and ok(*spec["key"]):
        out.append((f"{'_'.join(spec['key'])}_unique", "unique", tuple(spec["key"]), ()))
    out += [(f"{c}_not_null", "not_null", (c,), ()) for c in spec.get("not_null", []) if ok(c)]
    out += [(f"{c}_max_{n}", "max_length", (c,), (n,))
            for c, n in spec.get("max_length", {}).items() if ok(c)]
    out += [(f"{c}_{lo}_{hi}", "between", (c,), (lo, hi))
            for c, (lo, hi) in spec.get("between", {}).items() if ok(c)]
    out += [(f"{c}_over_{lo}_under_{hi}", "strictly_between", (c,), (lo, hi))
            for c, (lo, hi) in spec.get("strictly_between", {}).items() if ok(c)]
    out += [(f"{c}_positive", "positive", (c,), ()) for c in spec.get("positive", []) if ok(c)]
    out += [(f"{c}_non_negative", "non_negative", (c,), ())
            for c in spec.get("non_negative", []) if ok(c)]
    return out


_BUILDERS = {
    "unique": lambda name, cols, params: Q.unique(name, *cols),
    "not_null": lambda name, cols, params: Q.not_null(name, cols[0]),
    "max_length": lambda name, cols, params: Q.max_length(name, cols[0], *params),
    "between": lambda name, cols, params: Q.between(name, cols[0], *params),
    "strictly_between": lambda name, cols, params: Q.strictly_between(name, cols[0], *params),
    "positive": lambda name, cols, params: Q.positive(name, cols[0]),
    "non_negative": lambda name, cols, params: Q.non_negative(name, cols[0]),
}


def rules_for(table: str, columns: list[str] | None = None) -> list[Q.Rule]:
    """The rule list of a gold table, optionally restricted to the columns present."""
    return [_BUILDERS[kind](name, cols, params)
            for name, kind, cols, params in rule_specs(table, columns)]
