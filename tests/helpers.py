"""Small inline leagues."""

import datetime as dt

from courtside.sources.readers import RawTables
from courtside.sources.schemas import RAW_SCHEMAS

EMPTY_STAMP = dt.datetime(2025, 1, 1)


def frame(spark, name, rows):
    """Rows given as dictionaries, missing columns null, in the declared schema."""
    schema = RAW_SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def league_tables(spark, **tables):
    """Raw tables with the given rows; every other table is empty."""
    return RawTables(lambda name: frame(spark, name, tables.get(name, [])))


def game(game_id, day, home, away, season="2025-26", arena=0, tipoff="19:00:00"):
    return {
        "game_id": game_id, "game_date": dt.date.fromisoformat(day), "season": season,
        "home_team_id": home, "away_team_id": away, "arena_id": arena, "tipoff_time": tipoff,
    }


def box(game_id, team, side, points, **more):
    base = {
        "field_goals_made": 40, "field_goals_attempted": 90, "three_pointers_made": 10,
        "three_pointers_attempted": 30, "free_throws_made": 15, "free_throws_attempted": 20,
        "offensive_rebounds": 10, "defensive_rebounds": 30, "assists": 20, "steals": 7, "blocks": 5,
        "turnovers": 12, "personal_fouls": 18,
    }
    return {"game_id": game_id, "team_id": team, "home_away": side, "points": points, **base, **more}


def boxes(game_row, home_points, away_points, **more):
    return [
        box(game_row["game_id"], game_row["home_team_id"], "home", home_points, **more),
        box(game_row["game_id"], game_row["away_team_id"], "away", away_points, **more),
    ]


def as_dicts(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
