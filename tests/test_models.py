"""Rules the supplied data does not show, on small inline leagues."""

import datetime as dt

import pytest
from helpers import as_dicts, box, boxes, game, league_tables
from pyspark.sql import functions as F

from courtside import League
from courtside.operators.pairs import pair_record
from courtside.plans import officials
from courtside.sources.schemas import RAW_KEYS


def days(n, start="2025-11-01"):
    return (dt.date.fromisoformat(start) + dt.timedelta(days=n)).isoformat()


def series(scores, home="AAA", away="BBB", season="2025-26", start="2025-11-01"):
    """Games between two teams on consecutive days with the given (home, away) points."""
    rows = [game(f"{start[:4]}-{i:03d}", days(i, start), home, away, season) for i in range(len(scores))]
    stats = [b for g, (h, a) in zip(rows, scores) for b in boxes(g, h, a)]
    return rows, stats


def test_streak_labels(spark):
    games, stats = series([(100, 90), (101, 90), (80, 90), (95, 90)])
    league = League(league_tables(spark, games=games, team_game_stats=stats))
    rows = sorted(
        (r for r in league.team_streaks().collect() if r.team_id == "AAA"), key=lambda r: r.game_date
    )
    assert [r.streak_label for r in rows] == ["W1", "W2", "L1", "W1"]
    assert [(r.win_streak, r.loss_streak) for r in rows] == [(1, 0), (2, 0), (0, 1), (1, 0)]


def test_equal_scores(spark):
    games, stats = series([(100, 100), (110, 100)])
    league = League(league_tables(spark, games=games, team_game_stats=stats))
    scores = as_dicts(league.game_scores, "game_id")
    assert scores["2025-000"]["winner_home_away"] == "away"
    assert scores["2025-000"]["winner_team_id"] == "BBB"
    wins = {(r.team_id, r.game_id): r.win for r in league.team_record().collect()}
    assert wins[("AAA", "2025-000")] == wins[("BBB", "2025-000")] == 0
    record = league.head_to_head().first()
    assert (record.team_a, record.games_played, record.team_a_wins, record.team_b_wins) == ("AAA", 2, 1, 1)
    fair = pair_record(league.game_scores, tie_rule="nobody").first()
    assert (fair.team_a_wins, fair.team_b_wins) == (1, 0)
    with pytest.raises(ValueError):
        pair_record(league.game_scores, tie_rule="home")


def test_pair_record_ignores_who_is_at_home(spark):
    first, stats = series([(100, 90), (90, 100), (120, 90)])
    second, more = series([(100, 90), (90, 100)], home="BBB", away="AAA", start="2024-11-01")
    league = League(league_tables(spark, games=first + second, team_game_stats=stats + more))
    swapped = league.game_scores.selectExpr(
        "game_date", "home_team_id AS away_team_id", "away_team_id AS home_team_id",
        "home_points AS away_points", "away_points AS home_points",
    )
    assert pair_record(league.game_scores).collect() == pair_record(swapped).collect()


def test_unplayed_games_stay_in_the_card_only(spark):
    games, stats = series([(100, 90)])
    games.append(game("next", "2025-11-20", "BBB", "AAA"))
    half = game("half", "2025-11-21", "AAA", "BBB")
    tables = league_tables(
        spark, games=[*games, half], team_game_stats=[*stats, box("half", "AAA", "home", 50)],
        broadcast_schedule=[{"game_id": "2025-000", "is_national_broadcast": True}],
        referee_assignments=[{"game_id": "next", "referee_1": "7"}],
    )
    league = League(tables)
    assert {r.game_id for r in league.game_scores.select("game_id").collect()} == {"2025-000"}
    card = as_dicts(league.game_card(), "game_id")
    assert set(card) == {"2025-000", "next", "half"}
    assert card["2025-000"]["is_national_broadcast"] is True
    assert card["next"]["is_national_broadcast"] is None and card["next"]["home_points"] is None
    assert card["next"]["home_days_rest"] == 18 and card["next"]["home_losses"] == 1
    assert card["next"]["away_streak_label"] == "W1" and card["next"]["referee_1"] == "7"
    assert (card["next"]["h2h_home_wins"], card["next"]["h2h_away_wins"]) == (0, 1)
    assert (card["2025-000"]["h2h_home_wins"], card["2025-000"]["h2h_away_wins"]) == (1, 0)


def test_quarters_and_overtime_counts(spark):
    games, stats = series([(100, 95)])
    points = {"Q1": 20, "Q2": 25, "Q3": 30, "Q4": 20, "OT1": 5}
    quarters = [
        {**box("2025-000", team, side, p - shift), "quarter": q}
        for team, side, shift in (("AAA", "home", 0), ("BBB", "away", 1)) for q, p in points.items()
    ]
    league = League(league_tables(
        spark, games=games, team_game_stats=stats, team_quarter_stats=quarters,
        game_results=[{"game_id": "2025-000", "overtime_periods": 2}],
    ))
    scores = league.game_scores.first()
    assert (scores.home_pts_q3, scores.away_pts_ot1, scores.home_pts_ot2) == (30, 4, None)
    assert scores.overtime_periods == 1
    pace = league.game_pace().first()
    # Both sides: 90 - 10 + 12 + 0.44 * 20 = 100.8 possessions in 58 minutes.
    assert (pace.overtime_periods, pace.total_minutes) == (2, 58)
    assert (pace.home_possessions, pace.game_pace) == (100.8, 83.4)
    card = league.game_card().first()
    assert (card.q4_margin, card.margin_entering_q4, card.overtime_periods) == (1, 3, 2)


def test_missing_pace_is_slow(spark):
    games, stats = series([(100, 90)])
    stats = [{**s, "turnovers": None} for s in stats]
    league = League(league_tables(spark, games=games, team_game_stats=stats))
    rows = league.team_performance_by_pace().collect()
    assert {(r.game_pace, r.pace_bucket, r.is_current_season, r.is_last_10) for r in rows} == {
        (None, "slow", True, True)
    }


def test_schedule_features(spark):
    arenas = [
        {"arena_id": 1, "city": "N", "latitude": 40.75, "longitude": -73.99, "altitude_feet": 30, "timezone": "America/New_York"},
        {"arena_id": 2, "city": "D", "latitude": 39.75, "longitude": -105.0, "altitude_feet": 5280, "timezone": "America/Denver"},
        {"arena_id": 3, "city": "X", "latitude": None, "longitude": None, "altitude_feet": None, "timezone": None},
    ]
    games = [
        game("g1", "2025-11-01", "AAA", "BBB", arena=1),
        game("g2", "2025-11-03", "CCC", "AAA", arena=2),
        game("g3", "2025-11-04", "AAA", "BBB", arena=1),
        game("g4", "2025-11-06", "AAA", "BBB", arena=3),
    ]
    tables = league_tables(spark, games=games, dim_arenas=arenas)
    league = League(tables)
    rest = as_dicts(league.rest_days(), "game_id")
    assert rest["g1"]["home_days_rest"] is None and rest["g1"]["rest_advantage"] is None
    assert (rest["g3"]["home_days_rest"], rest["g3"]["away_days_rest"], rest["g3"]["rest_advantage"]) == (0, 2, 2)
    zones = as_dicts(league.timezone_lag(), "game_id")
    assert (zones["g2"]["home_timezone_shift"], zones["g2"]["away_timezone_shift"]) == (0, -2)
    assert zones["g3"]["home_timezone_shift"] == 2 and zones["g3"]["timezone_lag_advantage"] == 0
    assert zones["g4"]["home_timezone_shift"] == 0
    height = as_dicts(league.altitude_fatigue(), "game_id")
    assert (height["g2"]["away_altitude_change"], height["g2"]["altitude_fatigue_advantage"]) == (5250, 5250)
    assert height["g1"]["home_altitude_change"] == 0 and height["g4"]["home_altitude_change"] is None
    travel = as_dicts(league.travel(), "game_id")
    # AAA's home games are both in arena 1, so its away trip in between does not count.
    assert travel["g3"]["home_travel_miles"] == 0.0 and travel["g1"]["home_travel_miles"] == 0.0
    assert travel["g4"]["home_travel_miles"] is None and travel["g4"]["travel_advantage"] is None
    any_game = as_dicts(League(tables, travel_scope="all").travel(), "game_id")
    assert any_game["g3"]["home_travel_miles"] == pytest.approx(1629, abs=5)
    with pytest.raises(ValueError):
        League(tables, travel_scope="away").travel()


def player(game_id, name, team, points, minutes="30:00", **more):
    return {"game_id": game_id, "player_name": name, "team_id": team, "points": points,
            "minutes": minutes, "starter": True, "rebounds": 5, "assists": 4, "steals": 1, "blocks": 1,
            "turnovers": 2, "plus_minus": 3, **more}


def test_player_form(spark):
    games, stats = series([(100, 90)] * 12)
    points = [20] * 10 + [40, 41]
    lines = [player(f"2025-{i:03d}", "ANN LEE", "AAA", p) for i, p in enumerate(points)]
    lines.append(player("2025-011", "Bo Ray", "AAA", 9, minutes=""))
    lines += [player(f"2025-{i:03d}", "Cy Fox", "BBB", 10) for i in range(9)]
    league = League(league_tables(spark, games=games, team_game_stats=stats, player_game_stats=lines))
    rolling = {(r.player_name, r.game_id): r for r in league.player_rolling_averages().collect()}
    last = rolling[("Ann Lee", "2025-011")]
    assert (last.games_played, last.pts_season_avg, last.pts_last3, last.pts_above_avg_last3) == (12, 23.4, 33.7, 10.3)
    assert ("Bo Ray", "2025-011") not in rolling and len(rolling) == 21
    streaks = {r.game_id: r for r in league.player_streaks().collect()}
    assert set(streaks) == {f"2025-{i:03d}" for i in range(12)}
    assert (streaks["2025-009"].below_avg_streak, streaks["2025-011"].hot_game_streak) == (10, 2)
    assert streaks["2025-011"].is_pts_hot_last3 and not streaks["2025-011"].is_pts_cold_last3
    summary = as_dicts(league.player_summary(), "player_name")
    assert set(summary) == {"Ann Lee", "Cy Fox"}
    assert summary["Ann Lee"]["hot_game_streak"] == 2 and summary["Ann Lee"]["last_game_points"] == 41
    assert summary["Cy Fox"]["hot_game_streak"] is None and summary["Cy Fox"]["is_pts_hot_last3"] is None


def test_season_parameter(spark):
    old, stats = series([(100, 90)], season="2024-25", start="2024-11-01")
    new, more = series([(90, 100)])
    lines = [player("2024-000", "Ann Lee", "AAA", 30), player("2025-000", "Ann Lee", "AAA", 10)]
    tables = league_tables(
        spark, games=old + new, team_game_stats=stats + more, player_game_stats=lines
    )
    assert League(tables).baseline.first().pts_season_avg == 10.0
    assert League(tables, season=2025).baseline.first().pts_season_avg == 30.0


def returning_league(spark, injuries=(), last="2025-11-01", tonight="2025-11-20"):
    games = [game("g0", last, "AAA", "BBB"), game("tonight", tonight, "BBB", "AAA")]
    lines = [
        player("g0", "Nikola Jokić", "AAA", 25), player("g0", "Low Man", "AAA", 8),
        player("g0", "Cy O'Fox Jr.", "CCC", 28),
    ]
    injuries = [
        {"game_date": dt.date.fromisoformat(tonight), "scraped_at": dt.datetime(2025, 11, 20, h), **i}
        for h, i in enumerate(injuries)
    ]
    return League(
        league_tables(spark, games=games, team_game_stats=boxes(games[0], 100, 90),
                      player_game_stats=lines, injuries=injuries),
        as_of_date=tonight,
    ).returning_players().collect()


def test_returning_players(spark):
    (row,) = returning_league(spark)
    assert (row.player_name, row.days_since_last_game, row.absence_tier, row.impact_score) == (
        "Nikola Jokic", 19, "MEDIUM_ABSENCE", 1.0
    )
    assert not returning_league(spark, tonight="2025-11-07")
    assert not returning_league(spark, tonight="2025-12-17")
    assert returning_league(spark, tonight="2025-12-16")[0].absence_tier == "LONG_ABSENCE"
    assert returning_league(spark, tonight="2025-11-08")[0].absence_tier == "SHORT_ABSENCE"


@pytest.mark.parametrize(
    "statuses, returns",
    [(["Out"], False), (["Doubtful"], False), (["Questionable"], True), (["Out", "Available"], True)],
)
def test_injury_list_newest_status_counts(spark, statuses, returns):
    reports = [{"team_id": "AAA", "player_name": "NIKOLA JOKIC", "status": s} for s in statuses]
    assert bool(returning_league(spark, reports)) == returns


def officials_league(spark):
    now, stats = series([(100, 90), (90, 100), (100, 90)])
    last, more = series([(100, 90)], season="2024-25", start="2024-11-01")
    old, most = series([(90, 100)], season="2023-24", start="2023-11-01")
    older, rest = series([(90, 100)], season="2022-23", start="2022-11-01")
    games = now + last + old + older
    crews = [{"game_id": g["game_id"], "referee_1": "1", "referee_2": "2"} for g in games]
    crews[0]["referee_2"] = "1"
    return League(league_tables(
        spark, games=games, team_game_stats=stats + more + most + rest, referee_assignments=crews,
        dim_referees=[{"referee_id": 1, "full_name": "Ann"}],
    ))


def test_season_weights(spark):
    record = {(r.team_id, r.referee_id): r for r in officials_league(spark).team_referee_record().collect()}
    row = record[("AAA", "2")]
    # Seasons 2026 (a loss and a win), 2025 (a win) and 2024 (a loss); 2023 is too old.
    assert (row.games_with_referee, row.current_season_games) == (4, 2)
    assert row.weighted_win_pct == round((1 + 0.4) / (2 + 0.4 + 0.15), 3)
    assert row.current_season_ref_effect == row.current_season_win_pct == 0.5
    # Share of the last ten games, each with its own game: 0, .5, .667, .5, .6 and so on.
    shares = {2024: 0.0, 2025: 0.333, "loss": 0.4, "win": 0.5}
    effect = ((0 - 0.4) + (1 - 0.5)) * 1 + (1 - 0.333) * 0.4 + (0 - shares[2024]) * 0.15
    assert row.weighted_ref_effect == pytest.approx(effect / 2.55, abs=6e-4)
    assert row.home_games == 4 and row.home_win_pct == 0.5


def test_merged_states_equal_the_whole(spark, tmp_path):
    league = officials_league(spark)
    whole = sorted(map(tuple, league.team_referee_record().collect()), key=str)
    states = league.official_states().cache()
    # Games in two parts that share no game, whatever seasons they belong to.
    form, crews = league._team_form, league.stg("referee_assignments")
    first = F.pmod(F.xxhash64("game_id"), F.lit(2)) == 0
    parts = [officials.season_states(form.where(x), crews) for x in (first, ~first)]
    assert sorted(map(tuple, officials.merge_states(*parts).collect()), key=str) == sorted(map(tuple, states.collect()), key=str)
    # Seasons published one by one, one of them twice.
    path = str(tmp_path / "states")
    seasons = sorted(r.season for r in states.select("season").distinct().collect())
    for season in [*seasons, seasons[0]]:
        officials.publish_states(states.where(F.col("season") == season), path)
    published = officials.read_states(spark, path)
    assert sorted(map(tuple, officials.effect_of_states(published, league.season_now).collect()), key=str) == whole
    # Only seasons with a weight are needed.
    newest = officials.read_states(spark, path, [2026, 2025, 2024])
    assert sorted(map(tuple, officials.effect_of_states(newest, 2026).collect()), key=str) == whole
    assert newest.count() < states.count()


def test_official_named_twice(spark):
    league = officials_league(spark)
    tendencies = as_dicts(league.referee_tendencies(), "referee_id")
    # Both slots count as a game of the official, but the crew mean names the official once.
    assert tendencies["1"]["games_officiated"] == 7 and tendencies["2"]["games_officiated"] == 5
    rows = as_dicts(league.team_performance_by_pace().where("team_id = 'AAA'"), "game_id")
    assert rows["2025-000"]["crew_avg_total_points"] == tendencies["1"]["avg_total_points"]


def test_official_summary_labels(spark):
    summary = as_dicts(officials_league(spark).referee_summary(), "referee_id")
    assert summary["1"]["referee_name"] == "Ann" and summary["2"]["referee_name"] is None
    assert summary["1"]["current_season"] == 2026 and summary["1"]["season_games"] == 4
    assert summary["1"]["home_bias_label"] == "strong_home_bias"
    assert summary["2"]["home_bias_label"] == "strong_home_bias" or summary["2"]["season_home_win_pct"] == 0.5
    assert {r["sample_size_label"] for r in summary.values()} == {"insufficient"}
    assert {r["foul_tendency_label"] for r in summary.values()} == {"average"}


def test_one_game_has_no_deviation(spark):
    games, stats = series([(100, 90)])
    league = League(league_tables(
        spark, games=games, team_game_stats=stats,
        referee_assignments=[{"game_id": "2025-000", "referee_1": "1"}],
    ))
    row = league.team_referee_record().where(F.col("team_id") == "BBB").first()
    assert row.ref_effect_stddev is None and row.home_win_pct is None and row.home_games == 0


def test_team_summary_without_home_games(spark):
    games, stats = series([(100, 90), (80, 95)])
    row = as_dicts(League(league_tables(spark, games=games, team_game_stats=stats)).team_summary(), "team_id")
    assert row["BBB"]["home_games"] is None and row["BBB"]["away_games"] == 2
    assert row["BBB"]["avg_margin_away"] == 2.5 and row["BBB"]["current_streak"] == "W1"


def test_key_report(spark):
    games, stats = series([(100, 90), (80, 95)])
    lost = {**stats[1], "game_id": None}
    league = League(league_tables(spark, games=games, team_game_stats=[*stats, stats[0], stats[0], lost, lost]))
    report = as_dicts(league.key_report(), "table_name")
    assert report["games"] == {
        "table_name": "games", "row_count": 2, "key_count": 2, "repeated_keys": 0, "rows_without_key": 0,
    }
    box = report["team_game_stats"]
    assert [box[c] for c in ("row_count", "key_count", "repeated_keys", "rows_without_key")] == [8, 4, 1, 2]
    assert report["dim_arenas"]["row_count"] == 0 and set(report) == set(RAW_KEYS)


def test_key_columns_are_unique(spark):
    """The models take one raw row per key; this is what they produce from such rows."""
    league = officials_league(spark)
    for df, keys in (
        (league.game_scores, ["game_id"]), (league.team_record(), ["team_id", "game_id"]),
        (league.team_referee_record(), ["team_id", "referee_id"]), (league.game_card(), ["game_id"]),
    ):
        assert df.count() == df.select(*keys).distinct().count()


def three_seasons():
    games, stats = [], []
    for year in (2024, 2025, 2026):
        rows, boxes_ = series([(100, 90)] * 2, season=f"{year - 1}-{year % 100}", start=f"{year - 1}-11-01")
        games += rows
        stats += boxes_
    crews = [{"game_id": g["game_id"], "referee_1": "7"} for g in games]
    return dict(games=games, team_game_stats=stats, referee_assignments=crews)


def test_a_given_season_leaves_later_ones_out(spark):
    league = League(league_tables(spark, **three_seasons()), season=2025)
    effect = as_dicts(league.team_referee_record(), "team_id")["AAA"]
    assert (effect["games_with_referee"], effect["current_season_games"], effect["home_games"]) == (4, 2, 4)
    flags = {(r.season, r.is_current_season) for r in league.team_performance_by_pace().collect()}
    assert flags == {(2024, False), (2025, True), (2026, False)}


def test_repeated_box_rows_count_once(spark):
    rows, stats = series([(100, 90)])
    scores = League(league_tables(spark, games=rows, team_game_stats=stats + stats)).boxes.collect()
    assert [(r.home_points, r.away_points, r.home_team_id) for r in scores] == [(100, 90, "AAA")]
    one_side = League(league_tables(spark, games=rows, team_game_stats=stats[:1])).boxes
    assert one_side.count() == 0
