import datetime as dt

import pytest
from helpers import frame

from pyspark.sql import functions as F

from courtside.plans import picks, recap
from courtside.sources.schemas import PREVIEW_INSIGHTS

DAY = dt.date(2026, 3, 9)


def score(home, away, hour=1, day=DAY, tipoff="19:00:00", **more):
    return {"game_date": day, "home_team_id": home, "away_team_id": away, "tipoff_time": tipoff,
            "inserted_at": dt.datetime(2026, 3, 9, hour), **more}


def homes(df):
    return sorted(r.home_team_id for r in df.collect())


def test_unpublished_games(spark):
    scores = frame(spark, "scored_games", [
        score("A", "B", 1, composite_score=0.1), score("A", "B", 2, composite_score=0.2),
        score("C", "D", tipoff="13:00:00"), score("E", "F"), score("A", "B", 3, day=dt.date(2026, 3, 8)),
    ])
    published = frame(spark, "game_previews", [
        {"game_date": DAY, "home_team_id": "E", "away_team_id": "F"},
        {"game_date": dt.date(2026, 3, 8), "home_team_id": "C", "away_team_id": "D"},
    ])
    late = picks.unpublished_games(scores, published, DAY, "late")
    assert homes(late) == ["A", "C"]
    assert {r.composite_score for r in late.collect()} == {0.2, None}
    assert homes(picks.unpublished_games(scores, published, "2026-03-09", "early")) == ["C"]
    with pytest.raises(ValueError):
        picks.unpublished_games(scores, published, DAY, "noon")


def test_free_game(spark):
    first = frame(spark, "scored_games", [
        score("A", "B", tipoff="12:00:00", is_national_broadcast=False),
        score("C", "D", tipoff="20:00:00", is_national_broadcast=True),
        score("E", "F", tipoff="19:30:00", is_national_broadcast=True),
        score("G", "H", day=dt.date(2026, 3, 10), tipoff="19:00:00"),
        score("I", "J", day=dt.date(2026, 3, 10), tipoff="18:00:00"),
    ])
    flagged = picks.free_game_flag(first)
    assert homes(flagged.where("is_free_game")) == ["E", "I"] and flagged.count() == 5
    shown = picks.display_order(flagged.where(flagged.game_date == DAY)).collect()
    assert [r.home_team_id for r in shown] == ["E", "A", "C"]


def test_qualified_picks(spark):
    rows = [
        ("A", 0.10, 0.15, 0.0), ("B", 0.10, 0.14, 5.0), ("C", -0.10, -0.30, -5.0), ("D", None, None, None),
    ]
    scores = frame(spark, "scored_games", [
        score(h, "X", model_vs_market=m, composite_score=c, model_vs_line=l, spread_home=s, over_under=220.5)
        for (h, m, c, l), s in zip(rows, (-3.5, 0.0, 4.5, None))
    ])
    chosen = sorted((r.home_team_id, r.pick_type) for r in picks.qualify_picks(scores).collect())
    assert chosen == [("A", "spread"), ("B", "ou"), ("C", "ou"), ("C", "spread")]
    sides = {r.home_team_id: r for r in picks.pick_side(scores).collect()}
    assert (sides["A"].spread_pick_team, sides["A"].spread_pick_line) == ("A", "-3.5")
    assert (sides["C"].spread_pick_team, sides["C"].spread_pick_line) == ("X", "-4.5")
    assert (sides["B"].spread_pick_line, sides["B"].total_pick) == ("0.0", "OVER (~5.0)")
    assert sides["C"].total_pick == "UNDER (~5.0)" and sides["D"].spread_pick_side == "AWAY"


def test_signals(spark):
    texts = {
        PREVIEW_INSIGHTS[0]: "🔴 STRONG one", PREVIEW_INSIGHTS[2]: "⚪ CONTEXT STRONG", PREVIEW_INSIGHTS[4]: "",
        PREVIEW_INSIGHTS[6]: "some words then STRONG", PREVIEW_INSIGHTS[8]: "🟡 MEDIUM two",
        PREVIEW_INSIGHTS[-1]: "is STRONG three", PREVIEW_INSIGHTS[-2]: "🟡 MEDIUM four",
    }
    scores = frame(spark, "scored_games", [score("A", "B", **texts)])
    row = picks.extract_signals(scores).first()
    assert row.strong_signals == "🔴 STRONG one\nis STRONG three" and row.strong_count == 2
    assert row.medium_signals == "🟡 MEDIUM two\n🟡 MEDIUM four"
    short = picks.extract_signals(scores, "pick").first()
    assert short.strong_signals == "🔴 STRONG one" and "medium_signals" not in short


def test_merged_picks(spark):
    later = dt.date(2026, 3, 17)
    rows = [(DAY, "A", "B", "19:00:00", "spread", "s1"), (DAY, "A", "B", "19:00:00", "ou", "t1"),
            (DAY, "C", "D", "18:00:00", "ou", "t2"), (DAY, "E", "F", "18:00:00", "spread", None),
            (later, "A", "B", "13:00:00", "ou", "t3")]
    kinds = "game_date date, home_team_id string, away_team_id string, tipoff_time string, pick_type string, blurb string"
    df = spark.createDataFrame(rows, kinds).withColumns({c: F.lit(1.5) for c in picks.MODEL_COLUMNS})
    merged = {(r.game_date, r.home_team_id): (r.tipoff_time, r.picks_blurb, r.ou_picks_blurb) for r in picks.merge_pick_rows(df).collect()}
    assert merged == {
        (DAY, "A"): ("19:00:00", "s1", "t1"), (DAY, "C"): ("18:00:00", None, "t2"), (later, "A"): ("13:00:00", None, "t3"),
    }
    assert picks.merge_pick_rows(df).first().spread_home == 1.5


def test_early_batch_compares_numbers(spark):
    scores = frame(spark, "scored_games", [
        score("A", "B", tipoff="9:30:00"), score("C", "D", tipoff="17:59:59"), score("E", "F", tipoff="18:00:00"), score("G", "H", tipoff=None),
    ])
    nothing = frame(spark, "game_previews", [])
    assert {r.home_team_id for r in picks.unpublished_games(scores, nothing, DAY, "early").collect()} == {"A", "C"}
    assert picks.unpublished_games(scores, nothing, DAY, "late").count() == 4


def test_recap_lines_without_numbers(spark):
    row = grade("A", dt.date(2026, 3, 2), True, False) | {"spread_home": None, "over_under": None}
    lines = {r.pick_type: r.detail for r in recap.recap_lines(recap.week_picks(frame(spark, "model_tracker", [row]), "2026-03-09")).collect()}
    assert lines == {
        "spread": "Line: A N/A | Pick: A (HOME) | Result: ✅ WIN", "ou": "Total: N/A | Pick: UNDER (~6.0 pts) | Result: ❌ LOSS",
    }


def test_published_with_scores(spark):
    scores = frame(spark, "scored_games", [
        score("A", "B", 1, composite_score=0.1, model_total=200.0), score("A", "B", 2, composite_score=0.2, model_total=210.0),
        score("C", "D"),
    ])
    published = frame(spark, "game_previews", [
        {"game_date": DAY, "home_team_id": "A", "away_team_id": "B", "tipoff_time": "19:00:00", "composite_score": 0.7, "preview_text": "t"},
    ])
    row = picks.published_with_scores(published, scores, DAY, "late").first()
    assert (row.preview_text, row.composite_score, row.model_total) == ("t", 0.7, 210.0)
    assert picks.published_with_scores(published, scores, DAY, "early").count() == 0


def grade(home, day, correct, total_correct, hour=1, strong=True):
    level = "STRONG" if strong else "NONE"
    return {"game_date": day, "home_team_id": home, "away_team_id": "X", "scored_at": dt.datetime(2026, 3, 9, hour),
            "divergence_strength": level, "signal_strength": "MEDIUM", "ou_signal_strength": level,
            "divergence_correct": correct, "model_ou_correct": total_correct, "model_vs_market": 0.2,
            "model_vs_line": -6.0, "spread_home": -2.5, "over_under": 220.5, "actual_margin": 0, "actual_total": 214}


def test_pick_record(spark):
    tracker = frame(spark, "model_tracker", [
        grade("A", dt.date(2026, 3, 2), False, None, 1), grade("A", dt.date(2026, 3, 2), True, None, 2),
        grade("B", dt.date(2026, 3, 8), False, True), grade("C", dt.date(2026, 2, 1), True, False),
        grade("D", dt.date(2026, 3, 9), True, True), grade("E", dt.date(2026, 3, 3), True, True, strong=False),
    ])
    record = {(r.period, r.pick_type): (r.correct, r.total, r.record) for r in recap.pick_record(tracker, "2026-03-09").collect()}
    assert record == {
        ("week", "spread"): (1, 2, "1-1 (50.0%)"), ("week", "ou"): (1, 1, "1-0 (100.0%)"),
        ("season", "spread"): (3, 4, "3-1 (75.0%)"), ("season", "ou"): (2, 3, "2-1 (66.7%)"),
    }
    lines = recap.recap_lines(recap.week_picks(tracker, "2026-03-09")).collect()
    assert len(lines) == 3
    spread = next(r for r in lines if r.pick_type == "spread" and r.home_team_id == "A")
    assert spread.heading == "X @ A — 2026-03-02" and spread.final == "Final margin: +0"
    assert spread.detail == "Line: A -2.5 | Pick: A (HOME) | Result: ✅ WIN"
    total = next(r for r in lines if r.pick_type == "ou")
    assert total.detail == "Total: 220.5 | Pick: UNDER (~6.0 pts) | Result: ✅ WIN"
    empty = recap.pick_record(frame(spark, "model_tracker", []), "2026-03-09").collect()
    assert [(r.correct, r.total, r.record) for r in empty] == [(0, 0, "0-0 (0.0%)")] * 4
