import datetime as dt
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from courtside.functions import dates, geo, pick_text as pt
from courtside.functions.numeric import (
    bucketize, flag, greatest_or_null, least_or_null, one_if, ratio, round_half_up,
)
from courtside.functions.text import (
    NAME_PROFILES, NOT_PLAIN, clock_to_minutes, compile_spelling, match_key, normalize_name, season_end_year,
    title_case,
)


def apply(spark, make, values, kind):
    """One result per input value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", make(F.col("v")).alias("r")).collect())]


def test_round_half_up(spark):
    values = [0.25, -0.25, 2.5, -2.5, 0.0, -0.04, None, 1234.5678]
    assert apply(spark, lambda v: round_half_up(v, 1), values, "double") == [
        0.3, -0.3, 2.5, -2.5, 0.0, 0.0, None, 1234.6
    ]
    assert apply(spark, lambda v: round_half_up(v, 0), [2.5, -2.5], "double") == [3.0, -3.0]
    zero = apply(spark, lambda v: round_half_up(v, 1), [-0.04], "double")[0]
    assert math.copysign(1, zero) == 1.0


def test_ratio_and_guards(spark):
    df = spark.sql("SELECT 1L AS a, 0L AS z, CAST(NULL AS BIGINT) AS n")
    row = df.select(
        ratio("a", "z").alias("zero"), least_or_null("a", "z").alias("least"),
        least_or_null("a", "n").alias("least_null"), greatest_or_null("a", "n").alias("greatest_null"),
        one_if(F.col("n") > 0).alias("unknown"), flag(F.col("n") > 0).alias("flag"),
    ).first()
    assert row.asDict() == {
        "zero": None, "least": 0, "least_null": None, "greatest_null": None, "unknown": 0, "flag": False
    }


def test_bucketize_null_falls_through(spark):
    steps = [(">=", 106.0, "fast"), (">=", 100.0, "average")]
    assert apply(spark, lambda v: bucketize(v, steps, "slow"), [106.0, 100.0, 99.9, None], "double") == [
        "fast", "average", "slow", "slow"
    ]


def test_clock(spark):
    values = ["12:30", "7", "", None, "0:45", "bad"]
    assert apply(spark, clock_to_minutes, values, "string") == [12.5, 7.0, 0.0, 0.0, 0.75, None]


def test_season(spark):
    assert apply(spark, season_end_year, ["2025-26", "1999-00"], "string") == [2026, 2000]


@pytest.mark.parametrize(
    "raw, box_score, injury",
    [
        ("LeBron JAMES", "Lebron James", "Lebron James"),
        ("karl-anthony towns", "Karl-Anthony Towns", "Karl-Anthony Towns"),
        ("j.r. smith", "J.R. Smith", "J.R. Smith"),
        ("de'aaron fox", "De'aaron Fox", "De'aaron Fox"),
        ("Robert Williams III", "Robert Williams", "Robert Williams"),
        ("Gary Payton II", "Gary Payton", "Gary Payton"),
        ("Jimmy Butler V", "Jimmy Butler", "Jimmy Butler"),
        ("Nikola Jokić", "Nikola Jokic", "Nikola Jokic"),
        ("Dāvis Bertāns", "Dvis Bertns", "Dvis Bertns"),
        ("Kristaps Porziņģis", "Kristaps Porzingis", "Kristaps Porzingis"),
        ("Dennis Schröder", "Dennis Schroder", "Dennis Schroder"),
        ("Alperen Şengün", "Alperen Sengun", "Alperen Sengun"),
        ("José Alvarado", "Jose Alvarado", "Jose Alvarado"),
        ("Luka Šamanić", "Luka Samanic", "Luka Samanic"),
        ("Åke", "Ske", "Ake"),
        ("DennÃ¼s", "Dennus", "Dennas"),
        ("JokiÄ\u0087", "Jokic", "Jokic"),
    ],
)
def test_names(spark, raw, box_score, injury):
    assert apply(spark, lambda v: normalize_name(v, "box_score"), [raw], "string") == [box_score]
    assert apply(spark, lambda v: normalize_name(v, "injury"), [raw], "string") == [injury]


@pytest.mark.parametrize("profile", ["box_score", "injury"])
def test_one_pass_equals_the_rules_one_by_one(spark, profile):
    rules = [*NAME_PROFILES[profile], (NOT_PLAIN, "")]
    letters = sorted(set("".join(pattern for pattern, _ in rules[:-1])) - set("[]|")) + ["a", "\u4e2d", "\U0001f600", "\u0301"]
    draw = random.Random(profile)
    names = ["".join(draw.choices(letters, k=draw.randint(0, 6))) for _ in range(3000)]
    names += [a + b for a in letters for b in letters]

    def one_by_one(name):
        for pattern, replacement in rules:
            name = re.sub(pattern, replacement, name)
        return name

    dropped, known, replacements = compile_spelling(NAME_PROFILES[profile])
    found = apply(spark, lambda v: F.translate(F.regexp_replace(v, dropped, ""), known, replacements), names, "string")
    assert found == [one_by_one(name) for name in names]


def test_pairs_that_one_pass_cannot_tell_apart():
    with pytest.raises(ValueError):
        compile_spelling([("\u00e9\u00ea", "a"), ("\u00e8\u00ea", "b")])


def test_title_case_keeps_every_character(spark):
    values = ["KARL-ANTHONY o'neal", "  two  blanks ", "a\tb\nc", "x/y|z", "", None]
    assert apply(spark, title_case, values, "string") == [
        "Karl-Anthony O'neal", "  Two  Blanks ", "A\tB\nC", "X/Y|Z", "", None
    ]


def test_match_key(spark):
    assert apply(spark, match_key, ["O'Neal, Royce 2"], "string") == ["oneal royce "]


def test_zone_table(spark):
    zones = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"]
    hours = {z: -i for i, z in enumerate(zones)}
    pairs = [(a, b) for a in [*zones, "America/Phoenix", None] for b in [*zones, "America/Phoenix"]]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", geo.zone_shift(F.col("a"), F.col("b")).alias("s")).collect():
        known = row.a in hours and row.b in hours
        assert row.s == (hours[row.b] - hours[row.a] if known else 0), row


def test_miles(spark):
    df = spark.createDataFrame(
        [(40.75, -73.99, 34.04, -118.27), (40.0, -70.0, 40.0, -70.0), (None, -70.0, 40.0, -70.0)],
        "a double, b double, c double, d double",
    )
    miles = [r[0] for r in df.select(geo.great_circle_miles(*(F.col(c) for c in "abcd"))).collect()]
    assert miles[0] == pytest.approx(2450, abs=5) and miles[1] == 0.0 and miles[2] is None


def test_recap_week(spark):
    days = [dt.date(2026, 3, 8) + dt.timedelta(days=i) for i in range(9)]
    sundays = apply(spark, dates.recap_sunday, days, "date")
    assert sundays == [d - dt.timedelta(days=(d.weekday() + 1) % 7) for d in days]
    assert apply(spark, dates.recap_monday, days, "date") == [s - dt.timedelta(days=6) for s in sundays]


def test_default_day_is_new_york(spark):
    from datetime import datetime, timezone
    from zoneinfo import ZoneInfo

    before = datetime.now(timezone.utc).astimezone(ZoneInfo("America/New_York")).date()
    day = spark.range(1).select(dates.as_date(None)).first()[0]
    after = datetime.now(timezone.utc).astimezone(ZoneInfo("America/New_York")).date()
    assert before <= day <= after


def test_strengths(spark):
    values = [0.10, -0.10, 0.06, 0.059, None]
    assert apply(spark, pt.divergence_strength, values, "double") == [
        "STRONG", "STRONG", "MEDIUM", "NONE", "NONE"
    ]
    assert apply(spark, pt.signal_strength, [0.3, -0.15, 0.1], "double") == ["STRONG", "MEDIUM", "WEAK"]
    assert apply(spark, pt.total_strength, [5.0, -3.0, 2.9], "double") == ["STRONG", "MEDIUM", "NONE"]


def test_texts(spark):
    assert apply(spark, pt.one_decimal, [3.25, -3.25, 0.0, -0.01, 110.0, None], "double") == [
        "3.3", "-3.3", "0.0", "0.0", "110.0", None
    ]
    assert apply(spark, pt.signed, [3.5, -3.5, 0.0], "double") == ["+3.5", "-3.5", "0.0"]
    assert apply(spark, pt.margin_text, [7, -7, 0, None], "bigint") == ["+7", "-7", "+0", None]
    assert apply(spark, pt.total_side, [6.0, -6.0, 4.0, None], "double") == [
        "OVER (~6.0 pts)", "UNDER (~6.0 pts)", "UNDER (~4.0 pts)", "UNDER (~0.0 pts)"
    ]
    assert apply(spark, pt.result_label, [True, False, None], "boolean") == [pt.WIN, pt.LOSS, pt.PUSH]
    assert [f[:10] for f in apply(spark, pt.total_flag, [5.0, -5.0, 3.0, -3.0, 0.0], "double")] == [
        "OVER — tot", "UNDER — to", "SLIGHT OVE", "SLIGHT UND", "FAIR"
    ]
    assert [f[:9] for f in apply(spark, pt.spread_flag, [0.1, -0.1, 0.06, -0.06, 0.0], "double")] == [
        "HOME EDGE", "AWAY EDGE", "SLIGHT HO", "SLIGHT AW", "FAIR"
    ]


def test_record_text(spark):
    df = spark.createDataFrame([(7, 10), (0, 0), (1, 3)], "c bigint, t bigint")
    assert [r[0] for r in df.select(pt.record_text(F.col("c"), F.col("t"))).collect()] == [
        "7-3 (70.0%)", "0-0 (0.0%)", "1-2 (33.3%)"
    ]
