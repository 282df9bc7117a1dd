"""From scored games to flagged previews and picks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions import pick_text as pt
from courtside.functions.dates import as_date, minute_of_day
from courtside.operators.keyed import merge_newest, newest_per_key
from courtside.sources.commits import read_version, replace_table
from courtside.sources.schemas import PICK_INSIGHTS, PREVIEW_INSIGHTS
from courtside.sources.sinks import in_report_order

GAME_KEY = ["game_date", "home_team_id", "away_team_id"]
EARLY_BEFORE = 18 * 60  # minutes of the day
TAG_CHARACTERS = 15
MONTH = "_month"  # the folders of the kept newest versions
MODEL_COLUMNS = ["composite_score", "model_vs_market", "model_vs_line", "model_total", "spread_home", "over_under"]
LEVELS = ("STRONG", "MEDIUM")


# Versions with one time stamp are decided by content, so that every run picks the same.
CONTENT_ORDER = ["composite_score", "model_vs_market", "model_vs_line", "spread_home", "over_under"]


def _content_order(df: DataFrame) -> list[Column]:
    return [F.col(c).desc() for c in CONTENT_ORDER if c in df.columns]


def latest_scores(scores: DataFrame, stamp: str = "inserted_at") -> DataFrame:
    return newest_per_key(scores, GAME_KEY, [F.col(stamp).desc(), *_content_order(scores)])


def update_latest_scores(batch: DataFrame, path: str, stamp: str = "inserted_at") -> int:
    """Bring a kept table of newest versions up to date with the versions of a batch; its version number.

    The table is in partitions by month of the game date, since a day has too few games for a file. Only
    the months of the batch are read and replaced; its distinct months pass the driver. Batches may come
    late, in any order, or twice.
    """
    month = F.date_format("game_date", "yyyy-MM")
    months = [row[0] for row in batch.select(month).distinct().collect()]
    parts = [f"{MONTH}={'__HIVE_DEFAULT_PARTITION__' if name is None else name}" for name in months]
    state = read_version(batch.sparkSession, path, batch.schema, parts)
    newest_by = [stamp, *(c for c in CONTENT_ORDER if c in batch.columns)]
    merged = merge_newest(state, batch, GAME_KEY, newest_by)
    return replace_table(merged.withColumn(MONTH, month), path, MONTH)


def _in_batch(batch: str) -> Column:
    if batch not in ("early", "late"):
        raise ValueError("batch must be 'early' or 'late'")
    return minute_of_day("tipoff_time") < EARLY_BEFORE if batch == "early" else F.lit(True)


def unpublished_games(
    scores: DataFrame, published: DataFrame, day: dt.date | str | None, batch: str
) -> DataFrame:
    """Newest version of the day's games in the batch that have no preview yet.

    The date filter reaches both scans. The batch filter comes before the choice of the version.
    """
    date = as_date(day)
    today = scores.where((F.col("game_date") == date) & _in_batch(batch))
    done = published.where(F.col("game_date") == date).select(*GAME_KEY)
    return latest_scores(today).join(done, GAME_KEY, "left_anti")


def published_with_scores(
    published: DataFrame, scores: DataFrame, day: dt.date | str | None, batch: str
) -> DataFrame:
    """The day's previews together with the newest scores of their games."""
    date = as_date(day)
    latest = latest_scores(scores.where(F.col("game_date") == date))
    previews = published.where((F.col("game_date") == date) & _in_batch(batch))
    # Columns present on both sides: the preview's own value is kept.
    repeated = [c for c in latest.columns if c in previews.columns and c not in GAME_KEY]
    return previews.join(latest.drop(*repeated, "inserted_at"), GAME_KEY)


def free_game_flag(games: DataFrame) -> DataFrame:
    """One game per date is free: a national one if there is any, then the earliest tip-off."""
    national = F.coalesce(F.col("is_national_broadcast"), F.lit(False))
    chosen = newest_per_key(
        games.withColumn("_national", national),
        ["game_date"],
        [
            F.col("_national").desc(), F.col("tipoff_time").asc(),
            F.col("home_team_id").asc(), F.col("away_team_id").asc(),
        ],
    ).select(*GAME_KEY, F.lit(True).alias("is_free_game"))
    return games.drop("is_free_game").join(chosen, GAME_KEY, "left").withColumn(
        "is_free_game", F.coalesce("is_free_game", F.lit(False))
    )


def signal_strengths(games: DataFrame) -> DataFrame:
    return games.withColumns({
        "divergence_strength": pt.divergence_strength("model_vs_market"),
        "signal_strength": pt.signal_strength("composite_score"),
        "ou_signal_strength": pt.total_strength("model_vs_line"),
    })


def is_spread_pick() -> Column:
    return (F.col("divergence_strength") == "STRONG") & F.col("signal_strength").isin(*LEVELS)


def is_total_pick() -> Column:
    return F.col("ou_signal_strength") == "STRONG"


def qualify_picks(games: DataFrame) -> DataFrame:
    """One row per qualified pick, with its type."""
    types = F.array_compact(F.array(
        F.when(is_spread_pick(), F.lit("spread")), F.when(is_total_pick(), F.lit("ou"))
    ))
    return signal_strengths(games).withColumn("pick_type", F.explode(types))


def _away_spread(spread: Column) -> Column:
    """The spread seen from the away team; an even line stays as it is."""
    size = pt.one_decimal(F.abs(spread))
    return (
        F.when(spread > 0, F.concat(F.lit("-"), size))
        .when(spread < 0, F.concat(F.lit("+"), size))
        .otherwise(pt.one_decimal(spread))
    )


def pick_side(games: DataFrame) -> DataFrame:
    """The side argued for: team and its spread, total direction with the model's distance."""
    home = pt.or_zero("model_vs_market") >= pt.HOME_EDGE
    spread = F.col("spread_home")
    return games.withColumns({
        "spread_pick_side": F.when(home, F.lit("HOME")).otherwise(F.lit("AWAY")),
        "spread_pick_team": F.when(home, F.col("home_team_id")).otherwise(F.col("away_team_id")),
        "spread_pick_line": F.when(home, pt.signed(spread)).otherwise(_away_spread(spread)),
        "total_pick": pt.total_side("model_vs_line", suffix=""),
    })


def line_flags(games: DataFrame) -> DataFrame:
    return games.withColumns({
        "total_flag": pt.total_flag("model_vs_line"),
        "spread_flag": pt.spread_flag("model_vs_market"),
    })


def _level(text: Column) -> Column:
    """STRONG or MEDIUM when the tag stands in the first characters; context and blanks: none."""
    head = F.substring(text, 1, TAG_CHARACTERS)
    tagged = F.when(head.contains("STRONG"), F.lit("STRONG")).when(
        head.contains("MEDIUM"), F.lit("MEDIUM")
    )
    return F.when((text != "") & ~text.startswith("⚪ CONTEXT"), tagged)


def _is_level(level: str):
    # One parameter only: Spark passes the position to a second one.
    return lambda text: _level(text) == level


def extract_signals(games: DataFrame, purpose: str = "preview") -> DataFrame:
    """Texts of the tagged insights, in display order, as one block per level.

    ``preview`` reads all insights and both levels, ``pick`` the shorter list and STRONG alone.
    The texts of a game are on one row, so the lists are built there without a shuffle.
    """
    fields = {"preview": PREVIEW_INSIGHTS, "pick": PICK_INSIGHTS}[purpose]
    levels = LEVELS if purpose == "preview" else LEVELS[:1]
    texts = F.array(*fields)
    blocks = {}
    for level in levels:
        of_level = F.filter(texts, _is_level(level))
        blocks[f"{level.lower()}_signals"] = F.array_join(of_level, "\n")
        blocks[f"{level.lower()}_count"] = F.size(of_level).cast("bigint")
    return games.withColumns(blocks)


def merge_pick_rows(picks: DataFrame) -> DataFrame:
    """One row per game, with its model columns and the text of its spread and of its total pick.

    Picks come with ``pick_type`` and ``blurb``; for several of one type the last by tip-off
    counts. A pick without a text is left out.
    """
    written = picks.where(F.col("blurb").isNotNull() & (F.col("blurb") != ""))
    blurb = lambda kind: F.max_by(
        F.when(F.col("pick_type") == kind, F.col("blurb")),
        F.when(F.col("pick_type") == kind, F.struct("tipoff_time", "blurb")),
    )
    return written.groupBy(*GAME_KEY).agg(
        F.min("tipoff_time").alias("tipoff_time"),
        *[F.max(c).alias(c) for c in MODEL_COLUMNS],  # the picks of a game come from one row
        blurb("spread").alias("picks_blurb"),
        blurb("ou").alias("ou_picks_blurb"),
    )


def flagged_batch(
    scores: DataFrame, published: DataFrame, day: dt.date | str | None, batch: str
) -> DataFrame:
    """A day's unpublished games with all flags, ready for the preview sink."""
    games = free_game_flag(unpublished_games(scores, published, day, batch))
    return line_flags(signal_strengths(games))


def display_order(games: DataFrame) -> DataFrame:
    """Free game first, then by tip-off."""
    return in_report_order(games, "display")
