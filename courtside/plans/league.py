"""All models of one league, wired to its raw tables."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F

from courtside.operators.keyed import Season, key_counts
from courtside.operators.staging import stage
from courtside.operators.timeline import Timeline
from courtside.plans import card, games, officials, picks, players, recap, schedule, staging, teams
from courtside.sources.readers import RawTables
from courtside.sources.schemas import RAW_KEYS


class League:
    """Models by name; all of them are lazy.

    With ``work_folder``, a folder that all executors share, the schedule, ``played`` (wide games
    with pace, on which much of the card stands), the card's tables by team, pair and official and, for the models of players, their appearances and season
    means are written there once and read back, and the newest season is looked up in the schedule, so that it
    is a literal in all filters.
    """

    def __init__(
        self,
        raw: RawTables,
        season: int | None = None,
        as_of_date: dt.date | str | None = None,
        travel_scope: str = "side",
        work_folder: str | None = None,
    ):
        self.raw = raw
        self.season = season
        self.as_of_date = as_of_date
        self.travel_scope = travel_scope
        self.work_folder = work_folder
        self._staging: dict[str, DataFrame] = {}

    def stg(self, name: str) -> DataFrame:
        """A staging model by the name of its raw table."""
        if name not in self._staging:
            self._staging[name] = getattr(staging, name)(self.raw[name])
        return self._staging[name]

    def _shared(self, df: DataFrame, name: str) -> DataFrame:
        """df, written once if the league has a work folder."""
        return stage(df, f"{self.work_folder}/{name}-{uuid.uuid4().hex}") if self.work_folder else df

    @cached_property
    def schedule(self) -> DataFrame:
        """All games, played or not."""
        return self._shared(self.stg("games"), "games")

    @cached_property
    def season_now(self) -> Season:
        """The current season: the given year, else the newest in the schedule as one row or, if written, a year."""
        if self.season is not None:
            return self.season
        newest = self.schedule.agg(F.max("season").alias("current_season"))
        year = newest.first()["current_season"] if self.work_folder else None
        return newest if year is None else year

    def key_report(self) -> DataFrame:
        """How far the keys of the raw tables hold, one row per table."""
        counts = [
            key_counts(self.raw[name], keys).select(F.lit(name).alias("table_name"), "*")
            for name, keys in RAW_KEYS.items()
        ]
        return reduce(DataFrame.unionByName, counts)

    # -- games ------------------------------------------------------------------------------

    @cached_property
    def boxes(self) -> DataFrame:
        """Played games without the quarters, which most models do not need.

        The optimizer keeps an unused left join, so leaving it out saves a scan and a shuffle.
        """
        return games.box_scores(self.schedule, self.stg("team_game_stats"))

    @cached_property
    def paced(self) -> DataFrame:
        """Box scores with pace."""
        return games.with_pace(self.boxes, self.stg("game_results"))

    @cached_property
    def game_scores(self) -> DataFrame:
        return games.wide_game(self.boxes, self.stg("team_quarter_stats"))

    @cached_property
    def played(self) -> DataFrame:
        """Wide games with pace."""
        return self._shared(games.with_pace(self.game_scores, self.stg("game_results")), "played")

    def game_pace(self) -> DataFrame:
        return games.game_pace(self.boxes, self.stg("game_results"))

    def national_broadcast_flag(self) -> DataFrame:
        return games.national_broadcast_flag(self.boxes, self.stg("broadcast_schedule"))

    def head_to_head(self) -> DataFrame:
        return games.head_to_head(self.boxes)

    # -- teams ------------------------------------------------------------------------------

    @cached_property
    def paced_timeline(self) -> Timeline:
        """Team games with pace, in order."""
        return teams.team_timeline(games.team_rows(self.paced))

    @cached_property
    def timeline(self) -> Timeline:
        """Team games in order, without pace: for models that need the result alone."""
        return teams.team_timeline(games.team_rows(self.boxes))

    def team_record(self) -> DataFrame:
        return teams.running_record(self.timeline)

    def season_team_record(self) -> DataFrame:
        by_season = Timeline.of(
            games.team_rows(self.boxes), ["team_id", "season"], teams.TEAM_ORDER
        )
        return teams.running_record(by_season, by_season=True)

    def team_streaks(self) -> DataFrame:
        return teams.streaks(self.timeline)

    def team_rolling_averages(self) -> DataFrame:
        return teams.rolling_averages(self.paced_timeline)

    def team_performance_by_pace(self) -> DataFrame:
        crews = teams.crew_average(self.stg("referee_assignments"), self.referee_tendencies())
        return teams.performance_by_pace(self.paced_timeline, crews, self.season_now)

    @cached_property
    def _team_form(self) -> DataFrame:
        return teams.rolling_timeline(self.timeline, ["win_pct_last10"]).rows

    def team_referee_record(self) -> DataFrame:
        return officials.team_official_effect(
            self._team_form, self.stg("referee_assignments"), self.season_now
        )

    def official_states(self) -> DataFrame:
        """Mergeable moments per team, official and season, from which ``team_referee_record`` follows."""
        return officials.season_states(self._team_form, self.stg("referee_assignments"))

    def team_summary(self) -> DataFrame:
        return teams.team_summary(games.team_rows(self.paced), self.stg("team_quarter_stats"))

    # -- schedule ---------------------------------------------------------------------------

    @cached_property
    def _schedule_rows(self) -> DataFrame:
        return schedule.schedule_rows(self.schedule, self.stg("dim_arenas"))

    @cached_property
    def schedule_context(self) -> DataFrame:
        return schedule.schedule_context(schedule.schedule_timeline(self._schedule_rows))

    def rest_days(self) -> DataFrame:
        return schedule.rest_days(self.schedule_context)

    def timezone_lag(self) -> DataFrame:
        return schedule.timezone_lag(self.schedule_context)

    def altitude_fatigue(self) -> DataFrame:
        return schedule.altitude_fatigue(self.schedule_context)

    def travel(self) -> DataFrame:
        return schedule.travel_miles(
            schedule.travel_timeline(self._schedule_rows, self.travel_scope)
        )

    def altitude_fatigue_by_quarter(self) -> DataFrame:
        return schedule.altitude_by_quarter(self.stg("team_quarter_stats"), self.altitude_fatigue())

    def altitude_fatigue_by_player(self) -> DataFrame:
        return schedule.altitude_by_player(
            self.stg("player_quarter_stats"), self.boxes, self.altitude_fatigue()
        )

    # -- officials --------------------------------------------------------------------------

    def referee_tendencies(self) -> DataFrame:
        return officials.official_tendencies(self.stg("referee_assignments"), self.boxes)

    def referee_summary(self) -> DataFrame:
        return officials.official_summary(
            self.stg("referee_assignments"), self.paced, self.stg("dim_referees")
        )

    # -- players ----------------------------------------------------------------------------

    @cached_property
    def player_timeline(self) -> Timeline:
        return players.player_timeline(self.appearances)

    @cached_property
    def appearances(self) -> DataFrame:
        """Player games with time on the court."""
        dates = self._shared(self.boxes.select("game_id", "game_date", "season"), "dates")
        return self._shared(players.appearances(self.stg("player_game_stats"), dates), "appearances")

    @cached_property
    def baseline(self) -> DataFrame:
        """Season means, one row per player."""
        return self._shared(players.season_baseline(self.appearances, self.season_now), "baseline")

    def player_rolling_averages(self) -> DataFrame:
        return players.player_rolling_averages(self.player_timeline, self.baseline)

    def player_streaks(self) -> DataFrame:
        return players.player_streaks(self.player_timeline, self.baseline)

    def player_summary(self) -> DataFrame:
        return players.player_summary(
            self.appearances, self.baseline, self.stg("player_quarter_stats")
        )

    def player_referee_stats(self) -> DataFrame:
        return players.player_official_outliers(
            self.stg("player_game_stats"), self.stg("games"), self.season_now,
            self.stg("referee_assignments"),
            players.current_form(self.appearances, self.baseline),
            self.stg("dim_referees"),
        )

    def returning_players(self) -> DataFrame:
        return players.returning_players(
            self.stg("games"), self.season_now, self.stg("player_game_stats"), self.appearances,
            self.baseline, self.stg("injuries"), self.as_of_date,
        )

    # -- card and picks ---------------------------------------------------------------------

    def game_card(self) -> DataFrame:
        assignments, rows = self.stg("referee_assignments"), games.team_rows(self.played)
        form = teams.rolling_timeline(teams.team_timeline(rows), ["win_pct_last10"]).rows
        return card.game_card(
            games=self.schedule,
            played=self.played,
            broadcasts=self.stg("broadcast_schedule"),
            features=schedule.schedule_features(
                schedule.schedule_timeline(self._schedule_rows),
                schedule.travel_timeline(self._schedule_rows, self.travel_scope),
            ),
            rows=rows,
            season_now=self.season_now,
            assignments=assignments,
            tendencies=officials.official_tendencies(assignments, self.played),
            official_effect=officials.team_official_effect(form, assignments, self.season_now),
            shared=self._shared,
        )

    def unpublished_games(self, batch: str) -> DataFrame:
        return picks.unpublished_games(
            self.raw["scored_games"], self.raw["game_previews"], self.as_of_date, batch
        )

    def preview_batch(self, batch: str) -> DataFrame:
        return picks.flagged_batch(
            self.raw["scored_games"], self.raw["game_previews"], self.as_of_date, batch
        )

    def pick_record(self) -> DataFrame:
        return recap.pick_record(self.raw["model_tracker"], self.as_of_date)

    def recap_lines(self) -> DataFrame:
        return recap.recap_lines(recap.week_picks(self.raw["model_tracker"], self.as_of_date))
