"""Courtside: league schedule, form, officiating and matchup analytics on PySpark."""

from courtside.plans.league import League
from courtside.sources.readers import RawTables, read_league

__all__ = ["League", "RawTables", "read_league"]
