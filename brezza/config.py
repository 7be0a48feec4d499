"""Configuration as plain values, and windows of days."""

from __future__ import annotations

import calendar
import dataclasses
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

from brezza.errors import ConfigError


@dataclass(frozen=True)
class EngineConfig:
    """Thresholds and conventions; threaded through the operators as arguments, never global."""

    local_utc_offset_hours: int = 1
    lookback_days: int = 30
    weather_coordinate_decimals: int = 1
    windy_day_min_wind_ms: float = 3.0
    rainy_day_min_precipitation_mm: float = 1.0
    min_days_for_correlation: int = 20
    min_annual_coverage: float = 0.9
    min_coverage: float = 0.75
    rolling_hours: int = 8
    raw_freshness_hours: int = 48
    weather_freshness_days: int = 7
    completeness_days: int = 30
    min_recent_completeness: float = 0.9
    max_export_bytes: int = 2_000_000
    daily_pollutants: tuple[int, ...] = field(default=())

    @classmethod
    def parse(cls, values: Mapping[str, object], environment: Mapping[str, str] | None = None, prefix: str = "BREZZA") -> EngineConfig:
        """Values by name, overridden by variables ``BREZZA__<NAME>``.

        An unknown name, or a text that is not a number where one belongs, is an error.  Variables without the double underscore
        after the prefix are ignored.
        """
        merged = dict(values)
        for variable, text in (environment or {}).items():
            if variable.startswith(f"{prefix}__"):
                merged[variable[len(prefix) + 2 :].lower()] = text
        kinds = {f.name: type(f.default) if f.default is not dataclasses.MISSING else tuple for f in dataclasses.fields(cls)}
        for name, value in merged.items():
            if name not in kinds:
                raise ConfigError(f"unknown setting {name!r}")
            if isinstance(value, str) and kinds[name] in (int, float):
                try:
                    merged[name] = kinds[name](value)
                except ValueError:
                    raise ConfigError(f"{name} must be {kinds[name].__name__}, not {value!r}") from None
            if kinds[name] is tuple:
                merged[name] = tuple(int(x) for x in value.split(",")) if isinstance(value, str) else tuple(value)  # type: ignore[arg-type]
        return cls(**merged)  # type: ignore[arg-type]


@dataclass(frozen=True)
class DateWindow:
    """Days from first to last, both included."""

    first: date
    last: date

    def __post_init__(self) -> None:
        if self.first > self.last:
            raise ConfigError(f"the window begins on {self.first}, after its end on {self.last}")

    @classmethod
    def ending_on(cls, last: date, days: int) -> DateWindow:
        """The ``days`` days that end with ``last``; 0 counts as 1."""
        return cls(last - timedelta(days=max(1, days) - 1), last)

    def __contains__(self, day: date) -> bool:
        return self.first <= day <= self.last

    def within_year(self, year: int) -> DateWindow | None:
        """The part in a calendar year, if any."""
        first, last = max(self.first, date(year, 1, 1)), min(self.last, date(year, 12, 31))
        return DateWindow(first, last) if first <= last else None

    def months(self) -> Iterator[DateWindow]:
        """Calendar months, clipped to both ends."""
        first = self.first
        while first <= self.last:
            end = first.replace(day=calendar.monthrange(first.year, first.month)[1])
            yield DateWindow(first, min(end, self.last))
            first = end + timedelta(days=1)


def resolve_window(first: date | None, last: date | None, today: date, days: int) -> DateWindow:
    """The window asked for; without a last day it ends today, without a first it has ``days`` days."""
    last = last or today
    return DateWindow(first, last) if first else DateWindow.ending_on(last, days)


def provisional_window(today: date, days: int, earliest: date) -> DateWindow:
    """The days that may still be revised, not before the earliest one."""
    window = DateWindow.ending_on(today, days)
    return DateWindow(max(window.first, earliest), window.last)


def legal_day(stamp: datetime, offset_hours: int = 1) -> date:
    """The local day of a value that is stamped at the end of its period."""
    return (stamp.astimezone(UTC) + timedelta(hours=offset_hours) - timedelta(seconds=1)).date()


def local_today(now: datetime, offset_hours: int = 1) -> date:
    return (now.astimezone(UTC) + timedelta(hours=offset_hours)).date()


def bootstrap_requests(has_archive: bool, has_warehouse: bool, today: date) -> list[tuple[str, str]]:
    """(what to run, key of the run) on a first start: the archive first, then a refresh, then nothing."""
    if has_warehouse:
        return []
    return [("refresh" if has_archive else "archive", f"{'refresh' if has_archive else 'archive'}-{today}")]
