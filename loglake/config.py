"""Settings of the engine; everything that isn't a function of the input rows is here."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from datetime import UTC, datetime


@dataclass(frozen=True)
class EngineConfig:
    """now: the time of a batch as RFC 3339 in UTC; one value for all its rows. reference_year: the year of
    syslog times, which carry none (default: that of now). done_ttl_s: how long a processed id is remembered.
    max_files_per_trigger and trigger_s pace the stream reader."""

    now: str = field(default_factory=lambda: datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    reference_year: int | None = None
    done_ttl_s: int = 86_400
    max_files_per_trigger: int = 10
    trigger_s: int = 2

    @classmethod
    def of(cls, spark) -> EngineConfig:
        """Settings of a session: spark.loglake.<name> for each field that is set there; the others have their defaults."""
        given = {f.name: spark.conf.get(f"spark.loglake.{f.name}", None) for f in fields(cls)}
        return cls(**{k: v if k == "now" else int(v) for k, v in given.items() if v is not None})

    @property
    def year(self) -> int:
        return self.reference_year or int(self.now[:4])
