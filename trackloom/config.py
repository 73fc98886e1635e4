"""Parameters of the rail analytics, in one frozen place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Durations are whole seconds unless the name says otherwise."""

    zone: str = "Europe/Berlin"
    grace_minutes: int = 5
    plausible_low: int = -3600
    plausible_high: int = 86400
    thresholds: tuple[int, ...] = (60, 180, 360, 900, 3600)
    on_time: int = 60
    poll_interval: int = 30
    idle_polls: int = 240
    window_days: int = 30
    run_days: int = 3
    top_sections: int = 200
    sample_trips: int = 6

    @property
    def polls_per_hour(self) -> int:
        return 3600 // self.poll_interval


DEFAULT = Config()
