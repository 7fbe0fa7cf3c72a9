"""Typed configuration shared by every job."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Default topic names and time limits of the feed.
TOPICS = {
    "raw": "wiki.edits.raw",
    "clean": "wiki.edits.clean",
    "dlq": "wiki.edits.dlq",
    "stats": "wiki.stats.per_wiki_1m",
    "alerts": "wiki.alerts.edit_wars",
}


@dataclass(frozen=True)
class Settings:
    """Everything a job can be told. Intervals are plain integers, so no unit can be mistyped."""

    bootstrap_servers: str = "127.0.0.1:9092"
    topics: Mapping[str, str] = field(default_factory=lambda: dict(TOPICS))
    captures: str = ""
    bounded: bool = False
    out_of_order_seconds: int = 15
    window_minutes: int = 1
    war_seconds: int = 600
    trigger_seconds: int = 10
    bytes_per_trigger: int = 1 << 30
    offsets_per_trigger: int = 5_000_000

    def __post_init__(self) -> None:
        for name in (
            "out_of_order_seconds",
            "window_minutes",
            "war_seconds",
            "trigger_seconds",
            "bytes_per_trigger",
            "offsets_per_trigger",
        ):
            check_positive(name, getattr(self, name))
        unknown = set(self.topics) ^ set(TOPICS)
        if unknown:
            raise ValueError(f"topics must name exactly {sorted(TOPICS)}, got {sorted(self.topics)}")

    def topic(self, stage: str) -> str:
        return self.topics[stage]

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> Settings:
        """Defaults, then CHANGEFEED_* variables, then explicit overrides."""
        env = os.environ if env is None else env
        prefix = env.get("CHANGEFEED_TOPIC_PREFIX", "")
        values = {"topics": {stage: prefix + name for stage, name in TOPICS.items()}}
        if servers := env.get("CHANGEFEED_BOOTSTRAP_SERVERS"):
            values["bootstrap_servers"] = servers
        if captures := env.get("CHANGEFEED_CAPTURES"):
            values["captures"] = captures
        values["bounded"] = env.get("CHANGEFEED_BOUNDED") == "1"
        return cls(**{**values, **overrides})


def check_positive(name: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive whole number, got {value!r}")
    return value
