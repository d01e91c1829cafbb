"""Settings from the environment, with the feed's fixed values."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

#: Fixed values of the feed's contract.
AGENCY_ID = "mbta"
TOPIC = "raw.vehicle-positions"
TOPIC_PARTITIONS, TOPIC_REPLICATION = 4, 1
POLL_SECONDS = 15
SAMPLE_MESSAGES, SAMPLE_SECONDS = 24_000, 30
AGENCY_ZONE = "America/New_York"


def load_env(path: str = ".env") -> None:
    """Adds NAME=value lines of a file to the environment, where not set; a missing file is no error."""
    try:
        lines = Path(path).read_text().splitlines()
    except FileNotFoundError:
        return
    for line in lines:
        name, sep, value = line.strip().partition("=")
        if sep and name and not name.startswith("#"):
            os.environ.setdefault(name.strip(), value.strip().strip("'\""))


def required(name: str) -> str:
    """An environment variable; missing or empty is an error."""
    value = os.environ.get(name)
    if not value:
        raise ValueError(f"missing environment variable {name}")
    return value


@dataclass(frozen=True)
class Settings:
    feed_url: str
    brokers: list[str] = field(default_factory=list)
    topic: str = TOPIC
    agency_id: str = AGENCY_ID

    @classmethod
    def from_env(cls) -> Settings:
        return cls(os.environ.get("FEED_URL", ""), [b.strip() for b in required("KAFKA_BROKERS").split(",")])
