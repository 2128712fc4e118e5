"""Run configuration, resolved once on the driver and passed in."""

from __future__ import annotations

import datetime
import os
import shlex
from collections.abc import Mapping
from dataclasses import dataclass, field

from .vocab import CHUNK_ROWS, SCORE_FLOOR

FRACTIONAL, FIRST_TPM = "fractional", "first_tpm"


@dataclass(frozen=True)
class Lane:
    """What the report and the judge need to know of a lane; categories map to headings in report order."""

    name: str
    label: str
    sources: str
    criteria: str
    categories: Mapping[str, str]


# Headings and source names of the report.
LANES = {
    FRACTIONAL: Lane(FRACTIONAL, "Fractional Roles", 'RemoteOK, We Work Remotely (Programming + Product), HN "Who is hiring"', "ROLE_CRITERIA.md", {"senior_tpm": "Senior Technical Program Management", "agentic_ai_engineer": "Agentic AI Engineer"}),
    FIRST_TPM: Lane(FIRST_TPM, "First TPM", "Greenhouse, Ashby, and Lever boards of VC-portfolio companies", "ROLE_CRITERIA_FIRST_TPM.md", {"first_tpm": "First Technical Program Manager"}),
}


def active_lanes(setting: str | None, known: Mapping[str, Lane] = LANES) -> list[str]:
    """The lanes of a comma-separated setting, trimmed and without blanks; all lanes if it is unset or blank."""
    if setting is None or not setting.strip():
        return list(known)
    chosen = [s.strip() for s in setting.split(",") if s.strip()]
    if unknown := [s for s in chosen if s not in known]:
        raise ValueError(f"unknown lanes: {', '.join(unknown)}")
    return chosen


def valid_date(text: str) -> str:
    """An ISO date, or ValueError."""
    if len(text) != 10:
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return datetime.date.fromisoformat(text).isoformat()


@dataclass(frozen=True)
class RunConfig:
    """Everything a run depends on besides its inputs."""

    run_date: str
    root: str
    lanes: tuple[str, ...] = tuple(LANES)
    chunk_rows: int = CHUNK_ROWS
    score_floor: int = SCORE_FLOOR
    delay_s: float = 0.3
    force: bool = False
    model: str = ""
    judge_command: tuple[str, ...] = ()
    topic: str | None = None
    callers: int = 4
    judge_attempts: int = 2
    backoff_s: float = 2.0
    extra: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        valid_date(self.run_date)
        if self.chunk_rows < 1:
            raise ValueError("chunk_rows must be 1 at least")


def from_environment(run_date: str, root: str, env: Mapping[str, str] | None = None, prefix: str = "SIEVEWORKS_", **more) -> RunConfig:
    """A RunConfig from variables with the given prefix.

    LANES, CHUNK_SIZE, ATS_DELAY, MODEL, JUDGE (a command line; {model} and
    {schema} in it are filled in), TOPIC (the address of notices) and CALLERS.
    """
    env = os.environ if env is None else env
    said = lambda name, default: env.get(prefix + name) or default
    return RunConfig(
        run_date, root, tuple(active_lanes(env.get(prefix + "LANES"))), int(said("CHUNK_SIZE", CHUNK_ROWS)), delay_s=float(said("ATS_DELAY", "0.3")),
        model=said("MODEL", ""), judge_command=tuple(shlex.split(said("JUDGE", ""))), topic=said("TOPIC", None), callers=int(said("CALLERS", "4")), **more,
    )
