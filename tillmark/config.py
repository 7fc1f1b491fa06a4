"""Run settings and their checks, all on the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

# Feature and label names carry these spans, so other values are refused.
HISTORY_DAYS = 365
HORIZON_DAYS = 90
ACTIVE_DAYS = 180
RECENT_DAYS = 90


def as_moment(value: str | date | datetime) -> datetime:
    return datetime.fromisoformat(str(value))


@dataclass(frozen=True)
class RunConfig:
    """Chronological split and campaign settings of one run."""

    train_cutoffs: Sequence[str]
    validation_cutoff: str
    test_cutoff: str
    score_cutoff: str
    observed_until: str
    start: str | None = None
    history_days: int = HISTORY_DAYS
    horizon_days: int = HORIZON_DAYS
    active_days: int = ACTIVE_DAYS
    campaign_capacity: int = 150
    control_fraction: float = 0.2
    seed: int = 42

    @property
    def labelled_cutoffs(self) -> list[str]:
        return [*self.train_cutoffs, self.validation_cutoff, self.test_cutoff]

    @property
    def splits(self) -> dict[str, str]:
        """Cutoff to split name, the scoring cutoff included."""
        names = {cutoff: "train" for cutoff in self.train_cutoffs}
        names[self.validation_cutoff] = "validation"
        names[self.test_cutoff] = "test"
        names[self.score_cutoff] = "score"
        return names


def validate_split_plan(config: RunConfig, observed_until: str | datetime | None = None) -> None:
    """Refuse unsorted cutoffs, overlapping outcome windows and disagreeing end dates."""
    spans = (config.history_days, config.horizon_days, config.active_days)
    if spans != (HISTORY_DAYS, HORIZON_DAYS, ACTIVE_DAYS):
        raise ValueError("Names of features and labels carry their spans, which are fixed: 365 days of history, 90 of outcome, 180 of activity.")
    cutoffs = [as_moment(c) for c in config.train_cutoffs]
    if not cutoffs or cutoffs != sorted(set(cutoffs)):
        raise ValueError("List each training cutoff once, sorted from the oldest on.")
    horizon = timedelta(days=config.horizon_days)
    steps = [cutoffs[-1], *map(as_moment, (config.validation_cutoff, config.test_cutoff, config.score_cutoff))]
    if any(earlier + horizon > later for earlier, later in zip(steps, steps[1:])):
        raise ValueError("Overlapping outcome windows across train, validation, test and scoring.")
    end = as_moment(config.observed_until)
    if as_moment(config.score_cutoff) != end:
        raise ValueError("The scoring cutoff must be the exclusive end of observation.")
    if observed_until is not None and as_moment(observed_until) != end:
        raise ValueError("Settings and data disagree on the end of observation.")


def require_complete_follow_up(cutoffs: Sequence[str], horizon_days: int, observed_until: str | datetime) -> None:
    """Right-censoring guard: every outcome window must end inside the observed time."""
    end = as_moment(observed_until)
    for cutoff in cutoffs:
        if as_moment(cutoff) + timedelta(days=horizon_days) > end:
            raise ValueError(f"Right-censored labels: no complete follow-up after {cutoff}.")
