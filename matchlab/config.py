"""Parameters of the feature build, with the two presets the original
application ships (its notebooks and its scheduled job disagree; see
README "Semantics")."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class FeatureConfig:
    # cut-off on match date; "after" = applied to the output of the windows,
    # "before" = applied to the input (early windows then see no history)
    min_date: _dt.date | None = _dt.date(1950, 1, 1)
    min_date_applied: str = "after"
    normalise_names: bool = True
    # day spans of the two calendar frames: [-recent, -1] and [-prior, -(recent+1)]
    recent_days: int = 180
    prior_days: int = 365
    # ranking_change when the prior half-year has no match:
    # "zero_change" -> 0.0, "zero_prior" -> last6m - 0
    prior_missing: str = "zero_change"
    fill: float = 0.0
    h2h_default: float = 0.33
    h2h_flip_constant: float = 0.25
    h2h_flip_clamp: bool = True
    unknown_rate: float = 0.33
    unknown_other: float = 0.0
    train_from: _dt.date | None = _dt.date(1990, 1, 1)
    impute: str = "median"
    test_ratio: float = 0.2
    seed: int = 42
    round_digits: int = 4
    # window strategy: "ranged" (a team's or pair's rows spread over sorted
    # ranges) or "window" (one Window per team / pair)
    strategy: str = "ranged"
    # ranges of the ranged strategy; None: the session's shuffle partitions,
    # fewer where they would be small
    range_partitions: int | None = None
    # write the match input of the feature build once to the shared
    # checkpoint folder (it feeds the team and the pair windows)
    materialize_input: bool = True

    def with_(self, **kw) -> "FeatureConfig":
        return replace(self, **kw)


NOTEBOOK = FeatureConfig()
DAG = FeatureConfig(
    min_date_applied="before",
    normalise_names=False,
    prior_days=360,
    prior_missing="zero_prior",
    impute="zero",
)
