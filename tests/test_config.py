"""Run parameters are validated when the configuration is built."""

from __future__ import annotations

import pytest

from vulnsift.config import DEFAULT_CONFIG, CurationConfig


def test_defaults():
    c = DEFAULT_CONFIG
    assert (c.weight_relevance, c.weight_completeness, c.weight_credibility, c.weight_clarity) == (0.35, 0.25, 0.25, 0.15)
    assert (c.quality_threshold, c.review_floor, c.per_severity_quota, c.cutoff_date) == (0.6, 0.4, 50, "2024-08-01")
    assert (c.min_description_length, c.max_description_length) == (50, 5000)


@pytest.mark.parametrize(
    "kwargs",
    [
        {"weight_clarity": 0.2},  # weights no longer sum to 1
        {"review_floor": 0.7},  # floor above the threshold
        {"min_description_length": 6000},  # bounds reversed
        {"per_severity_quota": -1},
        {"cutoff_date": "08/01/2024"},
    ],
)
def test_invalid_settings_are_rejected(kwargs):
    with pytest.raises(ValueError):
        CurationConfig(**kwargs)


def test_configuration_is_hashable_and_frozen():
    c = CurationConfig(per_severity_quota=10)
    assert hash(c) == hash(CurationConfig(per_severity_quota=10))
    with pytest.raises(Exception):
        c.per_severity_quota = 5  # type: ignore[misc]
