"""Constants of the engine; passed as literals into column expressions so that Catalyst can fold them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

VERSION = "trendloom-1"
SOURCES = ("instagram", "youtube")


@dataclass(frozen=True)
class ScoringConfig:
    weight_social: float = 40.0
    weight_youtube: float = 25.0
    weight_cultural: float = 15.0
    weight_momentum: float = 20.0
    direction_threshold_pct: float = 5.0
    early_below: float = 30.0
    growth_until: float = 65.0
    early_post_count: float = 10.0
    influencer_tiers: tuple[tuple[int, float], ...] = ((1_000_000, 2.0), (100_000, 1.5), (10_000, 1.2))
    influencer_base: float = 1.0
    source_type_weights: dict[str, float] = field(
        default_factory=lambda: {"influencer_fixed": 1.0, "hashtag_tracking": 1.2, "hashtag_haul": 1.5, "bollywood_decode": 1.1}
    )
    video_weights: tuple[float, float, float] = (0.3, 0.4, 0.3)
    cultural_weights: tuple[float, float] = (0.6, 0.4)
    festival_boost: float = 1.5
    #: First day, last day and tags of each festival; a day belongs to the first that holds it.
    festivals: tuple[tuple[date, date, tuple[str, ...]], ...] = ((date(2026, 4, 13), date(2026, 5, 11), ("akshayatritiya", "akshayatritiya2026", "goldethnic")),)
    momentum_weights: tuple[float, float, float, float] = (0.4, 0.3, 0.15, 0.15)
    window_days: int = 7
    new_entity_days: int = 90
    maturity_days: tuple[int, int] = (3, 7)

    def active_festival_tags(self, day: date) -> tuple[str, ...]:
        return next((tags for first, last, tags in self.festivals if first <= day <= last), ())

    def __post_init__(self) -> None:
        total = self.weight_social + self.weight_youtube + self.weight_cultural + self.weight_momentum
        if abs(total - 100.0) > 1e-9:
            raise ValueError("factor weights must sum to 100")


@dataclass(frozen=True)
class DedupConfig:
    preset_weight: float = 0.40
    family_weight: float = 0.25
    garment_weight: float = 0.25
    technique_weight: float = 0.10
    threshold: float = 0.75

    def __post_init__(self) -> None:
        if abs(self.preset_weight + self.family_weight + self.garment_weight + self.technique_weight - 1.0) > 1e-9:
            raise ValueError("similarity weights must sum to 1")


SCORING = ScoringConfig()
DEDUP = DedupConfig()
#: Axis multipliers: both axes known, one known.
MULT_BOTH, MULT_ONE = 2.5, 1.0
#: Text evidence next to group evidence, by method.
TEXT_WEIGHTS = {"rule": 6.0, "llm": 3.0}
EVIDENCE_TOP_K = 4
UNKNOWN = "unknown"


def target_date(asked: str | None, configured: str | None, today: date) -> date:
    """The day of a run: what was asked for, else what is configured, else today."""
    return date.fromisoformat(asked) if asked else date.fromisoformat(configured) if configured else today
