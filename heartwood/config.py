"""The engine's settings: one frozen object that operators take."""

from __future__ import annotations

from dataclasses import dataclass

from heartwood.functions import fixed


@dataclass(frozen=True)
class EngineConfig:
    """Thresholds and weights of extraction and labelling; the defaults are the fixed values' own."""

    min_significance: float = 0.10
    min_resistance: float = 0.20
    lexicon_standalone: float = fixed.LEXICON_STANDALONE
    lexicon_boost: float = 0.15
    semantic_boost: float = 0.20
    semantic_weight: float = 0.80
    semantic_threshold: float = fixed.SEMANTIC_THRESHOLD
    structural_boost: float = 0.15
    zeroshot_threshold: float = 0.35
    zeroshot_standalone: float = 0.70
    zeroshot_boost: float = 0.15
    classifier_virtue: float = 0.60
    classifier_vice: float = 0.85
    classifier_boost: float = 0.10
    classifier_standalone: float = 0.80
    classifier_weight: float = 0.50
    polarity_reach: int = 120
    p1: float = fixed.P1
    p0: float = fixed.P0
    min_observations: int = 1
    min_consistency: float = 0.0
    pressure_seconds: float = fixed.PRESSURE_SECONDS
    pressure_passages: int = fixed.PRESSURE_PASSAGES
    pressure_kept: int = fixed.PRESSURE_KEPT

    def __post_init__(self) -> None:
        """Thresholds lie in [0, 1], the P0 threshold below the P1 threshold, counts from one on."""
        for name, value in vars(self).items():
            if isinstance(value, float) and name != "pressure_seconds" and not 0 <= value <= 1:
                raise ValueError(f"{name} must lie between 0 and 1, not {value}")
        if self.p0 >= self.p1:
            raise ValueError(f"the P0 threshold {self.p0} must lie below the P1 threshold {self.p1}")
        if self.min_observations < 1 or self.pressure_kept < 1 or self.pressure_seconds < 0:
            raise ValueError("min_observations and pressure_kept must be 1 or more, pressure_seconds 0 or more")


DEFAULT = EngineConfig()
