"""Thresholds of the operators in one place, for those who want to see or change them."""

from __future__ import annotations

from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class EngineConfig:
    """Settings of a run; the defaults are those of the operators."""

    confidence_threshold: float = 0.6
    top_candidates: int = 6
    bm25_top: int = 8
    escalations: int = 20

    def as_dict(self) -> dict[str, float]:
        """Settings by name."""
        return asdict(self)
