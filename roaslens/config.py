"""Run parameters of one comparison."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    curr_year: int = 2000
    prev_year: int = 1999
    mtd_only: bool = False
    # Fixed values of the decomposition and selection rules (must match the
    # reference behaviour): relative and absolute impact floor for a SINGLE
    # drill, defense-candidate revenue drop limit, topic ROAS-delta gate.
    rel_floor: float = 0.01
    abs_floor: float = 0.0
    phantom_drop_threshold: float = 0.30
    min_topic_roas_abs_delta: float = 0.03
    single_share_min: float = 0.45
    single_gap_min: float = 0.15
    wide_top_k: int = 3
    parse_error_threshold: float = 0.01

    def __post_init__(self) -> None:
        if self.curr_year <= 0 or self.prev_year <= 0:
            raise ValueError("years must be positive")
        if not 0.0 <= self.parse_error_threshold <= 1.0:
            raise ValueError("parse_error_threshold must be in [0, 1]")

    @staticmethod
    def resolve_years(curr_year: int | None, prev_year: int | None, today_year: int) -> tuple[int, int]:
        """explicit years win; one side missing is derived as +/- 1."""
        if curr_year is None and prev_year is None:
            curr_year = today_year
        if curr_year is None:
            curr_year = int(prev_year) + 1
        if prev_year is None:
            prev_year = int(curr_year) - 1
        if curr_year <= 0 or prev_year <= 0:
            raise ValueError("years must be positive")
        return int(curr_year), int(prev_year)
