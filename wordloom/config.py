"""Defaults of every tunable, in one frozen record; operators take them as parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Defaults:
    # search window of the localiser, in words; words a second where no speech is known
    search_back: int = 600
    search_forward: int = 200
    words_per_second: float = 1.71
    # anchors: n-gram lengths, tolerance of relative position, weight (0: off), cap
    anchor_min: int = 3
    anchor_max: int = 6
    anchor_tolerance: float = 0.25
    anchor_weight: float = 0.0
    anchor_cap: float = 60.0
    # committed position, overlap and boundary penalties (0: off)
    commit_distance: float = 0.35
    overlap_weight: float = 0.0
    boundary_words: int = 10
    boundary_weight: float = 0.0
    # silence mask and padding, in seconds
    mask_gap: float = 0.8
    pad: float = 0.5
    # gap filling
    gap: float = 3.0
    gap_overshoot: float = 1.10
    gap_backoff: float = 0.10
    gap_forward: float = 0.10
    gap_min_audio: float = 0.5
    # confidence trim
    trim_top_half: float = 0.50
    trim_contrast: float = 0.30
    trim_side_max: float = 0.35
    trim_side_factor: float = 0.45
    trim_keep: int = 5
    trim_cut: int = 5
    # speaker segments
    segment_gap: float = 0.5
    segment_min: float = 1.0
    # splits
    split_seed: int = 42
    split_threshold: float = 0.4
    train_min_s: float = 1.0
    train_max_s: float = 16.0
    # drift
    drift_high: float = 0.55
    drift_low: float = 0.45
    drift_window: int = 3
    drift_min_run: int = 2
    vote_lengths: tuple[int, ...] = (5, 4, 3)
    resync_margin: float = 0.15
    # reports
    thresholds: tuple[float, ...] = (0.0, 0.4)
    top_errors: int = 30
    sample_rate: int = 16_000


DEFAULTS = Defaults()
