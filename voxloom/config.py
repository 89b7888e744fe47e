"""Settings of the speech pipeline as one frozen value with two presets."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    """Durations are in seconds, gaps between positions in frames."""

    policy: str = "merge"
    sample_rate: int = 24_000
    asr_sample_rate: int = 24_000
    frame_rate: int = 50
    least_duration: float = 1.0
    most_duration: float = 30.0
    pack_duration: float = 20.0
    split_target: float = 25.0
    merge_gap: float = 0.5
    batch_size: int = 64
    most_equal_positions: int = 3
    most_position_gap: int = 150
    feature_width: int = 512
    index_digits: int = 4
    train_share: float = 0.95
    split_seed: int = 42
    verify_rows: int = 5
    verify_seed: int = 123
    attempts: int = 3
    dataset: str = "speech"
    output_prefix: str = "processed"

    def with_(self, **changes) -> Settings:
        return replace(self, **changes)


#: Joins neighbours over short gaps, splits what is long, drops what is short.
MERGE = Settings()
#: Packs neighbours greedily, splits what is long, absorbs or drops what is short.
PACK = Settings(policy="pack", asr_sample_rate=16_000, least_duration=5.0, split_target=15.0, index_digits=6)
PRESETS = {"merge": MERGE, "pack": PACK}
