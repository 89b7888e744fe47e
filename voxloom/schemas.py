"""The relations of the speech pipeline, as DDL."""

from __future__ import annotations

LISTING = "key string, size bigint"
RECORDING = "recording_id string, path string, length bigint, content binary"
WAVEFORM = "recording_id string, samples array<float>, sample_rate int, n_samples bigint, error string"
INTERVAL = "recording_id string, seq bigint, s double, e double"
SEGMENT = "recording_id string, idx bigint, s double, e double"
SLICE = "segment_id string, recording_id string, idx bigint, start_sample bigint, end_sample bigint, dur_s double"
TRANSCRIPT = "segment_id string, recording_id string, idx bigint, text string"
FEATURES = (
    "segment_id string, recording_id string, token_ids array<bigint>, encoder_features array<array<float>>, "
    "positions array<bigint>, f_before array<bigint>, f_after array<bigint>, duration_frames bigint"
)
DONE = "recording_id string, n_segments bigint, status string, run string"
MANIFEST = "segment_id string, dataset string, num_tokens bigint, duration_frames bigint, feature_path string"
REJECTIONS = "reason string, n bigint, pct double"
SPLIT = "recording_id string, pos bigint, split string"
CHECK = "check string, passed boolean"
UPLOAD = "local string, key string, local_size bigint"
TRANSFER = "key string, status string, attempts int, error string"
#: What a feature sample must hold, in the order in which what is missing is reported.
REQUIRED_KEYS = ("token_ids", "encoder_features", "positions", "f_before", "f_after")
FEATURE_COLUMNS = tuple(part.split()[0] for part in FEATURES.split(", "))
