"""Normalisers: raw line/file/key-value DataFrames → the five fixed tables.

Every operator takes DataFrames (never paths), so it runs over a lake of many
users' roots. Per-file state (back-fill, carry-forward, de-duplication) is
computed as small per-file / per-marker tables joined back to the lines — no
window ever spans all lines of a file, so one huge transcript cannot pin a
single task (AQE broadcasts the small side when its measured size allows and
splits skewed partitions otherwise)."""
