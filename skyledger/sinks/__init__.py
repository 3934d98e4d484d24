"""Writers: result files, per-batch outputs and keyed tables."""
