"""Named questions over current state, logs and snapshots."""
