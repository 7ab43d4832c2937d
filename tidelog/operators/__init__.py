"""DataFrame operators over change envelopes and event logs."""
