"""Readers, writers and the bindings from driver tables to event logs."""
