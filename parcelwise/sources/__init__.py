"""Readers and writers for the raw, typed and modelled layers."""
