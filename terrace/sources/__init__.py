"""Readers, bronze landing and sinks."""
