"""Readers, declared schemas and sinks."""
