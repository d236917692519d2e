"""Readers, sinks and the interfaces to what lies outside Spark."""
