"""Readers and writers for the tables, reports and model artefacts."""
