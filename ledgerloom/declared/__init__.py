"""Contracts as YAML files."""
