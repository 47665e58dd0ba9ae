"""Scans, landing steps and table input/output."""
