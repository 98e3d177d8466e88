"""Outputs: dated table, CSV, JSON."""
