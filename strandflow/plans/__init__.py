"""Specifications bound to sources."""
