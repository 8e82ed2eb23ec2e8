"""Landed inputs to posts."""
