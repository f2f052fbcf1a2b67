"""Readers for raw entities and zone tables, and the write/commit helpers."""
