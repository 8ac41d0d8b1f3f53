"""Adapters over input tables, and the snapshot store."""
