"""Reusable DataFrame operators (ordered scans, dedup, upsert, comparison)."""
