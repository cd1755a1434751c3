"""Composite jobs: extracts to warehouse tables."""
