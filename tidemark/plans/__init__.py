"""Composite jobs: catalogue, specs, levels, refresh and fetch plan."""
