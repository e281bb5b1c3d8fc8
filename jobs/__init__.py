"""Runnable jobs: `python -m jobs.notes` and `python -m jobs.stacks`. See README."""
