"""Composed dataflows: transforms, consolidation, reports, jobs."""
