"""Multi-step jobs."""
