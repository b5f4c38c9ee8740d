"""Profiles, staging, and the assembled jobs."""
