"""Operators put together: staging, marts, reports, ingest, triage."""
