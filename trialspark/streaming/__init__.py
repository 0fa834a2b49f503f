"""Structured Streaming jobs: landing, upserts, request de-duplication, replay."""
