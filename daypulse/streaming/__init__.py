"""Structured Streaming jobs: landing (stage 1) and the session state job."""
