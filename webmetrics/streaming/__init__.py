"""Structured Streaming: request stream -> validated events -> typed tables and facts."""
