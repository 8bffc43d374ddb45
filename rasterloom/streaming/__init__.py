"""Structured Streaming: scoring requests and their status."""
