"""Structured Streaming use of fitted models."""
