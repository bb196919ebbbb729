"""Structured Streaming counts over sliding windows."""
