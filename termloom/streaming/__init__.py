"""Streaming of termloom."""
