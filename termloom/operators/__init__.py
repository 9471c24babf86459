"""Operators of termloom."""
