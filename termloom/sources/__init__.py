"""Sources of termloom."""
