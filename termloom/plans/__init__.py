"""Plans of termloom."""
