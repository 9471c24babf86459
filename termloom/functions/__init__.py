"""Functions of termloom."""
