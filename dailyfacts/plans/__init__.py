"""Composed plans: the two load jobs, the daily question, the whole reload."""
