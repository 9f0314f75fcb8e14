"""Whole runs: the event audit and the freight dashboard."""
