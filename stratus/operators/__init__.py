"""Relational operators of the station / observation analytics."""
