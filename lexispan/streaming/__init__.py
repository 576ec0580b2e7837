"""Operators on tables that keep growing."""
