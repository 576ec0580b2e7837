"""Stateless column expressions."""
