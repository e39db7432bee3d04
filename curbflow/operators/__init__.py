"""Reusable distributed operators composed from DataFrame operations."""
