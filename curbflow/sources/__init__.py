"""Readers for the four staging relations and the jobs that describe source files."""
