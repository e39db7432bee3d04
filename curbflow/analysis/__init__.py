"""Parameterised jobs that read the relations."""
