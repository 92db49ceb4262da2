"""Staging models and marts composed from the operators."""
