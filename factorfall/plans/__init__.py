"""Operator chains and complete runs."""
