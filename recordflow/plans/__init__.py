"""Compositions of the operators: customer records and account reports."""
