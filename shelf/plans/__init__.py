"""Registered queries, each a composition of operators, with its SQL oracle."""
