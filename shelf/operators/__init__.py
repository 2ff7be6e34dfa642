"""Relational operators: catalogue facets, matching, claims, validation, exports."""
