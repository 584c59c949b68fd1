"""Composed operators: taxonomies, reconciliation, completeness, validation and profiles."""
