"""Relational operators: table mutation, ordered scans, matching, quality, comparison."""
