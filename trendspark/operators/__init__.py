"""Relational operators: matching, facts, dimensions, trends, quality."""
