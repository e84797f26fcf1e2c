"""Operators of a training-data pipeline (text and vectors to model input).

Nothing else in the library imports this subpackage.
"""
