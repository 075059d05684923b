"""Operators for preparing large text corpora for training.

Nothing else in the library imports this subpackage.  ``registry`` holds the
registered queries and their SQL.
"""
