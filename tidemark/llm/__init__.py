"""Operators for preparing and scoring text corpora, and their registered queries."""
