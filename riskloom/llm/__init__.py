"""Operators and a pipeline for cleaning, scanning and mixing training text."""
