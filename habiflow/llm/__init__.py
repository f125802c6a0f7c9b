"""Operators of a training-data pipeline (numbered 1-10) as Spark jobs.

Nothing else in the library imports this subpackage.  Every operator selects
the columns it names and nothing else, so extra or clashing input columns
never matter.
"""
