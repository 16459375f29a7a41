"""lectern: a course-catalog analytics engine written as plain PySpark jobs.

Every entry point takes and returns DataFrames, so Catalyst sees one declarative
plan and callers decide when (and where) to materialise it.
"""
