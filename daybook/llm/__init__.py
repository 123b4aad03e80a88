"""Operators of a training-data pipeline, each one Spark job over whole tables.

Nothing else in the library imports this subpackage.  ``queries`` holds one
registered query per operator and the SQL of those that SQL can express.
"""
