"""Published datasets, one job per chain.

Each job takes the raw (nested) chain table as a DataFrame and returns the
daily statistics as a DataFrame: one declarative plan per dataset.
"""
