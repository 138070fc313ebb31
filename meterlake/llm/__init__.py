"""Operators for training-data pipelines over the text tables.

Every module is self-contained over DataFrames; nothing outside this
subpackage imports it. ``queries`` registers one query per operator.
"""
