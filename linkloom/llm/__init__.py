"""Training-data operators: ten corpus operators written as Spark jobs.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator; the operators themselves have general interfaces.
"""
