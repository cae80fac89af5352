"""Session, customer, search and log analytics on PySpark.

Operators are pure functions from DataFrames and a configuration object to a
DataFrame; nothing here collects rows or touches files unless its name says so
(``sources``).
"""
