"""Driver queries: security logs rendered from the driver tables, run through the operators.

Each module offers QUERIES {name: function(spark, folder)} and SQL {name: text}; the SQL computes
the expected answer from the base columns and never parses a rendered log.
"""
