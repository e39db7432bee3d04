"""Linear models of hourly demand.

Row-level terms and every sum over rows are Spark jobs; the driver only solves systems whose size
is the number of model terms.
"""
