"""Order-business analytics on Spark: copy, clean, widen, summarise, check, report.

Everything is a function from DataFrame to DataFrame.  Dates and thresholds are
arguments; nothing reads the wall clock and no function opens a session.
"""
