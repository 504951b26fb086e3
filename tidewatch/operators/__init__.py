"""DataFrame operators: each takes and returns DataFrames.

A few run small jobs on the way: ranges of missing periods, the number of
series to decompose, and tables that several branches of a plan share.
"""
