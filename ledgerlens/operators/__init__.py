"""Relational operators: DataFrame(s) -> DataFrame, no collect, no driver loops.

Token sets are DataFrames with a unique ``mint`` column.  Per-token results
are aggregated first and joined to the token set afterwards (an inner join on
a unique key): partial aggregation absorbs hot keys such as SOL before any
shuffle, and the join never has to move raw event rows.
"""
