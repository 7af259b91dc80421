"""Operators: pure functions from catalog-role DataFrames to a DataFrame.

capacity (space, recovery area, growth, memory), health (structural
findings), security (grants, accounts), features (option usage),
partitions (table rewrite, rename/retention/drift/shrink plans), objects
(constraints, jobs, index usage), inventory (inventories, state capture,
diff), logs (redo history, log archive, file retention).
"""
