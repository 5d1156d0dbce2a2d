"""shelfscan: retail price tracking expressed as Spark DataFrame jobs.

Landed catalogue pages and dated per-retailer snapshot files go in; a typed,
partitioned product table, comparable unit prices, descriptive statistics and
completeness reports come out.  Everything after the HTML walk is native
Spark (Column expressions, joins, aggregates, windows).
"""

__version__ = "0.1.0"
