"""fleetplan: plan and audit a fleet of clusters as Spark tables.

Every operator is a function from DataFrames to DataFrames built on native
Spark expressions. Configuration layers, address plans, node rosters, DNS
record sets, readiness polls and run logs are rows; one job handles every
cluster at once.
"""

__version__ = "0.1.0"
