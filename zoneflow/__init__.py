"""zoneflow: change-data-capture zone processing on Spark DataFrames."""
