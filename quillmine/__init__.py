"""Document analytics on Spark: columns in, columns out, plans left to Catalyst."""
