"""Binds the library to the driver's test tables: inputs, queries, oracle SQL."""
