"""Spark-native risk-weighted-asset projection: factor lookups, add-ons, upload tables and checks."""
