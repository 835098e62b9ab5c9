"""Demand forecasting and replenishment on Spark.

Star schema in, six levels of daily roll-ups, features, models, error metrics
and order quantities out; every step takes and returns DataFrames.
"""
