"""Delivery-marketplace analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame; nothing here
holds a session of its own.
"""
