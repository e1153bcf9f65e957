"""Operators for training-data pipelines: filters, near duplicates, packing, scans.

Every operator is a function from DataFrame to DataFrame. Nothing outside this
folder imports it.
"""
