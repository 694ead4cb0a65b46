"""Interval, sequence, similarity-graph and roll-up analytics as PySpark DataFrame operators."""
