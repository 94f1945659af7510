"""kymo: windowed signal analytics on Spark DataFrames.

Operators take column names for entity, order, value and label, so the same
plans serve sensor recordings, event logs and relational tables.
"""

__version__ = "0.1.0"
