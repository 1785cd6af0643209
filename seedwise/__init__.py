"""seedwise: seed-based audience expansion on Spark DataFrames.

Sub-packages: ``sources`` (scans, text lists, sinks), ``functions`` (column
expressions, vectors), ``operators`` (encoders, populations, models,
evaluation, ranking, numbering, joins), ``plans`` (end-to-end jobs, the query
catalogue).
"""

__version__ = "0.1.0"
