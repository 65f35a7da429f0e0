"""unitcast: monthly demand forecasting on Spark DataFrames.

Subpackages: ``sources`` (readers, test-data adapter, sinks), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame steps and Spark ML
wrappers), ``plans`` (named queries and their SQL oracles).
"""

__version__ = "0.1.0"
