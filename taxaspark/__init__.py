"""Spark-native species-occurrence processing and risk screening.

Every public function maps DataFrames to DataFrames using Spark column
expressions, joins, windows and aggregates; nothing is collected to the
driver except bounded results (model coefficients, quantile boundaries,
a one-row threshold).
"""

__version__ = "0.1.0"
