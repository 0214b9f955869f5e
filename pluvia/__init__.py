"""Pluvia: a Spark-native lakehouse over hourly weather-station readings.

Bronze (station text files) -> Silver (typed, deduplicated readings) -> Gold (star schema and monthly
means) -> lookups, quality checks and a run log.  Everything is a DataFrame -> DataFrame function; I/O
lives in ``pluvia.sources`` and whole jobs in ``pluvia.plans``.
"""

__version__ = "0.1.0"
