"""strata: a PySpark library that takes raw CSV files through typed tables and silver
datasets to a per-customer gold table, every step a DataFrame job on executors."""

__version__ = "0.1.0"
