"""ledgerloom — Spark-native retail analytics models.

Raw change-synced retail tables go in; governed marts, consumer reports,
metrics, semantic selections and data-quality results come out, all as
lazy Spark DataFrames.  ``ledgerloom.plans.project.RetailProject`` wires
the model DAG; every model is a plain function ``DataFrame -> DataFrame``.
"""

__version__ = "0.1.0"
