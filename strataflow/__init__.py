"""strataflow: interval, catalogue, spatial-cell and log analytics as PySpark DataFrame operators."""
