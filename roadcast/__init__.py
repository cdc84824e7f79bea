"""Road-traffic forecasting jobs on Spark: feature tables, incidents, map matching, alerts and models."""
