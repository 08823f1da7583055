"""Event-decision analytics on Spark: validate, enrich, score and evaluate operational event logs."""
