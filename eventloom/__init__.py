"""Event analytics on Spark: clickstream aggregates, ordered folds, decision jobs, quality and delivery reports."""
