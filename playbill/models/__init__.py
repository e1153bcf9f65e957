"""Feature stages, classifiers, regressors and clusters on pyspark.ml."""
