"""Model fits as Spark jobs: quantile boosting, linear quantile regression,
Spark ML baselines, searches and cross-validation."""
