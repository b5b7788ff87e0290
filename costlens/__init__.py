"""Spark-native library for cost-interval analytics: record cleaning, per-key record choice, outlier handling, lookups, features, quantile models and interval metrics."""
