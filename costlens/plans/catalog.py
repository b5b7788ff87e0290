"""Imports every query module so that all queries are registered."""

from costlens.plans import (clean_queries, explore_queries, feature_queries, join_queries,
                            metric_queries,  # noqa: F401
                            model_queries, model_table_queries, record_queries)
