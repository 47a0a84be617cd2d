"""Relational building blocks: DataFrame in, DataFrame out."""

from rateweave.operators.aggregates import avg_by, count_by, distinct_values, last_wins
from rateweave.operators.filters import where_between_exclusive, where_equals, where_sql, where_suffix
from rateweave.operators.joins import join_dimension, lookup_after_top, semi_join
from rateweave.operators.project import project, rating_pairs, sample_rows
from rateweave.operators.topk import latest, top_k, top_k_per_group

__all__ = [
    "avg_by",
    "count_by",
    "distinct_values",
    "join_dimension",
    "last_wins",
    "latest",
    "lookup_after_top",
    "project",
    "rating_pairs",
    "sample_rows",
    "semi_join",
    "top_k",
    "top_k_per_group",
    "where_between_exclusive",
    "where_equals",
    "where_sql",
    "where_suffix",
]
