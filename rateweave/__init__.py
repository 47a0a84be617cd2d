"""rateweave: review and rating analytics as plain Spark DataFrame plans.

Every operator is a function from DataFrames to a DataFrame built only from
Spark's own expressions, so Catalyst does the pruning, pushdown, join
selection and top-k planning.  Nothing here creates a session, caches,
collects whole tables or runs Python per row.
"""

from rateweave.sources.tables import Tables, load_dat_tables, load_tables

__all__ = ["Tables", "load_tables", "load_dat_tables"]
