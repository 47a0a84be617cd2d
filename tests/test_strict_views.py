"""Registration without replacing."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from rateweave.plans import sql
from rateweave.sources.tables import load_tables
from tests.conftest import SF001, SF01


@pytest.mark.parametrize("scope", ["local", "global"])
def test_second_registration_fails_and_leaves_the_first(spark, scope):
    small, large = load_tables(spark, SF001), load_tables(spark, SF01)
    names = sql.register_views(spark, small, scope, "_strict", replace=False)
    try:
        before = spark.table(names["users"]).count()
        with pytest.raises(AnalysisException, match="TEMP_TABLE_OR_VIEW_ALREADY_EXISTS"):
            sql.register_views(spark, large, scope, "_strict", replace=False)
        assert spark.table(names["users"]).count() == before == small.users.count()
        sql.register_views(spark, large, scope, "_strict")
        assert spark.table(names["users"]).count() == large.users.count() > before
    finally:
        sql.drop_views(spark, names, scope)


def test_a_failed_registration_takes_no_name(spark):
    """The third name is taken: the first two are free again."""
    t = load_tables(spark, SF001)
    t.movies.createTempView("rw_movies_partly")
    try:
        with pytest.raises(AnalysisException):
            sql.register_views(spark, t, "local", "_partly", replace=False)
        left = {x.name for x in spark.catalog.listTables() if x.name.endswith("_partly")}
        assert left == {"rw_movies_partly"}
    finally:
        spark.catalog.dropTempView("rw_movies_partly")
