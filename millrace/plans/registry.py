"""Named queries with their SQL twins."""

from __future__ import annotations

from ..session import ship
from . import views

QUERIES, ORACLES = {}, {}


def query(name, oracle=None):
    """Register a function ``(spark, folder) -> DataFrame`` and, where there is one, its SQL."""

    def keep(function):
        def run(spark, folder):
            ship(spark)
            return views.plain(function(spark, folder))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = views.sql(oracle)
        return function

    return keep
