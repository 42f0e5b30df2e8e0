"""The registered queries and their SQL."""

from __future__ import annotations

from cindermill.plans.views import Views, with_views

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = with_views(sql)
        return f

    return add
