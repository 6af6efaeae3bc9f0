"""Query registry for ``__spark_entry__``: name -> builder, and name -> oracle SQL.

``prep`` holds the SQL-checked table/feature/split/metric queries, ``closed`` the
SQL-checked ones with a closed form (linear models, imputation); ``learn``
holds estimator and model-selection queries (rows-only checks: their SQL
equivalent does not exist, their real checks are the estimator tests).
"""

from __future__ import annotations

from . import closed, learn, prep


def _all() -> dict[str, tuple]:
    out = dict(prep.QUERIES)
    out.update(learn.QUERIES)
    out.update(closed.QUERIES)
    return out


def queries() -> dict:
    return {name: fn for name, (fn, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}


def flagship(spark, sf_dir: str):
    return prep.rule_report(spark, sf_dir)
