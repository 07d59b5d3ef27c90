"""Registered queries: each a Spark callable with, where SQL can say it, its SQL."""

from registry import models, recommendations, shapes, statistics, streams, tables, texts
from tastegraph.session import ship_package

MODULES = (tables, shapes, statistics, texts, models, recommendations, streams)


def _shipped(run):
    def call(spark, sf_dir):
        ship_package(spark)
        return run(spark, sf_dir)

    return call


def all_queries():
    return {name: _shipped(run) for module in MODULES for name, (run, _) in module.QUERIES.items()}


def all_sql():
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
