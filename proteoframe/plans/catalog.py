"""Decorator that registers a query together with its SQL twin."""

from __future__ import annotations

from proteoframe.session import tidy


class Catalog:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        def add(fn):
            def run(spark, sf_dir):
                return tidy(fn(spark, sf_dir))

            run.__doc__ = fn.__doc__
            run.module = fn.__module__.rsplit(".", 1)[-1]
            self.queries[fn.__name__] = run
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn
        return add
