"""Cases over literal rows: a function of (spark, sf_dir) and the SQL that states what it is to give."""

from __future__ import annotations

CASES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(f):
        CASES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return wrap
