"""All registered queries of the engine and the DuckDB SQL each is compared with."""

from tallyquill.plans import layout_queries, paper_queries, report_queries, run_queries, store_queries, text_queries, vocabulary_queries  # noqa: F401  they register themselves
from tallyquill.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
