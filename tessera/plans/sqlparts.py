"""Shared fragments of the DuckDB oracle SQL (same rules as the Spark side)."""

from __future__ import annotations


def lit(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def toks(expr: str, lower: bool = True) -> str:
    """Rule T in DuckDB."""
    e = f"lower({expr})" if lower else expr
    return f"list_filter(string_split_regex({e}, '\\s+'), lambda x: x <> '')"


def bucket(expr: str, seed: int = 42, buckets: int = 1000) -> str:
    """Rule H in DuckDB."""
    return (f"(('0x' || substr(md5('{seed}:' || CAST({expr} AS VARCHAR)), 1, 8))::BIGINT % {buckets})")


def first_n(expr: str, n: int = 300) -> str:
    """TX2 in DuckDB."""
    return (f"array_to_string(list_slice(string_split(trim(regexp_replace({expr}, '\\s+', ' ', 'g')), ' '), 1, {n}), ' ')")
