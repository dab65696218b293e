"""Slash-separated node paths as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def segments(path: Column) -> Column:
    """``/a/b`` → ``['', 'a', 'b']``; the leading empty string is the root."""
    return F.split(path, "/", -1)


def is_path(path: Column) -> Column:
    """Starts with a slash. A path other than the root has no trailing slash: parsers cut it."""
    return path.startswith("/")


def depth(path: Column) -> Column:
    """0 for the root, 1 for a suite, and so on; null for what is no path."""
    return F.when(is_path(path), F.when(path == "/", F.lit(0)).otherwise(F.size(segments(path)) - 1))


def name(path: Column) -> Column:
    return F.element_at(segments(path), -1)


def parent(path: Column) -> Column:
    """The enclosing path; ``/`` for a suite, null for the root and for what is no path."""
    up = F.regexp_replace(path, "/[^/]*$", "")
    return F.when(is_path(path) & (path != "/"), F.when(up == "", F.lit("/")).otherwise(up))


def ancestors(path: Column, include_self: bool = False) -> Column:
    """All enclosing non-root paths, outermost first; none for the root and for what is no path."""
    parts = segments(path)
    last = F.size(parts) if include_self else F.size(parts) - 1
    return F.when(
        is_path(path) & (path != "/") & (last >= 2),
        F.transform(F.sequence(F.lit(2), last), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")),
    ).otherwise(F.array().cast("array<string>"))


def is_under(path: Column, top: Column | str) -> Column:
    """Is ``path`` strictly below ``top``? Below the root is every other path."""
    top = F.lit(top) if isinstance(top, str) else top
    return F.when(top == "/", is_path(path) & (path != "/")).otherwise(path.startswith(F.concat(top, F.lit("/"))))
