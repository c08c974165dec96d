"""Names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_key(path: Column) -> Column:
    """Sorts paths by component: ``a/B`` before ``a-b``."""
    return F.split(path, "/")


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(file_name: Column) -> Column:
    """The last dot and what follows, lower-case; empty for dot-files and trailing dots."""
    return F.lower(F.regexp_extract(file_name, r"(?s)^.+(\.[^.]+)$", 1))


def stem(file_name: Column) -> Column:
    """The name without its suffix."""
    return F.substring(file_name, F.lit(1), F.length(file_name) - F.length(F.regexp_extract(file_name, r"(?s)^.+(\.[^.]+)$", 1)))


def output_path(folder: str, file_name: Column, file_hash: Column) -> Column:
    """Where a conversion goes; the hash keeps equal stems of two folders apart."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), stem(file_name), F.lit("-"), F.substring(file_hash, 1, 16), F.lit(".pdf"))


def usable_path(converted: Column, original: Column) -> Column:
    """The converted file if there is one, else the original."""
    return F.coalesce(F.nullif(converted, F.lit("")), original)
