"""File manifests: listing, selection, categories, glob filters, re-rooting.

A manifest is a DataFrame with at least a ``path`` column.  ``list_files``
builds one from storage (``parley.sources.listing``; no file is opened).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.sources.listing import file_list


class EmptySourceError(FileNotFoundError):
    """No input file matched."""


def list_files(spark: SparkSession, root: str | list[str], glob: str | None = "*.jsonl", recursive: bool = True,
               allow_empty: bool = False) -> DataFrame:
    """``(path, length, modificationTime)`` of files under ``root``, zero-length and hidden ones included.

    Raises ``EmptySourceError`` where no file matches (S4), unless ``allow_empty``; a missing root raises
    ``FileNotFoundError``.
    """
    roots = [root] if isinstance(root, str) else list(root)
    files = file_list(spark, roots, glob, recursive)
    return files if allow_empty else require_nonempty(files, f"input files under {roots}")


def require_nonempty(df: DataFrame, what: str = "input files") -> DataFrame:
    """Raise when the source set is empty (one-row probe, not a count)."""
    if df.isEmpty():
        raise EmptySourceError(f"no {what} found")
    return df


def select_files(df: DataFrame, folder: str, suffix: str = ".jsonl", path_col: str = "path") -> DataFrame:
    """Paths under ``folder/`` (nested included) ending with ``suffix`` (case-sensitive)."""
    p = F.col(path_col)
    return df.where(p.startswith(folder.rstrip("/") + "/") & p.endswith(suffix))


def tag_categories(df: DataFrame, identity_file: str, skills_dir: str, suffix: str = ".jsonl",
                   path_col: str = "path") -> DataFrame:
    """The fixed identity file (if listed) + every ``suffix`` file under ``skills_dir``.

    A file that is both is listed twice, as the reference's two lists would.
    """
    p = F.col(path_col)
    ident = df.where(p == identity_file).withColumn("category", F.lit("identity"))
    skills = df.where(p.startswith(skills_dir.rstrip("/") + "/") & p.endswith(suffix)).withColumn(
        "category", F.lit("skills"))
    return ident.unionByName(skills)


def extension(path_col: str = "path") -> Column:
    """Text after the last dot of the base name ('' when none)."""
    return F.regexp_extract(F.col(path_col), "\\.([^./]+)$", 1)


def ext_counts(df: DataFrame, path_col: str = "path") -> DataFrame:
    """S3: ``(ext, n)`` files per extension (case-sensitive)."""
    return df.groupBy(extension(path_col).alias("ext")).agg(F.count(F.lit(1)).alias("n"))


def glob_to_regex(pattern: str) -> str:
    """``fnmatch``-style glob → anchored Java regex (``*`` also crosses ``/``)."""
    out, i, n = [], 0, len(pattern)
    while i < n:
        c = pattern[i]
        i += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                out.append("\\[")
            else:
                body = pattern[i:j]
                i = j + 1
                neg = body.startswith("!")          # only '!' negates, as in fnmatch
                if neg:
                    body = body[1:]
                # escape characters that are special inside a set in Java or Python
                # regex ('[' nests, '&&' intersects, '^' negates); '-' keeps ranges
                body = "".join("\\" + ch if ch in "\\[]&~|^" else ch for ch in body)
                out.append("[" + ("^" if neg else "") + body + "]")
        else:
            out.append(re.escape(c))
    return "^(?s:" + "".join(out) + ")$"


def match_any_glob(col: Column, patterns: Sequence[str]) -> Column:
    if not patterns:
        return F.lit(False)
    return col.rlike("|".join(glob_to_regex(p) for p in patterns))


def filter_globs(df: DataFrame, patterns: Sequence[str], *, keep: bool, path_col: str = "path",
                 relative_to: str | None = None) -> DataFrame:
    """S10 (``keep=False``, ignore list) / S11 (``keep=True``, allow list).

    Patterns match the path relative to ``relative_to`` when given.
    """
    p = F.col(path_col)
    if relative_to is not None:
        p = F.regexp_replace(p, "^" + relative_to, "")
    m = match_any_glob(p, patterns)
    return df.where(m if keep else ~m)


def reroot(df: DataFrame, prefix: str, path_col: str = "path") -> DataFrame:
    """Files under ``prefix`` get ``new_path`` with the prefix dropped; others keep theirs."""
    p = F.col(path_col)
    pre = prefix if prefix.endswith("/") else prefix + "/"
    moved = p.startswith(pre)
    return df.select("*", moved.alias("moved"),
                     F.when(moved, F.substring(p, len(pre) + 1, 1 << 30)).otherwise(p).alias("new_path"))


def reroot_conflicts(rerooted: DataFrame) -> DataFrame:
    """Target names reached by more than one file where at least one was moved."""
    return (rerooted.groupBy("new_path")
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("moved").cast("int")).alias("_m"))
            .where((F.col("n") > 1) & (F.col("_m") == 1)).drop("_m"))
