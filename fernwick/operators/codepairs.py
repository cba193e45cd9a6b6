"""Function and docstring pairs of Python files.

Python code runs once per file, to parse it; tokenizing stays in native expressions.
"""

from __future__ import annotations

import ast
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwick.functions.text import join_tokens, tokenize_code, tokenize_docstring
from fernwick.operators.relational import drop_duplicates, make_url, split_repo_path, token_count
from fernwick.operators.sampling import grouped_split
from fernwick.session import cut_lineage

_RAW = "nwo string, path string, function_name string, lineno int, original_function string, code string, docstring string"


def _functions(blob: str) -> list[tuple[str, int, str, str, str]]:
    """Top-level functions, then methods of top-level classes; a file that does not parse has none."""
    try:
        body = ast.parse(blob).body
        found = [n for n in body if isinstance(n, ast.FunctionDef)]
        for cls in (n for n in body if isinstance(n, ast.ClassDef)):
            found += [n for n in cls.body if isinstance(n, ast.FunctionDef)]
        out = []
        for f in found:
            source, doc = ast.unparse(f), ast.get_docstring(f) or ""
            if doc:
                f.body = f.body[1:]
            out.append((f.name, f.lineno, source, ast.unparse(f) if doc else source, doc))
        return out
    except (AssertionError, MemoryError, SyntaxError, UnicodeError, ValueError, RecursionError):
        return []


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["nwo", "path", "function_name", "lineno", "original_function", "code", "docstring"]
    for pdf in batches:
        rows = [(nwo, path, *f) for nwo, path, blob in zip(pdf["nwo"], pdf["path"], pdf["content"])
                if blob is not None for f in _functions(blob)]
        yield pd.DataFrame(rows, columns=names)


def function_docstring_pairs(files: DataFrame) -> DataFrame:
    """``(nwo, path, content)`` to one row per function, with its tokens and docstring tokens."""
    raw = files.select("nwo", "path", "content").mapInPandas(_parse_batches, _RAW)
    return raw.select(
        "nwo", "path", "function_name", "lineno", "original_function",
        tokenize_code("code").alias("function_tokens"),
        join_tokens(tokenize_docstring("docstring")).alias("docstring_tokens"))


def explode_pairs(files: DataFrame, pairs: str = "pairs", base: str = "https://github.com") -> DataFrame:
    """One row per pair of an array column of structs, with the metadata columns and the url."""
    rows = files.select("nwo", "path", F.explode(pairs).alias("p")).select("nwo", "path", "p.*")
    return rows.withColumn("url", make_url(base))


def apply_parallel(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a pandas function to the Arrow batches of all partitions; rows are keyed by their id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def code_corpus(raw: DataFrame, base: str = "https://github.com", min_tokens: int = 3) -> DataFrame:
    """Raw files to the split function table.

    Parse, add the url and an id, keep one copy of each function, set functions without a real
    docstring aside, and split the others by repository. Parsed and deduplicated rows are used
    several times each, so both are written to the reliable checkpoint.
    """
    pairs = cut_lineage(function_docstring_pairs(split_repo_path(raw))).withColumn("url", make_url(base))
    # The id names the place of the function, so a task that is run again makes the same one.
    rows = pairs.withColumn("id", F.concat_ws("\t", "nwo", "path", F.lpad(F.col("lineno").cast("string"), 9, "0"), "function_name"))
    rows = cut_lineage(drop_duplicates(rows, ["original_function", "function_tokens"], "id"))
    documented = token_count("docstring_tokens") >= min_tokens
    split = grouped_split(rows.filter(documented), "nwo")
    return split.unionByName(rows.filter(~documented).withColumn("split", F.lit("without_docstrings")))
