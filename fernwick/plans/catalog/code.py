"""Function pairs of Python files that Spark derives from the documents, and batch functions."""

import pandas as pd
from pyspark.sql import functions as F

from fernwick.functions.text import words
from fernwick.operators import codepairs as N
from fernwick.plans.catalog.registry import query
from fernwick.plans.catalog.relational import WORDS

_LINE = "array_to_string({w}, ' ')".format(w=WORDS)


def python_files(t):
    """A Python module per document: a documented function and a class with a bare method.

    German documents give a file that does not parse.
    """
    key = F.col("doc_id").cast("string")
    doc = F.array_join(words("text"), " ")
    good = F.concat(
        F.lit("# module\n\ndef first_"), key, F.lit('(x):\n    """'), doc, F.lit('"""\n    return x  # same\n\n'),
        F.lit("class Holder:\n    def second_"), key, F.lit("(self, y=2):\n        return y\n"))
    content = F.when(F.col("lang") == "de", F.concat(F.lit("def broken(:\n"), doc)).otherwise(good)
    path = F.concat("source", F.lit(" m/"), key, F.lit(".py"))
    return t.documents.select(path.alias("repo_path"), content.alias("content"))


_PAIRS = rf"""pairs AS (
    SELECT source AS nwo, 'm/' || doc_id || '.py' AS path, 'first_' || doc_id AS function_name, CAST(3 AS INTEGER) AS lineno,
        'def first_' || doc_id || ' x return x' AS function_tokens, lower({_LINE}) AS docstring_tokens FROM documents WHERE lang <> 'de'
    UNION ALL SELECT source, 'm/' || doc_id || '.py', 'second_' || doc_id, 8, 'def second_' || doc_id || ' self y 2 return y', '' FROM documents WHERE lang <> 'de')"""


@query("function_docstring_pairs", rf"""
    WITH {_PAIRS} SELECT nwo, path, function_name, lineno, regexp_replace(function_tokens, '(def \w+) ', '\1 ') AS function_tokens, docstring_tokens FROM pairs""")
def _(t):
    from fernwick.operators.relational import split_repo_path

    return N.function_docstring_pairs(split_repo_path(python_files(t))).drop("original_function")


@query("explode_pairs", f"""
    WITH {_PAIRS} SELECT nwo, path, function_name, 'https://github.com/' || nwo || '/blob/master/' || path || '#L' || lineno AS url FROM pairs""")
def _(t):
    from fernwick.operators.relational import split_repo_path

    flat = N.function_docstring_pairs(split_repo_path(python_files(t)))
    # Pairs of one file are few; they are gathered per file to be exploded again.
    nested = flat.groupBy("nwo", "path").agg(F.collect_list(F.struct("function_name", "lineno")).alias("pairs"))
    return N.explode_pairs(nested).select("nwo", "path", "function_name", "url")


def _count_words(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n": pdf["text"].str.split(" ").str.len()})


@query("apply_parallel", "SELECT doc_id, len(string_split(text, ' ')) AS n FROM documents")
def _(t):
    return N.apply_parallel(t.documents.select("doc_id", "text"), _count_words, "doc_id long, n long")


@query("code_corpus", rf"""
    WITH {_PAIRS}, d AS (SELECT * FROM pairs WHERE len(list_filter(string_split(docstring_tokens, ' '), lambda w: w <> '')) >= 3),
    n AS (SELECT DISTINCT nwo FROM d),
    g AS (SELECT nwo, row_number() OVER (ORDER BY md5('8081|' || nwo), nwo) AS r, floor(0.87::DOUBLE * count(*) OVER ()) AS k FROM n),
    g2 AS (SELECT nwo, row_number() OVER (ORDER BY md5('8081|second|' || nwo), nwo) AS r2, k FROM g WHERE r <= k),
    s AS (SELECT nwo, CASE WHEN r2 <= floor(0.82::DOUBLE * k) THEN 'train' ELSE 'valid' END AS split FROM g2)
    SELECT path, function_name, coalesce(split, 'test') AS split FROM d LEFT JOIN s USING (nwo)
    UNION ALL SELECT path, function_name, 'without_docstrings' FROM pairs WHERE (path, function_name) NOT IN (SELECT path, function_name FROM d)""")
def _(t):
    return N.code_corpus(python_files(t)).select("path", "function_name", "split")
