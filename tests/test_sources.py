"""Readers and writers on small files."""

import gzip
import json

import pytest

from fernwick.operators import codepairs as N
from fernwick.sources import files as A

MODULE = '''
import os

def top(a, b):
    """Add two numbers.

    More text.
    """
    # a comment
    return a + b

async def later(x):
    """Not taken."""
    return x

def outer():
    def inner():
        """Nested, not taken."""
    return inner

class C:
    """Class text."""
    def method(self):
        "Short doc"
        return 'Short doc'

    class D:
        def deep(self):
            """Not taken."""
'''


def test_csv_shards(spark, tmp_path):
    for i, body in enumerate(['"a/b x.py","line ""one""\ntwo"\n', 'c/d y.py,"é, ü"\n']):
        (tmp_path / f"00{i}.csv").write_text("repo_path,content\n" + body)
    rows = sorted(map(tuple, A.read_csv_shards(spark, f"{tmp_path}/00*.csv").collect()))
    assert rows == [("a/b x.py", 'line "one"\ntwo'), ("c/d y.py", "é, ü")]


def test_code_pairs(spark):
    files = [("a/b", "m.py", MODULE), ("a/b", "bad.py", "def broken(:"), ("a/b", "nul.py", "x\0"), ("c/d", "empty.py", ""),
             ("c/d", "none.py", None)]
    out = N.function_docstring_pairs(spark.createDataFrame(files, "nwo string, path string, content string")).collect()
    got = {r["function_name"]: r for r in out}
    assert set(got) == {"top", "outer", "method"}
    assert got["top"]["docstring_tokens"] == "add two numbers ." and got["top"]["function_tokens"] == "def top a b return a b"
    assert got["top"]["lineno"] == 4 and "comment" not in got["top"]["original_function"]
    assert got["method"]["docstring_tokens"] == "short doc"
    assert got["method"]["function_tokens"] == "def method self return Short doc"


def test_corpus(spark):
    raw = [(f"r{i}/x  p{j}.py", f'def f{i}_{j}():\n    """Do the thing {i}."""\n    return {j}\n\ndef bare():\n    return 1\n')
           for i in range(20) for j in range(3)]
    out = N.code_corpus(spark.createDataFrame(raw, "repo_path string, content string"))
    rows = out.collect()
    assert sum(r["split"] == "without_docstrings" for r in rows) == 1  # one copy of the bare function
    sides = {}
    for r in rows:
        if r["split"] != "without_docstrings":
            sides.setdefault(r["nwo"], set()).add(r["split"])
    assert all(len(s) == 1 for s in sides.values()) and len(sides) == 20


def test_json_lines_and_annotations(spark, tmp_path):
    rec = {"repo": "r", "path": "p", "url": "u", "code": "c", "code_tokens": ["a"], "docstring": "d", "docstring_tokens": ["b"],
           "language": "python", "partition": "train"}
    with gzip.open(tmp_path / "python_train_0.jsonl.gz", "wt") as f:
        f.write(json.dumps(rec) + "\n" + json.dumps(rec | {"partition": "valid"}) + "\n")
    df = A.read_jsonl_gz(spark, f"{tmp_path}/*.jsonl.gz", A.CODE_RECORD_SHORT)
    assert df.columns == list(A.CODE_RECORD_SHORT) and df.count() == 2
    boxes = [{"filename": "x.jpg", "annotations": [{"height": 1.0, "width": 2.0, "x": -1.0, "y": 3.0}, {"height": 5.0, "width": 6.0, "x": 0.0, "y": 0.0}]},
             {"filename": "y.jpg", "annotations": []}]
    (tmp_path / "boxes.json").write_text(json.dumps(boxes, indent=1))
    assert [r["height"] for r in A.read_json_annotations(spark, f"{tmp_path}/boxes.json").collect()] == [1.0, 5.0]


def test_folders(spark, tmp_path):
    for label in ("pos", "neg"):
        (tmp_path / "all" / label).mkdir(parents=True)
        for i in range(2):
            (tmp_path / "all" / label / f"{i}.txt").write_text(f"{label}\ntext {i}")
    (tmp_path / "all" / "pos" / "noext").write_text("skipped")
    (tmp_path / "all" / ".DS_Store").mkdir()
    rows = A.texts_labels_from_folders(spark, f"{tmp_path}/all", ["neg", "pos"]).collect()
    assert sorted(map(tuple, rows)) == [("neg\ntext 0", 0), ("neg\ntext 1", 0), ("pos\ntext 0", 1), ("pos\ntext 1", 1)]
    dirs = {tuple(r) for r in A.read_dirs(spark, str(tmp_path), "all").collect()}
    assert ("all/neg/0.txt", "neg", 0) in dirs and ("all/pos/noext", "pos", 1) in dirs and len(dirs) == 5
    assert A.read_dir(spark, f"{tmp_path}/all", "pos").count() == 2
    (tmp_path / "void").mkdir()
    with pytest.raises(FileNotFoundError):
        A.read_dir(spark, str(tmp_path), "void")


def test_labels_and_pairs(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,tags\na,x y\nb,y\n")
    assert sorted(map(tuple, A.parse_csv_labels(spark, f"{tmp_path}/t.csv").collect())) == [("a", ["x", "y"]), ("b", ["y"])]
    out, names = A.csv_source(spark, "f", f"{tmp_path}/t.csv", suffix=".jpg")
    assert names == ["x", "y"]
    assert sorted((r["file"], r["label_vector"]) for r in out.collect()) == [("f/a.jpg", [1.0, 1.0]), ("f/b.jpg", [0.0, 1.0])]
    (tmp_path / "one.csv").write_text("a,x\nb,y\n")
    out, _ = A.csv_source(spark, "f", f"{tmp_path}/one.csv", skip_header=False)
    assert sorted((r["name"], r["label"]) for r in out.collect()) == [("a", 0), ("b", 1)]


def test_lines_over_many_files_and_splits(spark, tmp_path):
    lines = [f"row {i} " + "x" * (i % 37) for i in range(3000)]
    for part in range(3):
        (tmp_path / f"part-{part}.txt").write_text("\n".join(lines[part * 1000:(part + 1) * 1000]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 7000)
    try:
        got = {r["line_no"]: r["line"] for r in A.read_lines(spark, f"{tmp_path}/part-*.txt").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == dict(enumerate(lines))


def test_alignment(spark):
    a, b = spark.range(5), spark.range(1, 6)
    with pytest.raises(ValueError):
        A.check_aligned(a, b, "id")
    A.check_aligned(a, spark.range(5), "id")


def test_manifest(spark, tmp_path):
    files = spark.createDataFrame([(f"d/{i}.jpg", "c") for i in range(500)], "file string, label string")
    A.write_manifest(files, f"{tmp_path}/m", label=None, sample=0.1)
    rows = spark.read.csv(f"{tmp_path}/m").collect()
    assert 20 < len(rows) < 90 and {r[1] for r in rows} == {"0"}
