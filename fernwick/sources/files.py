"""Readers and writers.

Rows are identified by an explicit id column, never by their place in a file; line numbers are
made only where two raw text files must be aligned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fernwick.functions.dates import parse_date
from fernwick.operators.sampling import bernoulli_sample
from fernwick.session import bounded_broadcast, cut_lineage, load_table

RAW_CODE = "repo_path string, content string"
CODE_RECORD = (
    "repo string, path string, url string, code string, code_tokens array<string>, docstring string, "
    "docstring_tokens array<string>, language string, partition string"
)
CODE_RECORD_SHORT = ("code_tokens", "docstring_tokens", "language", "partition")
ANNOTATIONS = (
    "filename string, annotations array<struct<height: double, width: double, x: double, y: double>>"
)
# Folder entries that are no labels, and known image extensions.
NO_LABELS = (".ipynb_checkpoints", ".DS_Store")
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "ppm", "bmp")


def load_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: load_table(spark, folder, n) for n in names}


def read_csv_shards(spark: SparkSession, glob: str, schema: str = RAW_CODE) -> DataFrame:
    """Numbered CSV shards with multi-line quoted fields; one task per shard."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(glob))


def read_jsonl_gz(spark: SparkSession, glob: str, columns: Sequence[str] | None = None,
                  schema: str = CODE_RECORD) -> DataFrame:
    """Gzip JSON lines; only the chosen columns are parsed."""
    df = spark.read.schema(schema).json(glob)
    return df.select(*columns) if columns else df


def read_csv_dir_with_source(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All CSV files of a folder under one header, each row behind its file name (no extension)."""
    df = spark.read.schema(schema).option("header", True).csv(f"{folder}/*.csv")
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    return df.select(name.alias("file"), *df.columns)


def read_csv_parse_dates(spark: SparkSession, path: str, schema: str, dates: Sequence[str],
                         formats: Sequence[str] = ("yyyy-MM-dd", "MM/dd/yyyy H:mm")) -> DataFrame:
    """CSV with typed columns; ``dates`` are read as text and parsed by the formats."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumns({c: parse_date(c, formats) for c in dates})


def read_csv_headerless(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headerless CSV in bounded memory: file splits play the chunks."""
    return spark.read.schema(schema).option("header", False).option("escape", '"').csv(path)


def texts_labels_from_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """``(text, label)``: each file is one text, its label the index of its folder in the list."""
    globs = [f"{path}/{f}/*.*" for f in folders]
    raw = spark.read.text(globs, wholetext=True)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    index = F.array_position(F.array(*[F.lit(f) for f in folders]), folder) - 1
    return raw.select(F.col("value").alias("text"), index.cast("long").alias("label"))


def _listing(spark: SparkSession, glob: str, recursive: bool = False) -> DataFrame:
    """File names and sizes; the content column is not asked for, so no file is opened."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(glob).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def read_dir(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """``(file)`` relative to ``path``; an empty folder is an error."""
    try:
        files = _listing(spark, f"{path}/{folder}/*.*")
        empty = files.isEmpty()
    except Exception as e:  # a glob without a match is an analysis error
        if "PATH_NOT_FOUND" not in str(e):
            raise
        empty = True
    if empty:
        raise FileNotFoundError(f"no files in {folder}")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.concat(F.lit(f"{folder}/"), name).alias("file"))


def read_dirs(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """``(file, label, label_id)``: label is the sub-folder, ids follow the sorted label names."""
    from fernwick.operators.features import apply_cats, category_dictionary

    parts = F.split("path", "/")
    files = _listing(spark, f"{path}/{folder}/*/*").select(
        F.element_at(parts, -1).alias("_name"), F.element_at(parts, -2).alias("label"))
    files = files.filter(~F.col("label").isin(*NO_LABELS)).select(
        F.concat(F.lit(f"{folder}/"), "label", F.lit("/"), "_name").alias("file"), "label",
        F.col("label").alias("label_id"))
    return apply_cats(files, category_dictionary(files, ["label_id"]), ["label_id"])


def parse_csv_labels(spark: SparkSession, path: str, skip_header: bool = True, sep: str = " ") -> DataFrame:
    """``(name, labels)`` from a two-column CSV file, labels split at ``sep``."""
    df = spark.read.schema("name string, tags string").option("header", skip_header).csv(path)
    return df.select("name", F.split("tags", "\\Q" + sep + "\\E").alias("labels"))


def csv_source(spark: SparkSession, folder: str, path: str, skip_header: bool = True, suffix: str = "",
               continuous: bool = False) -> tuple[DataFrame, list[str]]:
    """Full file names with label vectors (or class indexes), and the label names."""
    from fernwick.functions.text import build_path
    from fernwick.operators.features import nhot_labels

    labelled, names = nhot_labels(parse_csv_labels(spark, path, skip_header), "name", "labels", continuous)
    return labelled.withColumn("file", build_path(folder, "name", suffix)), names


def read_lines(spark: SparkSession, path: str, name: str = "line") -> DataFrame:
    """``(line_no, text)`` of text files in file-name order.

    The lines are read once and stored; they are numbered inside their file split, and one row per split says
    where the split begins.
    """
    split = ["_file", "_start"]
    stored = cut_lineage(spark.read.text(path).select(
        F.col("value").alias(name), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start")))
    rows = stored.withColumn("_m", F.monotonically_increasing_id())
    sizes = rows.groupBy(*split).agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    before = F.coalesce(F.sum("_n").over(
        Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per file split.
    starts = bounded_broadcast(sizes.select(*split, (before - F.col("_first")).alias("_shift")))
    return rows.join(starts, split).select((F.col("_m") + F.col("_shift")).alias("line_no"), name)


def read_parallel(spark: SparkSession, a: str, b: str) -> DataFrame:
    """``(line_no, a, b)``: two text files aligned by line number; files of unequal length are an error."""
    both = read_lines(spark, a, "a").join(read_lines(spark, b, "b"), "line_no", "full")
    odd = F.raise_error(F.lit("the files have different numbers of lines"))
    return both.select("line_no", *[F.when(F.col(c).isNotNull(), F.col(c)).otherwise(odd).alias(c) for c in ("a", "b")])


def read_json_annotations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per annotation of JSON array files; records without annotations give none.

    ``multi_line`` reads one array per file; without it every line is an array, and files split.
    """
    df = spark.read.schema(ANNOTATIONS).option("multiLine", multi_line).json(path)
    return df.select("filename", F.explode("annotations").alias("a")).select("filename", "a.*")


def list_files(spark: SparkSession, folder: str, extensions: Sequence[str] = IMAGE_EXTENSIONS) -> DataFrame:
    """``(path)`` of all files below a folder with one of the extensions, in any case."""
    ends = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return _listing(spark, folder, recursive=True).filter(ends.isin(*extensions)).select("path")


def pair_files(files: DataFrame, partners: DataFrame, pattern: str, replacement: str, col: str = "file"
               ) -> DataFrame:
    """``(file, partner)``: the partner's name follows from the file's by a replacement."""
    wanted = files.select(col, F.regexp_replace(col, pattern, replacement).alias("partner"))
    return wanted.join(partners.select(F.col(col).alias("partner")), "partner", "left_semi").select(col, "partner")


# ---------------------------------------------------------------- writers


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Write a wrangled table and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_splits(df: DataFrame, path: str, id_col: str, split: str = "split",
                 bare: str = "without_docstrings") -> None:
    """Per split: function tokens, gzip JSON of originals, docstrings (not for ``bare``), lineage.

    Every output carries the id, so that rows are matched by it and not by line.
    """
    df = df.persist()
    try:
        df.select(id_col, "function_tokens", split).write.partitionBy(split).csv(f"{path}/function", header=True)
        df.select(id_col, "original_function", split).write.partitionBy(split).json(
            f"{path}/original_function", compression="gzip")
        df.filter(F.col(split) != bare).select(id_col, "docstring_tokens", split).write.partitionBy(split).csv(
            f"{path}/docstring", header=True)
        df.select(id_col, "url", split).write.partitionBy(split).csv(f"{path}/lineage", header=True)
    finally:
        df.unpersist()


def write_predictions(df: DataFrame, path: str, id_col: str, pred: str) -> None:
    """Gzip CSV of id and prediction; label arrays are joined by a space."""
    c = F.array_join(pred, " ") if dict(df.dtypes)[pred].startswith("array") else F.col(pred)
    df.select(id_col, c.alias(pred)).write.csv(path, header=True, compression="gzip")


def write_manifest(files: DataFrame, path: str, label: str | None = "label", sample: float | None = None,
                   seed: int = 42) -> None:
    """``file,label`` lines (``file,0`` without labels), of all files or a hashed share."""
    rows = files.select("file", F.col(label) if label else F.lit(0).alias("label"))
    if sample is not None:
        rows = bernoulli_sample(rows, sample, "file", seed)
    rows.write.csv(path)


def save_vocab(vocab: DataFrame, path: str) -> None:
    vocab.select("token", "id").write.parquet(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("token string, id long").parquet(path)


def save_vectors(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def load_vectors(spark: SparkSession, path: str, id_col: str = "id", vec: str = "vec") -> DataFrame:
    return spark.read.parquet(path).select(id_col, F.col(vec).cast("array<float>").alias(vec))


# ---------------------------------------------------------------- alignment


def alignment(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """One row: rows on both sides and ids found on one side only."""
    left = a.groupBy(id_col).agg(F.count("*").alias("_a"))
    right = b.groupBy(id_col).agg(F.count("*").alias("_b"))
    both = left.join(right, id_col, "full")
    return both.agg(F.coalesce(F.sum("_a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("_b"), F.lit(0)).alias("rows_b"),
                    F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"))


def check_aligned(a: DataFrame, b: DataFrame, id_col: str) -> None:
    """Fail if the row counts differ or an id is on one side only."""
    r = alignment(a, b, id_col).first()
    if r["rows_a"] != r["rows_b"] or r["only_a"] or r["only_b"]:
        raise ValueError(f"row mismatch: {r.asDict()}")


def build_reference_table(urls: DataFrame, code: DataFrame, id_col: str) -> DataFrame:
    """Two columns side by side after the alignment check."""
    check_aligned(urls, code, id_col)
    return urls.join(code, id_col)
