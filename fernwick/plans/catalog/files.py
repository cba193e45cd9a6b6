"""Readers and writers: Spark writes files from the tables, and the readers read them back."""

from pyspark.sql import functions as F

from fernwick.operators import sampling as S
from fernwick.plans.catalog.registry import query
from fernwick.session import scratch_path
from fernwick.sources import files as A


@query("read_csv_shards", "SELECT source || ' m/' || doc_id || '.txt' AS repo_path, text AS content FROM documents")
def _(t):
    path = scratch_path(t.spark, "shards")
    rows = t.documents.select(F.concat("source", F.lit(" m/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("repo_path"), F.col("text").alias("content"))
    # A shard is read by one task: four at least, and about so many documents in each.
    rows.repartition(max(4, -(-rows.count() // 8_192))).write.csv(path, header=True, escape='"', quoteAll=True)
    return A.read_csv_shards(t.spark, path)


@query("read_jsonl_gz", """
    SELECT lang AS language, CASE WHEN doc_id % 10 = 0 THEN 'valid' ELSE 'train' END AS partition, array_to_string(string_split(text, ' '), '|') AS code_tokens FROM documents""")
def _(t):
    path = scratch_path(t.spark, "jsonl")
    part = F.when(F.col("doc_id") % 10 == 0, "valid").otherwise("train")
    t.documents.select(F.col("source").alias("repo"), F.col("lang").alias("language"), part.alias("partition"), F.col("text").alias("code"),
                       F.split("text", " ").alias("code_tokens")).write.json(path, compression="gzip")
    df = A.read_jsonl_gz(t.spark, path, ["language", "partition", "code_tokens"])
    return df.withColumn("code_tokens", F.array_join("code_tokens", "|"))


@query("read_csv_dir_with_source", "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, count(*) AS named, true AS files FROM orders")
def _(t):
    path = scratch_path(t.spark, "csvdir")
    t.orders.select("o_orderkey", "o_totalprice").write.csv(path, header=True)
    df = A.read_csv_dir_with_source(t.spark, path, "o_orderkey long, o_totalprice double")
    return df.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.count_if(F.col("file").startswith("part-")).alias("named"),
                  (F.countDistinct("file") > 0).alias("files"))


@query("load_tables", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region")
def _(t):
    from fernwick.operators.relational import union_all

    tables = A.load_tables(t.spark, t.folder, ["nation", "orders", "region"])
    return union_all([df.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, df in tables.items()])


@query("read_csv_parse_dates", "SELECT o_orderkey, o_totalprice, date_trunc('day', o_orderdate) AS o_orderdate FROM orders")
def _(t):
    path = scratch_path(t.spark, "dates")
    t.orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")).write.csv(path, header=True)
    return A.read_csv_parse_dates(t.spark, path, "o_orderkey long, o_totalprice double, o_orderdate string", ["o_orderdate"])


@query("read_csv_headerless", "SELECT quality AS label, doc_id FROM labels")
def _(t):
    path = scratch_path(t.spark, "plain")
    t.labels.select("quality", "doc_id").write.csv(path, header=False)
    return A.read_csv_headerless(t.spark, path, "label int, doc_id long")


def _write_label_files(t, path):
    """Small text files in one folder per label, from as many tasks as the table has."""
    t.conversations.filter("role <> 'system'").select("role", F.hex(F.encode("text", "utf-8")).alias("value")).write.option(
        "maxRecordsPerFile", 200).partitionBy("role").text(path)


@query("texts_labels_from_folders", "SELECT CASE role WHEN 'user' THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS label, text FROM conversations WHERE role <> 'system'")
def _(t):
    path = scratch_path(t.spark, "labels")
    _write_label_files(t, path)
    files = A.texts_labels_from_folders(t.spark, path, ["role=user", "role=assistant"])
    lines = files.select("label", F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    return lines.select("label", F.decode(F.unhex("line"), "utf-8").alias("text"))


@query("read_dirs", "SELECT DISTINCT 'tree/role=' || role AS folder, 'role=' || role AS label, CASE role WHEN 'assistant' THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS label_id FROM conversations WHERE role <> 'system'")
def _(t):
    path = scratch_path(t.spark, "dirs")
    _write_label_files(t, f"{path}/tree")
    files = A.read_dirs(t.spark, path, "tree")
    return files.select(F.regexp_extract("file", "^(.*)/[^/]*$", 1).alias("folder"), "label", "label_id").distinct()


@query("parse_csv_labels", "SELECT 'd' || doc_id AS name, lang || '|' || source AS labels FROM documents")
def _(t):
    path = scratch_path(t.spark, "tags")
    t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"), F.concat_ws(" ", "lang", "source").alias("tags")).write.csv(path, header=True)
    return A.parse_csv_labels(t.spark, path).withColumn("labels", F.array_join("labels", "|"))


@query("csv_source", """
    WITH n AS (SELECT list(DISTINCT l ORDER BY l) AS names FROM (SELECT lang AS l FROM documents UNION ALL SELECT source FROM documents))
    SELECT 'texts/d' || doc_id || '.txt' AS file, array_to_string(list_transform(names, lambda l: CAST(l = lang OR l = source AS INTEGER)), ' ') AS hot FROM documents, n""")
def _(t):
    path = scratch_path(t.spark, "tags")
    t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"), F.concat_ws(" ", "lang", "source").alias("tags")).write.csv(path, header=True)
    out, _ = A.csv_source(t.spark, "texts", path, suffix=".txt")
    return out.select("file", F.array_join(F.col("label_vector").cast("array<int>").cast("array<string>"), " ").alias("hot"))


@query("read_parallel", "SELECT doc_id AS line_no, 'a' || doc_id AS a, lang || n_chars AS b FROM documents")
def _(t):
    a, b = scratch_path(t.spark, "left"), scratch_path(t.spark, "right")
    rows = t.documents.orderBy("doc_id")
    rows.select(F.concat(F.lit("a"), F.col("doc_id").cast("string"))).write.text(a)
    rows.select(F.concat("lang", F.col("n_chars").cast("string"))).write.text(b)
    return A.read_parallel(t.spark, a, b)


@query("read_json_annotations", "SELECT CAST(l_orderkey AS VARCHAR) AS filename, l_quantity AS height, l_tax AS width, l_discount AS x, CAST(l_linenumber AS DOUBLE) AS y FROM lineitem")
def _(t):
    path = scratch_path(t.spark, "boxes")
    box = F.struct(F.col("l_quantity").alias("height"), F.col("l_tax").alias("width"), F.col("l_discount").alias("x"), F.col("l_linenumber").cast("double").alias("y"))
    t.lineitem.groupBy(F.col("l_orderkey").cast("string").alias("filename")).agg(F.collect_list(box).alias("annotations")).select(
        F.to_json(F.array(F.struct("filename", "annotations")))).write.text(path)
    return A.read_json_annotations(t.spark, path, multi_line=False)


@query("save_table", "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders")
def _(t):
    return A.save_table(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), scratch_path(t.spark, "saved"))


@query("write_splits", """
    SELECT kind, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM (
        SELECT 'function' AS kind, doc_id FROM documents UNION ALL SELECT 'original_function', doc_id FROM documents
        UNION ALL SELECT 'lineage', doc_id FROM documents UNION ALL SELECT 'docstring', doc_id FROM documents WHERE lang <> 'de') GROUP BY 1""")
def _(t):
    from fernwick.operators.relational import union_all

    path = scratch_path(t.spark, "splits")
    rows = t.documents.select("doc_id", F.md5("text").alias("function_tokens"), F.col("text").alias("original_function"), F.col("lang").alias("docstring_tokens"),
                              F.col("source").alias("url"), F.when(F.col("lang") == "de", "without_docstrings").otherwise("train").alias("split"))
    A.write_splits(rows, path, "doc_id")
    spark = t.spark
    parts = [spark.read.json(f"{path}/original_function").select(F.lit("original_function").alias("kind"), "doc_id")]
    parts += [spark.read.csv(f"{path}/{k}", header=True).select(F.lit(k).alias("kind"), F.col("doc_id").cast("long")) for k in ("function", "docstring", "lineage")]
    return union_all(parts).groupBy("kind").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query("write_predictions", "SELECT doc_id, lang || ' ' || source AS tags FROM documents")
def _(t):
    path = scratch_path(t.spark, "predictions")
    A.write_predictions(t.documents.select("doc_id", F.array("lang", "source").alias("tags")), path, "doc_id", "tags")
    return t.spark.read.schema("doc_id long, tags string").csv(path, header=True)


@query("build_reference_table", "SELECT doc_id, source || '/' || doc_id AS url, text AS code FROM documents")
def _(t):
    urls = t.documents.select("doc_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"))
    return A.build_reference_table(urls, t.documents.select("doc_id", F.col("text").alias("code")), "doc_id")


@query("check_aligned", """
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM documents) AS rows_a, (SELECT CAST(count(*) AS BIGINT) FROM labels) AS rows_b,
           (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS only_a,
           (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS only_b""")
def _(t):
    return A.alignment(t.documents, t.labels, "doc_id")


@query("write_manifest", "SELECT 'texts/' || doc_id || '.txt' AS file, lang AS label FROM documents")
def _(t):
    path = scratch_path(t.spark, "manifest")
    files = t.documents.select(F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"), F.col("lang").alias("label"))
    A.write_manifest(files, path)
    return t.spark.read.schema("file string, label string").csv(path)


@query("list_files", "SELECT DISTINCT lang AS label FROM documents WHERE lang <> 'en'")
def _(t):
    path = scratch_path(t.spark, "images")
    rows = t.documents.select("lang", F.col("doc_id").cast("string").alias("value"))
    rows.filter("lang <> 'en'").write.option("maxRecordsPerFile", 200).partitionBy("lang").text(path)
    found = A.list_files(t.spark, path, ["txt"])
    return found.select(F.regexp_extract("path", "lang=([a-z]+)/", 1).alias("label")).distinct()


_MASK = "CAST('0x' || substr(md5('cut|' || replace(file, '.jpg', '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.2"


@query("pair_files", f"""
    WITH f AS (SELECT 'd' || doc_id || '.jpg' AS file, 'd' || doc_id || '_mask.png' AS partner FROM documents WHERE lang <> 'es')
    SELECT file, partner, {_MASK} AS is_val FROM f""")
def _(t):
    stem = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    files = t.documents.select(F.concat(stem, F.lit(".jpg")).alias("file"))
    masks = t.documents.filter("lang <> 'es'").select(F.concat(stem, F.lit("_mask.png")).alias("file"))
    pairs = A.pair_files(files, masks, r"\.jpg$", "_mask.png").withColumn("stem", F.replace("file", F.lit(".jpg"), F.lit("")))
    return pairs.select("file", "partner", (S.hash_fraction("stem", "cut") < 0.2).alias("is_val"))
