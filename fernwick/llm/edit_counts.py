"""Token counts that follow edits: each document keeps a segment tree over its pre-tokens, and an edit encodes
only the leaves it touches.

Leaves are cut where a run of white space begins after other text. No pre-token and no merge of the byte-level
pattern reaches over such a place, whatever stands around it, so counts of leaves add up to the count of the
text, and an edit can change only leaves that it touches or borders: those are the boundary context. The inner
nodes of the tree hold sums of characters and tokens; an edit finds its leaves from the root, encodes their new
text, and brings the sums on the way up to date.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwick.llm.bpe import CUT, WHITE, Encoder, encoder, read_tokenizer, slices
from fernwick.llm.common import arrow_map, only, store
from fernwick.operators.ordered import keyed_position

# Characters of a leaf, about.
LEAF_CHARS = 512
_START = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")
EDIT = "array<struct<start:int,drop:int,put:string>>"


def _leaves(text: str, size: int) -> list[str]:
    out, at = [], 0
    while len(text) - at > size:
        cut = _START.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return out + [text[at:]] if at < len(text) else out


class SegmentTree:
    """Counts of the leaves in the lower half of two arrays, sums of pairs above them."""

    def __init__(self, leaves: list[str], counts: list[int]):
        self.leaves = leaves
        n = max(1, len(leaves))
        self.width = 1 << (n - 1).bit_length()
        self.chars, self.tokens = (np.zeros(2 * self.width, np.int64) for _ in range(2))
        self.chars[self.width:self.width + len(leaves)] = [len(x) for x in leaves]
        self.tokens[self.width:self.width + len(leaves)] = counts
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last filled leaf, if the text ends before), and where it starts."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if place - start >= self.chars[i] and self.chars[i + 1]:
                start += int(self.chars[i])
                i += 1
        return i - self.width, start

    def set(self, leaf: int, text: str, count: int) -> None:
        i = leaf + self.width
        self.leaves[leaf], self.chars[i], self.tokens[i] = text, len(text), count
        while i > 1:
            i //= 2
            self._sum(i)

    def edit(self, start: int, drop: int, put: str, count) -> int:
        """Replace ``drop`` characters from ``start``; returns the number of characters that were encoded again."""
        total = int(self.chars[1])
        start = min(max(start, 0), total)
        stop = min(start + max(drop, 0), total)
        if not self.leaves:
            self.leaves = [""]
        # Leaves that the edit touches or borders: from the character before it to the one behind it.
        first, at = self.find(max(start - 1, 0))
        last, _ = self.find(stop)
        old = "".join(self.leaves[first:last + 1])
        new = old[:start - at] + put + old[stop - at:]
        self.set(first, new, count(new))
        for leaf in range(first + 1, last + 1):
            self.set(leaf, "", 0)
        return len(new)

    def balanced(self, size: int) -> bool:
        """Whether no leaf has outgrown its size by far, so that edits stay cheap."""
        return max((len(x) for x in self.leaves), default=0) <= 8 * size


def _counter(enc: Encoder):
    return lambda text: sum(map(len, enc.ids_of(CUT.findall(text)))) // 4


def build_trees(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF_CHARS) -> DataFrame:
    """Per row: id, ``leaves`` (texts), ``counts`` (tokens of each), and ``n_tokens``. Null texts count as empty and
    have no leaf. Rows are independent of each other; repeated rows and null ids have trees of their own."""
    spec = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))
    docs = only(docs, [id_col, text_col])
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch):
        count = _counter(encoder(spec.value))
        for part in slices(batch):
            leaves = [_leaves(t, leaf) for t in part.column(1).to_pylist()]
            counts = [[count(x) for x in row] for row in leaves]
            yield {"_id": part.column(0), "leaves": pa.array(leaves, pa.list_(pa.string())),
                   "counts": pa.array(counts, pa.list_(pa.int32())), "n_tokens": pa.array(list(map(sum, counts)), pa.int64())}

    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return arrow_map(src, f"_id {kind}, leaves array<string>, counts array<int>, n_tokens long", run).withColumnRenamed("_id", id_col)


def apply_edits(trees: DataFrame, path: str, id_col: str = "doc_id", edits: str = "edits", leaf: int = LEAF_CHARS) -> DataFrame:
    """Apply the array ``edits`` (start, drop, put), one after the other, to each row's tree: start counts
    characters of the text as the edits before have left it. Starts beyond the text mean its end; negative
    numbers mean 0; a null array or a null text to put means none.

    Returns id, ``leaves``, ``counts``, ``n_tokens`` after, ``n_tokens_before``, and ``encoded_chars``, the number of
    characters that were encoded again.
    """
    spec = trees.sparkSession.sparkContext.broadcast(read_tokenizer(path))
    trees = only(trees, [id_col, "leaves", "counts", edits])
    kind = trees.schema[id_col].dataType.simpleString()

    def run(batch):
        count = _counter(encoder(spec.value))
        for part in slices(batch):
            out = [[] for _ in range(5)]
            for leaves, counts, todo in zip(*[part.column(k).to_pylist() for k in range(1, 4)]):
                tree, again = SegmentTree(leaves, counts), 0
                before = int(tree.tokens[1])
                for e in todo or []:
                    again += tree.edit(e["start"] or 0, e["drop"] or 0, e["put"] or "", count)
                    if not tree.balanced(leaf):
                        # A leaf that has outgrown is cut again; its parts are encoded, the other leaves are not.
                        cut = [(_leaves(x, leaf), None) if len(x) > 8 * leaf else ([x], n) for x, n in zip(tree.leaves, tree.tokens[tree.width:])]
                        flat = [(x, count(x) if n is None else int(n)) for xs, n in cut for x in xs if x]
                        again += sum(len(x) for xs, n in cut if n is None for x in xs)
                        tree = SegmentTree([x for x, _ in flat], [n for _, n in flat])
                kept = [(x, int(n)) for x, n in zip(tree.leaves, tree.tokens[tree.width:]) if x]
                for col, got in zip(out, ([x for x, _ in kept], [n for _, n in kept], int(tree.tokens[1]), before, again)):
                    col.append(got)
            kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64())
            yield {"_id": part.column(0), **{n: pa.array(c, k) for n, c, k in zip(_AFTER, out, kinds)}}

    schema = f"_id {kind}, leaves array<string>, counts array<int>, n_tokens long, n_tokens_before long, encoded_chars long"
    src = trees.select(F.col(id_col).alias("_id"), "leaves", "counts", F.col(edits).cast(EDIT).alias("edits"))
    return arrow_map(src, schema, run).withColumnRenamed("_id", id_col)


_AFTER = ("leaves", "counts", "n_tokens", "n_tokens_before", "encoded_chars")


def apply_edit_table(trees: DataFrame, edits: DataFrame, path: str, id_col: str = "doc_id", at_once: int = 1_000) -> DataFrame:
    """The same for a table of edits: id, ``seq`` (their order, unique per id), ``start``, ``drop``, ``put``. All rows of an
    id get its edits. Edits go in rounds of ``at_once`` per document, so a document with very many edits is never
    one group; each round is a join on the id. Edits of ids without a tree, and of the null id, are not used."""
    w_edits = edits.select(F.col(id_col).alias("_key"), F.col("seq").cast("long").alias("seq"), F.struct("start", "drop", "put").alias("e"))
    # Rounds go by the number of an edit within its id, whatever the values of ``seq`` are.
    w_edits = store(keyed_position(w_edits.filter("_key is not null"), ["_key"], ["seq"], "place"), "edits")
    span = w_edits.agg(F.min("place"), F.max("place")).first()
    out = trees.select(id_col, "leaves", "counts", "n_tokens", F.col("n_tokens").alias("n_tokens_before"), F.lit(0).cast("long").alias("encoded_chars"))
    if span[0] is None:
        return out
    for first in range(span[0], span[1] + 1, at_once):
        some = w_edits.filter(F.col("place").between(first, first + at_once - 1))
        lists = some.groupBy("_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "e"))), lambda x: x["e"]).alias("edits"))
        joined = out.join(lists, out[id_col] == lists["_key"], "left")
        kept = ["n_tokens_before", "encoded_chars"]
        done = apply_edits(joined.withColumn(id_col, F.struct(F.col(id_col).alias("id"), *kept)), path, id_col)
        out = store(done.select(F.col(f"{id_col}.id").alias(id_col), "leaves", "counts", "n_tokens", F.col(f"{id_col}.n_tokens_before").alias("n_tokens_before"),
                                (F.col(f"{id_col}.encoded_chars") + F.col("encoded_chars")).alias("encoded_chars")), "edited")
    return out
