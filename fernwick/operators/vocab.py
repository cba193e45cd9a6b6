"""Vocabularies, id sequences, term counts and token streams."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick.functions.text import characters, ngrams
from fernwick.operators.ordered import dictionary_join, global_position, running_totals
from fernwick import session
from fernwick.session import cut_lineage, written

# Tokens of the rows that are counted together: some 20 MB of numbers. A longer row is counted alone.
COUNTED_TOKENS = 1 << 18

# A list of kept terms up to this many rows (some tens of MB) is sent to every task.
DICTIONARY_ROWS = 1_000_000
DICTIONARY_BYTES = 128_000_000
# By how much the bound that a sixteenth of the rows gives is raised at first.
GUESS = 4
# Texts whose numbers are sent to every task (32 MB).
HASHED_TERMS = 4_000_000

# The four special tokens at ids 0 to 3.
SPECIALS = ("_bos_", "_pad_", "_eos_", "_unk_")

# Counts up to this one have a bin of their own; beyond, each doubling has 64.
_EXACT = 4096
# Up to so many rows are numbered by a window; more by a distributed sort.
_WINDOW_ROWS = 100_000
# Counters of the sketch that leaves rare terms out.
_SKETCH = 1 << 20


def _bin(n: str):
    wide = F.floor((F.log2(F.col(n).cast("double")) - 12) * 64) + _EXACT
    return F.when(F.col(n) <= _EXACT, F.col(n)).otherwise(F.greatest(wide, F.lit(_EXACT))).cast("long")


def _cut(counts: DataFrame, size: int, n: str) -> tuple[int, int] | None:
    """The bin that the ``size``-th largest count lies in, and how many rows of it belong to the ``size`` largest; null if
    there are fewer rows. A few thousand bins reach the driver."""
    found = sorted(((r["b"], r["rows"]) for r in counts.groupBy(_bin(n).alias("b")).agg(F.count("*").alias("rows")).collect()), reverse=True)
    left = size
    for b, rows in found:
        if rows >= left:
            return b, left
        left -= rows
    return None


def most_frequent(counts: DataFrame, size: int, col: str, n: str = "n") -> DataFrame:
    """The ``size`` rows of the largest counts ``n``; ties go to the smaller ``col``.

    A histogram of the counts tells where the cut lies. All rows above it stay where they are; only rows at the cut are
    put in order, by a distributed sort: no task gets the best rows of all the others.
    """
    counts = cut_lineage(counts)
    cut = _cut(counts, size, n) if size > 0 else (1 << 62, 0)
    if cut is None:
        return counts
    b, need = cut
    above, at = counts.filter(_bin(n) > b), counts.filter(_bin(n) == b)
    if not need:
        return above
    placed = global_position(at, [F.desc(n), F.asc(col)], "_place")
    return above.unionByName(placed.filter(F.col("_place") < need).drop("_place"))


def _numbered(rows: DataFrame, order: Sequence, name: str, size: int) -> DataFrame:
    """0-based places of at most ``size`` rows."""
    if size <= _WINDOW_ROWS:
        return rows.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    return global_position(rows, order, name)


def build_vocab(tokens: DataFrame, max_vocab: int = 50000, min_freq: int = 0,
                specials: Sequence[str] = SPECIALS, col: str = "token") -> DataFrame:
    """``(token, id, n)``: special tokens, then tokens by count.

    The ``max_vocab`` most frequent tokens are taken first, then those with a count above ``min_freq`` are kept, which
    is the same the other way round. The result never has more than ``max_vocab`` rows plus the specials.
    """
    counts = tokens.groupBy(F.col(col).alias("token")).agg(F.count("*").alias("n"))
    top = most_frequent(counts.filter(F.col("n") > min_freq), max_vocab, "token")
    ranked = _numbered(top, [F.desc("n"), F.asc("token")], "_place", max_vocab).select(
        "token", (F.col("_place") + len(specials)).cast("long").alias("id"), "n")
    marks = tokens.sparkSession.createDataFrame(
        [(s, i, None) for i, s in enumerate(specials)], "token string, id long, n long")
    return marks.unionByName(ranked) if specials else ranked


def _map_items(df: DataFrame, seq: str, id_col: str, pairs: DataFrame, key: str, value: str, default,
               out: str) -> DataFrame:
    """Replace each array item by its partner in ``pairs``, in order.

    A dictionary of at most ``BROADCAST_ROWS`` rows goes to the tasks, which look up whole
    Arrow batches in place: no shuffle. A larger one is joined: items are counted out with their
    positions, looked up, and gathered per row id (a group is what was one array before).
    """
    # Of a repeated key the smallest value counts, whatever the size of the dictionary.
    pairs = cut_lineage(pairs.groupBy(key).agg(F.min(value).alias(value)))
    kind = pairs.schema[value].dataType
    if pairs.count() <= session.BROADCAST_ROWS:
        known = pairs.toArrow()
        keys, values = known.column(key).combine_chunks(), known.column(value).combine_chunks()

        @F.arrow_udf(T.ArrayType(kind))
        def look_up(lists: pa.Array) -> pa.Array:
            flat = lists.flatten()
            flat = flat.cast(keys.type) if flat.type != keys.type else flat
            found = pc.fill_null(values.take(pc.index_in(flat, value_set=keys)), default)
            sizes = pc.fill_null(pc.list_value_length(lists), 0)
            offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))])
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)

        return df.select(id_col, look_up(seq).alias(out))
    # Rows are told apart by their number, not by an id that may repeat.
    stored = cut_lineage(df.select(id_col, seq)).withColumn("_row", F.monotonically_increasing_id())
    items = stored.select(id_col, "_row", F.posexplode_outer(seq).alias("_pos", key))
    found = dictionary_join(items, pairs, key, "left").select(
        id_col, "_row", "_pos", F.when(F.col("_pos").isNotNull(), F.coalesce(value, F.lit(default).cast(kind))).alias("_v"))
    gathered = found.groupBy(id_col, "_row").agg(F.sort_array(F.collect_list(
        F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_v")))).alias("_items"))
    return gathered.select(id_col, F.col("_items._v").alias(out))


def numericalize_docs(df: DataFrame, tokens: str, vocab: DataFrame, id_col: str, unk: int = 3,
                      append: int | None = None) -> DataFrame:
    """``(id, ids)``: token ids in order, unknown tokens as ``unk``, and ``append`` at the end."""
    pairs = vocab.select(F.col("token").alias("_t"), F.col("id").cast("long").alias("_id"))
    out = _map_items(df, tokens, id_col, pairs, "_t", "_id", unk, "ids")
    if append is not None:
        out = out.withColumn("ids", F.concat("ids", F.array(F.lit(append).cast("long"))))
    return out


def denumericalize(df: DataFrame, ids: str, vocab: DataFrame, id_col: str, unk: str = "_unk_") -> DataFrame:
    """``(id, tokens)``: ids back to tokens."""
    pairs = vocab.select(F.col("id").cast("long").alias("_id"), F.col("token").alias("_t"))
    return _map_items(df, ids, id_col, pairs, "_id", "_t", unk, "tokens")


def resample_vocab(ids: DataFrame, size: int, col: str = "token_id") -> DataFrame:
    """``(old id, new id)``: the ``size`` most frequent ids behind the two kept ids 0 and 1.

    Ids that are not listed map to 0. The result has at most ``size`` + 2 rows.
    """
    counts = ids.groupBy(col).agg(F.count("*").alias("n"))
    top = _numbered(most_frequent(counts, size, col), [F.desc("n"), F.asc(col)], "_place", size)
    ranked = top.select(F.col(col).alias("old_id"), (F.col("_place") + 2).cast("long").alias("new_id"))
    fixed = ids.sparkSession.createDataFrame([(0, 0), (1, 1)], "old_id long, new_id long")
    # A kept id that is frequent again takes its later place.
    rest = fixed.join(ranked.select("old_id"), "old_id", "left_anti")
    return rest.unionByName(ranked.withColumn("old_id", F.col("old_id").cast("long")))


def doc_term(df: DataFrame, tokens: str, id_col: str, ngram_range: tuple[int, int] = (1, 1),
             max_features: int | None = None) -> DataFrame:
    """``(id, term, n)`` counts of lower-cased n-grams, of the ``max_features`` most frequent terms (ties go to the
    smaller term)."""
    lo, hi = ngram_range
    low = df.select(id_col, F.transform(tokens, F.lower).alias("_t"))
    if max_features is None:
        grams = F.flatten(F.array(*[ngrams(F.col("_t"), n) for n in range(lo, hi + 1)])) if (lo, hi) != (1, 1) else F.col("_t")
        return low.select(id_col, F.explode(grams).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("n"))
    # Tokens are stored, n-grams are not: they take many times the space, and are counted anew for each length.
    low = written(low, "tokens")
    words, odd = low.agg(F.sum(F.greatest(F.size("_t"), F.lit(0)).cast("long")), F.max(F.exists(
        "_t", lambda x: x.isNull() | x.contains(" ")))).first()
    least = _least_count(_terms(_row_terms(low.filter(_some(id_col)), id_col, lo, hi), id_col), id_col, max_features)
    # With a space in a token, n-grams of different lengths may be the same text, and are counted together.
    levels = [(lo, hi)] if odd else [(n, n) for n in range(lo, hi + 1)]
    totals = _totals(low, id_col, max_features, levels, GUESS * least, words or 0) if least > 1 else None
    if totals is None:
        totals = _totals(low, id_col, max_features, levels, least, words or 0, known=True)
    kept = cut_lineage(most_frequent(totals, max_features, "term", "_n").select("term"))
    terms = _terms(_row_terms(low, id_col, lo, hi, kept=_hashes(kept)), id_col)
    # Sent to all tasks if their number, a parameter, and their bytes allow it.
    size = kept.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    kept = F.broadcast(kept) if max_features <= DICTIONARY_ROWS and size <= DICTIONARY_BYTES else kept
    out = terms.join(kept, "term", "left_semi")
    # A row is counted in its task; only ids that several rows have ask for a sum.
    if low.groupBy(id_col).count().filter("count > 1").isEmpty():
        return out.select(id_col, "term", "n")
    return out.groupBy(id_col, "term").agg(F.sum("n").alias("n"))


def _totals(low: DataFrame, id_col: str, size: int, levels: Sequence[tuple[int, int]], least: int, words: int, known: bool = False) -> DataFrame | None:
    """``(term, _n)``: totals of n-grams, of the ``size`` most frequent at least. The ``size``-th largest is taken to be ``least`` at
    least; null if that is not ``known`` and turns out to be wrong."""
    made, both = None, None
    for lo, hi in levels:
        # An n-gram is no more frequent than the two shorter ones in it.
        terms = _terms(_row_terms(low, id_col, lo, hi, None if made is None else _hashes(made)), id_col)
        terms = _without_rare(terms, id_col, size, least=least) if words <= least * _SKETCH else terms
        # Of the totals, too, only those are stored that can be among the most frequent.
        made = written(terms.groupBy("term").agg(F.sum("n").alias("_n")).filter(F.col("_n") >= least), "totals")
        both = made if both is None else both.unionByName(made)
        cut = _cut(both, size, "_n")
        least = max(least, _floor(cut[0])) if cut else least
    return both.filter(F.col("_n") >= least) if known or cut else None


def _terms(rows: DataFrame, id_col: str) -> DataFrame:
    """`_row_terms` as rows of id, term and count."""
    return rows.select(id_col, F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(id_col, F.col("t.terms").alias("term"), F.col("t.counts").alias("n"))


def _hashed(terms: pa.Array) -> np.ndarray:
    """A number of each text; different texts seldom have the same."""
    return hash_array(pc.fill_null(terms, "").to_numpy(zero_copy_only=False), categorize=False)


def _hashes(terms: DataFrame) -> np.ndarray | None:
    """The numbers of the texts in ``term``, in order; null if they are too many to be sent to all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hashed(batch.column(0)).view(np.int64))], names=["h"])

    if terms.count() > HASHED_TERMS:
        return None
    return np.unique(terms.select("term").mapInArrow(run, "h long").toArrow()["h"].to_numpy().view(np.uint64))


def _among(terms: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """Whether a text can be one of those whose numbers are ``hashes``."""
    if not len(hashes):
        return np.zeros(len(terms), bool)
    own = _hashed(terms)
    return hashes[np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)] == own


def _row_terms(low: DataFrame, id_col: str, lo: int, hi: int, parts: np.ndarray | None = None, kept: np.ndarray | None = None) -> DataFrame:
    """Per row its distinct n-grams (``terms``) and how often each occurs (``counts``); only those whose two shorter n-grams can
    be among ``parts``, and that can be among ``kept``, where these are given (`_hashes`).

    Rows of some `COUNTED_TOKENS` together are counted by the numbers of their tokens, so that strings are made once for
    each n-gram of a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(ends):
                begin = ends[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(ends, begin + COUNTED_TOKENS, "right")))
                rows, terms, counts = _counted(lists.slice(at, end - at).flatten(), ends[at:end] - begin, lo, hi, parts)
                if kept is not None:
                    here = _among(terms, kept)
                    rows, terms, counts = rows[here], terms.filter(pa.array(here)), counts[here]
                order = np.argsort(rows, kind="stable")
                offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=end - at))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), terms.take(pa.array(order))),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(counts[order], pa.int64()))], names=[id_col, "terms", "counts"])
                at = end

    kind = T.StructType([low.schema[id_col], T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    return low.mapInArrow(run, kind)


def _counted(flat: pa.Array, ends: np.ndarray, lo: int, hi: int, parts: np.ndarray | None = None) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row number, n-gram and count of each different n-gram of rows whose tokens are ``flat``, up to ``ends``."""
    words = flat.dictionary_encode(null_encoding="encode")
    codes, kinds = words.indices.to_numpy().astype(np.int64), max(len(words.dictionary), 1)
    sizes = np.diff(ends, prepend=0)
    row, left = np.repeat(np.arange(len(ends)), sizes), np.repeat(ends, sizes) - np.arange(len(flat))
    rows, terms, counts = [], [], []

    def keys(key: np.ndarray, span: int, starts: np.ndarray, n: int) -> np.ndarray:
        """Numbers that tell n-grams with different ``key`` or tokens apart."""
        for k in range(n):
            if span * kinds >= 1 << 63:  # n-grams so far are numbered anew
                key, span = np.unique(key, return_inverse=True)[1], len(starts) + 1
            key, span = key * kinds + codes[starts + k], span * kinds
        return key

    def texts_at(starts: np.ndarray, n: int) -> pa.Array:
        joined = [flat.take(pa.array(starts + k)) for k in range(n)]
        return pc.binary_join_element_wise(*joined, " ") if n > 1 else joined[0]

    for n in range(lo, hi + 1):
        starts = np.flatnonzero(left >= n)
        if parts is not None and n > 1:
            short = np.flatnonzero(left >= n - 1)
            _, first, place = np.unique(keys(np.zeros(len(short), np.int64), 1, short, n - 1), return_index=True, return_inverse=True)
            known = np.zeros(len(flat) + 1, bool)
            known[short] = _among(texts_at(short[first], n - 1), parts)[place]
            starts = starts[known[starts] & known[starts + 1]]
        _, first, found = np.unique(keys(row[starts], len(ends), starts, n), return_index=True, return_counts=True)
        terms.append(texts_at(starts[first], n))
        rows.append(row[starts[first]]), counts.append(found)
    rows, terms, counts = np.concatenate(rows), pa.concat_arrays(terms), np.concatenate(counts)
    if lo < hi and pc.any(pc.match_substring(words.dictionary, " ")).as_py():
        # Tokens with spaces in them: n-grams of different lengths may be the same text.
        texts = terms.dictionary_encode(null_encoding="encode")
        key = rows * len(texts.dictionary) + texts.indices.to_numpy()
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
        rows, terms, counts = rows[first], terms.take(pa.array(first)), np.bincount(place, counts).astype(np.int64)
    return rows, terms, counts


def _some(id_col: str, share: int = 16):
    """Whether a row is in the sixteenth of the ids that bounds are taken from."""
    return F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(share)) == 0


def _least_count(terms: DataFrame, id_col: str, size: int, share: int = 16) -> int:
    """A lower bound of the ``size``-th largest count of ``terms`` (``term``, ``n``): the one within a sixteenth of the ids."""
    some = terms.filter(_some(id_col, share))
    cut = _cut(cut_lineage(some.groupBy("term").agg(F.sum("n").alias("n"))), size, "n")
    if cut is None:
        return 0
    return _floor(cut[0])


def _floor(b: int) -> int:
    """The least count of a bin; beyond the exact ones, with room for rounding."""
    return b if b < _EXACT else int(2 ** ((b - _EXACT - 1) / 64 + 12))


def _without_rare(terms: DataFrame, id_col: str, size: int, share: int = 16, least: int | None = None) -> DataFrame:
    """``terms`` (``term``, ``n``) without most of those that cannot be among the ``size`` most frequent.

    The ``size``-th largest count is at least ``least``. Hashed counters, each the sum of the terms that fall on it, are
    upper bounds of single terms. A term whose counter stays below the lower bound goes before any term is shuffled; no
    kept term can.
    """
    least = _least_count(terms, id_col, size, share) if least is None else least
    if least < 2:
        return terms
    place = F.pmod(F.xxhash64("term"), F.lit(_SKETCH))
    heavy = terms.groupBy(place.alias("_place")).agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("_place")
    return terms.withColumn("_place", place).join(F.broadcast(heavy), "_place", "left_semi").drop("_place")


def bow_rows(counts: DataFrame, id_col: str, max_len: int, docs: DataFrame | None = None) -> DataFrame:
    """``(id, terms, counts, length)``: sparse rows of a term-document table (``term``, ``n``), ready to be stacked.

    Terms are numbered from 1 in their order; a row lists its terms and their counts in that order, the last
    ``max_len`` of them, with zeros in front up to ``max_len``; ``length`` is the number of terms listed. Rows of
    ``docs`` without a term have zeros alone.
    """
    numbered = global_position(counts.select("term").distinct(), ["term"], "_place")
    placed = counts.join(numbered, "term").select(id_col, (F.col("_place") + 1).alias("_t"), F.col("n").cast("long").alias("_n"))
    # A group is what one row of the table was before.
    rows = placed.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("_t", "_n"))).alias("_row"))
    if docs is not None:
        rows = docs.select(id_col).join(rows, id_col, "left")
    rows = rows.withColumn("_row", F.coalesce("_row", F.array().cast("array<struct<_t:bigint,_n:bigint>>")))
    last = F.slice("_row", F.greatest(F.size("_row") - max_len + 1, F.lit(1)), F.lit(max_len))
    rows = rows.withColumn("_row", last).withColumn("length", F.size("_row"))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(max_len) - F.col("length"))
    return rows.select(id_col, F.concat(zeros, F.col("_row._t")).alias("terms"), F.concat(zeros, F.col("_row._n")).alias("counts"), "length")


def binarize(counts: DataFrame) -> DataFrame:
    return counts.withColumn("n", F.signum("n").cast("long"))


def char_index(df: DataFrame, text: str) -> DataFrame:
    """``(char, idx)``: distinct characters in sorted order from 1; index 0 is the NUL filler.

    There are no more rows than characters in Unicode.
    """
    chars = df.select(F.explode(characters(text)).alias("char")).distinct()
    ranked = chars.select("char", F.row_number().over(Window.orderBy("char")).alias("idx"))
    zero = df.sparkSession.createDataFrame([("\0", 0)], "char string, idx int")
    return zero.unionByName(ranked.filter("char <> '\\0'"))


def stream_starts(df: DataFrame, seq: str, id_col: str) -> DataFrame:
    """``(id, start, n)``: where each document begins in the concatenated stream, in id order.

    Only one narrow row per document takes part in the running total.
    """
    sizes = df.select(id_col, F.size(seq).cast("long").alias("n"))
    return running_totals(sizes, [id_col], {"_end": "n"}).select(
        id_col, (F.col("_end") - F.col("n")).alias("start"), "n")


def concat_corpus(df: DataFrame, tokens: str, id_col: str, eos: str = "<eos>") -> DataFrame:
    """The corpus as one token stream ``(pos, token)`` with an end mark after each row."""
    marked = df.select(id_col, F.concat(tokens, F.array(F.lit(eos))).alias("_t"))
    starts = stream_starts(marked, "_t", id_col).select(id_col, "start")
    return marked.join(starts, id_col).select("start", F.posexplode("_t").alias("_i", "token")).select(
        (F.col("start") + F.col("_i")).alias("pos"), "token")


def stream_windows(df: DataFrame, seq: str, id_col: str, width: int, step: int = 1) -> DataFrame:
    """``(pos, items, next)``: windows of ``width`` items over the concatenated stream, every ``step`` positions from 0, as
    long as an item follows. Windows go on through the ends of documents.

    A window belongs to the document that it begins in. That document takes the ``width`` items behind its end from its
    followers, however many they are: only the first ``width`` items of each document can be such, and they are looked
    up by blocks of ``width`` positions, two for each end. Empty documents hold no position; ids must not repeat.
    """
    starts = stream_starts(df, seq, id_col).filter("n > 0")
    total = starts.agg(F.sum("n")).scalar()
    docs = df.select(id_col, F.col(seq).alias("_seq")).join(starts, id_col)
    heads = docs.select("start", F.posexplode(F.slice("_seq", 1, width)).alias("_i", "_item"))
    heads = heads.select((F.col("start") + F.col("_i")).alias("_p"), "_item")
    blocks = heads.groupBy(F.expr(f"_p div {width}").alias("_b")).agg(F.collect_list(F.struct("_p", "_item")).alias("_heads"))
    ends = starts.select(id_col, (F.col("start") + F.col("n")).alias("_end"))
    asked = ends.select(id_col, "_end", F.explode(F.array(F.expr(f"_end div {width}"), F.expr(f"_end div {width} + 1"))).alias("_b"))
    behind = asked.join(blocks, "_b").groupBy(id_col, "_end").agg(F.flatten(F.collect_list("_heads")).alias("_h"))
    halo = behind.select(id_col, F.transform(F.sort_array(F.filter(
        "_h", lambda x: (x["_p"] >= F.col("_end")) & (x["_p"] < F.col("_end") + width))), lambda x: x["_item"]).alias("_halo"))
    rows = docs.join(halo, id_col, "left").select(
        "start", "n", F.concat("_seq", F.coalesce("_halo", F.slice("_seq", 1, 0))).alias("_seq"))
    first = (F.ceil(F.col("start") / step) * step - F.col("start")).cast("int")
    last = F.least(F.col("n"), total - width - F.col("start")).cast("int") - 1
    begins = F.when(last >= first, F.sequence(first, last, F.lit(step)))
    found = rows.select("start", "_seq", F.explode(begins).alias("_at"))
    return found.select((F.col("start") + F.col("_at")).alias("pos"), F.slice("_seq", F.col("_at") + 1, F.lit(width)).alias("items"),
                        F.get("_seq", F.col("_at") + width).alias("next"))


def drawn_windows(spark: SparkSession, rows: int, bptt: int, seed: str = "windows") -> DataFrame:
    """``(window, start, length)``: windows of drawn lengths over ``rows`` rows, of which the last is a target only.

    The first has ``bptt`` + 25 rows; later ones are drawn around ``bptt``, one in twenty around half of it, with
    deviation 5 and at least 5 rows; there are at most ``rows // bptt - 1``. Draws are hashes of seed and window.
    """
    share = lambda what: (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|{what}|"), F.col("id").cast("string"))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    normal = F.sqrt(-2 * F.log(share("radius"))) * F.cos(share("angle") * (2 * math.pi))
    mean = F.when(share("half") < 0.95, float(bptt)).otherwise(bptt / 2)
    size = F.when(F.col("id") == 0, F.lit(bptt + 25)).otherwise(F.greatest(F.lit(5), (mean + 5 * normal).cast("long"))).cast("long")
    drawn = running_totals(spark.range(max(0, rows // bptt - 1)).withColumn("_n", size), ["id"], {"_end": "_n"})
    found = drawn.select(F.col("id").alias("window"), (F.col("_end") - F.col("_n")).alias("start"), F.col("_n").alias("length"))
    return found.filter(F.col("start") < rows - 1).withColumn("length", F.least("length", F.lit(rows - 1) - F.col("start")))


def lm_stream_drawn(df: DataFrame, ids: str, id_col: str, bs: int, bptt: int, seed: str = "windows", backwards: bool = False) -> DataFrame:
    """`lm_stream` with windows of drawn lengths. Rows behind the last window are left out.

    A row finds its window by blocks of ``bptt`` rows: each window is listed once for every block it touches.
    """
    stream = lm_stream(df, ids, id_col, bs, bptt, backwards).drop("window")
    rows = (df.agg(F.sum(F.greatest(F.size(ids), F.lit(0)).cast("long"))).first()[0] or 0) // bs
    windows = drawn_windows(df.sparkSession, rows, bptt, seed).withColumn(
        "_b", F.explode(F.expr(f"sequence(start div {bptt}, (start + length - 1) div {bptt})")))
    met = stream.withColumn("_b", F.expr(f"row div {bptt}")).join(windows, "_b")
    return met.filter((F.col("row") >= F.col("start")) & (F.col("row") < F.col("start") + F.col("length"))).select(
        "col", "row", "window", (F.col("row") - F.col("start")).alias("place"), "id", "target")


def lm_stream(df: DataFrame, ids: str, id_col: str, bs: int, bptt: int, backwards: bool = False) -> DataFrame:
    """Training windows over the concatenated id stream.

    The stream is cut to a multiple of ``bs`` and laid out as ``bs`` columns of equal length
    (``backwards`` turns the columns upside down), which are cut into windows of ``bptt`` rows.
    Returns ``(col, row, window, id, target)``; the target is the id of the next row, taken from
    the same document or, at its edge, from a narrow table of document edges.
    """
    starts = stream_starts(df, ids, id_col).filter("n > 0")
    edges = df.select(id_col, F.element_at(ids, 1 if not backwards else -1).alias("_edge"),
                      F.size(ids).alias("_n")).filter("_n > 0").drop("_n")
    docs = starts.join(edges, id_col).withColumn("end", F.col("start") + F.col("n"))
    meet, mine = ("start", "end") if not backwards else ("end", "start")
    # Documents without tokens hold no position, so neighbours meet exactly at an edge.
    beyond = docs.select(F.col(meet).alias(mine), F.col("_edge").alias("_beyond"))
    placed = docs.select(id_col, "start", "end").join(beyond, mine, "left").select(id_col, "start", "_beyond")
    total = starts.agg(F.sum("n")).scalar()
    rows = df.select(id_col, F.col(ids).alias("_ids")).join(placed, id_col)
    size = F.greatest(F.size("_ids") - 1, F.lit(0))
    other = F.concat(F.array("_beyond"), F.slice("_ids", F.lit(1), size)) if backwards else F.concat(F.slice("_ids", F.lit(2), size), F.array("_beyond"))
    # Each item meets its target inside the array, so that no row of an item carries the array.
    pairs = F.zip_with("_ids", other, lambda x, y: F.struct(x.alias("id"), y.alias("target")))
    items = rows.filter(F.size("_ids") > 0).select("start", F.posexplode(pairs).alias("_i", "_p")).select(
        (F.col("start") + F.col("_i")).alias("_pos"), "_p.id", "_p.target")
    items = items.withColumn("_nb", F.floor(total / bs))
    items = items.filter(F.col("_pos") < F.col("_nb") * bs).withColumn("col", F.floor(F.col("_pos") / F.col("_nb")))
    down = F.col("_pos") % F.col("_nb")
    row = F.col("_nb") - 1 - down if backwards else down
    items = items.withColumn("row", row)
    return items.filter(F.col("row") < F.col("_nb") - 1).select(
        "col", "row", F.floor(F.col("row") / bptt).alias("window"), "id", "target")
