"""Source divergence audit by chunk factorization.

Terms never contain white space, so a text's terms are those of its white-space chunks. Documents are reduced to
chunk counts; all rows of a chunk meet, where each globally distinct chunk is tokenized once and its terms take
over its counts; then all rows of a term meet. A row lists its documents only while they are fewer than the
number that keeps a term: beyond it the term is kept whatever they are, so no list grows with the corpus.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fernwick.llm.common import only, store, text_bytes

# Letters A-Z and all bytes of characters beyond ASCII: the complement of `[\x00-\x40\x5B-\x60\x7B-\x7F]` in UTF-8.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
# Chunks up to this many bytes are their own key; longer ones are known by a 128-bit digest.
KEY_BYTES = 32
# Words and distinct chunks that are counted together before a row per chunk leaves the task.
SLICE_WORDS = 5_000_000
SLICE_CHUNKS = 1_000_000
# Sums of one pass over pairs of sources, in numbers: 32 MB.
PAIR_CELLS = 4_000_000
# Rows of one term that wait for more of its rows before they are merged.
WAITING = 50_000

# Occurrences by source: its number, and how many.
_GROUP = np.dtype([("g", "<u4"), ("n", "<u8")])


def _lists(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of packed lists, and the number of entries per row."""
    kind = np.dtype(kind)
    column = pa.concat_arrays([column]) if column.offset else column
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data.view(kind), np.diff(offsets) // kind.itemsize


def _packed(entries: np.ndarray, sizes: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """A column of packed lists; rows that are not ``valid`` are null (and have no entries)."""
    offsets = np.append(0, np.cumsum(sizes * entries.itemsize)).astype(np.int32)
    nulls = None if valid is None else pa.array(valid).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [nulls, pa.py_buffer(offsets), pa.py_buffer(entries.tobytes())])


def _merged(row: np.ndarray, docs: pa.Array, groups: pa.Array, min_docs: int) -> tuple[pa.Array, pa.Array]:
    """Merge rows (``row``: the new row of each, ascending): the union of their documents, null if that is ``min_docs``
    or more or if one of them is null already, and the sums of their occurrences by source."""
    n = int(row[-1]) + 1
    entries, sizes = _lists(docs.fill_null(b""), "<u8")
    at = np.repeat(row, sizes)
    order = np.lexsort((entries, at))
    at, entries = at[order], entries[order]
    new = np.append(True, (at[1:] != at[:-1]) | (entries[1:] != entries[:-1])) if len(at) else np.zeros(0, bool)
    at, entries = at[new], entries[new]
    size = np.bincount(at, minlength=n)
    known = (np.bincount(row, docs.is_null().to_numpy(zero_copy_only=False), n) == 0) & (size < min_docs)
    packed_docs = _packed(entries[known[at]], np.where(known, size, 0), known)
    entries, sizes = _lists(groups, _GROUP)
    key = np.repeat(row, sizes).astype(np.uint64) << np.uint64(32) | entries["g"]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sums = np.zeros(len(first), _GROUP)
    sums["g"] = key[first] & np.uint64(0xFFFFFFFF)
    sums["n"] = np.add.reduceat(entries["n"][order], first)
    return packed_docs, _packed(sums, np.bincount((key[first] >> np.uint64(32)).astype(np.int64), minlength=n))


def chunk_counts(docs: DataFrame, places: dict[tuple[str, str], int], min_docs: int, lang: str, source: str, text: str,
                 slice_words: int = SLICE_WORDS) -> DataFrame:
    """One row per slice of documents, lang (its number) and chunk: numbers of its documents, unless they are
    ``min_docs`` or more, and occurrences by source (its number in ``places``). ``chunk`` is filled only where the key
    is a digest."""
    rows = docs.select(text_bytes(docs, text).alias("t"), *[
        F.coalesce(docs[c].cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))])
    langs = {name: k for k, name in enumerate(sorted({x for x, _ in places}))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # 23 bits for a task, 16 for its slice, 24 for the document: each has a word, and a slice ends by their number.
        number = count(TaskContext.get().partitionId() << 16)
        held, size, index = [], 0, defaultdict(count().__next__)
        for batch in batches:
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split()
                if not words:
                    continue
                held.append((langs[lang], places[lang, source], np.fromiter(map(index.__getitem__, words), np.int32, len(words))))
                size += len(words)
                if size >= slice_words or len(index) >= SLICE_CHUNKS:
                    yield _slice_counts(held, list(index), next(number), min_docs)
                    held, size, index = [], 0, defaultdict(count().__next__)
        if size:
            yield _slice_counts(held, list(index), next(number), min_docs)

    return rows.mapInArrow(run, "lang int, key binary, chunk binary, docs binary, groups binary")


def _slice_counts(held: list[tuple[int, int, np.ndarray]], chunks: list[bytes], part: int, min_docs: int) -> pa.RecordBatch:
    held.sort(key=lambda x: x[:2])  # so that chunk, document order is also chunk, lang, source order
    lang, group = np.array([x[0] for x in held], np.int32), np.array([x[1] for x in held], np.int64)
    ids = np.concatenate([x[2] for x in held]).astype(np.int64)
    ids *= len(held)
    ids += np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
    pairs, n = np.unique(ids, return_counts=True)
    del ids
    chunk, doc = np.divmod(pairs, len(held))
    new_row = np.append(True, (chunk[1:] != chunk[:-1]) | (lang[doc[1:]] != lang[doc[:-1]]))
    new_group = new_row | np.append(True, group[doc[1:]] != group[doc[:-1]])
    rows, groups = np.flatnonzero(new_row), np.flatnonzero(new_group)
    counts = np.zeros(len(groups), _GROUP)
    counts["g"], counts["n"] = group[doc[groups]], np.add.reduceat(n, groups)
    df = np.diff(np.append(rows, len(doc)))
    few = df < min_docs
    numbers = doc[np.repeat(few, df)].astype("<u8") | np.uint64(part << 24)
    keys = pa.array([c if len(c) <= KEY_BYTES else b"\0" + xxhash.xxh3_128_hexdigest(c).encode() for c in chunks], pa.binary())
    texts = pa.array([None if len(c) <= KEY_BYTES else c for c in chunks], pa.binary())
    at = pa.array(chunk[rows])
    return pa.RecordBatch.from_arrays(
        [pa.array(lang[doc[rows]]), keys.take(at), texts.take(at), _packed(numbers, np.where(few, df, 0), few),
         _packed(counts, np.diff(np.append(np.searchsorted(groups, rows), len(groups))))], names=["lang", "key", "chunk", "docs", "groups"])


def chunk_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """The rows of all slices by chunk, merged, with each chunk tokenized once: one row per term of it, in lower case,
    which takes over the chunk's documents and its occurrences, times those in the chunk."""
    # A slice gives one small row per chunk, so all rows of a frequent chunk still fit one task.
    rows = counts.repartition("key").sortWithinPartitions("key", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, Counter()
        for batch in batches:
            lang, keys = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            new_key = np.array([k != before for k, before in zip(keys, [last, *keys])], bool)
            chunks = batch.column(2)
            new_row = new_key | np.append(True, lang[1:] != lang[:-1])
            new_row[0] = True
            first = np.flatnonzero(new_row)
            docs, groups = _merged(np.cumsum(new_row) - 1, batch.column(3), batch.column(4), min_docs)
            terms, times, number = [], [], np.zeros(len(first), np.int64)
            for k, row in enumerate(first.tolist()):
                if new_key[row]:
                    last = keys[row]
                    found = Counter(TERM.findall((chunks[row].as_py() if len(last) > KEY_BYTES else last).lower()))
                terms += found
                times += found.values()
                number[k] = len(found)
            at = np.repeat(np.arange(len(first)), number)
            entries, sizes = _lists(groups.take(pa.array(at)), _GROUP)
            entries = entries.copy()
            entries["n"] *= np.repeat(np.array(times, np.uint64), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang[first][at]), pa.array(terms, pa.binary()), docs.take(pa.array(at)), _packed(entries, sizes)],
                names=["lang", "term", "docs", "groups"])

    return rows.mapInArrow(run, "lang int, term binary, docs binary, groups binary")


def kept_terms(terms: DataFrame, min_docs: int) -> DataFrame:
    """The terms that ``min_docs`` documents or more of a lang hold, with their occurrences by source (``found``)."""
    rows = terms.repartition("lang", "term").sortWithinPartitions("lang", "term")

    def merge(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lang, term = table.column(0).to_numpy(), table.column(1).to_pylist()
        new = np.append(True, (lang[1:] != lang[:-1]) | np.array([a != b for a, b in zip(term[1:], term)], bool))
        first = pa.array(np.flatnonzero(new))
        docs, groups = _merged(np.cumsum(new) - 1, *(c.chunk(0) if c.num_chunks else pa.array([], pa.binary()) for c in (table.column(2), table.column(3))), min_docs)
        return pa.table([table.column(0).take(first), table.column(1).take(first), docs, groups], names=["lang", "term", "docs", "groups"])

    def chosen(table: pa.Table) -> pa.RecordBatch:
        table = table.filter(table.column(2).is_null()).combine_chunks()
        packed = table.column(3).chunk(0) if table.num_rows else pa.array([], pa.binary())
        entries, sizes = _lists(packed, _GROUP)
        found = pa.StructArray.from_arrays([pa.array(entries["g"].astype(np.int32)), pa.array(entries["n"].astype(np.int64))], ["g", "n"])
        column = lambda k: table.column(k).chunk(0) if table.num_rows else pa.array([], table.column(k).type)
        return pa.RecordBatch.from_arrays(
            [column(0), column(1).cast(pa.string()), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), found)],
            names=["lang", "term", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table])
            end = (table.column(0)[-1], table.column(1)[-1])
            # The last term may go on in the next batch. Its rows wait, merged if they are many.
            lang, term = table.column(0).to_numpy(), table.column(1)
            cut = table.num_rows - 1
            while cut and lang[cut - 1] == end[0].as_py() and term[cut - 1] == end[1]:
                cut -= 1
            if cut:
                yield chosen(merge(table.slice(0, cut)))
            waiting = table.slice(cut)
            waiting = merge(waiting) if waiting.num_rows > WAITING else waiting.combine_chunks()
        if waiting is not None:
            yield chosen(merge(waiting))

    return rows.mapInArrow(run, "lang int, term string, found array<struct<g:int,n:long>>")


def source_list(docs: DataFrame, lang: str, source: str) -> list[tuple[str, str]]:
    """All (lang, source) groups in order; null counts as ''."""
    names = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))]
    return sorted((r["lang"], r["source"]) for r in docs.select(names).distinct().collect())


def term_table(docs: DataFrame, groups: list[tuple[str, str]], min_docs: int, lang: str, source: str, text: str,
               slice_words: int = SLICE_WORDS) -> DataFrame:
    """Kept terms by lang (its number) with ``found``: number of the group and its occurrences."""
    counts = chunk_counts(docs, {x: k for k, x in enumerate(groups)}, min_docs, lang, source, text, slice_words)
    return store(kept_terms(chunk_terms(counts, min_docs), min_docs), "kept-terms")


def term_counts(docs: DataFrame, min_docs: int = 30, lang: str = "lang", source: str = "source", text: str = "text",
                slice_words: int = SLICE_WORDS) -> DataFrame:
    """Occurrences (``n`` > 0) per ``lang``, ``source`` and ``term`` of the terms that at least ``min_docs`` documents
    of the lang hold. Rows are documents, equal ones too; null columns count as ''. Texts without terms add nothing."""
    docs = only(docs, [lang, source, text])
    groups = source_list(docs, lang, source)
    found = term_table(docs, groups, min_docs, lang, source, text, slice_words).select("term", F.explode("found").alias("f"))
    named = docs.sparkSession.createDataFrame([(k, *x) for k, x in enumerate(groups)], "g int, lang string, source string")
    return found.select("term", "f.g", "f.n").join(named, "g").select("lang", "source", "term", "n")


class Shares:
    """Smoothed shares of the sources of one lang: the number of its first group, the sources' totals and the number of
    kept terms."""

    def __init__(self, first: int, totals: list[int], size: int, smooth: int, scale: int):
        self.first, self.sources = first, len(totals)
        self.below = np.array([total + smooth * size for total in totals], np.int64)
        self.whole = np.array([sum(totals) + smooth * size], np.int64)
        self.smooth, self.scale = smooth, scale
        self.absent = self.of(np.zeros(len(totals), np.int64), self.below) if size else np.zeros(len(totals), np.int64)

    def of(self, n: np.ndarray, below: np.ndarray) -> np.ndarray:
        """1 + floor(scale * (n + smooth) / below), exact for any count."""
        if int(n.max(initial=0)) + self.smooth > np.iinfo(np.int64).max // self.scale:
            return np.array([1 + self.scale * (int(x) + self.smooth) // int(y) for x, y in zip(n, np.broadcast_to(below, n.shape))], np.int64)
        return 1 + self.scale * (n + self.smooth) // below


def compare_sources(terms: DataFrame, known: list[Shares], top: int, cells: int = PAIR_CELLS) -> DataFrame:
    """Rows (``lang``, ``a``, ``b``, ``item``, ``value``): per pair of places of sources the sum of absolute
    differences over the terms of a task, and, with ``b`` null, the best ``top`` terms of each source in a task."""
    # Where the pairs of a lang exceed one array, each block of its sources adds up its own share of the pairs.
    blocks = F.lit(1)
    for name, shares in enumerate(known):
        if shares.sources ** 2 > cells:
            blocks = F.when(F.col("lang") == name, -(-shares.sources ** 2 // cells)).otherwise(blocks)
    rows = terms.withColumn("blocks", blocks).select("lang", "term", "found", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        best: dict[tuple[int, int], list[tuple[int, str]]] = defaultdict(list)
        for batch in batches:
            dealt: dict[tuple[int, int, int], list] = defaultdict(list)
            for lang, term, found, blocks, block in zip(*(batch.column(k).to_pylist() for k in range(5))):
                size = -(-known[lang].sources // blocks)
                dealt[lang, block * size, min((block + 1) * size, known[lang].sources)].append((term, found))
            for (lang, low, high), terms in dealt.items():
                shares = known[lang]
                step = max(1, cells // shares.sources)
                mine = sums.setdefault((lang, low, high), np.zeros((high - low, shares.sources), np.int64))
                for k in range(0, len(terms), step):
                    part = terms[k:k + step]
                    row = np.repeat(np.arange(len(part)), [len(x[1]) for x in part])
                    at = np.array([y["g"] for x in part for y in x[1]]) - shares.first
                    n = np.array([y["n"] for x in part for y in x[1]])
                    p = shares.of(n, shares.below[at])
                    table = np.tile(shares.absent, (len(part), 1))
                    table[row, at] = p
                    for a in range(low, high):
                        mine[a - low] += np.abs(table - table[:, a:a + 1]).sum(0)
                    if low:
                        continue
                    whole = np.zeros(len(part), np.int64)
                    np.add.at(whole, row, n)
                    above = p - shares.of(whole, shares.whole)[row]
                    for a in np.unique(at[above > 0]):
                        chosen = np.flatnonzero((at == a) & (above > 0))
                        listed = best[lang, int(a)] + [(-int(above[x]), part[row[x]][0]) for x in chosen]
                        best[lang, int(a)] = sorted(listed, key=lambda x: (x[0], x[1].encode()))[:top]
        for (lang, low, high), mine in sums.items():
            for a in range(low, high):
                b = np.arange(len(mine[0]))
                yield _rows(lang, a, pa.array(b), [None] * len(b), mine[a - low])
        for (lang, a), terms in best.items():
            yield _rows(lang, a, pa.nulls(len(terms), pa.int64()), [t for _, t in terms], [-v for v, _ in terms])

    def _rows(lang, a, b, items, values):
        size = len(items)
        return pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.int32()), pa.array([a] * size, pa.int64()), b, pa.array(items, pa.string()), pa.array(values, pa.int64())],
                                          names=["lang", "a", "b", "item", "value"])

    return rows.mapInArrow(run, "lang int, a long, b long, item string, value long")


def divergence(docs: DataFrame, min_docs: int = 30, smooth: int = 5, scale: int = 10**9, top: int = 50,
               lang: str = "lang", source: str = "source", text: str = "text", cells: int = PAIR_CELLS) -> DataFrame:
    """How the sources of each lang differ in their words: (``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``).

    Each lang keeps the terms of at least ``min_docs`` of its documents. With c occurrences of a kept term in a group,
    N of all V kept terms, its smoothed share is p = 1 + floor(scale * (c + smooth) / (N + smooth * V)). Part ``pair``:
    for each other source of the lang the sum of the absolute differences of all shares, 0 without kept terms. Part
    ``term``: the ``top`` terms of a source by how far their share lies above the lang's. Ranks run from 1 by falling
    value, ties in UTF-8 order of the item.

    Null lang, source or text counts as ''. Repeated rows are documents of their own. Sources without terms are
    compared like others; a lang of one source has no pairs; an empty table gives an empty result. A text without
    white space is one chunk, of any length. Other columns are ignored.

    The list of sources goes to every task. The result holds its square per lang, so a list that a result can be
    written for is small.
    """
    docs = only(docs, [lang, source, text])
    spark = docs.sparkSession
    groups = source_list(docs, lang, source)
    terms = term_table(docs, groups, min_docs, lang, source, text)
    sizes = {r["lang"]: r["count"] for r in terms.groupBy("lang").count().collect()}
    said = terms.select(F.explode("found").alias("f")).groupBy("f.g").agg(F.sum("f.n").alias("n")).collect()
    total = {r["g"]: r["n"] for r in said}
    known = []
    for k, name in enumerate(sorted({x for x, _ in groups})):
        own = [g for g, x in enumerate(groups) if x[0] == name]
        known.append(Shares(own[0], [total.get(g, 0) for g in own], sizes.get(k, 0), smooth, scale))
    langs = {name: k for k, name in enumerate(sorted({x for x, _ in groups}))}

    found = store(compare_sources(terms, known, top, cells), "compared")
    sources = spark.createDataFrame([(langs[x], x, s, g - known[langs[x]].first) for g, (x, s) in enumerate(groups)], "number int, lang string, source string, a long")
    found = found.withColumnRenamed("lang", "number")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    words = found.filter("b is null").join(sources, ["number", "a"]).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    sums = found.filter("b is not null").groupBy("number", "a", "b").agg(F.sum("value").alias("value"))
    other = sources.select("number", F.col("source").alias("item"), F.col("a").alias("b"))
    every = sources.join(other, "number").filter("a <> b")  # the rows of the result
    pairs = every.join(sums, ["number", "a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0)).cast("long"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(names).unionByName(words.withColumn("part", F.lit("term")).select(names))


SQL = r"""
with texts as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (select row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from texts),
kept as (select lang, term, count(*) as lang_n from words group by all having count(distinct row) >= 30),
lang_size as (select lang, count(*) as v, sum(lang_n) as all_n from kept group by lang),
groups as (select distinct lang, source from texts),
found as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
total as (select lang, source, sum(n) as total from found group by all),
share as (select g.lang, g.source, k.term, coalesce(f.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(f.n, 0) + 5)) // (coalesce(t.total, 0)::hugeint + 5 * z.v) as p,
    1 + (1000000000::hugeint * (k.lang_n + 5)) // (z.all_n::hugeint + 5 * z.v) as q
  from groups g join kept k using (lang) join lang_size z using (lang) left join found f on f.lang = g.lang and f.source = g.source and f.term = k.term
  left join total t on t.lang = g.lang and t.source = g.source),
far as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from share a join share b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
listed as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(far.value, 0) as value from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join far on far.lang = a.lang and far.source = a.source and far.item = b.source
  union all select lang, source, 'term', term, p - q from share where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from listed)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= 50
"""
