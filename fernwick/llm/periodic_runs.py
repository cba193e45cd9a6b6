"""Periodic runs of words, found by the branching-tandem test on an enhanced suffix array.

Each text's words become numbers; many texts share one array in which a suffix ends with its text. Suffixes are
sorted by doubling, neighbours' common prefixes (LCP) come from the ranks of the doubling steps, and every LCP
boundary splits the widest interval around it in two sides: no tree nodes are made. For the suffixes i of the
smaller side, ISA[i + depth] or ISA[i - depth] in the other side means a square of period depth that ends where
its period breaks. Squares are rotated to the left as far as the period holds, which gives the run; squares of a
multiple of the period have the same ends and merge into it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwick.llm.common import only

# Words that share one suffix array: texts are taken together up to it, a longer text stands alone.
GROUP_WORDS = 300_000
# Suffixes that are tested in one step.
STEP = 2_000_000


def suffix_levels(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of ``symbols``, in which no symbol that ends a text occurs twice, and for each length 1, 2, 4, ...
    the rank of every position by its next symbols, as long as some are equal."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    first = np.append(True, symbols[order[1:]] != symbols[order[:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, size = [], 1
    while not first.all():
        levels.append((size, rank.copy()))
        # Only members of groups are sorted again; a group's rank is the place of its first member.
        single = first & np.append(first[1:], True)
        at = np.flatnonzero(~single)
        member = order[at]
        key = (rank[member].astype(np.int64) << 32) | rank[member + size]
        again = np.argsort(key, kind="stable")
        key, member = key[again], member[again]
        order[at] = member
        split = np.append(True, key[1:] != key[:-1])
        first[at] |= split
        rank[member] = np.maximum.accumulate(np.where(split, at, 0))
        size *= 2
    return order, levels


def neighbours(order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """LCP[k]: symbols that the suffixes at k - 1 and k have in common; 0 at 0."""
    lcp = np.zeros(len(order), np.int32)
    a, b = order[:-1].copy(), order[1:].copy()
    for size, rank in reversed(levels):
        same = np.flatnonzero(rank[a] == rank[b])
        a[same] += size
        b[same] += size
        lcp[same + 1] += size
    return lcp


def smaller_before(values: np.ndarray, strict: bool) -> np.ndarray:
    """For each place the last one before it with a smaller value (or an equal one, unless ``strict``); -1 for none.
    Candidates jump over stretches whose least value is known, doubling and then halving their length."""
    n = len(values)
    least = [values]
    while (1 << len(least)) <= n:
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][half:], least[-1][:-half]))  # least[j][k]: of k .. k + 2^j - 1
    at = np.arange(n)  # all of at .. k - 1 do not count
    left = np.arange(n)
    j = 0
    goes = np.ones(n, bool)
    while left.size and j < len(least):
        size = 1 << j
        fits = at[left] >= size
        low = least[j][np.maximum(at[left] - size, 0)]
        goes = fits & ((low >= values[left]) if strict else (low > values[left]))
        at[left[goes]] -= size
        left, j = left[goes], j + 1
    for j in reversed(range(len(least))):
        size = 1 << j
        low = least[j][np.clip(at - size, 0, n - size)]
        goes = (at >= size) & ((low >= values) if strict else (low > values))
        at -= np.where(goes, size, 0)
    return at - 1


def runs_of(symbols: np.ndarray, least_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """All runs (start, end, smallest period) of at least ``least_length`` symbols and ``exponent`` periods."""
    order, levels = suffix_levels(symbols)
    if not levels:
        return []
    lcp = neighbours(order, levels)
    isa = np.empty(len(order), np.int32)
    isa[order] = np.arange(len(order), dtype=np.int32)
    # Suffixes that share no symbol with their neighbours stand between the intervals, which are looked at one by one.
    inner = np.flatnonzero(lcp)
    low = smaller_before(np.append(0, lcp), True)[1:][inner] - 1
    high = len(lcp) - smaller_before(np.append(0, lcp[::-1]), False)[1:][::-1][inner]
    high = np.minimum(high, len(lcp))
    low = np.maximum(low, 0)
    left = inner - low <= high - inner  # the smaller side of boundary k: low .. k - 1, or k .. high - 1
    begin, size = np.where(left, low, inner), np.where(left, inner - low, high - inner)
    other, end = np.where(left, inner, low), np.where(left, high, inner)
    squares: list[np.ndarray] = []
    total = np.cumsum(size)
    k = 0
    while k < len(inner):
        top = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + STEP)))
        part = slice(k, top)
        which = np.repeat(np.arange(k, top), size[part])
        place = np.arange(len(which)) - np.repeat(np.cumsum(size[part]) - size[part], size[part]) + begin[which]
        i, depth = order[place].astype(np.int64), lcp[inner[which]].astype(np.int64)
        for start, other_end in ((i, i + depth), (i - depth, i - depth)):
            ok = (other_end >= 0) & (other_end < len(isa))
            there = isa[np.where(ok, other_end, 0)]
            ok &= (there >= other[which]) & (there < end[which])
            squares.append(np.stack([start[ok] + 2 * depth[ok], depth[ok]]))
        k = top
    found = np.unique(np.concatenate(squares, 1), axis=1)
    return _rotated(symbols, found[0], found[1], least_length, exponent)


def _rotated(symbols: np.ndarray, end: np.ndarray, period: np.ndarray, least_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """Squares (end, period) whose period breaks at their end, rotated to the left to runs; of those with equal ends the
    smallest period stays. A square is left alone as soon as a look ahead shows that it cannot grow long enough."""
    need = np.maximum(least_length, exponent * period)
    begin = end - need  # a long enough run holds its period from here on
    ok = begin >= 0
    end, period, begin, need = end[ok], period[ok], begin[ok], need[ok]
    # Look at a few places first: most squares fall out here.
    for part in (0.0, 0.5):
        at = begin + ((need - 2 * period) * part).astype(np.int64)
        ok = symbols[at] == symbols[at + period]
        end, period, begin, need = end[ok], period[ok], begin[ok], need[ok]
    runs: list[tuple[int, int, int]] = []
    last_start, last_end = 0, -1
    for e, q in zip(end.tolist(), period.tolist()):  # by end, then period
        if e == last_end and e - 2 * q >= last_start:
            continue  # a square inside the run that ends here: of a multiple of its period
        start = e - 2 * q
        size = q
        while start > 0:  # rotate, in growing steps
            low = max(0, start - size)
            differs = np.flatnonzero(symbols[low:start] != symbols[low + q:start + q])
            if len(differs):
                start = low + int(differs[-1]) + 1
                break
            start, size = low, 2 * size
        if e - start >= max(least_length, exponent * q):
            runs.append((start, e, q))
            last_start, last_end = start, e
    return runs


def find_runs(texts: list[list[bytes]], least_length: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, smallest period) of all runs of each text, by start, then period."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    ids = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in texts]
    # A run of L words has a suffix that shares L - q words, so at least this many, with another one.
    shared = least_length - least_length // exponent
    asked = [k for k, x in enumerate(ids) if len(x) >= least_length and _repeats(x, shared)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not asked:
        return out
    # A word of another text is another symbol, and each text ends with a symbol of its own.
    symbols = np.concatenate([np.append(ids[k] + j * (len(number) + 1) + 1, j * (len(number) + 1)) for j, k in enumerate(asked)])
    offsets = np.cumsum([0] + [len(ids[k]) + 1 for k in asked])
    for s, e, q in runs_of(symbols, least_length, exponent):
        j = int(np.searchsorted(offsets, s, "right")) - 1
        out[asked[j]].append((s - int(offsets[j]), e - s, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def _repeats(ids: np.ndarray, size: int) -> bool:
    """Whether some ``size`` words stand at two places (or seem to: equal hashes suffice)."""
    if len(ids) <= size:
        return False
    hashed = np.zeros(len(ids) - size + 1, np.uint64)
    for k in range(size):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + ids[k:len(ids) - size + 1 + k].astype(np.uint64) + np.uint64(1)
    hashed.sort()
    return bool((hashed[1:] == hashed[:-1]).any())


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(inside)[:-1] == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, exponent: int = 4,
                  edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row: id, ``runs`` (array of ``start``, ``length``, ``period`` in words, by start, then period) and
    ``collapsed``: the words joined by one space, of each run only the first period.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a longest stretch of words with smallest period q, of at least
    ``least_length`` words and ``exponent`` times q. ``edit`` may change a row's words by its id first.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Ids may be null or repeat: rows are on
    their own. An empty table gives an empty result; other columns are ignored. A text is worked on whole, in one
    task, with some 100 bytes a word plus 4 bytes for each doubling of its longest repeat.
    """
    if least_length < 2 or exponent < 2:
        raise ValueError("runs have at least two words and two periods")
    docs = only(docs, [id_col, text_col])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("t"))

    def answer(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = find_runs(texts, least_length, exponent)
        flat = np.array([r for x in runs for r in x], np.int64).reshape(-1, 3)
        entries = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
        ends = pa.array(np.cumsum([0] + [len(x) for x in runs]), pa.int32())
        collapsed = pa.array([b" ".join(kept_words(w, r)) for w, r in zip(texts, runs)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(ends, entries), collapsed], names=["id", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, text in zip(batch.column(0), batch.column(1)):
                i, words = i.as_py(), text.as_py().split()
                ids.append(i)
                texts.append(edit(i, words) if edit else words)
                size += len(words)
                if size >= GROUP_WORDS:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield answer(ids, texts)

    found = rows.mapInArrow(run, "id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return found.select(F.col("id").alias(id_col), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def longest_run(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period. Null without runs."""
    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"),
                       lambda best, x: F.when(best.isNull() | (x["length"] > best["length"]), x).otherwise(best))


def runs_text(runs: Column) -> Column:
    """`start,length,period` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda x: F.concat(x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n"))), "")
