"""Order MinHash fingerprints in native expressions: signatures that are sensitive to edit distance.

A text is a sequence of words (long words in pieces), its k-mers are runs of k of them. Each k-mer gets its
occurrence number, so repeated k-mers are different elements. One hash value per element puts it into a bin and
orders the elements of a bin. The two smallest of each bin, kept in the order of the text, are hashed as a
tuple: that is the bin's part of the signature. Moved or replaced passages change tuples even where the set of
k-mers stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernwick.llm.common import only

WORDS = 3
BIN_BITS = 6
# A value and a place in the text share one 64-bit number; places fill the lower bits. Beyond 16 million words
# places repeat, which can turn the order of two elements that lie so far apart.
PLACE_BITS = 24
_PLACES = (1 << PLACE_BITS) - 1


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def _value(x: Column) -> Column:
    return x.bitwiseAND(F.lit(~_PLACES))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_PLACES))


def _runs(size: Column, first) -> Column:
    """Indices from 0 at which a stretch begins: ``first(i)`` compares i with i - 1."""
    return F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | first(i)))


def signature(df: DataFrame, text: str, name: str, k: int = WORDS) -> DataFrame:
    """Add ``name``: an array with one number per filled bin, the bin in its upper bits and the hash of the
    bin's tuple in the others; empty for texts without words, null included. Equal texts have equal signatures.

    Each step reads what the step before made more than once, so steps are not merged and nothing is computed
    once per element that belongs to the whole text.
    """
    w, s, o, e = (f"_{name}_{x}" for x in "wsoe")
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]{1,16}"), F.lit(0))
    out = df.withColumn(w, F.transform(words, lambda x: F.xxhash64(x)))
    size = F.greatest(F.size(w) - (k - 1), F.lit(1))
    kmer = F.slice(w, F.lit(1), size)
    for j in range(1, k):
        # A text of fewer than k words is one run of all its words.
        kmer = F.zip_with(kmer, F.slice(w, F.lit(j + 1), size), lambda a, b: F.xxhash64(a, F.coalesce(b, F.lit(0))))
    out = out.withColumn(s, F.sort_array(F.transform(kmer, lambda x, i: _value(x).bitwiseOR(_place(i.cast("long"))))))
    out = out.withColumn(o, _runs(F.size(s), lambda i: _value(F.get(F.col(s), i - 1)) != _value(F.get(F.col(s), i))))
    ends = F.concat(F.slice(o, F.lit(2), F.size(o)), F.array(F.size(s)))
    number = F.flatten(F.zip_with(F.col(o), ends, lambda a, b: F.sequence(F.lit(0), b - a - 1)))
    element = F.zip_with(F.col(s), number, lambda x, n: _value(F.xxhash64(_value(x), n)).bitwiseOR(_place(x)))
    out = out.withColumn(e, F.sort_array(element))

    def part(i: Column) -> Column:
        x, y = F.get(F.col(e), i), F.get(F.col(e), i + 1)
        a, b = F.shiftrightunsigned(x, PLACE_BITS), F.shiftrightunsigned(y, PLACE_BITS)
        hashed = F.when(y.isNull() | (_bin(y) != _bin(x)), F.xxhash64(a)).when(
            _place(y) < _place(x), F.xxhash64(b, a)).otherwise(F.xxhash64(a, b))
        return F.shiftleft(_bin(x), 64 - BIN_BITS).bitwiseOR(F.shiftrightunsigned(hashed, BIN_BITS))

    # Sorted values of one bin are one stretch, its smallest first.
    heads = _runs(F.size(e), lambda i: _bin(F.get(F.col(e), i - 1)) != _bin(F.get(F.col(e), i)))
    out = out.withColumn(name, F.coalesce(F.transform(heads, part), F.array().cast("array<bigint>")))
    return out.drop(w, s, o, e)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among the bins that either signature fills; 1 for two empty ones."""
    bins = F.size(F.array_union(F.transform(a, _bin), F.transform(b, _bin)))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def as_text(sig: Column) -> Column:
    """The signature in hexadecimal, 16 digits a number."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def ranged(docs: DataFrame, order: str) -> DataFrame:
    """Deal the rows to ranges (``_range``) of the whole numbers ``order``; the first rows of each range are also put
    behind the range before it, those of the first range behind the last one, marked ``_halo``.

    Bounds are percentiles; one number per range reaches the driver. Nulls are in the first range.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = F.array(*[F.lit(k / n) for k in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    bounds = sorted(set(docs.select(F.percentile_approx(order, steps, 10_000)).first()[0] or []))
    literal = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    at = F.coalesce(F.when(F.col(order).isNotNull(), F.size(F.filter(literal, lambda b: b < F.col(order)))), F.lit(0))
    placed = docs.withColumn("_range", at)
    low = placed.groupBy("_range").agg(F.min(order).alias("low"), F.max(F.col(order).isNull()).alias("null")).collect()
    heads = {r["_range"]: r for r in low}
    used = sorted(heads) or [0]
    before = {r: used[k - 1] for k, r in enumerate(used)}
    lows = F.array(*[F.lit(heads[r]["low"] if r in heads and not heads[r]["null"] else None).cast("long") for r in range(len(bounds) + 1)])
    backs = F.array(*[F.lit(before.get(r)).cast("int") for r in range(len(bounds) + 1)])
    first = F.col(order).eqNullSafe(F.get(lows, F.col("_range")))
    places = F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("h")))
    twice = F.concat(places, F.array(F.struct(F.get(backs, F.col("_range")).alias("r"), F.lit(True).alias("h"))))
    dealt = placed.withColumn("_at", F.explode(F.when(first, twice).otherwise(places)))
    return dealt.select(*docs.columns, F.col("_at.r").alias("_range"), F.col("_at.h").alias("_halo")).repartition(n, "_range")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_chars`` (code points), ``fingerprint``, and the same for the edited text, whose last quarter
    is replaced by as much of the beginning of the next document: ``edited_sha256``, ``edited_fingerprint``; and
    the likeness of the fingerprint to the edited text's (``near_edited``) and to the next document's (``near_next``).

    The next document is the next row by id, of equal ids by text; the first follows the last, and a single row
    follows itself. Null ids come first. Null texts count as empty; two texts without words have likeness 1.
    An empty table gives an empty one.
    """
    docs = only(docs, [id_col, text_col]).select(
        F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rows = signature(ranged(docs, "_id"), "_text", "_sig")
    w = Window.partitionBy("_range").orderBy("_halo", "_id", "_text")
    rows = rows.select("_id", "_text", "_sig", "_halo", F.lead("_text").over(w).alias("_next"), F.lead("_sig").over(w).alias("_next_sig"))
    rows = rows.filter(~F.col("_halo")).withColumn("n_chars", F.length("_text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), (F.col("n_chars") - quarter).cast("int")),
                      F.substring(F.coalesce("_next", F.lit("")), F.lit(1), quarter))
    rows = signature(rows.withColumn("_edited", edited), "_edited", "_edited_sig")
    return rows.select(
        F.col("_id").alias(id_col), "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        as_text(F.col("_sig")).alias("fingerprint"), as_text(F.col("_edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("_sig"), F.col("_edited_sig")).alias("near_edited"),
        likeness(F.col("_sig"), F.col("_next_sig")).alias("near_next"))
