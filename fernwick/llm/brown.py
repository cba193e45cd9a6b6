"""Brown class-based language model: exchange clustering assigns words to classes; class-transition and
word-emission probabilities score texts.

P(w | v) = P(class(w) | class(v)) P(w | class(w)), both smoothed by adding a constant. Units of the clustering
are the most frequent words, one by one, and all other words together with those of like ending (their shape),
so every word of any text has a class without being looked up. Units move between classes while this raises
the likelihood of the class bigrams; counts cover all training tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwick.llm.bpe import slices
from fernwick.llm.common import arrow_map, hash_fraction, only, split_words, store, summed_arrays, text_bytes

FLUSH = 400_000


@dataclass
class Setup:
    """Sizes of the model; none depends on the corpus."""

    classes: int = 64
    clustered: int = 16_383
    shapes: int = 1_024
    looked_up: int = 200_000
    sweeps: int = 8
    alpha: float = 0.1
    delta: float = 0.1

    @property
    def end(self) -> int:
        """Unit of the end of a text, which also stands before its first word."""
        return self.clustered + self.shapes

    @property
    def units(self) -> int:
        return self.clustered + self.shapes + 1


class Lexicon(dict):
    """Word to its number: the looked-up words have their rank, by count; other words have
    ``-1 - shape``. Shapes are the hashed last three bytes."""

    def __init__(self, words: list[bytes], shapes: int, limit: int = 200_000):
        super().__init__(zip(words, range(len(words))))
        self.shapes, self.limit, self.more = shapes, limit, {}

    def __missing__(self, word: bytes) -> int:
        got = self.more.get(word[-3:])
        if got is None:
            if len(self.more) >= self.limit:
                self.more.clear()
            got = self.more[word[-3:]] = -1 - xxhash.xxh3_64_intdigest(word[-3:]) % self.shapes
        return got

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _units(numbers: np.ndarray, lexicon: Lexicon, setup: Setup, shape_of: np.ndarray) -> np.ndarray:
    """Units of words: ranks below ``clustered`` are units of their own, other words are their shapes."""
    shape = np.where(numbers < 0, -1 - numbers, shape_of[np.maximum(numbers, 0)])
    return np.where((numbers >= 0) & (numbers < setup.clustered), numbers, setup.clustered + shape)


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(``word`` in bytes, ``n``) over all words of all texts, counted in the tasks before the shuffle."""
    def run(batches):
        counts: dict[bytes, int] = {}

        def flush():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()

        get = counts.get
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for w in split_words(text):
                    counts[w] = get(w, 0) + 1
                if len(counts) > FLUSH:
                    yield from flush()
        yield from flush()

    parts = docs.select(text_bytes(docs, text_col).alias("text")).mapInArrow(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` words, the most frequent ones, ties by word. Words that tie at the bound are left out
    together, so that no task has to sort all words: at most ``most`` rows are collected."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(most + 1).collect()
    total, least = 0, 0
    for r in by_count:
        total += r["words"]
        if total > most:
            break
        least = r["n"]
    if not least:
        return []
    rows = counts.filter(F.col("n") >= least).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


def _unit_rows(docs: DataFrame, text_col: str, lexicon, setup: Setup) -> DataFrame:
    """The training texts as units: binaries of some ten thousand 16- or 32-bit numbers, the end unit after each text."""
    width = "<u2" if setup.units <= 1 << 16 else "<u4"

    def run(batches):
        lex, shape_of = lexicon.value
        for batch in batches:
            for part in slices(batch):
                out = []
                for text in part.column(0).to_pylist():
                    units = _units(lex.numbers(split_words(text)), lex, setup, shape_of)
                    out.append(np.append(units, setup.end).astype(width).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], names=["units"])

    return store(docs.select(text_bytes(docs, text_col).alias("text")).mapInArrow(run, "units binary"), "units")


def _contexts(rows: DataFrame, classes: np.ndarray, setup: Setup) -> tuple[np.ndarray, np.ndarray]:
    """(unit, class) counts: of the classes that follow each unit, and of those that come before it."""
    sent = rows.sparkSession.sparkContext.broadcast(classes)
    u, c = setup.units, setup.classes
    width = "<u2" if setup.units <= 1 << 16 else "<u4"

    def count(batches):
        of = sent.value
        sums = np.zeros(2 * u * c, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                now = np.frombuffer(data, width).astype(np.int64)
                before = np.concatenate([[setup.end], now[:-1]])
                sums[:u * c] += np.bincount(before * c + of[now], minlength=u * c)
                sums[u * c:] += np.bincount(now * c + of[before], minlength=u * c)
        return sums

    after, ahead = summed_arrays(rows, count, 2 * u * c).reshape(2, u, c)
    sent.destroy()
    return after, ahead


def _phi(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, without the part that does not depend on the classes."""
    return float(_phi(pairs).sum() - _phi(pairs.sum(0)).sum() - _phi(pairs.sum(1)).sum())


def best_moves(spark, after: np.ndarray, ahead: np.ndarray, classes: np.ndarray, setup: Setup, chosen: np.ndarray):
    """For each chosen unit the class with the largest gain in likelihood, and that gain, if all others stay.

    Units are dealt to tasks; each compares all classes at once. The pair matrix and the units' context rows
    have fixed sizes.
    """
    pairs = np.zeros((setup.classes, setup.classes))
    np.add.at(pairs, classes, after)
    sent = spark.sparkContext.broadcast((pairs, classes, after, ahead))
    blocks = np.array_split(chosen, max(1, len(chosen) // 256))
    src = spark.createDataFrame([(b.astype("<i8").tobytes(),) for b in blocks], "units binary").repartition(
        max(2, spark.sparkContext.defaultParallelism))

    def run(batch):
        n, of, out, into = sent.value
        row, col, size = n.sum(1), n.sum(0), len(n)
        for data in batch.column(0).to_pylist():
            units = np.frombuffer(data, "<i8")
            target, gain = [], []
            for w in units:
                a, f, b = of[w], out[w].astype(float), into[w].astype(float)
                if not f.any():
                    target.append(int(a)), gain.append(0.0)
                    continue
                m = n.copy()
                m[a] -= f
                m[:, a] -= b
                m = np.maximum(m, 0)  # pairs of the unit with itself count as pairs with its present class
                r, s = row.copy(), col.copy()
                r[a] -= f.sum()
                s[a] -= b.sum()
                g = (_phi(m + f[None]) - _phi(m)).sum(1) + (_phi(m + b[:, None]) - _phi(m)).sum(0)
                g -= _phi(r + f.sum()) - _phi(r) + _phi(s + b.sum()) - _phi(s)
                best = int(np.argmax(g))
                target.append(best), gain.append(float(g[best] - g[a]))
            yield {"unit": pa.array(units, pa.int64()), "target": pa.array(target, pa.int64()), "gain": pa.array(gain, pa.float64())}

    got = arrow_map(src, "unit long, target long, gain double", run).collect()
    sent.destroy()
    return pairs, {r["unit"]: r["target"] for r in got if r["gain"] > 1e-9 and r["target"] != classes[r["unit"]]}


def exchange_classes(rows: DataFrame, setup: Setup) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units and the class pair counts.

    Starts with units dealt to classes by frequency rank. In each sweep a third of the units, chosen by number,
    moves to the classes with the largest gain, all at once; the classes with the best likelihood seen are
    kept. Class 0 belongs to the end of texts alone.
    """
    spark = rows.sparkSession
    classes = 1 + np.arange(setup.units) % (setup.classes - 1)
    classes[setup.end] = 0
    best = (-np.inf, classes, np.zeros((setup.classes, setup.classes)))
    movable = np.arange(setup.units - 1)
    for sweep in range(setup.sweeps + 1):
        after, ahead = _contexts(rows, classes, setup)
        chosen = movable[movable % 3 == sweep % 3]
        pairs, moves = best_moves(spark, after, ahead, classes, setup, chosen)
        worth = likelihood(pairs)
        if worth > best[0]:
            best = (worth, classes, pairs)
        moves = {u: c for u, c in moves.items() if c}
        if not moves:
            break
        classes = classes.copy()
        classes[list(moves)] = list(moves.values())
    return best[1], best[2]


def score_texts(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                setup: Setup | None = None) -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigram) and
    ``score``: log10 probabilities of the text under the model learnt from ``train``.

    Tokens are words (runs other than ASCII white space, A-Z lower-cased) and one end. Null, empty and blank
    texts consist of the end alone. A word that training has not seen shares the probability that its class
    keeps for one unseen word. Repeated rows and null ids are scored like others. Without training rows all
    counts are 0, and the smoothing constants alone give the scores.
    """
    setup = setup or Setup()
    docs, train = only(docs, [id_col, text_col]), only(train, [id_col, text_col])
    spark = docs.sparkSession
    counts = store(word_counts(train, text_col), "words")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("words")).first()
    texts = train.count()
    n_all, n_distinct = totals["tokens"] + texts, totals["words"] + (texts > 0)

    known = frequent_words(counts, setup.looked_up)
    words = [w for w, _ in known]
    shape_of = np.array([xxhash.xxh3_64_intdigest(w[-3:]) % setup.shapes for w in words] or [0])
    lexicon = spark.sparkContext.broadcast((Lexicon(words, setup.shapes), shape_of))
    rows = _unit_rows(train, text_col, lexicon, setup)
    classes, pairs = exchange_classes(rows, setup)
    sent = spark.sparkContext.broadcast((classes, np.array([n for _, n in known] or [0])))

    def sizes(batches):
        """Tokens and distinct words of each class."""
        lex, shapes = lexicon.value
        of = sent.value[0]
        out = np.zeros((2, setup.classes), np.int64)
        for batch in batches:
            units = _units(lex.numbers(batch.column(0).to_pylist()), lex, setup, shapes)
            np.add.at(out[0], of[units], batch.column(1).to_numpy())
            np.add.at(out[1], of[units], 1)
        return out.reshape(-1)

    mass, distinct = summed_arrays(counts, sizes, 2 * setup.classes).reshape(2, -1)
    mass[0], distinct[0] = texts, 1
    room = mass + setup.delta * (distinct + 1)
    step = np.log10(pairs + setup.alpha) - np.log10(pairs.sum(1, keepdims=True) + setup.alpha * setup.classes)
    base_room = n_all + 0.1 * (n_distinct + 1)
    end_score, end_base = np.log10((texts + setup.delta) / room[0]), np.log10((texts + 0.1) / base_room)

    def scored(batches):
        lex, shapes = lexicon.value
        of, n = sent.value
        emit = np.log10(n + setup.delta) - np.log10(room[of[_units(np.arange(len(n)), lex, setup, shapes)]])
        base = np.log10((n + 0.1) / base_room)
        for batch in batches:
            for part in slices(batch):
                cols = [[] for _ in range(5)]
                for text in part.column(2).to_pylist():
                    found = split_words(text)
                    number = lex.numbers(found)
                    path = np.concatenate([[0], of[_units(number, lex, setup, shapes)], [0]])
                    hit = number >= 0
                    rare: dict[bytes, int] = {}
                    for k in np.flatnonzero(~hit):
                        rare[found[k]] = rare.get(found[k], 0) + 1
                    at = number[hit]
                    cols[0].append(len(found) + 1)
                    cols[1].append(int(hit.sum()) + (texts > 0))
                    cols[2].append(float(base[at].sum() + end_base))
                    cols[3].append(float(step[path[:-1], path[1:]].sum() + emit[at].sum() + end_score))
                    cols[4].append([{"word": w, "cls": int(of[setup.clustered - 1 - lex[w]]), "m": m} for w, m in rare.items()])
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                         pa.list_(pa.struct([("word", pa.binary()), ("cls", pa.int32()), ("m", pa.int64())])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                    names=["_row", "_id", "n_tokens", "n_known", "base_score", "score", "rare"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), text_bytes(docs, text_col).alias("text"))
    # Stored, so that row numbers stay the same when rows and their rare words are read apart.
    part = store(src.mapInArrow(scored, f"_row long, _id {kind}, n_tokens long, n_known long, base_score double, "
                                        "score double, rare array<struct<word:binary,cls:int,m:long>>"), "scored")
    rare = part.select("_row", F.explode("rare").alias("r")).select("_row", "r.*")
    found = rare.join(counts.filter(F.col("n") > 0), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rooms = F.element_at(F.array(*[F.lit(float(x)) for x in room]), F.col("cls") + 1)
    more = found.groupBy("_row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("_known"),
        F.sum(F.col("m") * F.log10((F.col("n") + 0.1) / F.lit(float(base_room)))).alias("_base"),
        F.sum(F.col("m") * F.log10((F.col("n") + setup.delta) / rooms)).alias("_score"))
    out = part.drop("rare").join(more, "_row", "left")
    return out.select(
        F.col("_id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"))
