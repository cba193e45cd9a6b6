"""Byte-pair encoding of whole texts, equal to the tokenizers library, and long unsplit text by tree concatenation.

Texts are cut where a run of white space begins: no pre-token and no merge reaches over such a place. The
pieces between are encoded once per worker and looked up afterwards. A long pre-token (text without any
split) is encoded by halves: its leaves are encoded apart, and at each join a growing window of tokens from
both sides is encoded again, until the tokens on either edge of the window agree with their neighbours. Two
neighbours agree if their bytes, encoded together, give just these two tokens; a sequence all of whose
neighbours agree is the encoding of its bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwick.llm.common import arrow_map, only, store, worker_cache

# The characters that the pre-tokenizers' patterns take as white space (Unicode White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The two known patterns, as they read for plain text: ASCII and the letters of Latin-1.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN_PATTERNS = {
    "bytes": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+",
    "words": rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+",
}
PLAIN = re.compile(rf"[\x00-\x7f{LETTERS}]*")
LEAF = 2048
# Chunks that a worker keeps for good, those it keeps until there are too many, and pre-tokens: some 150 MB.
MEMO = 500_000
LATER = 150_000
WORD_MEMO = 200_000


def read_tokenizer(path: str) -> str:
    """The tokenizer's file as text, to be sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte: printable Latin-1 bytes stand for themselves, the others for
    the characters from 256 on."""
    shown = {b: chr(b) for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    hidden = [b for b in range(256) if b not in shown]
    return shown | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Encodes pieces of text as the library does; made from the tokenizer's file in the tasks."""

    def __init__(self, spec: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.leaf = self.tokenizer.model, leaf
        made = json.loads(spec)
        self.added = [a["content"] for a in made["added_tokens"]]
        kind = made["pre_tokenizer"]
        kind = kind["type"] if kind["type"] == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"] else json.dumps(kind)
        self.lower = bool(made["normalizer"])
        known = "bytes" if kind == "ByteLevel" and not self.lower else "words" if r"[\\p{L}]+|[\\p{N}]|" in kind and self.lower else None
        self.plain = re.compile(PLAIN_PATTERNS[known], re.ASCII) if known else None
        self.chars = byte_alphabet()
        self.table = str.maketrans({chr(i): "".join(self.chars[b] for b in chr(i).encode()) for i in range(256)})
        self.words: dict[str, bytes] = {}
        self.chunks = _Chunks(self.encode)

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; added tokens are their own text."""
        back = {c: b for b, c in self.chars.items()}
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        return [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in names]

    def merge(self, word: str) -> bytes:
        """Ids of one pre-token, written in the byte alphabet, as little-endian 32-bit integers."""
        if len(word) > self.leaf:
            return packed(self.tree(word))
        got = self.words.get(word)
        if got is None:
            got = packed(self.direct(word))
            if len(self.words) < WORD_MEMO:
                self.words[word] = got
        return got

    def direct(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word)]

    def tree(self, word: str) -> list[int]:
        """Encode the two halves, then settle their join."""
        if len(word) <= self.leaf:
            return self.direct(word)
        half = len(word) // 2
        # A mark at the end of words belongs to the last leaf alone; such models are encoded as a whole.
        if self.model.end_of_word_suffix or self.model.continuing_subword_prefix:
            return self.direct(word)
        return self.join(self.tree(word[:half]), self.tree(word[half:]))

    def _agree(self, left: int, right: int) -> bool:
        return self.direct(self.spell([left, right])) == [left, right]

    def spell(self, ids: list[int]) -> str:
        return "".join(self.chars[b] for i in ids for b in self.token_bytes[i])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of two neighbouring parts as one: the window around the join grows until both edges agree."""
        width = 4
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.direct(self.spell(left[a:] + right[:b]))
            if (a == 0 or self._agree(left[a - 1], window[0])) and (
                    b == len(right) or self._agree(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def pieces(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk without added tokens, in the byte alphabet."""
        if self.plain is not None and PLAIN.fullmatch(chunk):
            return [p.translate(self.table) for p in self.plain.findall(chunk.lower() if self.lower else chunk)]
        norm = self.tokenizer.normalizer
        text = norm.normalize_str(chunk) if norm else chunk
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def segments(self, chunk: str) -> list[str | int]:
        """Pre-tokens of a chunk, and the ids of added tokens in it."""
        if not any(a in chunk for a in self.added):
            return self.pieces(chunk)
        out = []
        for k, part in enumerate(re.split("(" + "|".join(map(re.escape, self.added)) + ")", chunk)):
            out += [self.tokenizer.token_to_id(part)] if k % 2 else self.pieces(part) if part else []
        return out

    def encode(self, chunk: str) -> bytes:
        """Ids of text that begins at a cut and ends at one."""
        return b"".join(packed([p]) if isinstance(p, int) else self.merge(p) for p in self.segments(chunk))

    def ids_of(self, chunks: list) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk (text, or its UTF-8 bytes)."""
        return list(map(self.chunks.__getitem__, chunks))


class _Chunks(dict):
    """Encoded chunks. The first ones stay: the frequent ones are among them. When these are ``MEMO``, later ones
    are kept apart, and that part is emptied when it is full."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.later = encode, {}

    def __missing__(self, chunk):
        ids = self.later.get(chunk)
        if ids is None:
            ids = self.encode(chunk if isinstance(chunk, str) else chunk.decode())
            if len(self) < MEMO:
                self[chunk] = ids
            else:
                if len(self.later) >= LATER:
                    self.later.clear()
                self.later[chunk] = ids
        return ids


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


CUT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


SLICE = 512


def encoder(spec: str, leaf: int = LEAF) -> Encoder:
    return worker_cache(f"bpe {hash(spec)} {leaf}", lambda: Encoder(spec, leaf))


def slices(batch: pa.RecordBatch, rows: int = SLICE):
    """A batch in parts, so that what is made of it stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF,
                 spread: int = 1 << 16) -> DataFrame:
    """Per row of ``docs``: the id and ``ids``, the token ids as little-endian 32-bit integers.

    Equal to the library's encoding of the whole text without added start and end tokens; truncation and
    padding of the file are not used. Null and empty texts give no ids. Texts with ``spread`` or more
    characters without white space are encoded by many tasks: their leaves are dealt out, and the joins are
    settled level by level. Rows are independent: repeated rows and null ids are kept as they are.
    """
    def whole(batch, enc):
        for part in slices(batch):
            ids = [b"".join(enc.ids_of(CUT.findall(t))) for t in part.column(1).to_pylist()]
            yield {"_id": part.column(0), "ids": pa.array(ids, pa.binary())}

    short, long = _encoded(docs, path, id_col, text_col, leaf, spread, "ids binary", whole)
    return (short if long is None else short.unionByName(long)).withColumnRenamed("_id", id_col)


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, leaf: int, spread: int, schema: str, fn):
    """``fn(batch, encoder)`` over the ids and texts of most rows; and ids of the texts with long unsplit runs,
    or None if there are none."""
    spec = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))
    docs = only(docs, [id_col, text_col]).select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    kind = docs.schema["_id"].dataType.simpleString()
    unsplit = (F.length("_text") >= spread) & F.col("_text").rlike(f"[^{WHITE}]{{{spread}}}")
    short = arrow_map(docs.filter(~unsplit), f"_id {kind}, {schema}", lambda batch: fn(batch, encoder(spec.value, leaf)))
    long = docs.filter(unsplit)
    return short, None if long.isEmpty() else _long_texts(long, spec, kind, leaf)


def _long_texts(long: DataFrame, spec, kind: str, leaf: int) -> DataFrame:
    """The same for texts with long pre-tokens. A row of ``parts`` holds ids that are settled, or one leaf."""
    long = store(long.withColumn("_row", F.monotonically_increasing_id()), "long")

    def cut(batch):
        enc = encoder(spec.value, leaf)
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts, settled = [], b""
            for chunk in CUT.findall(text):
                for piece in enc.segments(chunk):
                    if isinstance(piece, str) and len(piece) > leaf and not enc.model.end_of_word_suffix:
                        parts += [(settled, None, 0), *[(b"", piece[k:k + leaf], k // leaf) for k in range(0, len(piece), leaf)]]
                        settled = b""
                    else:
                        settled += enc.merge(piece) if isinstance(piece, str) else packed([piece])
            parts.append((settled, None, 0))
            number = np.cumsum([node == 0 for _, _, node in parts])
            yield {"row": pa.array([row] * len(parts), pa.int64()), "part": pa.array(number, pa.int32()),
                   "node": pa.array([p[2] for p in parts], pa.int32()), "word": pa.array([p[1] for p in parts], pa.string()),
                   "ids": pa.array([p[0] for p in parts], pa.binary())}

    def leaves(batch):
        enc = encoder(spec.value, leaf)
        ids = [i if w is None else packed(enc.direct(w))
               for w, i in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
        yield {**{n: batch.column(k) for k, n in enumerate(("row", "part", "node"))}, "ids": pa.array(ids, pa.binary())}

    def joined(batch):
        enc = encoder(spec.value, leaf)
        ids = []
        for pair in batch.column(3).to_pylist():
            both = [np.frombuffer(p["ids"], "<u4").tolist() for p in pair]
            ids.append(packed(enc.join(*both)) if len(both) == 2 else pair[0]["ids"])
        yield {**{n: batch.column(k) for k, n in enumerate(("row", "part", "node"))}, "ids": pa.array(ids, pa.binary())}

    schema = "row long, part int, node int, ids binary"
    parts = arrow_map(long.select("_row", "_text"), "row long, part int, node int, word string, ids binary", cut)
    parts = store(arrow_map(parts.repartition("row", "part", "node"), schema, leaves), "leaves")
    top = parts.agg(F.max("node")).first()[0]
    while top:
        top //= 2
        pairs = parts.groupBy("row", "part", F.expr("node div 2").cast("int").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("node").alias("at"), "ids"))).alias("pair"))
        parts = store(arrow_map(pairs, schema, joined), "joined")

    def gather(batch):
        ids = [b"".join(p["ids"] for p in parts) for parts in batch.column(1).to_pylist()]
        yield {"row": batch.column(0), "ids": pa.array(ids, pa.binary())}

    rows = parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    rows = arrow_map(rows, "row long, ids binary", gather)
    return long.select(F.col("_row").alias("row"), "_id").join(rows, "row").select("_id", "ids")


class Decoder:
    """Bytes of all ids in one array, with the place and the size of each."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.flat, self.starts = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(self.sizes) - self.sizes

    def text(self, ids: bytes) -> str:
        got = np.frombuffer(ids, "<u4")
        size = self.sizes[got]
        ends = np.cumsum(size)
        where = np.repeat(self.starts[got] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[where].tobytes().decode("utf-8", "replace")


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of the ids, special tokens included: the bytes of all ids, read as UTF-8, with U+FFFD for
    what is not UTF-8. Null ids give null; an id outside the vocabulary raises an error."""
    decoder = encoded.sparkSession.sparkContext.broadcast(Decoder(Encoder(read_tokenizer(path)).token_bytes))

    def run(batch):
        for part in slices(batch):
            out = [None if x is None else decoder.value.text(x) for x in part.column(names.index(ids)).to_pylist()]
            yield {**{n: part.column(k) for k, n in enumerate(names)}, text: pa.array(out, pa.string())}

    names = encoded.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return arrow_map(encoded, f"{schema}, `{text}` string", run)


def decimal_text(ids: bytes) -> bytes:
    """The ids in decimal, joined by commas."""
    got = np.frombuffer(ids, "<u4")
    table = worker_cache("decimals", lambda: np.char.mod("%d,", np.arange(1 << 16)).astype("S"))
    if not len(got) or got.max() >= len(table):
        return ",".join(map(str, got.tolist())).encode()
    cells = table[got].view(np.uint8)
    return cells[cells != 0].tobytes()[:-1]


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                       leaf: int = LEAF, spread: int = 1 << 16) -> DataFrame:
    """``encode_texts`` and ``decode_ids`` in one pass: per row the number of ids, the SHA-256 of the ids in
    decimal with commas, and that of the text decoded from the ids, in lowercase hex."""
    decoder = docs.sparkSession.sparkContext.broadcast(Decoder(Encoder(read_tokenizer(path)).token_bytes))
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    def digests(first, ids):
        sha = [(hashlib.sha256(decimal_text(x)).hexdigest(), hashlib.sha256(decoder.value.text(x).encode()).hexdigest()) for x in ids]
        return {"_id": first, "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([a for a, _ in sha], pa.string()), "decoded_sha256": pa.array([b for _, b in sha], pa.string())}

    def whole(batch, enc):
        for part in slices(batch):
            yield digests(part.column(0), [b"".join(enc.ids_of(CUT.findall(t))) for t in part.column(1).to_pylist()])

    def stored(batch):
        yield digests(batch.column(0), batch.column(1).to_pylist())

    short, long = _encoded(docs, path, id_col, text_col, leaf, spread, schema, whole)
    if long is not None:
        short = short.unionByName(arrow_map(long, f"_id {short.schema['_id'].dataType.simpleString()}, {schema}", stored))
    return short.withColumnRenamed("_id", id_col)
