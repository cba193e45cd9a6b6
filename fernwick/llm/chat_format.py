"""Chat formatting in native expressions: schema fingerprints select declarative mappings to canonical turns.

A record's nested field paths (`messages[].role`, `prompt`, ...) are walked, hashed and looked up; the hash names the
layout whose mapping turns the record into (role, text) turns. A template marks the turns; control strings inside
texts are escaped, so that the formatted text can be read back, and the loss mask lists the stretches to learn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from fernwick.llm.common import only

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Each:
    """One turn for each entry of an array of objects."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class Turn:
    """One turn from fields, those present joined by a blank line; names that end with ``?`` may be absent. Without
    any field there is no turn."""

    role: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Layout:
    """A mapping to turns; fields of ``ignored`` may stand beside those that it reads."""

    name: str
    turns: tuple[Each | Turn, ...]
    ignored: tuple[str, ...] = ()

    def paths(self) -> Iterator[list[str]]:
        """The sets of field paths that a record of this layout can have."""
        need = [f"{t.path}[].{f}" for t in self.turns if isinstance(t, Each) for f in (t.role, t.text)]
        fields = [f for t in self.turns if isinstance(t, Turn) for f in t.fields]
        need += [f for f in fields if not f.endswith("?")]
        free = [f[:-1] for f in fields if f.endswith("?")] + list(self.ignored)
        for k in range(len(free) + 1):
            for more in combinations(free, k):
                yield need + list(more)


# Names of fields in public data sets.
LAYOUTS = (
    Layout("messages", (Each("messages", "role", "content"),), ("prompt",)),
    Layout("from_value", (Turn("system", ("system?",)), Each("conversations", "from", "value"))),
    Layout("preference", (Each("prompt", "role", "content"), Each("chosen", "role", "content"))),
    Layout("instruction_output", (Turn("system", ("system?",)), Turn("user", ("instruction", "input?")), Turn("assistant", ("output",)))),
    Layout("instruction_response", (Turn("user", ("instruction", "context?")), Turn("assistant", ("response",)))),
    Layout("prompt_completion", (Turn("user", ("prompt",)), Turn("assistant", ("completion",)))),
    Layout("prompt_response", (Turn("system", ("system?",)), Turn("user", ("prompt",)), Turn("assistant", ("response",)))),
    Layout("question_answer", (Turn("user", ("context?", "question")), Turn("assistant", ("answer",)))),
)
# Roles by other names.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Rows:
    """A table with one row per turn."""

    conversation: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    text: str = "text"


def fingerprint(paths: Sequence[str]) -> str:
    return hashlib.md5("\n".join(sorted(set(paths))).encode()).hexdigest()


def schema_paths(kind: DataType, at: str = "") -> list[str]:
    """Paths of all leaves of a table's schema."""
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, at + "[]")
    if isinstance(kind, StructType):
        return [p for f in kind for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    return [at]


_TOKENS = r"`(?:[^`]|``)*`: |\w+: |OBJECT<|ARRAY<|>|[A-Z]+"


def record_paths(record: Column) -> Column:
    """Paths of all leaves of a variant that are not null, walked through the nesting of its schema."""
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(_TOKENS), F.lit(0))
    start = F.struct(F.array(F.lit("")).alias("up"), F.lit("").alias("at"), F.array().cast("array<string>").alias("paths"))

    def step(state: Column, token: Column) -> Column:
        up, at, paths = state["up"], state["at"], state["paths"]
        name = F.regexp_replace(F.regexp_replace(token, "^`|`?: $", ""), "``", "`")
        opens = token.isin("OBJECT<", "ARRAY<")
        leaf = ~opens & (token != ">") & ~token.endswith(": ") & (token != "VOID")
        return F.struct(
            F.when(opens, F.concat(up, F.array(F.when(token == "OBJECT<", F.when(at == "", "").otherwise(F.concat(at, F.lit(".")))).otherwise(at))))
            .when(token == ">", F.slice(up, 1, F.size(up) - 1)).otherwise(up).alias("up"),
            F.when(token.endswith(": "), F.concat(F.element_at(up, -1), name)).when(token == "ARRAY<", F.concat(at, F.lit("[]"))).otherwise(at).alias("at"),
            F.when(leaf, F.concat(paths, F.array(at))).otherwise(paths).alias("paths"))

    return F.aggregate(tokens, start, step, lambda state: state["paths"])


def _known(layouts: Sequence[Layout]) -> dict[str, str]:
    """Layout by fingerprint."""
    names: dict[str, str] = {}
    for layout in layouts:
        for paths in layout.paths():
            if names.setdefault(fingerprint(paths), layout.name) != layout.name:
                raise ValueError(f"layouts {layout.name} and {names[fingerprint(paths)]} have the same fields")
    return names


def _role(role: Column) -> Column:
    named = F.coalesce(role, F.lit(""))
    out = named
    for old, new in ROLES.items():
        out = F.when(named == old, new).otherwise(out)
    return out


def _said(entries: Column, role: str, text: str) -> Column:
    return F.transform(entries, lambda x: F.struct(_role(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")))


def _turns(record: Column, layout: Layout) -> Column:
    parts = []
    for t in layout.turns:
        if isinstance(t, Each):
            entries = F.try_variant_get(record, f"$.{t.path}", f"array<struct<`{t.role}`:string,`{t.text}`:string>>")
            parts.append(_said(entries, t.role, t.text))
        else:
            fields = [F.try_variant_get(record, f"$.{f.rstrip('?')}", "string") for f in t.fields]
            text = F.array_compact(F.array(*[f if name == t.fields[0] and not name.endswith("?") else F.nullif(f, F.lit("")) for f, name in zip(fields, t.fields)]))
            turn = F.struct(F.lit(t.role).alias("role"), F.array_join(text, "\n\n").alias("text"))
            parts.append(F.when(F.size(text) > 0, F.array(turn)).otherwise(F.array().cast(TURNS)))
    return F.concat(*[p.cast(TURNS) for p in parts])


def record_turns(records: DataFrame, id_col: str, record: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Per row: id, ``fingerprint`` and ``layout`` of the JSON text or variant ``record``, and its canonical ``turns``.

    Fields that no layout names do not count, nor do fields that are null. Where no layout has the fingerprint, or the
    text is no JSON, ``layout`` and ``turns`` are null. Null texts and roles of turns count as ''.
    """
    names = _known(layouts)
    fields = sorted({p for layout in layouts for paths in layout.paths() for p in paths})
    kind = dict(records.dtypes)[record]
    value = F.col(record) if kind == "variant" else F.try_parse_json(F.col(record).cast("string"))
    out = records.select(F.col(id_col), value.alias("_record"))
    found = F.array_sort(F.array_distinct(F.array_intersect(record_paths(F.col("_record")), F.array(*map(F.lit, fields)))))
    out = out.withColumn("fingerprint", F.md5(F.array_join(found, "\n").cast("binary")))
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    out = out.withColumn("layout", F.try_element_at(lookup, F.col("fingerprint")))
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, _turns(F.col("_record"), layout)).otherwise(turns)
    out = out.withColumn("turns", turns)
    return out.select(id_col, "fingerprint", F.when(F.col("turns").isNotNull(), F.col("layout")).alias("layout"), "turns")


def table_turns(df: DataFrame, id_col: str, layouts: Sequence[Layout] = LAYOUTS, rows: Sequence[Rows] = (Rows(),)) -> DataFrame:
    """Canonical ``turns`` of a typed table, with ``fingerprint`` and ``layout``.

    If the table's schema has the fields of one of ``rows`` (names in the order conversation, turn, role, text), it holds
    one row per turn: rows are gathered by conversation, in the order of turn, then role, then text; a null text is
    empty, and a null conversation is one of its own. Else each row is a record, whose fields may differ from row to
    row by nulls. Other columns are ignored.
    """
    paths = schema_paths(df.schema)
    for r in rows:
        names = [r.conversation, r.turn, r.role, r.text]
        if r.conversation == id_col and fingerprint([p for p in paths if p in names]) == fingerprint(names):
            df = only(df, names)
            said = F.struct(df[r.turn].alias("turn"), F.coalesce(df[r.role].cast("string"), F.lit("")).alias("role"),
                            F.coalesce(df[r.text].cast("string"), F.lit("")).alias("text"))
            # One conversation is one row of the result, so its turns meet anyway.
            gathered = df.groupBy(id_col).agg(F.array_sort(F.collect_list(said)).alias("said"))
            return gathered.select(id_col, F.lit(fingerprint(names)).alias("fingerprint"), F.lit("rows").alias("layout"), _said(F.col("said"), "role", "text").alias("turns"))
    return record_turns(df.select(df[id_col], F.to_variant_object(F.struct(*[df[c] for c in df.columns])).alias("_record")), id_col, "_record", layouts)


@dataclass(frozen=True)
class Template:
    """Marks around the texts of a user and an assistant; other turns carry their role between ``other`` and ``end``.
    All marks begin or end with a space towards the text, and no control string holds a space, so that a control
    string can neither begin in a text and end in a mark nor the other way round."""

    start: str = "<s>"
    user: tuple[str, str] = ("[INST] ", " [/INST]")
    assistant: tuple[str, str] = (" ", " </s>")
    other: str = "<<SYS>> "
    end: str = " <</SYS>>"

    def controls(self) -> list[str]:
        marks = [self.start, *self.user, *self.assistant, self.other, self.end]
        return sorted({m.strip() for m in marks if m.strip()})

    def escape(self, text: Column) -> Column:
        r"""Put `\` behind each `\` and behind the first character of each control string."""
        rest = "|".join(re.escape(c[0]) + f"(?={re.escape(c[1:])})" for c in self.controls())
        return F.regexp_replace(text, rf"\\|{rest}", r"$0\\")

    def unescape(self, text: Column) -> Column:
        firsts = "".join(sorted({re.escape(c[0]) for c in self.controls()}))
        return F.regexp_replace(text, rf"(\\)\\|([{firsts}])\\(?!\\)", "$1$2")


TEMPLATE = Template()


def _starts(lengths: Column) -> Column:
    """Running totals before each number, added up in blocks of about the root of their number."""
    width = F.greatest(F.ceil(F.sqrt(F.size(lengths))).cast("int"), F.lit(1))
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)
    blocks = F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / width).cast("int") - 1, F.lit(0))), F.array(F.lit(0).cast("long")),
        lambda sums, k: F.concat(sums, F.array(F.element_at(sums, -1) + total(F.slice(lengths, k * width + 1, width)))))
    return F.transform(lengths, lambda x, k: F.get(blocks, F.floor(k / width).cast("int")) + total(F.slice(lengths, F.floor(k / width).cast("int") * width + 1, k % width)))


def format_turns(df: DataFrame, template: Template = TEMPLATE, turns: str = "turns") -> DataFrame:
    """Replace ``turns`` by ``formatted``, the marked text, and ``loss``: the stretches of it to learn from, one per turn
    of an assistant, as ``start`` and ``length`` in UTF-8 bytes. Null turns give a null text and mask; no turns
    give the template's start alone and no stretch."""
    t = template

    def piece(x: Column) -> Column:
        body = t.escape(x["text"])
        whole = F.when(x["role"] == "user", F.concat(F.lit(t.user[0]), body, F.lit(t.user[1]))).when(
            x["role"] == "assistant", F.concat(F.lit(t.assistant[0]), body, F.lit(t.assistant[1]))).otherwise(
            F.concat(F.lit(t.other), t.escape(x["role"]), F.lit(t.end + " "), body, F.lit(t.end)))
        return F.struct(whole.alias("text"), (x["role"] == "assistant").alias("learn"))

    around = sum(len(m.encode()) for m in t.assistant)
    out = df.withColumn("_pieces", F.transform(turns, piece)).withColumn("_sizes", F.transform("_pieces", lambda p: F.octet_length(p["text"]).cast("long")))
    # Both columns are read by two others, so Spark computes each once.
    out = out.withColumn("formatted", F.concat(F.lit(t.start), F.array_join(F.transform("_pieces", lambda p: p["text"]), "")))
    spans = F.zip_with(F.zip_with("_pieces", _starts(F.col("_sizes")), lambda p, s: F.struct(p["learn"].alias("learn"), s.alias("s"))), F.col("_sizes"),
                       lambda x, n: F.struct(x["learn"].alias("learn"), (x["s"] + len(t.start.encode()) + len(t.assistant[0].encode())).cast("int").alias("start"),
                                             (n - around).cast("int").alias("length")))
    out = out.withColumn("loss", F.transform(F.filter(spans, lambda x: x["learn"]), lambda x: F.struct(x["start"], x["length"])))
    return out.drop("_pieces", "_sizes", turns)


def read_turns(df: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """The ``turns`` of ``formatted``, and ``learnt``: the texts under the mask ``loss``, unescaped."""
    t = template
    e = lambda mark: re.escape(mark).replace("/", "/")
    whole = "|".join([rf"{e(t.user[0])}.*?{e(t.user[1])}", rf"{e(t.other)}.*?{e(t.end)} .*?{e(t.end)}", rf"{e(t.assistant[0])}.*?{e(t.assistant[1])}"])
    pieces = F.regexp_extract_all(F.substring("formatted", len(t.start) + 1, (1 << 31) - 1), F.lit(f"(?s){whole}"), F.lit(0))

    def between(p: Column, marks: tuple[str, str]) -> Column:
        return t.unescape(F.substring(p, F.lit(len(marks[0]) + 1), F.length(p) - len(marks[0]) - len(marks[1])))

    def turn(p: Column) -> Column:
        role = t.unescape(F.regexp_extract(p, rf"(?s)^{e(t.other)}(.*?){e(t.end)} ", 1))
        text = t.unescape(F.regexp_extract(p, rf"(?s)^{e(t.other)}.*?{e(t.end)} (.*){e(t.end)}$", 1))
        return F.when(p.startswith(t.user[0]), F.struct(F.lit("user").alias("role"), between(p, t.user).alias("text"))).when(
            p.startswith(t.other), F.struct(role.alias("role"), text.alias("text"))).otherwise(
            F.struct(F.lit("assistant").alias("role"), between(p, t.assistant).alias("text")))

    out = df.withColumn("turns", F.transform(pieces, turn)).withColumn("_bytes", F.col("formatted").cast("binary"))
    masked = F.transform("loss", lambda x: t.unescape(F.substring(F.col("_bytes"), x["start"] + 1, x["length"]).cast("string")))
    return out.withColumn("learnt", F.when(F.length("_bytes") >= 0, masked)).drop("_bytes")


def chat_digests(df: DataFrame) -> DataFrame:
    """Digests of what `read_turns` has read: of all turns, and of the texts to learn from, with their sizes."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return df.withColumns({
        "n_turns": F.size("turns").cast("long"), "turns_sha256": F.sha2(said, 256), "loss_chars": F.length(learnt).cast("long"),
        "loss_sha256": F.sha2(learnt, 256), "formatted_chars": F.length("formatted").cast("long")})


# Marks of the template: 3 for the start, 15 around a user's text, 6 around an assistant's, 27 and the role otherwise.
SQL = r"""
with said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped as (select *, length(text) + length(text) - length(replace(text, '\', '')) + list_sum(list_transform(
    ['<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>'], lambda c: (length(text) - length(replace(text, c, ''))) // length(c))) as size from said)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  (3 + sum(size + case role when 'user' then 15 when 'assistant' then 6 else 27 + length(role) end))::bigint as formatted_chars
from escaped group by conv_id
"""
