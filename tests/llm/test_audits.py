"""Chat formatting, periodic runs and source divergence against plain versions."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fernwick.llm import chat_format as chat
from fernwick.llm import divergence, periodic_runs, queries
from tests.llm.fixtures import awkward_rows, empty, table

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


RECORDS = [
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "gpt", "content": None}]},
     "messages", [("system", "s"), ("user", "u"), ("assistant", "")]),
    ({"prompt": "p", "messages": [{"role": "user", "content": "u"}], "id": 3, "meta": {"a b": [[{"x": 1}]], "q`r": 2}}, "messages", [("user", "u")]),
    ({"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}], "system": "be"}, "from_value", [("system", "be"), ("user", "x"), ("assistant", "y")]),
    ({"instruction": "i", "input": None, "output": "o"}, "instruction_output", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "with", "output": "o", "system": "s"}, "instruction_output", [("system", "s"), ("user", "i\n\nwith"), ("assistant", "o")]),
    ({"instruction": "i", "context": "", "response": "o"}, "instruction_response", [("user", "i"), ("assistant", "o")]),
    ({"prompt": "p", "completion": ""}, "prompt_completion", [("user", "p"), ("assistant", "")]),
    ({"prompt": "p", "response": "r"}, "prompt_response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": [{"role": "user", "content": "p"}], "chosen": [{"role": "assistant", "content": "c"}]}, "preference", [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "a"}, "question_answer", [("user", "q"), ("assistant", "a")]),
    ({"text": "plain"}, None, None),
    ({"prompt": "p"}, None, None),
    ({"messages": []}, None, None),
    ({"messages": "no list"}, None, None),
    ({"messages": [{"role": "user", "content": {"deep": 1}}]}, None, None),
]


def test_layouts_are_found_by_fingerprint(spark):
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(RECORDS)] + [(100, "no json"), (101, None), (102, "3"), (103, "[]")]
    df = spark.createDataFrame(rows, "id int, record string").withColumn("turns", F.lit(1)).withColumn("_record", F.lit(2))
    got = {r.id: r for r in chat.record_turns(df, "id", "record").collect()}
    for k, (_, layout, turns) in enumerate(RECORDS):
        assert got[k].layout == layout, RECORDS[k]
        assert (got[k].turns and [tuple(t) for t in got[k].turns]) == turns
    assert all(got[k].layout is None and got[k].turns is None for k in (100, 101, 102, 103))
    assert got[3].fingerprint == chat.fingerprint(["output", "instruction"]) == got[3].fingerprint
    assert len({got[k].fingerprint for k in (2, 3, 5, 6, 7, 8, 9)}) == 7


def test_typed_tables(spark):
    wide = spark.createDataFrame(
        [(1, "p", None, "c", None), (2, None, [("user", "u"), ("assistant", "a")], None, 5), (3, None, None, None, None)],
        "id int, prompt string, messages array<struct<role:string,content:string>>, completion string, extra int")
    got = {r.id: r for r in chat.table_turns(wide, "id").collect()}
    assert (got[1].layout, got[2].layout, got[3].layout) == ("prompt_completion", "messages", None)
    assert [tuple(t) for t in got[2].turns] == [("user", "u"), ("assistant", "a")]


def adversarial(r):
    return "".join(r.choice(CONTROLS + ["\\", "<", "[", "/", ">", "]", "INST]", "s>", " ", "\n", "é", "\U0001F642", "$1", "a"]) for _ in range(r.randint(0, 12)))


def test_formatting_is_read_back(spark):
    r = random.Random(2)
    said = [(c, t, r.choice(["user", "assistant", "system", "tool" + adversarial(r), None]), r.choice([None, adversarial(r), adversarial(r)]))
            for c in range(300) for t in range(r.randint(1, 6))]
    said += [(1000, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]  # many turns
    said += [(1001, 0, "user", "<s>" * 400_000), (1001, 1, "assistant", "\\" * 1_000_000)]  # very long texts
    said += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (5, 0, "assistant", "again"), (5, 0, "assistant", "again")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("turns", "loss", "formatted", "_pieces")})
    formatted = chat.format_turns(chat.table_turns(df, "conv_id"))
    want = {}
    for c, t, role, text in said:
        want.setdefault(c, []).append((t, role or "", text or ""))
    rows = {x.conv_id: x for x in chat.chat_digests(chat.read_turns(formatted)).collect()}
    assert rows.keys() == want.keys()
    for c, turns in want.items():
        turns = [x[1:] for x in sorted(turns)]
        learnt = [t for role, t in turns if role == "assistant"]
        got = rows[c]
        assert [tuple(x) for x in got.turns] == turns
        assert got.learnt == learnt
        assert (got.n_turns, got.loss_chars, got.formatted_chars) == (len(turns), sum(map(len, learnt)), len(got.formatted))
        assert got.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns)) and got.loss_sha256 == sha("".join(learnt))
        marks = Counter(re.findall("|".join(map(re.escape, CONTROLS)), got.formatted))
        kinds = Counter(role if role in ("user", "assistant") else "other" for role, _ in turns)
        assert marks == +Counter({"<s>": 1, "</s>": kinds["assistant"], "[INST]": kinds["user"], "[/INST]": kinds["user"],
                                  "<<SYS>>": kinds["other"], "<</SYS>>": 2 * kinds["other"]})
        data = got.formatted.encode()
        assert all(data[x["start"] + x["length"]:].startswith(b" </s>") and data[x["start"] - 1:x["start"]] == b" " for x in got.loss)
    assert chat.read_turns(chat.format_turns(chat.table_turns(df.filter("false"), "conv_id"))).count() == 0


def plain_runs(w, least, exponent):
    n, out = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_all_periods():
    r = random.Random(1)
    for _ in range(600):
        texts = []
        for _ in range(r.randint(1, 5)):
            w = [r.choice("abcd"[:r.randint(1, 4)]).encode() for _ in range(r.randint(0, 60))]
            if w and r.random() < .6:
                a = r.randrange(len(w))
                w = w[:a] + (w[a:a + r.randint(1, 6)] * 60)[:len(w) - a] + [b"z"] * r.randint(0, 8)
            texts.append(w)
        least, exponent = r.choice([(6, 4), (2, 2), (4, 2), (6, 3)])
        assert periodic_runs.find_runs(texts, least, exponent) == [plain_runs(w, least, exponent) for w in texts]


def test_runs_of_long_texts():
    assert periodic_runs.find_runs([[b"a"] * 200_000, [b"x", b"y", b"z"] * 70_000], 6, 4) == [[(0, 200_000, 1)], [(0, 210_000, 3)]]
    r = random.Random(4)
    stretch = [str(r.random()).encode() for _ in range(3000)]
    assert periodic_runs.find_runs([[b"q"] + stretch * 30 + stretch[:7] + [b"e"]], 6, 4) == [[(1, 90_007, 3000)]]


def test_op12_digests(spark):
    rows = awkward_rows() + [(300 + k, "a b c " * k) for k in range(20)] + [(400, "w " * 300_000), (401, "x y " * 9 + "z z z z z z z"), (402, "A a " * 8)]
    found = periodic_runs.periodic_runs(table(spark, rows), edit=queries.periodic_tail)
    found = found.select("doc_id", "runs", "collapsed", periodic_runs.longest_run(F.col("runs")).alias("best"), periodic_runs.runs_text(F.col("runs")).alias("text"))
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        if i is not None and w and zlib.crc32(str(i).encode()) % 10 == 0:
            g, n = zlib.crc32(str(i).encode()) // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w, 6, 4) if len(w) < 10_000 else [(0, len(w), 1)]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want.append((i, runs, " ".join(x.decode() for k, x in enumerate(w) if k not in gone), best, "".join("%d,%d,%d\n" % x for x in runs)))
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed, r.best and tuple(r.best), r.text) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert periodic_runs.periodic_runs(empty(spark)).count() == 0


def sourced(seed):
    r = random.Random(seed)
    rows = [(t, r.choice(["en", "fr", None]), r.choice(["a", "b", "é", None, ""])) for _, t in awkward_rows(seed)]
    rows += [("common, Common COMMON! x-y_z" + " rare" * r.randint(0, 1) + f" {r.choice('klm')}{r.choice(',.')}", r.choice(["en", "fr"]), r.choice("abc")) for _ in range(30)]
    return rows + [("1 2 3", "de", "only"), (None, "it", "p"), ("", "it", "q"), ("long-" * 5000 + "é", "en", "a"), ("long-" * 5000 + "é", "en", "b")]


def plain_divergence(rows, least, top):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), g or "", s or "") for t, g, s in rows]
    out = []
    for g in {x[1] for x in docs}:
        df = Counter(t for words, lang, _ in docs if lang == g for t in set(words))
        kept = [t for t in df if df[t] >= least]
        n = {s: Counter() for _, lang, s in docs if lang == g}
        for words, lang, s in docs:
            if lang == g:
                n[s].update(t for t in words if df[t] >= least)
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        whole = sum(n.values(), Counter())
        for s in n:
            pairs = [(o, sum(abs(share(n[s], t) - share(n[o], t)) for t in kept)) for o in n if o != s]
            terms = [(t, share(n[s], t) - share(whole, t)) for t in kept if n[s][t]]
            for part, found, size in (("pair", pairs, None), ("term", [x for x in terms if x[1] > 0], top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(g, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:size])]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence(spark, seed):
    rows = sourced(seed)
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit(1) for c in ("term", "n", "key", "part", "groups", "df")})
    for least, top, cells in ((3, 50, 4_000_000), (10, 2, 6), (1000, 5, 4)):
        got = sorted(map(tuple, divergence.divergence(df.repartition(3), least, top=top, cells=cells).collect()))
        assert got == plain_divergence(rows, least, top)
    assert divergence.divergence(df.filter("false")).count() == 0


def test_term_counts_of_any_slices(spark):
    df = spark.createDataFrame(sourced(3), "text string, lang string, source string")
    ways = [sorted(map(tuple, divergence.term_counts(df.repartition(p), 4, slice_words=s).collect())) for p, s in ((1, 10**6), (3, 20), (5, 1))]
    assert ways[0] == ways[1] == ways[2] and ways[0]


def test_a_term_of_many_batches(spark):
    # Each chunk is another one, all hold one term; its rows fill several Arrow batches and wait for each other.
    rows = [(" ".join(f"x{k}-{i}" for i in range(400)), "en", "ab"[k % 2]) for k in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.term_counts(df, 300).collect())) == [("en", "a", "x", 60_000), ("en", "b", "x", 60_000)]
    assert divergence.term_counts(df, 301).count() == 0
