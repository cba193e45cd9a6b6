"""Text marks against a plain Python statement of the rules.

The patterns are fixed values.
"""

import html
import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fernwick.functions import text as T

CASES = [
    "", "a", "aaaa", "!!!!! wow", "haha haha haha haha haha!", "no no no no", "la, la, la, la, la, end",
    "SHOUT at ME NOW", "A1B2 x_Y ÉTÉ Straße ÀÇ", "a/b #tag  two", "x<br />y<BR>z< br / >", "ééééé ñ",
    "----====", "one  two\n\nthree   ", "it's a \"test\" (really)", "co op £5 «q»", "aa\naa aaa\taaaa",
    "go go go go go go GO GO", "1111 2222 33333", "___ ____", "a,a,a,a,a,", "tab\ttab\ttab\ttab\tx",
]


def reps(s):
    return re.sub(r"(\S)(\1{3,})", lambda m: f" tk_rep {len(m.group(2)) + 1} {m.group(1)} ", s)


def word_reps(s):
    return re.sub(r"(\b\w+\W+)(\1{3,})", lambda m: f" tk_wrep {len(m.group(2).split()) + 1} {m.group(1)} ", s)


def caps(s):
    return "".join(f" t_up {w.lower()}" if w.isupper() and len(w) > 2 else w.lower() for w in re.findall(r"\w+|\W+", s))


def plain(s):
    return re.sub("([" + re.escape(string.punctuation) + "“”¨«»®´·º½¾¿¡§£₤‘’])", r" \1 ", s).split()


def run(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").repartition(2)
    return [r[1] for r in sorted(df.select("i", column).collect())]


def check(spark, texts):
    assert run(spark, texts, T.mark_char_repeats("s")) == [reps(s) for s in texts]
    assert run(spark, texts, T.mark_word_repeats("s")) == [word_reps(s) for s in texts]
    assert run(spark, texts, T.mark_caps("s")) == [caps(s) for s in texts]
    assert run(spark, texts, T.tokenize("s")) == [plain(s) for s in texts]


def rules(s):
    """Plain version: the longest candidate without spaces is cut step by step."""
    out = []
    while s:
        if s[0].isspace():
            s = s[1:]
            continue
        whole = [w for w in T.WHOLE if s.lower().startswith(w)]
        m = (re.match(r"(?:https?|ftp)://\S+", s) or re.match(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", s) or re.match(r"\d+(?:[.,/:]\d+)+", s)
             or re.match(r"\w+(?:\.(?:[^\W\dA-ZÀ-ÖØ-Þ]|\d)\w*)*(?:['’]\w+)*", s) or re.match(r"\.\.+|--+", s) or re.match(r"\S", s))
        t = s[:len(whole[0])] if whole else m[0]
        s = s[len(t):]
        cut = None
        if re.fullmatch(r"(?is).+n['’]t", t):
            cut = len(t) - 3
        elif re.fullmatch(r"(?is).+['’](s|re|ve|ll|d|m)", t):
            cut = max(t.rfind("'"), t.rfind("’"))
        elif t.lower() in T.TOGETHER:
            cut = T.TOGETHER[t.lower()]
        out += [t] if cut is None else [t[:cut], t[cut:]]
    return out


TOKENS = [
    "Don't say can't, won't or ISN'T; she's, they'll, I'd've", "cannot gonna Dont o'clock l'aile rock 'n' roll '90s", "e.g. this, i.e. Mr. X at 5 p.m. vs. co-op.",
    "<eos> a <BOS> <unk>x", "see https://a.b/c?d=e&f. mail me.you+x@mail.example.org now", "1.5 1,000.25 1/2 3:45 v1.2.3 10km 3d", "os.path.join end.Next U.S.A. a..b ... -- --- a--b well-known",
    "it’s n't 't 's don’t", "x_y.z __init__ f(x)=y[0]", "", "  \n", "a'b'c's", "tcan't cannotx",
]


def test_rule_tokens(spark):
    assert run(spark, TOKENS, T.rule_tokens("s")) == [rules(s) for s in TOKENS]
    assert run(spark, ["Don't use os.path, e.g. can't!"], T.tokenize_docstring("s")) == [["do", "n't", "use", "os.path", ",", "e.g.", "ca", "n't", "!"]]


def test_cases(spark):
    check(spark, CASES)


def test_whole_chain(spark):
    def chain(s):
        s = re.sub(r"([/#])", r" \1 ", caps(word_reps(reps(s))))
        s = re.sub(r"<\s*br\s*/?>", "\n", re.sub(" {2,}", " ", s), flags=re.I)
        return rules(s)

    assert run(spark, CASES, T.proc_text("s")) == [chain(s) for s in CASES]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aAbB éÉ1_.,!/#\n ", max_size=40), min_size=20, max_size=20))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_long_text_does_not_overflow(spark):
    long = "word " * 20000 + "z" * 50000 + " End"
    assert run(spark, [long], T.mark_char_repeats("s")) == [reps(long)]
    assert run(spark, [long], T.mark_word_repeats("s")) == [word_reps(long)]


def test_fixup(spark):
    raw = ["a #39;b&amp;lt; x", "line\\nnext<br />z", 'q\\"r\\s', "1 @.@ 5 @-@ 6  <unk>", "&eacute;quot;", None]

    def one(x):
        if x is None:
            return None
        for old, new in T.REPAIRS:
            x = x.replace(old, new)
        return re.sub("  +", " ", html.unescape(x))

    assert run(spark, raw, T.fixup("s")) == [one(x) for x in raw]


def test_docstring_tokens(spark):
    got = run(spark, ["Return X, please.\nNow\n\nSecond part"], T.tokenize_docstring("s"))
    assert got == [["return", "x", ",", "please", ".", "now"]]


def test_fields_and_split(spark):
    df = spark.createDataFrame([("t", "b", "c")], "t string, b string, c string")
    assert df.select(T.mark_fields(["t", "b", "c"])).first()[0] == "\nxbos xfld 1 t xfld 1 b xfld 2 c"
    assert df.select(T.split_part(F.lit("a - b"), " - ", 0), T.split_part(F.lit("a"), "_", 2)).first()[:] == ("a", None)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams(spark, n):
    words = "a b c d".split()
    df = spark.createDataFrame([(words,), ([],)], "w array<string>")
    got = [r[0] for r in df.select(T.ngrams(F.col("w"), n)).collect()]
    assert got[0] == [" ".join(words[i:i + n]) for i in range(5 - n)] and got[1] == []
