"""Text expressions.

Everything but the HTML unescape is a native expression. Java's ``\\w`` and ``\\s`` are ASCII, so
the Unicode classes are spelled out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"

# Punctuation that stands alone after tokenizing (ASCII, then other signs).
PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~""" + "“”¨«»®´·º½¾¿¡§£₤‘’"

# Marks put in front of repeated characters, repeated words and capitals.
TK_REP, TK_WREP, TOK_UP = "tk_rep", "tk_wrep", "t_up"

# Text repairs, applied in this order.
REPAIRS = (
    ("#39;", "'"),
    ("amp;", "&"),
    ("#146;", "'"),
    ("nbsp;", " "),
    ("#36;", "$"),
    ("\\n", "\n"),
    ("quot;", "'"),
    ("<br />", "\n"),
    ('\\"', '"'),
    ("<unk>", "u_n"),
    (" @.@ ", "."),
    (" @-@ ", "-"),
    ("\\", " \\ "),
)

# A Unicode noncharacter (not for interchange, so not in texts) that fences matches.
_FENCE = "﷐"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _class(chars: str) -> str:
    return "".join("\\" + ch if ch in r"\[]^-&" else ch for ch in chars)


def words(col: str | Column) -> Column:
    """All runs of word characters."""
    return F.regexp_extract_all(_c(col), F.lit(f"([{WORD_CHARS}]+)"), F.lit(1))


def tokenize_code(col: str | Column) -> Column:
    """All runs of word characters joined by a space."""
    return F.array_join(words(col), " ")


def words_and_punctuation(col: str | Column) -> Column:
    """Runs of word characters, and every other non-space character on its own."""
    return F.regexp_extract_all(
        _c(col), F.lit(f"([{WORD_CHARS}]+|[^{SPACE_CHARS}{WORD_CHARS}])"), F.lit(1))


# Marks and shortened words that stay whole.
WHOLE = ("<eos>", "<bos>", "<unk>", "a.m.", "p.m.", "e.g.", "i.e.", "vs.", "mr.", "mrs.", "ms.", "dr.", "prof.", "jr.", "inc.", "ltd.", "co.", "corp.", "st.", "ph.d.")
# Words written together that are two tokens, and where the second begins.
TOGETHER = {"cannot": 3, "gonna": 3, "gotta": 3, **{w: len(w) - 2 for w in (
    "aint arent cant couldnt didnt doesnt dont hadnt hasnt havent isnt mustnt shouldnt wasnt werent wont wouldnt").split()}}


# Bytes of the shortest and the longest of them. Beyond ASCII only the Kelvin sign is lower-cased to ASCII, to a k; they have none.
_TOGETHER_LENGTHS = (min(map(len, TOGETHER)), max(map(len, TOGETHER)))


def token_pattern(whole: Sequence[str] = WHOLE) -> str:
    """The rules that find tokens, the first that fits at a place: whole marks and shortened words, links, mail addresses,
    numbers with separators, words (with dots before small letters and with apostrophes inside), runs of dots or
    dashes, single signs. Look-arounds are not used, so every engine of Perl's kind reads it alike."""
    w, s = WORD_CHARS, SPACE_CHARS
    rules = ["(?i:" + "|".join(re.escape(x) for x in whole) + ")", rf"(?:https?|ftp)://[^{s}]+", rf"[{w}.+-]+@[{w}-]+(?:\.[{w}-]+)+",
             r"\p{N}+(?:[.,/:]\p{N}+)+", rf"[{w}]+(?:\.[\p{{Ll}}\p{{N}}_][{w}]*)*(?:['’][{w}]+)*", r"\.\.+", "--+", rf"[^{s}]"]
    return "(" + "|".join(rules) + ")"


# Endings of a word that are tokens of their own.
CLITICS = (r"(?i)^(.+)(n['’]t)$", r"(?i)^(.+)(['’](?:s|re|ve|ll|d|m))$")


def rule_tokens(col: str | Column) -> Column:
    """Tokens by `token_pattern`; contractions and words written together are split ("do" + "n't", "can" + "not")."""
    found = F.regexp_extract_all(_c(col), F.lit(token_pattern()), F.lit(1))

    def split(t: Column) -> Column:
        out = F.array(t)
        for word, at in TOGETHER.items():
            out = F.when(F.lower(t) == word, F.array(F.substring(t, 1, at), F.substring(t, at + 1, len(word)))).otherwise(out)
        for rule in reversed(CLITICS):
            out = F.when(t.rlike(rule), F.array(F.regexp_extract(t, rule, 1), F.regexp_extract(t, rule, 2))).otherwise(out)
        # Few tokens are split; the others pass by one look.
        likely = t.contains("'") | t.contains("’") | (F.octet_length(t).between(*_TOGETHER_LENGTHS) & F.lower(t).isin(*TOGETHER))
        return F.when(likely, out).otherwise(F.array(t))

    return F.flatten(F.transform(found, split))


def tokenize_docstring(col: str | Column) -> Column:
    """Lower-case tokens of the first paragraph."""
    return F.transform(rule_tokens(F.substring_index(_c(col), "\n\n", 1)), F.lower)


def split_spaces(c: Column) -> Column:
    return F.filter(F.split(c, f"[{SPACE_CHARS}]+"), lambda t: t != "")


def tokenize(col: str | Column) -> Column:
    """Put spaces around punctuation, then split on white space."""
    return split_spaces(F.regexp_replace(_c(col), f"([{_class(PUNCTUATION)}])", " $1 "))


def sub_br(col: str | Column) -> Column:
    """Line-break tags to newlines."""
    return F.regexp_replace(_c(col), r"(?i)<[\s\x0b]*br[\s\x0b]*/?>", "\n")


def _replace_matches(c: Column, pattern: str, make) -> Column:
    """Replace each match by ``make(match)``: fence the matches, so every second piece is one."""
    pieces = F.split(F.regexp_replace(c, f"({pattern})", f"{_FENCE}$1{_FENCE}"), _FENCE, -1)
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, make(p)).otherwise(p)), "")


def mark_char_repeats(col: str | Column) -> Column:
    """Four or more equal non-space characters become `` tk_rep N c ``."""
    return _replace_matches(
        _c(col), rf"([^{SPACE_CHARS}])\2{{3,}}",
        lambda m: F.concat(F.lit(f" {TK_REP} "), F.length(m).cast("string"), F.lit(" "),
                           F.substring(m, 1, 1), F.lit(" ")))


def mark_word_repeats(col: str | Column) -> Column:
    """A word with what follows it, four or more times, becomes `` tk_wrep N w ``."""
    unit = rf"[{WORD_CHARS}]+[^{WORD_CHARS}]+"
    start = rf"(?<![{WORD_CHARS}])"
    inside = rf"^({unit})(\1{{3,}})"

    def make(m: Column) -> Column:
        again = split_spaces(F.regexp_extract(m, inside, 2))
        return F.concat(F.lit(f" {TK_WREP} "), (F.size(again) + 1).cast("string"), F.lit(" "),
                        F.regexp_extract(m, inside, 1), F.lit(" "))

    return _replace_matches(_c(col), rf"{start}({unit})\2{{3,}}", make)


def mark_caps(col: str | Column) -> Column:
    """`` t_up `` before upper-case words longer than two characters; everything lower-cased."""
    runs = F.regexp_extract_all(_c(col), F.lit(f"([{WORD_CHARS}]+|[^{WORD_CHARS}]+)"), F.lit(1))

    def one(w: Column) -> Column:
        # The length is looked at first: most runs between words are a single space.
        upper = (F.length(w) > 2) & (w == F.upper(w)) & (w != F.lower(w))
        return F.concat(F.when(upper, F.lit(f" {TOK_UP} ")).otherwise(F.lit("")), F.lower(w))

    return F.array_join(F.transform(runs, one), "")


def proc_text(col: str | Column) -> Column:
    """Marks for repeats and capitals, space around slash and hash, line breaks, then tokens."""
    c = mark_caps(mark_word_repeats(mark_char_repeats(col)))
    c = F.regexp_replace(c, "([/#])", " $1 ")
    c = F.regexp_replace(c, " {2,}", " ")
    return rule_tokens(sub_br(c))


def repair_literals(col: str | Column) -> Column:
    c = _c(col)
    for old, new in REPAIRS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


# What `html.unescape` looks at, in Java's spelling.
_ENTITY = r"(&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?))"


@F.pandas_udf(ArrayType(StringType()))
def _unescaped(entities: pd.Series) -> pd.Series:
    return entities.map(lambda found: found if found is None else [html.unescape(e) for e in found])


def html_unescape(c: Column) -> Column:
    """Entities to characters; the entities alone go to Python, the text around them stays where it is."""
    found = F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(1))
    between = F.split(c, _ENTITY, -1)
    return F.when(c.contains("&"), F.array_join(F.flatten(F.zip_with(between, _unescaped(found), lambda t, e: F.array(t, F.coalesce(e, F.lit(""))))), "")).otherwise(c)


def fixup(col: str | Column) -> Column:
    """Repair broken entities and markers, unescape HTML, squeeze spaces."""
    return F.regexp_replace(html_unescape(repair_literals(col)), "  +", " ")


def mark_fields(cols: Sequence[str], bos: str = "xbos", fld: str = "xfld") -> Column:
    """One text from several fields: the first two fields are both numbered 1, then 2, 3, ..."""
    parts = [F.lit(f"\n{bos} {fld} 1 "), F.col(cols[0]).cast("string")]
    for i, c in enumerate(cols[1:], 1):
        parts += [F.lit(f" {fld} {i} "), F.col(c).cast("string")]
    return F.concat(*parts)


def question_pairs(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows whose first text opens with a Wh-question and whose second opens with a question."""
    q1 = F.regexp_extract(first, r"^(Wh[^?.!]+\?)", 1)
    q2 = F.regexp_extract(second, r"^([^?.!]+\?)", 1)
    return df.withColumns({"q_first": q1, "q_second": q2}).filter("q_first <> '' AND q_second <> ''")


def split_part(col: str | Column, sep: str, i: int) -> Column:
    """Piece ``i`` (from 0) of the split; null if there is none."""
    return F.get(F.split(_c(col), "\\Q" + sep + "\\E"), F.lit(i))


def clean_category(col: str | Column) -> Column:
    return F.regexp_replace(_c(col), r"[.\-]", "")


def compose_text(category: str, title: str, summary: str) -> Column:
    """Category, title and summary behind their tags."""
    return F.concat_ws(" ", F.lit("<CAT>"), F.col(category), F.lit("<SUMM>"), F.col(title), F.col(summary))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def html_item(link: str, title: str, summary: str) -> Column:
    """One list item; newlines in title and summary become spaces."""
    flat = [F.replace(F.col(c), F.lit("\n"), F.lit(" ")) for c in (title, summary)]
    return F.concat(F.lit('<li><a href="'), F.col(link), F.lit('">'), flat[0], F.lit("</a>: "), flat[1],
                    F.lit("</li>"))


# The page around the list items.
PAGE_HEAD = "<!DOCTYPE html>\n<html>\n<head><title>{title}</title></head>\n<body>\n<ul>"
PAGE_FOOT = "</ul>\n</body>\n</html>"


def html_lines(df: DataFrame, item: Column, order: str, title: str = "Review") -> DataFrame:
    """Page as rows ``(part, place, line)``: head, one line per row, foot; never one big string."""
    spark = df.sparkSession
    place = dict(df.dtypes)[order]
    ends = spark.createDataFrame([(0, PAGE_HEAD.format(title=title)), (2, PAGE_FOOT)], "part int, line string")
    items = df.select(F.lit(1).alias("part"), F.col(order).alias("place"), item.alias("line"))
    return ends.select("part", F.lit(None).cast(place).alias("place"), "line").unionByName(items)


def build_path(folder: str, name: str, suffix: str = "") -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), F.col(name).cast("string"), F.lit(suffix))


def ngrams(tokens: Column, n: int) -> Column:
    """The runs of ``n`` tokens, each joined by a space. ``tokens`` should be a stored column."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))


def characters(col: str | Column) -> Column:
    """The characters of a text, without empty pieces."""
    return F.filter(F.split(_c(col), ""), lambda ch: ch != "")
