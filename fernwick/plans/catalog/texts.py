"""Text functions, vocabularies, streams and term-weight classifiers."""

from pyspark.sql import functions as F

from fernwick.functions import arrays as A
from fernwick.functions import text as T
from fernwick.operators import classify as C
from fernwick.operators import vocab as V
from fernwick.operators.relational import vocab_overlap
from fernwick.plans.catalog.registry import query
from fernwick.plans.catalog.relational import WORDS
from fernwick.session import bounded_broadcast, cut_lineage

# Sizes of vocabularies and of term lists, as in the work that is covered.
VOCAB = 60_000
TERMS = 800_000
# Words that a resampled vocabulary keeps.
KEPT_WORDS = 5_000

_SP = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_W = r"\p{L}\p{N}_"


@query("tokenize_code", f"SELECT doc_id, array_to_string({WORDS}, ' ') AS tokens FROM documents")
def _(t):
    return t.documents.select("doc_id", T.tokenize_code("text").alias("tokens"))


def _rule_tokens(col):
    """Candidates by the pattern, then each one split where an ending or a word written together asks for it."""
    cases = " ".join([rf"WHEN regexp_matches(z, '(?i)^.+n[''’]t$') THEN [left(z, length(z) - 3), right(z, 3)]",
                      r"WHEN regexp_matches(z, '(?i)^.+[''’](s|d|m)$') THEN [left(z, length(z) - 2), right(z, 2)]",
                      r"WHEN regexp_matches(z, '(?i)^.+[''’](re|ve|ll)$') THEN [left(z, length(z) - 3), right(z, 3)]",
                      *[f"WHEN lower(z) = '{w}' THEN [left(z, {k}), substr(z, {k + 1})]" for w, k in T.TOGETHER.items()]])
    pattern = T.token_pattern().replace("'", "''").replace(r"\-", "-")
    return f"flatten(list_transform(regexp_extract_all({col}, '{pattern}', 1), lambda z: CASE {cases} ELSE [z] END))"


@query("tokenize_docstring", f"""
    SELECT doc_id, lower(array_to_string({_rule_tokens("string_split(text, chr(10) || chr(10))[1]")}, ' ')) AS tokens FROM documents""")
def _(t):
    return t.documents.select("doc_id", T.join_tokens(T.tokenize_docstring("text")).alias("tokens"))


_PUNCT = T._class(T.PUNCTUATION).replace("'", "''")


@query("tokenize", rf"""
    SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(regexp_replace(text, '([{_PUNCT}])', ' \1 ', 'g'), '[{_SP}]+'),
        lambda w: w <> ''), ' ') AS tokens FROM documents""")
def _(t):
    return t.documents.select("doc_id", T.join_tokens(T.tokenize("text")).alias("tokens"))


@query("sub_br", r"SELECT page_id, regexp_replace(html, '(?i)<[\s\x0b]*br[\s\x0b]*/?>', chr(10), 'g') AS html FROM pages")
def _(t):
    return t.pages.select("page_id", T.sub_br("html").alias("html"))


# Runs of equal characters are islands: their place minus their rank among equal ones stays the same.
_CHAR_REPEATS = rf"""
    ch AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?s).')) AS c, unnest(range(length(text))) AS i FROM documents),
    isl AS (SELECT doc_id, c, i - row_number() OVER (PARTITION BY doc_id, c ORDER BY i) AS k, i FROM ch),
    run AS (SELECT doc_id, c, min(i) AS place, count(*) AS n FROM isl GROUP BY doc_id, c, k),
    reps AS (SELECT doc_id, string_agg(CASE WHEN n >= 4 AND NOT regexp_matches(c, '[{_SP}]') THEN ' tk_rep ' || n || ' ' || c || ' ' ELSE repeat(c, n) END, '' ORDER BY place) AS text
             FROM run GROUP BY 1 UNION ALL SELECT doc_id, text FROM documents WHERE text = '')"""

# A unit is a word with the signs behind it. Equal neighbours are islands; the unit behind an island belongs to it too if
# it begins like the others (its signs go on), and what is left of it stays.
_WORD_REPEATS = rf"""
    pre AS (SELECT doc_id, text, regexp_extract(text, '^[^{_W}]+') AS head, regexp_extract(text, '[{_W}]+$') AS tail FROM reps),
    u AS (SELECT doc_id, unnest(regexp_extract_all(text, '[{_W}]+[^{_W}]+')) AS u, unnest(range(len(regexp_extract_all(text, '[{_W}]+[^{_W}]+')))) AS i FROM pre),
    ui AS (SELECT doc_id, u, i - row_number() OVER (PARTITION BY doc_id, u ORDER BY i) AS k, i FROM u),
    ur AS (SELECT doc_id, u, min(i) AS place, count(*) AS n FROM ui GROUP BY doc_id, u, k),
    ux AS (SELECT *, n >= 3 AND coalesce(starts_with(lead(u) OVER w, u), false) AS more, lead(u) OVER w AS behind FROM ur WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
    uy AS (SELECT *, coalesce(lag(more) OVER w, false) AS lost, lag(u) OVER w AS before FROM ux WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
    uz AS (SELECT *, n - CAST(lost AS INT) AS own, n - CAST(lost AS INT) + CAST(more AS INT) AS m FROM uy),
    wreps AS (SELECT doc_id, string_agg(CASE WHEN lost THEN substr(u, length(before) + 1) ELSE '' END
        || CASE WHEN m >= 4 THEN ' tk_wrep ' || (len(list_filter(regexp_split_to_array(repeat(u, m - 1), '[{_SP}]+'), lambda z: z <> '')) + 1) || ' ' || u || ' ' ELSE repeat(u, own) END, '' ORDER BY place) AS text
        FROM uz GROUP BY 1),
    words AS (SELECT doc_id, head || coalesce(w.text, '') || tail AS text FROM pre LEFT JOIN wreps w USING (doc_id) WHERE pre.text <> tail
        UNION ALL SELECT doc_id, text FROM pre WHERE text = tail)"""

_CAPS = rf"""array_to_string(list_transform(regexp_extract_all(text, '[{_W}]+|[^{_W}]+'), lambda w:
        CASE WHEN w = upper(w) AND w <> lower(w) AND length(w) > 2 THEN ' t_up ' || lower(w) ELSE lower(w) END), '')"""


@query("mark_char_repeats", f"WITH {_CHAR_REPEATS} SELECT doc_id, text FROM reps")
def _(t):
    return t.documents.select("doc_id", T.mark_char_repeats("text").alias("text"))


@query("mark_word_repeats", f"""
    WITH reps AS (SELECT doc_id, text FROM documents), {_WORD_REPEATS} SELECT doc_id, text FROM words""")
def _(t):
    return t.documents.select("doc_id", T.mark_word_repeats("text").alias("text"))


@query("mark_caps", rf"""
    SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[{_W}]+|[^{_W}]+'), lambda w:
        CASE WHEN w = upper(w) AND w <> lower(w) AND length(w) > 2 THEN ' t_up ' || lower(w) ELSE lower(w) END), '') AS text FROM documents""")
def _(t):
    return t.documents.select("doc_id", T.mark_caps("text").alias("text"))


_MARKED = r"regexp_replace(regexp_replace(regexp_replace(text, '([/#])', ' \1 ', 'g'), ' {2,}', ' ', 'g'), '(?i)<[\s\x0b]*br[\s\x0b]*/?>', chr(10), 'g')"


@query("proc_text", f"""
    WITH {_CHAR_REPEATS}, {_WORD_REPEATS}, caps AS (SELECT doc_id, {_CAPS} AS text FROM words), marked AS (SELECT doc_id, {_MARKED} AS text FROM caps)
    SELECT doc_id, array_to_string({_rule_tokens("text")}, ' ') AS tokens FROM marked""")
def _(t):
    return t.documents.select("doc_id", T.join_tokens(T.proc_text("text")).alias("tokens"))


def _replaced(col):
    for old, new in T.REPAIRS:
        lit = [x.replace("'", "''") for x in (old, new)]
        col = f"replace({col}, '{lit[0]}', '{lit[1]}')"
    return col


@query("repair_literals", f"SELECT page_id, {_replaced('html')} AS html FROM pages")
def _(t):
    return t.pages.select("page_id", T.repair_literals("html").alias("html"))


# The entities that pages hold: two names, and one that lost its end.
@query("fixup", f"""
    SELECT page_id, regexp_replace(replace(replace(replace({_replaced('html')}, '&copy;', '©'), '&middot;', '·'), '&amp', '&'), '  +', ' ', 'g') AS html FROM pages""")
def _(t):
    return t.pages.select("page_id", T.fixup("html").alias("html"))


@query("mark_fields", """
    SELECT doc_id, chr(10) || 'xbos xfld 1 ' || lang || ' xfld 1 ' || source || ' xfld 2 ' || text AS text FROM documents""")
def _(t):
    return t.documents.select("doc_id", T.mark_fields(["lang", "source", "text"]).alias("text"))


@query("extract_question_pairs", r"""
    WITH s AS (SELECT conv_id, turn, role, regexp_replace(text, '^([^ .]+ [^ .]+)', 'What \1?') AS text FROM conversations),
    p AS (SELECT u.conv_id, u.turn, u.text AS a, s.text AS b FROM s u JOIN s ON u.conv_id = s.conv_id AND s.turn = u.turn + 1)
    SELECT conv_id, turn, regexp_extract(a, '^(Wh[^?.!]+\?)', 1) AS q_first, regexp_extract(b, '^([^?.!]+\?)', 1) AS q_second
    FROM p WHERE q_first <> '' AND q_second <> ''""")
def _(t):
    said = t.conversations.select("conv_id", "turn", F.regexp_replace("text", "^([^ .]+ [^ .]+)", "What $1?").alias("text"))
    after = said.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    pairs = said.withColumnRenamed("text", "a").join(after, ["conv_id", "turn"])
    return T.question_pairs(pairs, "a", "b").select("conv_id", "turn", "q_first", "q_second")


@query("split_part", """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first, string_split(p_brand, '#')[2] AS code, string_split(p_name, ' ')[4] AS fourth FROM part""")
def _(t):
    return t.part.select("p_partkey", T.split_part("p_name", " ", 0).alias("first"),
                         T.split_part("p_brand", "#", 1).alias("code"), T.split_part("p_name", " ", 3).alias("fourth"))


@query("clean_category", r"SELECT p_partkey, regexp_replace(p_type || '-' || p_brand || '.x', '[.\-]', '', 'g') AS category FROM part")
def _(t):
    raw = F.concat("p_type", F.lit("-"), "p_brand", F.lit(".x"))
    return t.part.select("p_partkey", T.clean_category(raw).alias("category"))


@query("compose_text", "SELECT p_partkey, '<CAT> ' || p_type || ' <SUMM> ' || p_name || ' ' || p_brand AS text FROM part")
def _(t):
    return t.part.select("p_partkey", T.compose_text("p_type", "p_name", "p_brand").alias("text"))


@query("join_tokens", rf"SELECT doc_id, array_to_string({WORDS}, ' ') AS line FROM documents")
def _(t):
    return t.documents.select("doc_id", T.join_tokens(T.words("text")).alias("line"))


@query("html_list", """
    SELECT CAST(1 AS INTEGER) AS part, page_id AS place, '<li><a href="' || url || '">' || replace(html, chr(10), ' ') || '</a>: ' || replace(html, chr(10), ' ') || '</li>' AS line FROM pages
    UNION ALL SELECT 0, NULL, '<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<head><title>Review</title></head>' || chr(10) || '<body>' || chr(10) || '<ul>'
    UNION ALL SELECT 2, NULL, '</ul>' || chr(10) || '</body>' || chr(10) || '</html>'""")
def _(t):
    return T.html_lines(t.pages, T.html_item("url", "html", "html"), "page_id")


@query("build_path", "SELECT doc_id, 'texts/' || doc_id || '.txt' AS path FROM documents")
def _(t):
    return t.documents.select("doc_id", T.build_path("texts", "doc_id", ".txt").alias("path"))


_STREAM = rf"""
    d AS (SELECT doc_id, list_append({WORDS}, '<eos>') AS w FROM documents),
    s AS (SELECT doc_id, w, sum(len(w)) OVER (ORDER BY doc_id) - len(w) AS start FROM d),
    st AS (SELECT CAST(start + i AS BIGINT) AS pos, w[i + 1] AS token FROM (SELECT start, w, unnest(range(len(w))) AS i FROM s))"""


@query("concat_corpus", f"WITH {_STREAM} SELECT pos, token FROM st")
def _(t):
    return V.concat_corpus(t.documents.select("doc_id", T.words("text").alias("w")), "w", "doc_id")


@query("char_index", r"""
    SELECT ch AS "char", CAST(row_number() OVER (ORDER BY ch) AS INTEGER) AS idx FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM conversations) WHERE ch <> ''
    UNION ALL SELECT chr(0), 0""")
def _(t):
    return V.char_index(t.conversations, "text")


# ---------------------------------------------------------------- vocabularies

_TOK = rf"tok AS (SELECT doc_id, unnest({WORDS}) AS token FROM documents)"


def _vocab_sql(size, min_freq, specials):
    marks = " UNION ALL ".join(f"SELECT '{s}' AS token, CAST({i} AS BIGINT) AS id, CAST(NULL AS BIGINT) AS n" for i, s in enumerate(specials))
    return f"""{_TOK}, top AS (SELECT token, count(*) AS n FROM tok GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {size}),
    vocab AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 + {len(specials)} AS id, n FROM top WHERE n > {min_freq}
              UNION ALL {marks})"""


def _docs(t):
    return t.documents.select("doc_id", T.words("text").alias("w"))


def _tokens(t):
    return t.documents.select(F.explode(T.words("text")).alias("token"))


@query("build_vocab", f"WITH {_vocab_sql(VOCAB, 5, V.SPECIALS)} SELECT token, id, n FROM vocab")
def _(t):
    return V.build_vocab(_tokens(t), VOCAB, 5)


@query("build_vocab_unk_pad", f"WITH {_vocab_sql(60000, 2, ['_unk_', '_pad_'])} SELECT token, id, n FROM vocab")
def _(t):
    return V.build_vocab(_tokens(t), 60000, 2, ["_unk_", "_pad_"])


@query("build_vocab_no_minimum", f"WITH {_vocab_sql(40000, 0, ['_bos_', '_pad_', '_eos_', '_unk'])} SELECT token, id, n FROM vocab")
def _(t):
    return V.build_vocab(_tokens(t), 40000, 0, ["_bos_", "_pad_", "_eos_", "_unk"])


_NUM = f"""{_vocab_sql(VOCAB, 5, V.SPECIALS)},
    num AS (SELECT d.doc_id, i, coalesce(v.id, 3) AS id FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, {WORDS} AS w FROM documents)) d
            LEFT JOIN vocab v ON v.token = w[i])"""


@query("numericalize_docs", f"""
    WITH {_NUM} SELECT doc_id, array_to_string(list_append(list(id ORDER BY i), 2), ' ') AS ids FROM num GROUP BY 1""")
def _(t):
    vocab = V.build_vocab(_tokens(t), VOCAB, 5)
    return V.numericalize_docs(_docs(t), "w", vocab, "doc_id", append=2).select(
        "doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query("denumericalize", f"""
    WITH {_NUM} SELECT doc_id, array_to_string(list(coalesce(v.token, '_unk_') ORDER BY i), ' ') AS tokens FROM num LEFT JOIN vocab v USING (id) GROUP BY 1""")
def _(t):
    vocab = V.build_vocab(_tokens(t), VOCAB, 5)
    ids = V.numericalize_docs(_docs(t), "w", vocab, "doc_id")
    return V.denumericalize(ids, "ids", vocab, "doc_id").select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("resample_vocab", f"""
    WITH {_vocab_sql(VOCAB, 5, V.SPECIALS)},
    ids AS (SELECT coalesce(id, 3) AS id FROM tok LEFT JOIN vocab USING (token)),
    r AS (SELECT id AS old_id, row_number() OVER (ORDER BY count(*) DESC, id) + 1 AS new_id FROM ids GROUP BY 1 QUALIFY new_id <= {KEPT_WORDS + 1}),
    m AS (SELECT * FROM r UNION ALL SELECT 0, 0 WHERE 0 NOT IN (SELECT old_id FROM r) UNION ALL SELECT 1, 1 WHERE 1 NOT IN (SELECT old_id FROM r))
    SELECT coalesce(new_id, 0) AS new_id, count(*) AS n FROM ids LEFT JOIN m ON id = old_id GROUP BY 1""")
def _(t):
    from fernwick.operators.relational import lookup_or_default

    vocab = V.build_vocab(_tokens(t), VOCAB, 5)
    known = bounded_broadcast(vocab.select("token", F.col("id").alias("old_id")))
    ids = lookup_or_default(_tokens(t), known, "token", "old_id", 3).select("old_id")
    mapping = V.resample_vocab(ids, KEPT_WORDS, "old_id")
    return lookup_or_default(ids, bounded_broadcast(mapping), "old_id", "new_id", 0).groupBy("new_id").agg(
        F.count("*").alias("n"))


@query("save_and_load_vocab", f"WITH {_vocab_sql(VOCAB, 5, V.SPECIALS)} SELECT token, id FROM vocab")
def _(t):
    from fernwick.session import scratch_path
    from fernwick.sources.files import load_vocab, save_vocab

    path = scratch_path(t.spark, "vocab")
    save_vocab(V.build_vocab(_tokens(t), VOCAB, 5), path)
    return load_vocab(t.spark, path)


@query("vocab_missed_tokens", rf"""
    SELECT DISTINCT token FROM (SELECT unnest({WORDS}) AS token FROM benchmark) WHERE token NOT IN (SELECT unnest({WORDS}) FROM documents)""")
def _(t):
    mine = t.benchmark.select(F.explode(T.words("text")).alias("token"))
    return vocab_overlap(mine, _tokens(t)).filter("NOT found").select("token")


_DT = rf"""lw AS (SELECT doc_id, list_transform({WORDS}, lambda w: lower(w)) AS w FROM documents),
    dt AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(w) AS term FROM lw) GROUP BY ALL)"""


def _terms(t):
    return V.doc_term(_docs(t), "w", "doc_id")


@query("doc_term", f"WITH {_DT} SELECT doc_id, term, n FROM dt")
def _(t):
    return _terms(t)


@query("doc_term_trigrams", rf"""
    WITH lw AS (SELECT doc_id, list_transform({WORDS}, lambda w: lower(w)) AS w FROM documents),
    g AS (SELECT doc_id, array_to_string(w[i:i + k - 1], ' ') AS term FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lw, range(1, 4) r(k))),
    f AS (SELECT term FROM g GROUP BY 1 ORDER BY count(*) DESC, term LIMIT {TERMS})
    SELECT doc_id, term, count(*) AS n FROM g SEMI JOIN f USING (term) GROUP BY ALL""")
def _(t):
    return V.doc_term(_docs(t), "w", "doc_id", (1, 3), TERMS)


@query("binarize", f"WITH {_DT} SELECT doc_id, term, CAST(1 AS BIGINT) AS n FROM dt")
def _(t):
    return V.binarize(_terms(t))


@query("doc_term_user_tokenizer", r"""
    SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents) GROUP BY ALL""")
def _(t):
    def on_blanks(c):
        return F.split(c, " ")

    return V.doc_term(t.documents.select("doc_id", on_blanks(F.col("text")).alias("w")), "w", "doc_id")


# ---------------------------------------------------------------- classifiers

_LAB = f"""{_DT}, ldt AS (SELECT dt.doc_id, term, n, quality AS y FROM dt JOIN labels USING (doc_id)),
    sz AS (SELECT CAST(sum(quality) AS DOUBLE) AS n1, CAST(count(*) - sum(quality) AS DOUBLE) AS n0 FROM labels)"""


def _sums(expr):
    return f"pq AS (SELECT term, sum(CASE WHEN y = 1 THEN {expr} ELSE 0 END) + 1.0::DOUBLE AS p, sum(CASE WHEN y = 0 THEN {expr} ELSE 0 END) + 1.0::DOUBLE AS q FROM ldt GROUP BY 1)"


def _labels(t):
    return t.labels.select("doc_id", F.col("quality").alias("y"))


def _labelled_terms(t):
    """Counts of the labelled documents, the rows a classifier is fitted on."""
    docs = t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    return V.doc_term(docs.select("doc_id", T.words("text").alias("w")), "w", "doc_id")


@query("log_count_ratio", f"WITH {_LAB}, {_sums('n')} SELECT term, round(ln((p / (n1 + 1)) / (q / (n0 + 1))), 9) AS r FROM pq, sz")
def _(t):
    return C.log_count_ratio(_labelled_terms(t), _labels(t)).withColumn("r", F.round("r", 9))


@query("interpolate_ratio", f"""
    WITH {_LAB}, {_sums('n')}, r AS (SELECT term, ln((p / (n1 + 1)) / (q / (n0 + 1))) AS r FROM pq, sz)
    SELECT term, round(0.75::DOUBLE * (SELECT avg(r) FROM r) + 0.25::DOUBLE * r, 9) AS w FROM r""")
def _(t):
    weights = C.log_count_ratio(_labelled_terms(t), _labels(t)).select("term", F.col("r").alias("w"))
    return C.interpolate_weights(weights, 0.25).select("term", F.round("w", 9).alias("w"))


@query("log_count_ratio_one_vs_rest", f"""
    WITH {_LAB}, {_sums('1')} SELECT term, CAST(1 AS INTEGER) AS "class", round(ln((p / n1) / (q / n0)), 9) AS r FROM pq, sz
    UNION ALL SELECT term, 0, round(ln((q / n0) / (p / n1)), 9) FROM pq, sz""")
def _(t):
    return C.one_vs_rest_ratios(_labelled_terms(t), _labels(t), 2).withColumn("r", F.round("r", 9))


@query("log_count_ratio_share", f"""
    WITH {_LAB}, {_sums('n')}, tot AS (SELECT sum(p) AS tp, sum(q) AS tq FROM pq)
    SELECT term, round(ln((p / tp) / (q / tq)), 9) AS r FROM pq, tot""")
def _(t):
    return C.log_count_ratio(_labelled_terms(t), _labels(t), smoothing="share").withColumn("r", F.round("r", 9))


def _nb_sql(expr):
    return f"""{_LAB}, {_sums(expr)}, r AS (SELECT term, ln((p / (n1 + 1)) / (q / (n0 + 1))) AS r FROM pq, sz),
    sc AS (SELECT doc_id, sum({expr} * r) AS s FROM ldt JOIN r USING (term) GROUP BY 1)"""


@query("naive_bayes", f"""
    WITH {_nb_sql('n')} SELECT doc_id, round(coalesce(s, 0) + ln(n1 / n0), 6) AS score, CAST(coalesce(s, 0) + ln(n1 / n0) > 0 AS INTEGER) AS pred
    FROM labels LEFT JOIN sc USING (doc_id), sz""")
def _(t):
    terms, labels = cut_lineage(_labelled_terms(t)), _labels(t)
    out = C.naive_bayes_predict(terms, C.log_count_ratio(terms, labels), C.class_prior(labels), labels)
    return out.withColumn("score", F.round("score", 6))


@query("naive_bayes_binary_accuracy", f"""
    WITH {_nb_sql('1')} SELECT round(avg(CASE WHEN (coalesce(s, 0) + ln(n1 / n0) > 0) = (quality = 1) THEN 1.0 ELSE 0.0 END), 9) AS accuracy
    FROM labels LEFT JOIN sc USING (doc_id), sz""")
def _(t):
    from fernwick.operators.evaluate import accuracy

    terms, labels = cut_lineage(V.binarize(_labelled_terms(t))), _labels(t)
    out = C.naive_bayes_predict(terms, C.log_count_ratio(terms, labels), C.class_prior(labels), labels)
    return out.join(labels, "doc_id").agg(F.round(accuracy("pred", "y"), 9).alias("accuracy"))


@query("nb_features", f"""
    WITH {_LAB}, {_sums('1')}, r AS (SELECT term, ln((p / n1) / (q / n0)) AS r FROM pq, sz),
    x AS (SELECT doc_id, sum(0.4::DOUBLE * r / 10.0::DOUBLE) AS x1 FROM ldt JOIN r USING (term) GROUP BY 1)
    SELECT doc_id, round(1 / (1 + exp(2 * x1)), 6) AS p0, round(1 / (1 + exp(-2 * x1)), 6) AS p1 FROM x""")
def _(t):
    terms, labels = cut_lineage(_labelled_terms(t)), _labels(t)
    out = C.nb_softmax(terms, C.one_vs_rest_ratios(terms, labels, 2), 2)
    return out.select("doc_id", F.round("p0", 6).alias("p0"), F.round("p1", 6).alias("p1"))


def _fitted(t):
    docs = t.documents.join(_labels(t), "doc_id")
    # The tokens are read by each fitting step.
    docs = cut_lineage(docs.select("doc_id", "y", F.transform(T.words("text"), F.lower).alias("w")))
    model, rows = C.term_features(docs, "w", TERMS)
    return model, rows, C.logistic_regression(rows, "y", C=0.1)


@query("logistic_regression")
def _(t):
    _, rows, lr = _fitted(t)
    return lr.transform(rows).select("doc_id", "y", F.col("prediction").cast("int").alias("pred"))


@query("interpolate_weights")
def _(t):
    model, rows, lr = _fitted(t)
    # One weight per term of a vocabulary of at most TERMS terms.
    weights = t.spark.createDataFrame(list(zip(model.vocabulary, map(float, lr.coefficients.toArray()))), "term string, w double")
    mixed = C.interpolate_weights(weights, 0.25)
    terms = V.binarize(V.doc_term(rows.select("doc_id", "w"), "w", "doc_id"))
    return C.naive_bayes_predict(terms, mixed.withColumnRenamed("w", "r"), float(lr.intercept), rows)


# ---------------------------------------------------------------- streams and next tokens


@query("lm_stream", f"""
    WITH {_STREAM}, k AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + 3 AS id FROM st WHERE token <> '<eos>' GROUP BY 1
                          ORDER BY count(*) DESC, token LIMIT {VOCAB}),
    z AS (SELECT pos, CASE WHEN token = '<eos>' THEN 2 ELSE coalesce(id, 3) END AS id FROM st LEFT JOIN k USING (token)),
    nb AS (SELECT count(*) // 8 AS nb FROM z)
    SELECT a.pos // nb AS col, a.pos % nb AS "row", (a.pos % nb) // 20 AS "window", CAST(a.id AS BIGINT) AS id, CAST(b.id AS BIGINT) AS target
    FROM z a JOIN z b ON b.pos = a.pos + 1, nb WHERE a.pos < nb * 8 AND a.pos % nb < nb - 1""")
def _(t):
    vocab = V.build_vocab(_tokens(t), VOCAB, 0)
    # The id sequences are read several times.
    ids = cut_lineage(V.numericalize_docs(_docs(t), "w", vocab, "doc_id", append=2))
    return V.lm_stream(ids, "ids", "doc_id", bs=8, bptt=20)


@query("lm_stream_backwards", f"""
    WITH {_STREAM}, z AS (SELECT pos, length(token) AS id FROM st), nb AS (SELECT count(*) // 8 AS nb FROM z)
    SELECT a.pos // nb AS col, nb - 1 - a.pos % nb AS "row", (nb - 1 - a.pos % nb) // 20 AS "window", CAST(a.id AS INTEGER) AS id, CAST(b.id AS INTEGER) AS target
    FROM z a JOIN z b ON b.pos = a.pos - 1, nb WHERE a.pos < nb * 8 AND nb - 1 - a.pos % nb < nb - 1""")
def _(t):
    ids = cut_lineage(t.documents.select("doc_id", F.transform(
        F.concat(T.words("text"), F.array(F.lit("<eos>"))), F.length).alias("ids")))
    return V.lm_stream(ids, "ids", "doc_id", bs=8, bptt=20, backwards=True)


@query("stream_windows", rf"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents), s AS (SELECT w, sum(len(w)) OVER (ORDER BY doc_id) - len(w) AS start FROM d WHERE len(w) > 0),
    st AS (SELECT CAST(start + i AS BIGINT) AS pos, w[i + 1] AS token FROM (SELECT start, w, unnest(range(len(w))) AS i FROM s)),
    k AS (SELECT pos, list(token) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS items, lead(token, 8) OVER (ORDER BY pos) AS "next" FROM st)
    SELECT pos, array_to_string(items, ' ') AS items, "next" FROM k WHERE pos % 8 = 0 AND "next" IS NOT NULL""")
def _(t):
    return V.stream_windows(_docs(t), "w", "doc_id", 8, 8).withColumn("items", F.array_join("items", " "))


def _draw(what):
    return f"((CAST('0x' || substr(md5('windows|{what}|' || k), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {float(1 << 52)}::DOUBLE)"


@query("lm_stream_drawn", f"""
    WITH {_STREAM}, z AS (SELECT pos, length(token) AS id FROM st), nb AS (SELECT count(*) // 8 AS nb FROM z),
    g AS (SELECT unnest(range(nb // 20 - 1)) AS k, nb FROM nb),
    l AS (SELECT k, nb, CASE WHEN k = 0 THEN 45 ELSE greatest(5, CAST(trunc(CASE WHEN {_draw('half')} < 0.95::DOUBLE THEN 20.0::DOUBLE ELSE 10.0::DOUBLE END
          + 5 * sqrt(-2 * ln({_draw('radius')})) * cos({_draw('angle')} * (2 * pi()))) AS BIGINT)) END AS n FROM g),
    b AS (SELECT k, nb, n, CAST(sum(n) OVER (ORDER BY k) - n AS BIGINT) AS start FROM l),
    r AS (SELECT k, start, unnest(range(start, least(start + n, nb - 1))) AS "row" FROM b WHERE start < nb - 1)
    SELECT a.pos // nb AS col, "row", k AS "window", "row" - start AS place, CAST(a.id AS INTEGER) AS id, CAST(b.id AS INTEGER) AS target
    FROM nb, z a JOIN z b ON b.pos = a.pos + 1 JOIN r ON r."row" = a.pos % (SELECT nb FROM nb) WHERE a.pos < nb * 8""")
def _(t):
    ids = cut_lineage(t.documents.select("doc_id", F.transform(
        F.concat(T.words("text"), F.array(F.lit("<eos>"))), F.length).alias("ids")))
    return V.lm_stream_drawn(ids, "ids", "doc_id", bs=8, bptt=20)


@query("bow_rows", f"""
    WITH {_DT}, k AS (SELECT term, row_number() OVER (ORDER BY term) AS t FROM (SELECT DISTINCT term FROM dt)),
    g AS (SELECT doc_id, list(t ORDER BY t) AS t, list(n ORDER BY t) AS n FROM dt JOIN k USING (term) GROUP BY 1),
    c AS (SELECT doc_id, coalesce(t, [])[greatest(coalesce(len(t), 0) - 99, 1):] AS t, coalesce(n, [])[greatest(coalesce(len(n), 0) - 99, 1):] AS n FROM documents LEFT JOIN g USING (doc_id)),
    p AS (SELECT *, list_transform(range(100 - len(t)), lambda i: 0) AS z FROM c)
    SELECT doc_id, array_to_string(list_concat(z, t), ' ') AS terms, array_to_string(list_concat(z, n), ' ') AS counts, CAST(len(t) AS INTEGER) AS length FROM p""")
def _(t):
    rows = V.bow_rows(_terms(t), "doc_id", 100, t.documents)
    return rows.select("doc_id", *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("terms", "counts")], "length")


_CTX = rf"""w AS (SELECT {WORDS} AS w FROM documents), x AS (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2),
    c AS (SELECT w[i] || ' ' || w[i + 1] AS context, w[i + 2] AS "next", count(*) AS n FROM x GROUP BY ALL)"""


@query("ngram_next_token", f"""
    WITH {_CTX} SELECT context, "next", n, CAST(1 AS INTEGER) AS place FROM c
    QUALIFY row_number() OVER (PARTITION BY context ORDER BY n DESC, "next") = 1""")
def _(t):
    return C.next_tokens(C.context_counts(_docs(t), "w", 2))


@query("continue_text", f"""
    WITH RECURSIVE {_CTX}, b AS (SELECT context, "next" FROM c QUALIFY row_number() OVER (PARTITION BY context ORDER BY n DESC, "next") = 1),
    g AS (SELECT item_id, ({WORDS})[1:2] AS w, 0 AS step FROM benchmark
          UNION ALL SELECT item_id, CASE WHEN "next" IS NULL THEN g.w ELSE list_append(g.w, "next") END, step + 1
          FROM g LEFT JOIN b ON context = array_to_string(g.w[len(g.w) - 1:], ' ') WHERE step < 5)
    SELECT item_id, array_to_string(w, ' ') AS text FROM g WHERE step = 5""")
def _(t):
    best = C.next_tokens(C.context_counts(_docs(t), "w", 2))
    seeds = t.benchmark.select("item_id", A.truncate(T.words("text"), 2).alias("w"))
    return C.continue_text(seeds, best, "w", 2, 5).select("item_id", F.array_join("w", " ").alias("text"))


@query("perplexity", f"""
    WITH {_CTX}, s AS (SELECT context, sum(n) AS m FROM c GROUP BY 1), v AS (SELECT count(DISTINCT "next") AS v FROM c)
    SELECT round(exp(sum(-ln((n + 1.0::DOUBLE) / (m + v)) * n) / sum(n)), 4) AS perplexity FROM c JOIN s USING (context), v""")
def _(t):
    return C.perplexity(C.context_counts(_docs(t), "w", 2)).withColumn("perplexity", F.round("perplexity", 4))
