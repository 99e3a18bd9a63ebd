"""SQL counterparts of the queries, written independently of the Spark code."""

from __future__ import annotations

from lexigrain import fixed_values as V
from lexigrain.functions.expressions import NOT_SPACE
from lexigrain.plans.registry import LEXICON, MARK_PHRASES, SENTIMENT_PHRASES

L = r"\p{L}\p{N}_"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words_in(words) -> str:
    return "(" + ", ".join(text(w) for w in words) + ")"


def r6(name: str, expr: str | None = None) -> str:
    return f"round({expr or name}, 6) + 0.0 AS {name}"


def phrase(column: str, lang: str, phrases: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {lang} = {text(k)} THEN {text(v)}" for k, v in phrases.items())
    return f"{column} || CASE {cases} ELSE '' END"


# ------------------------------------------------------------------------ text functions
def contracted(x: str) -> str:
    rules = []
    for short, long in V.CONTRACTIONS:
        # A rule with letters before "n't" stands for a word of its own.
        start, end = (r"\b" if short[0].isalpha() and short != "n't" else ""), r"\b"
        rules.append((start + short.replace("'", "['’]") + end, long))
    for pattern, long in rules:
        x = f"regexp_replace({x}, {text('(?i)' + pattern)}, {text(long)}, 'g')"
    return x


def unescaped(x: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<")):
        x = f"replace({x}, '&{name};', {text(char)})"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


#: What the references appended to every page stand for, by the HTML standard.
RESOLVED = " 😂😂 😂 \U000f4240 \U0010fffd||\ufffd ©x &bogus; \ufffd –"


def no_links(x: str) -> str:
    x = f"regexp_replace({x}, {text(f'(?i)(https?://|www[.])[{NOT_SPACE}]+')}, ' ', 'g')"
    return f"regexp_replace({x}, {text(f'@[{L}]+')}, ' ', 'g')"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {text(f'[^{NOT_SPACE}]+')}), lambda w: w <> '')"


def classified(x: str) -> str:
    x = f"replace({no_links(contracted(f'lower({unescaped(x)})'))}, '#', ' ')"
    # Twice, because neighbouring matches share the character between them.
    for _ in range(2):
        x = f"regexp_replace({x}, {text(f'(^|[^{L}])911([^{L}]|$)')}, '\\1 nineoneone \\2', 'g')"
    x = f"regexp_replace({x}, '\\p{{Nd}}+', ' ', 'g')"
    x = f"regexp_replace(translate({x}, {text(V.PUNCTUATION)}, ''), '[^\\x00-\\x7F]+', '', 'g')"
    kept = f"list_filter({tokens(x)}, lambda w: w NOT IN {words_in(V.STOP_WORDS)})"
    named = f"list_transform({kept}, lambda w: CASE WHEN w = 'nineoneone' THEN '911' ELSE w END)"
    return f"coalesce(array_to_string({named}, ' '), '')"


def light(x: str) -> str:
    x = f"replace({no_links(contracted(unescaped(x)))}, '#', '')"
    return f"trim(regexp_replace({x}, {text(f'[^{NOT_SPACE}]+')}, ' ', 'g'))"


def counted(x: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {text(pattern)})) AS INTEGER)"


def marker_columns(x: str) -> dict[str, str]:
    return {
        "url_count": counted(x, f"(?i)(https?://|www[.])[{NOT_SPACE}]+"),
        "mention_count": counted(x, f"@[{L}]+"),
        "hashtag_count": counted(x, "#"),
        "exclamation_count": counted(x, "!"),
        "question_count": counted(x, r"\?"),
        "digit_count": counted(x, r"[\p{Nd}²³¹]"),
        "contains_911": f"CAST(regexp_matches({x}, {text(f'(^|[^{L}])911([^{L}]|$)')}) AS INTEGER)",
        "emoji_like_count": counted(x, r"[^\x00-\x7F]"),
    }


def named_columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


DISTINCT_RATIO = "len(list_distinct({t})) / greatest(1, len({t}))"
MARKED = (
    "marked AS (SELECT doc_id AS id, source AS keyword, lang AS location, "
    f"{phrase('text', 'lang', MARK_PHRASES)} AS text FROM documents)"
)
CATEGORY = f"CASE target WHEN 0 THEN {text(V.CATEGORY_NAMES[0])} WHEN 1 THEN {text(V.CATEGORY_NAMES[1])} END"
CORPUS = (
    "corpus AS (SELECT doc_id AS id, source AS keyword, lang AS location, text, quality AS target "
    "FROM documents JOIN labels USING (doc_id))"
)
PARTLY = (
    "corpus AS (SELECT doc_id AS id, source AS keyword, lang AS location, text, quality AS target "
    "FROM documents LEFT JOIN labels USING (doc_id))"
)
EITHER = (
    "corpus AS (SELECT doc_id AS id, source AS keyword, lang AS location, text, quality AS target "
    "FROM documents FULL JOIN labels USING (doc_id))"
)
CLEAN = f"{CORPUS}, clean AS MATERIALIZED (SELECT id, keyword, target, text, {classified('text')} AS clean_text FROM corpus)"
LOWER_TOKENS = tokens("lower(text)")
FEATURES = (
    f"{MARKED}, base AS MATERIALIZED (SELECT id, keyword, location, text, quality AS target, "
    f"{classified('text')} AS clean_text, {LOWER_TOKENS} AS lt FROM marked JOIN labels ON id = doc_id), "
    "features AS MATERIALIZED (SELECT id, keyword, location, text, target, clean_text, length(text) AS char_count, "
    f"len({tokens('text')}) AS word_count, len({tokens('clean_text')}) AS clean_word_count, "
    f"{DISTINCT_RATIO.format(t='lt')} AS unique_word_ratio, {named_columns(marker_columns('text'))}, "
    "CAST(keyword IS NOT NULL AS INTEGER) AS keyword_present, "
    "CAST(location IS NOT NULL AS INTEGER) AS location_present FROM base)"
)

ALL_FEATURES = FEATURES.replace("FROM marked JOIN labels", "FROM marked LEFT JOIN labels")


# ---------------------------------------------------------------------------- sentiment
def values(table: dict[str, float]) -> str:
    return ", ".join(f"({text(k)}, CAST({v!r} AS DOUBLE))" for k, v in table.items())


def case_of(expr: str, table: dict[str, float]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {text(k)} THEN CAST({v!r} AS DOUBLE)" for k, v in table.items()) + " END"


def spelled_emojis(x: str) -> str:
    for emoji, words in LEXICON.emojis.items():
        x = f"replace({x}, {text(emoji)}, chr(1) || {text(words)})"
    return f"replace(regexp_replace({x}, '(^| )\\x01', '\\1', 'g'), chr(1), ' ')"


def stripped(word: str) -> str:
    core = f"trim({word}, {text(V.PUNCTUATION)})"
    return f"CASE WHEN length({core}) <= 2 THEN {word} ELSE {core} END"


def upper_only(word: str) -> str:
    return f"(upper({word}) = {word} AND lower({word}) <> {word})"


def sentiment_ctes(source: str) -> str:
    """From ``source(id, text…)`` to ``scores`` and ``counts``, one row per id."""
    lags = ", ".join(
        [f"lag(low, {k}) OVER w AS low{k}, lag(val, {k}) OVER w AS val{k}, lag(tok, {k}) OVER w AS tok{k}, "
         f"lag(boost, {k}) OVER w AS boost{k}" for k in (1, 2, 3)]
        + [f"lead(low, {k}) OVER w AS next{k}" for k in (1, 2)]
        + ["lead(val, 1) OVER w AS nextval"]
    )
    negators = words_in(LEXICON.negators)

    def negates(k: int) -> str:
        return f"(low{k} IN {negators} OR contains(low{k}, 'n''t'))"

    def never(k: int) -> str:
        if k == 2:
            return "(low2 = 'never' AND low1 IN ('so', 'this'))"
        return "((low3 = 'never' AND low2 IN ('so', 'this')) OR low1 IN ('so', 'this'))"

    def doubt(k: int) -> str:
        if k == 2:
            return "(low2 = 'without' AND low1 = 'doubt')"
        return "(low3 = 'without' AND (low2 = 'doubt' OR low1 = 'doubt'))"

    def step(k: int) -> str:
        loud = f"mixed AND {upper_only(f'tok{k}')}"
        sign = f"CASE WHEN v < 0 THEN -boost{k} ELSE boost{k} END"
        amount = f"CASE WHEN {loud} THEN {sign} + CASE WHEN v > 0 THEN {V.CAPS_BOOST} ELSE -{V.CAPS_BOOST} END ELSE {sign} END"
        boosted = f"v + coalesce(({amount}) * {V.DISTANCE_DAMPING[k - 1]}, 0)"
        plain = f"CASE WHEN {negates(k)} THEN ({boosted}) * {V.NEGATION_FACTOR} ELSE {boosted} END"
        if k > 1:
            plain = (
                f"CASE WHEN {never(k)} THEN ({boosted}) * {V.NEVER_FACTOR} WHEN {doubt(k)} THEN {boosted} ELSE {plain} END"
            )
        return f"CASE WHEN low{k} IS NOT NULL AND val{k} IS NULL THEN {plain} ELSE v END"

    def idiom(expr: str) -> str:
        return case_of(expr, dict(LEXICON.idioms))

    one_zero, two_one_zero = "low1 || ' ' || low", "low2 || ' ' || low1 || ' ' || low"
    two_one, three_two_one, three_two = "low2 || ' ' || low1", "low3 || ' ' || low2 || ' ' || low1", "low3 || ' ' || low2"
    forward = [idiom("low || ' ' || next1 || ' ' || next2"), idiom("low || ' ' || next1")]
    backward = [idiom(x) for x in (one_zero, two_one_zero, two_one, three_two_one, three_two)]
    phrases = " + ".join(
        f"coalesce({case_of(x, {p: -V.BOOST for p in V.DAMPENER_PHRASES})}, 0)" for x in (three_two_one, three_two, two_one)
    )
    idioms = (
        f"CASE WHEN low3 IS NOT NULL AND val3 IS NULL THEN coalesce({', '.join(forward + backward)}, v) + {phrases} ELSE v END"
    )
    emojis = {
        e: max((LEXICON.valences.get(w, 0.0) for w in d.split()), key=abs) for e, d in LEXICON.emojis.items()
    }
    amp = (
        f"least(len(regexp_extract_all(st, '!')), {V.EXCLAMATION_LIMIT}) * {V.EXCLAMATION_WEIGHT} + "
        f"CASE WHEN q <= 1 THEN 0 WHEN q <= {V.QUESTION_LIMIT} THEN q * {V.QUESTION_WEIGHT} ELSE {V.QUESTION_CEILING} END"
    )
    return f"""
lex(w, val) AS (VALUES {values(dict(LEXICON.valences))}),
boosters(w, boost) AS (VALUES {values(dict(LEXICON.boosters))}),
lighted AS MATERIALIZED (SELECT id, {light('text')} AS st FROM {source}),
plain_words AS (SELECT id, {tokens('st')} AS ws FROM lighted),
spelled_words AS (SELECT id, {tokens(spelled_emojis('st'))} AS ws FROM lighted),
toks AS MATERIALIZED (SELECT id, i, {stripped('word')} AS tok FROM
  (SELECT id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM spelled_words)),
joined AS (SELECT id, i, tok, lower(tok) AS low, lex.val AS val, boosters.boost AS boost
  FROM toks LEFT JOIN lex ON lower(tok) = lex.w LEFT JOIN boosters ON lower(tok) = boosters.w),
texts AS MATERIALIZED (SELECT id, count(*) AS n, count(*) FILTER ({upper_only('tok')}) AS caps,
  min(i) FILTER (low = 'but') AS but FROM joined GROUP BY id),
around AS MATERIALIZED (SELECT *, {lags} FROM joined WINDOW w AS (PARTITION BY id ORDER BY i)),
hits AS (SELECT a.*, t.but, t.caps > 0 AND t.caps < t.n AS mixed FROM around a JOIN texts t USING (id) WHERE val IS NOT NULL),
v0 AS (SELECT *, CASE WHEN low1 = 'no' OR low2 = 'no' OR (low3 = 'no' AND low1 IN ('or', 'nor')) THEN val * {V.NEGATION_FACTOR}
  WHEN low = 'no' AND nextval IS NOT NULL THEN 0 ELSE val END AS v FROM hits),
v1 AS (SELECT * REPLACE (CASE WHEN mixed AND {upper_only('tok')} THEN CASE WHEN v > 0 THEN v + {V.CAPS_BOOST} ELSE v - {V.CAPS_BOOST} END ELSE v END AS v) FROM v0),
v2 AS (SELECT * REPLACE ({step(1)} AS v) FROM v1),
v3 AS (SELECT * REPLACE ({step(2)} AS v) FROM v2),
v4 AS (SELECT * REPLACE ({step(3)} AS v) FROM v3),
v5 AS (SELECT * REPLACE ({idioms} AS v) FROM v4),
v6 AS (SELECT * REPLACE (CASE WHEN low1 = 'least' AND val1 IS NULL AND NOT coalesce(low2 IN ('at', 'very'), false) THEN v * {V.NEGATION_FACTOR} ELSE v END AS v) FROM v5),
v7 AS (SELECT id, CASE WHEN boost IS NOT NULL OR (low = 'kind' AND next1 = 'of') THEN 0 ELSE v END
  * CASE WHEN i < but THEN {V.BUT_BEFORE} WHEN i > but THEN {V.BUT_AFTER} ELSE 1 END AS v FROM v6),
sums AS (SELECT id, sum(v) AS s, coalesce(sum(v + 1) FILTER (v > 0), 0) AS up, coalesce(sum(v - 1) FILTER (v < 0), 0) AS down,
  count(*) FILTER (v <> 0) AS moved FROM v7 GROUP BY id),
amped AS (SELECT id, st, {amp} AS amp FROM (SELECT *, len(regexp_extract_all(st, '\\?')) AS q FROM lighted)),
combined AS (SELECT id, coalesce(n, 0) AS n, coalesce(n, 0) - coalesce(moved, 0) AS neutral, coalesce(s, 0) AS s,
  coalesce(up, 0) AS up, abs(coalesce(down, 0)) AS down, amp FROM amped LEFT JOIN texts USING (id) LEFT JOIN sums USING (id)),
pushed AS (SELECT id, n, neutral, CASE WHEN s > 0 THEN s + amp WHEN s < 0 THEN s - amp ELSE s END AS s,
  CASE WHEN up > down THEN up + amp ELSE up END AS up, CASE WHEN up < down THEN down + amp ELSE down END AS down FROM combined),
scores AS MATERIALIZED (SELECT id, CASE WHEN n = 0 THEN 0 ELSE round_even(greatest(-1, least(1, s / sqrt(s * s + {V.NORMALISER}))), 4) + 0.0 END AS compound,
  CASE WHEN n = 0 THEN 0 ELSE round_even(down / (up + down + neutral), 3) END AS negative,
  CASE WHEN n = 0 THEN 0 ELSE round_even(neutral / (up + down + neutral), 3) END AS neutral,
  CASE WHEN n = 0 THEN 0 ELSE round_even(up / (up + down + neutral), 3) END AS positive FROM pushed),
emoji_val(w, val) AS (VALUES {values(emojis)}),
plain_toks AS (SELECT id, {stripped('word')} AS tok FROM (SELECT id, unnest(ws) AS word FROM plain_words)),
lexical AS (SELECT id, coalesce(e.val, a.val, b.val, 0) AS val FROM plain_toks
  LEFT JOIN emoji_val e ON tok = e.w LEFT JOIN lex a ON lower(tok) = a.w
  LEFT JOIN lex b ON trim(lower(tok), {text(V.PUNCTUATION)}) = b.w),
counts AS MATERIALIZED (SELECT lighted.id, CAST(count(*) FILTER (val > 0) AS INTEGER) AS pos_word_count,
  CAST(count(*) FILTER (val < 0) AS INTEGER) AS neg_word_count, CAST(count(*) FILTER (val = 0) AS INTEGER) AS neu_word_count,
  CAST(count(val) AS INTEGER) AS token_count FROM lighted LEFT JOIN lexical USING (id) GROUP BY lighted.id)"""


SENTIMENT_LABEL = (
    f"CASE WHEN compound >= {V.POSITIVE_THRESHOLD} THEN 'positivo' WHEN compound <= {V.NEGATIVE_THRESHOLD} "
    "THEN 'negativo' ELSE 'neutral' END"
)


def sentiment_frame(phrases: bool, everything: bool = False) -> str:
    """CTEs ending in ``sentiment``, of the labelled or of all documents."""
    join = "LEFT JOIN" if everything else "JOIN"
    body = phrase("text", "lang", SENTIMENT_PHRASES) if phrases else "text"
    return (
        f"spoken AS MATERIALIZED (SELECT doc_id AS id, {body} AS text, quality AS target, source AS keyword "
        f"FROM documents {join} labels USING (doc_id)), {sentiment_ctes('spoken')}, "
        "sentiment AS MATERIALIZED (SELECT spoken.*, compound AS sentiment_compound, negative AS sentiment_negative, "
        f"positive AS sentiment_positive, neutral AS sentiment_neutral, {SENTIMENT_LABEL} AS sentiment_label, "
        "CASE WHEN compound < 0 THEN -compound ELSE 0.0 END AS negativity, pos_word_count, neg_word_count, "
        "neu_word_count, token_count FROM spoken JOIN scores USING (id) JOIN counts USING (id))"
    )


def all_scored() -> str:
    return (
        f"spoken AS (SELECT doc_id AS id, {phrase('text', 'lang', SENTIMENT_PHRASES)} AS text FROM documents), "
        f"{sentiment_ctes('spoken')}"
    )


# ------------------------------------------------------------------------------- models
def grams(sizes: tuple[int, ...], source: str, x: str = "clean_text") -> str:
    """CTE bodies listing every n-gram occurrence ``id, target, n, gram``."""
    runs = f"regexp_extract_all({x}, {text(f'[{L}]{{2,}}')})"
    parts = []
    for n in sizes:
        joined = " || ' ' || ".join(f"t[i + {k}]" for k in range(n))
        parts.append(
            f"SELECT id, target, {n} AS n, {joined} AS gram FROM (SELECT id, target, t, "
            f"unnest(range(1, len(t) - {n - 2})) AS i FROM (SELECT *, {runs} AS t FROM {source}))"
        )
    return " UNION ALL ".join(parts)


SPLIT = (
    "sized AS (SELECT target, count(*) AS n FROM corpus GROUP BY target), "
    f"wanted AS (SELECT ceil(round({V.TEST_SHARE} * sum(n), 9)) AS k, sum(n) AS total FROM sized), "
    "ideal AS (SELECT target, k, floor(k * n / total) AS low, k * n / total - floor(k * n / total) AS rest FROM sized, wanted), "
    "quotas AS (SELECT target, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, target) <= k - sum(low) OVER () "
    "THEN 1 ELSE 0 END AS quota FROM ideal), "
    f"placed AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(id AS VARCHAR) || ':{V.SEED}')) AS place FROM corpus), "
    "split AS MATERIALIZED (SELECT id, placed.target, CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split FROM placed JOIN quotas USING (target))"
)
TFIDF = (
    f"{CLEAN}, {SPLIT}, occurrences AS ({grams((1, 2), 'clean')}), "
    "tf AS MATERIALIZED (SELECT id, o.target, split, gram AS term, count(*) AS tf FROM occurrences o JOIN split USING (id) GROUP BY ALL), "
    "train_size AS (SELECT count(*) AS n FROM split WHERE split = 'train'), "
    "vocabulary AS MATERIALIZED (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM (SELECT term, count(*) AS df, sum(tf) AS total "
    "FROM tf WHERE split = 'train' GROUP BY term), train_size "
    f"WHERE df >= {V.MIN_DOCUMENTS} AND df <= {V.MAX_DOCUMENT_SHARE} * n ORDER BY total DESC, term LIMIT {V.MAX_TERMS}), "
    "raw AS (SELECT id, target, split, term, (1 + ln(tf)) * idf AS w FROM tf JOIN vocabulary USING (term)), "
    "weights AS MATERIALIZED (SELECT id, target, split, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw)"
)
NAIVE_BAYES = (
    f"{TFIDF}, per_term AS (SELECT term, coalesce(sum(w) FILTER (target = 0), 0) + {V.NAIVE_BAYES_SMOOTHING} AS w0, "
    f"coalesce(sum(w) FILTER (target = 1), 0) + {V.NAIVE_BAYES_SMOOTHING} AS w1 FROM weights WHERE split = 'train' GROUP BY term), "
    "coefficients AS (SELECT term, ln(w1 / sum(w1) OVER ()) - ln(w0 / sum(w0) OVER ()) AS c FROM per_term), "
    "margins AS (SELECT s.id, s.target, coalesce(sum(w.w * c), 0) AS m FROM split s LEFT JOIN weights w ON s.id = w.id "
    "LEFT JOIN coefficients USING (term) WHERE s.split = 'test' GROUP BY s.id, s.target), "
    "nb AS MATERIALIZED (SELECT id, target AS actual, round(1 / (1 + exp(-m)), 9) AS probability FROM margins)"
)
MAJORITY = (
    "constant AS (SELECT CASE WHEN count(*) FILTER (target = 1) > count(*) FILTER (target = 0) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p "
    "FROM split WHERE split = 'train')"
)
PREDICTED = (
    f"{NAIVE_BAYES}, {MAJORITY}, predictions AS MATERIALIZED (SELECT id, {text(V.NAIVE_BAYES_MODEL)} AS model, actual, "
    "CAST(probability >= 0.5 AS INTEGER) AS predicted, probability FROM nb UNION ALL "
    f"SELECT id, {text(V.BASELINE_MODEL)}, target, CAST(p >= 0.5 AS INTEGER), p FROM split, constant WHERE split = 'test')"
)
CELLS = (
    "cells AS (SELECT model, count(*) FILTER (actual = 0 AND predicted = 0) AS tn, count(*) FILTER (actual = 0 AND predicted = 1) AS fp, "
    "count(*) FILTER (actual = 1 AND predicted = 0) AS fn, count(*) FILTER (actual = 1 AND predicted = 1) AS tp FROM predictions GROUP BY model)"
)
AUC = (
    "auc AS (SELECT a.model, sum(CASE WHEN a.probability > b.probability THEN 1.0 WHEN a.probability = b.probability THEN 0.5 ELSE 0 END) "
    "/ count(*) AS roc_auc FROM predictions a JOIN predictions b ON a.model = b.model AND a.actual = 1 AND b.actual = 0 GROUP BY a.model)"
)


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE ({part}) / ({whole}) END"


METRICS = (
    f"{PREDICTED}, {CELLS}, {AUC}, metrics AS MATERIALIZED (SELECT model, (tn + tp) / (tn + fp + fn + tp) AS accuracy, "
    f"{ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, "
    f"({ratio('2 * tn', '2 * tn + fp + fn')} + {ratio('2 * tp', '2 * tp + fp + fn')}) / 2 AS f1_macro, roc_auc, tn, fp, fn, tp "
    "FROM cells JOIN auc USING (model))"
)
METRIC_COLUMNS = ", ".join(
    [r6(m) for m in ("accuracy", "precision", "recall", "f1", "f1_macro", "roc_auc")] + ["tn", "fp", "fn", "tp"]
)
OUTCOMES = (
    f"{NAIVE_BAYES}, {sentiment_frame(False)}, outcomes AS (SELECT nb.id, actual, CAST(probability >= 0.5 AS INTEGER) AS predicted, "
    "probability, s.text, clean_text, sentiment_label, sentiment_compound, negativity, s.keyword, "
    f"CASE WHEN actual = 0 AND probability >= 0.5 THEN {text(V.FALSE_POSITIVE)} WHEN actual = 1 AND probability < 0.5 "
    f"THEN {text(V.FALSE_NEGATIVE)} ELSE {text(V.CORRECT)} END AS error_type, abs(probability - 0.5) AS confidence "
    "FROM nb JOIN sentiment s USING (id) JOIN clean USING (id))"
)


def median_of(column: str) -> str:
    return f"quantile_cont({column}, 0.5)"


def summary(metrics, stats) -> str:
    forms = {"count": "count({m})", "mean": "avg({m})", "median": "quantile_cont(CAST({m} AS DOUBLE), 0.5)", "std": "stddev_samp({m})"}
    cells = []
    for m in metrics:
        for s in stats:
            expr = forms[s].format(m=m)
            cells.append(f"{expr} AS {m}_{s}" if s == "count" else r6(f"{m}_{s}", expr))
    return ", ".join(cells)


def contrast_sql(source: str, metrics) -> str:
    """Rank-sum statistics per metric from ``source(target, metrics…)``."""
    parts = " UNION ALL ".join(
        f"SELECT {text(m)} AS metric, target, CAST({m} AS DOUBLE) AS value FROM {source} WHERE target IN (0, 1)" for m in metrics
    )
    return (
        f"long AS ({parts}), grouped AS (SELECT metric, value, count(*) FILTER (target = 1) AS n1, count(*) FILTER (target = 0) AS n0 "
        "FROM long GROUP BY ALL), cumulated AS (SELECT *, coalesce(sum(n0) OVER (PARTITION BY metric ORDER BY value "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b0 FROM grouped), "
        "u AS (SELECT metric, CAST(sum(n1) AS BIGINT) AS n_group_1, CAST(sum(n0) AS BIGINT) AS n_group_0, "
        "CAST(sum(n1 * (b0 + n0 / 2)) AS DOUBLE) AS u_statistic, "
        "CAST(sum(pow(n1 + n0, 3) - (n1 + n0)) AS DOUBLE) AS tie_term FROM cumulated GROUP BY metric)"
    )


DELTA = "2 * u_statistic / (n_group_1 * n_group_0) - 1"
MAGNITUDE = (
    "CASE " + " ".join(f"WHEN abs({DELTA}) < {b} THEN {text(n)}" for b, n in V.EFFECT_SIZES) + f" ELSE {text(V.LARGEST_EFFECT)} END"
)


def ranks(alias: str, column: str) -> str:
    """Average rank of a column among the rows of ``pairs``."""
    return f"(rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2) AS {alias}"


def oracles() -> dict[str, str]:
    feature_names = (
        "char_count", "word_count", "clean_word_count", "unique_word_ratio", "url_count", "mention_count", "hashtag_count",
        "exclamation_count", "question_count", "digit_count", "contains_911", "emoji_like_count", "keyword_present", "location_present",
    )
    measures = (
        "sentiment_compound", "negativity", "sentiment_negative", "sentiment_positive", "sentiment_neutral",
        "pos_word_count", "neg_word_count", "neu_word_count", "token_count",
    )
    presence = ("url_count", "mention_count", "hashtag_count", "exclamation_count", "question_count", "contains_911", "emoji_like_count")
    columns = (("id", "bigint"), ("keyword", "string"), ("location", "string"), ("text", "string"), ("target", "int"))
    spoken, all_spoken = sentiment_frame(True), sentiment_frame(True, True)
    extreme = (
        f"{all_spoken}, extremes AS (SELECT * FROM (SELECT *, {text(V.TOP_POSITIVE)} AS extreme FROM sentiment ORDER BY sentiment_compound DESC, id LIMIT 10) "
        f"UNION ALL SELECT * FROM (SELECT *, {text(V.TOP_NEGATIVE)} AS extreme FROM sentiment ORDER BY sentiment_compound, id LIMIT 10))"
    )
    out: dict[str, str] = {}

    out["validate_corpus"] = (
        f"WITH {EITHER} SELECT 'duplicate_ids' AS \"check\", count(*) - count(DISTINCT id) AS violations FROM corpus "
        "UNION ALL SELECT 'unknown_labels', count(*) FILTER (target NOT IN (0, 1)) FROM corpus "
        "UNION ALL SELECT 'missing_labels', CAST(2 - count(DISTINCT target) FILTER (target IN (0, 1)) AS BIGINT) FROM corpus "
        "UNION ALL SELECT 'null_texts', count(*) FILTER (text IS NULL) FROM corpus"
    )
    out["duplicate_rows"] = (
        "SELECT CAST(sum(n) AS BIGINT) AS row_count, 3 AS column_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows "
        "FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source)"
    )
    out["schema_profile"] = f"WITH {PARTLY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count, "
        f"{r6('null_pct', f'100 * (count(*) - count({c})) / count(*)')}, count(DISTINCT {c}) AS distinct_count FROM corpus"
        for c, t in columns
    )
    out["null_rates"] = f"WITH {PARTLY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6('null_pct', f'100 * (count(*) - count({c})) / count(*)')} FROM corpus" for c, _ in columns
    )
    plain = unescaped("html")
    out["html_entities"] = f"SELECT page_id, CAST(length(p) AS INTEGER) AS plain_chars, md5(p) AS plain_md5 FROM (SELECT page_id, {plain} || {text(RESOLVED)} AS p FROM pages)"
    out["contractions"] = f"WITH {MARKED} SELECT id, {contracted('text')} AS expanded FROM marked"
    out["clean_classification"] = f"WITH {MARKED} SELECT id, {classified('text')} AS clean_text FROM marked"
    out["clean_sentiment"] = f"WITH {MARKED} SELECT id, {light('text')} AS sentiment_text FROM marked"
    out["surface_markers"] = f"WITH {MARKED} SELECT id, {named_columns(marker_columns('text'))} FROM marked"
    out["page_url_markers"] = f"SELECT page_id, {named_columns(marker_columns('url'))} FROM pages"
    out["length_features"] = (
        f"WITH {MARKED} SELECT id, CAST(length(text) AS INTEGER) AS char_count, CAST(len({tokens('text')}) AS INTEGER) AS word_count, "
        f"CAST(len({tokens('clean_text')}) AS INTEGER) AS clean_word_count, {r6('unique_word_ratio', DISTINCT_RATIO.format(t='lt'))} "
        f"FROM (SELECT *, {classified('text')} AS clean_text, {LOWER_TOKENS} AS lt FROM marked)"
    )
    negation = "(^|[^{l}])({w})([^{l}]|$)".format(l=L, w="|".join(V.NEGATION_WORDS))
    out["uppercase_repeat_negation"] = (
        f"WITH {MARKED}, words AS (SELECT id, unnest({LOWER_TOKENS}) AS w FROM marked), "
        "repeats AS (SELECT id, max(n) AS n FROM (SELECT id, w, count(*) AS n FROM words GROUP BY ALL) GROUP BY id) "
        f"SELECT id, {r6('uppercase_pct', f'100 * len(regexp_extract_all(text, {text(chr(92) + "p{Lu}")})) / greatest(1, length(text))')}, "
        "CAST(coalesce(n, 0) AS INTEGER) AS max_token_repeats, "
        f"CAST(regexp_matches(text, {text('(?i)' + negation)}) AS INTEGER) AS contains_negation FROM marked LEFT JOIN repeats USING (id)"
    )
    out["decoded_keywords"] = (
        "SELECT doc_id AS id, url_decode(source || '%20' || lang || '+%C3%A9') AS keyword_decoded FROM documents"
    )
    out["label_distribution"] = (
        f"WITH {PARTLY} SELECT * FROM (SELECT target, count(*) AS documents, {CATEGORY} AS category, "
        f"{r6('percent', '100 * count(*) / sum(count(*)) OVER ()')} FROM corpus GROUP BY target) WHERE target IS NOT NULL"
    )
    out["features_by_class"] = f"WITH {FEATURES} SELECT target, {summary(feature_names, ('mean', 'median', 'std'))} FROM features GROUP BY target"
    audit = {
        "documents": "count(*)", "empty_text": "count(*) FILTER (text = '')", "empty_clean_text": "count(*) FILTER (clean_text = '')",
        "mean_words": "avg(word_count)", "mean_clean_words": "avg(clean_word_count)", "with_url": "count(*) FILTER (url_count > 0)",
        "with_mention": "count(*) FILTER (mention_count > 0)", "with_hashtag": "count(*) FILTER (hashtag_count > 0)",
        "with_911": "sum(contains_911)", "clean_with_911": "count(*) FILTER (regexp_matches(clean_text, '\\b911\\b'))",
    }
    out["cleaning_audit"] = f"WITH {ALL_FEATURES} " + " UNION ALL ".join(
        f"SELECT '{k}' AS indicator, round(CAST({v} AS DOUBLE), 6) AS value FROM features" for k, v in audit.items()
    )
    marked_row = "(url_count > 0 OR mention_count > 0 OR hashtag_count > 0 OR contains_911 = 1)"
    out["before_after_examples"] = (
        f"WITH {ALL_FEATURES} SELECT * FROM (SELECT id, target, text, clean_text FROM features WHERE {marked_row} ORDER BY id LIMIT 8) "
        f"UNION ALL SELECT * FROM (SELECT id, target, text, clean_text FROM features WHERE NOT {marked_row} ORDER BY id LIMIT 4)"
    )
    out["marker_rates"] = f"WITH {FEATURES} " + " UNION ALL ".join(
        f"SELECT '{m}' AS marker, target, {r6('percent', f'100 * avg(CAST({m} > 0 AS INTEGER))')}, {CATEGORY} AS category FROM features GROUP BY target"
        for m in presence
    )
    out["top_keywords"] = (
        f"WITH {CORPUS} SELECT target, keyword AS keyword_decoded, n AS frequency FROM (SELECT *, row_number() OVER (PARTITION BY target "
        "ORDER BY n DESC, keyword) AS r FROM (SELECT target, keyword, count(*) AS n FROM corpus GROUP BY target, keyword)) WHERE r <= 15"
    )

    def ngram_table(n: int) -> str:
        return (
            f"WITH {CLEAN}, grams AS ({grams((n,), 'clean')}), kept AS (SELECT target, n, gram, count(*) AS f FROM grams GROUP BY ALL "
            "HAVING count(DISTINCT id) >= 2), ranked AS (SELECT *, f / sum(f) OVER (PARTITION BY target) AS p, "
            "row_number() OVER (PARTITION BY target ORDER BY f DESC, gram) AS r FROM kept) "
            f"SELECT target, n, gram AS ngram, f AS frequency, {r6('probability', 'p')} FROM ranked WHERE r <= 50"
        )

    for name, n in (("unigrams", 1), ("bigrams", 2), ("trigrams", 3)):
        out[name] = ngram_table(n)
    out["discriminative_terms"] = (
        f"WITH {CLEAN}, grams AS ({grams((1,), 'clean')}), kept AS (SELECT target, gram, count(*) AS f FROM grams GROUP BY ALL "
        "HAVING count(DISTINCT id) >= 2), both_classes AS (SELECT coalesce(a.gram, b.gram) AS ngram, coalesce(a.f, 0) AS freq_0, coalesce(b.f, 0) AS freq_1 "
        "FROM (SELECT * FROM kept WHERE target = 0) a FULL JOIN (SELECT * FROM kept WHERE target = 1) b USING (gram)), "
        "totals AS (SELECT sum(freq_0) AS t0, sum(freq_1) AS t1, count(*) AS v FROM both_classes) "
        f"SELECT ngram, freq_0, freq_1, {r6('log2_ratio', 'log2(((freq_1 + 0.5) / (t1 + 0.5 * v)) / ((freq_0 + 0.5) / (t0 + 0.5 * v)))')}, "
        "freq_0 + freq_1 AS total_frequency FROM both_classes, totals WHERE freq_0 + freq_1 >= 8"
    )
    out["stopword_audit"] = (
        f"WITH {CORPUS}, words AS (SELECT DISTINCT id, target, unnest({LOWER_TOKENS}) AS word FROM corpus), "
        "totals AS (SELECT count(*) FILTER (target = 0) AS t0, count(*) FILTER (target = 1) AS t1 FROM words), "
        "counted AS (SELECT word, count(*) FILTER (target = 0) AS n0, count(*) FILTER (target = 1) AS n1 FROM words "
        f"WHERE word IN {words_in(V.STOP_WORDS)} GROUP BY word) SELECT word, n0 AS documents_0, n1 AS documents_1, "
        f"{r6('log2_ratio', 'log2(((n1 + 0.5) / greatest(1, t1)) / ((n0 + 0.5) / greatest(1, t0)))')}, "
        f"word IN {words_in(V.CONTENT_STOP_WORDS)} AS is_content_word FROM counted, totals WHERE n0 + n1 >= {V.MIN_STOP_WORD_DOCUMENTS}"
    )
    out["cloud_weights"] = (
        f"WITH {CLEAN}, grams AS ({grams((1,), 'clean')}), ranked AS (SELECT target, gram, count(*) AS f, "
        "row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, gram) AS r FROM grams GROUP BY target, gram) "
        f"SELECT target, gram AS word, f AS frequency, {r6('weight', 'f / max(f) OVER (PARTITION BY target)')} FROM ranked WHERE r <= 180"
    )
    out["sentiment_word_counts"] = f"WITH {all_scored()} SELECT * FROM counts"
    out["polarity_scores"] = f"WITH {all_scored()} SELECT * FROM scores"
    out["sentiment_labels"] = (
        f"WITH {all_spoken} SELECT id, sentiment_compound, sentiment_label, negativity, token_count FROM sentiment"
    )
    out["sentiment_by_class"] = (
        f"WITH {spoken} SELECT target, l AS sentiment_label, count(*) FILTER (sentiment_label = l) AS documents, "
        f"{r6('percent', '100 * count(*) FILTER (sentiment_label = l) / count(*)')}, {CATEGORY} AS category "
        "FROM sentiment, (VALUES ('negativo'), ('neutral'), ('positivo')) t(l) GROUP BY target, l"
    )
    out["sentiment_observed"] = (
        f"WITH {spoken} SELECT target, sentiment_label, count(*) AS documents, "
        f"{r6('percent', '100 * count(*) / sum(count(*)) OVER (PARTITION BY target)')} FROM sentiment GROUP BY target, sentiment_label"
    )
    out["sentiment_global"] = (
        f"WITH {all_spoken} SELECT sentiment_label, count(*) AS documents, {r6('percent', '100 * count(*) / sum(count(*)) OVER ()')} "
        "FROM sentiment GROUP BY sentiment_label"
    )
    out["sentiment_stats"] = (
        f"WITH {spoken} SELECT target, {summary(measures, ('count', 'mean', 'median', 'std'))}, {CATEGORY} AS category FROM sentiment GROUP BY target"
    )
    out["sentiment_mean_words"] = f"WITH {spoken} " + " UNION ALL ".join(
        f"SELECT {CATEGORY} AS category, {text(n)} AS word_type, {r6('mean_words', f'avg({c})')} FROM sentiment GROUP BY target"
        for c, n in V.WORD_TYPES.items()
    )
    out["extreme_docs"] = (
        f"WITH {extreme} SELECT id, text, target, {CATEGORY} AS category, sentiment_label, sentiment_compound, negativity, "
        "pos_word_count, neg_word_count, extreme FROM extremes"
    )
    out["extremes_composition"] = f"WITH {extreme} SELECT extreme, {CATEGORY} AS category, count(*) AS documents FROM extremes GROUP BY extreme, target"
    shown = {k: v for k, v in marker_columns("text").items() if k in presence[:5]}
    out["extremes_patterns"] = (
        f"WITH {extreme}, words AS (SELECT DISTINCT id, unnest({LOWER_TOKENS}) AS w, text FROM extremes), "
        f"repeats AS (SELECT id, max(n) AS n FROM (SELECT id, w, count(*) AS n FROM (SELECT id, unnest({LOWER_TOKENS}) AS w FROM (SELECT DISTINCT id, text FROM extremes)) GROUP BY ALL) GROUP BY id) "
        f"SELECT extreme, id, {CATEGORY} AS category, {r6('sentiment_compound')}, {r6('negativity')}, pos_word_count, neg_word_count, {named_columns(shown)}, "
        f"{r6('uppercase_pct', f'100 * len(regexp_extract_all(text, {text(chr(92) + "p{Lu}")})) / greatest(1, length(text))')}, "
        "CAST(coalesce(n, 0) AS INTEGER) AS max_token_repeats, "
        f"CAST(regexp_matches(text, {text('(?i)' + negation)}) AS INTEGER) AS contains_negation FROM extremes LEFT JOIN repeats USING (id)"
    )
    spearman = "corr(rx, ry)"
    audit_values = {
        "minimum": "min(negativity)", "maximum": "max(negativity)", "mean": "avg(negativity)", "median": "quantile_cont(negativity, 0.5)",
        "std": "stddev_samp(negativity)", "zero_documents": "count(*) FILTER (negativity = 0)",
        "zero_pct": "100 * count(*) FILTER (negativity = 0) / count(*)",
    }
    out["negativity_audit"] = (
        f"WITH {all_spoken} "
        + " UNION ALL ".join(f"SELECT '{k}' AS indicator, round(CAST({v} AS DOUBLE), 9) + 0.0 AS value FROM sentiment" for k, v in audit_values.items())
        + "".join(
            f" UNION ALL SELECT '{k}', round({spearman}, 9) + 0.0 FROM (SELECT {ranks('rx', 'negativity')}, {ranks('ry', c)} FROM sentiment WHERE {c} IS NOT NULL)"
            for k, c in (("spearman_negative", "sentiment_negative"), ("spearman_target", "target"))
        )
    )
    edges = list(zip(V.NEGATIVITY_EDGES, V.NEGATIVITY_EDGES[1:]))
    bins = "CASE " + " ".join(f"WHEN negativity > {a} AND negativity <= {b} THEN '({a}, {b}]'" for a, b in edges) + " END"
    out["negativity_ranges"] = (
        f"WITH {spoken} SELECT {bins} AS range, {CATEGORY} AS category, count(*) AS documents, "
        f"{r6('percent', '100 * count(*) / sum(count(*)) OVER (PARTITION BY target)')} FROM sentiment GROUP BY 1, target"
    )
    returned = (
        "returned AS (SELECT CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 END AS target, l_extendedprice, l_quantity FROM lineitem)"
    )
    out["cliffs_delta"] = (
        f"WITH {returned}, {contrast_sql('returned', ('l_extendedprice', 'l_quantity'))} "
        f"SELECT metric, {r6('cliffs_delta', DELTA)}, {MAGNITUDE} AS magnitude FROM u"
    )
    contrast_metrics = ("negativity", "sentiment_negative", "sentiment_compound")
    centre = (
        "centre AS (SELECT metric, avg(value) FILTER (target = 1) AS m1, avg(value) FILTER (target = 0) AS m0, "
        "quantile_cont(value, 0.5) FILTER (target = 1) AS d1, quantile_cont(value, 0.5) FILTER (target = 0) AS d0 FROM long GROUP BY metric)"
    )
    out["group_contrast"] = (
        f"WITH {spoken}, {contrast_sql('sentiment', contrast_metrics)}, {centre}, {TAILS} SELECT metric, n_group_1, n_group_0, "
        f"{r6('mean_group_1', 'm1')}, {r6('mean_group_0', 'm0')}, {r6('median_group_1', 'd1')}, {r6('median_group_0', 'd0')}, "
        f"{r6('mean_difference', 'm1 - m0')}, {r6('median_difference', 'd1 - d0')}, {r6('u_statistic')}, {P_VALUES}, {r6('cliffs_delta', DELTA)}, "
        f"{MAGNITUDE} AS magnitude FROM zs JOIN centre USING (metric)"
    )
    clicked = "SELECT 'value' AS metric, CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS target, value FROM events WHERE event_type IN ('click', 'purchase')"
    sold = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS target, CAST({name} AS DOUBLE) AS value FROM lineitem WHERE l_returnflag IN ('R', 'N')"
        for name in ("l_extendedprice", "l_quantity")
    )
    for name, source in (("bootstrap_checked", clicked), ("bootstrap_checked_wide", sold)):
        of = "{f}(value{q}) FILTER (target = {k})"
        halves = [[of.format(f=f, q=q, k=k) for k in (1, 0)] for f, q in (("count", ""), ("avg", ""), ("quantile_cont", ", 0.5"))]
        out[name] = (
            f"SELECT metric, {halves[0][0]} AS n_group_1, {halves[0][1]} AS n_group_0, {r6('mean_difference', ' - '.join(halves[1]))}, "
            f"{r6('median_difference', ' - '.join(halves[2]))}, true AS mean_inside, true AS median_inside, true AS width_as_expected "
            f"FROM ({source}) GROUP BY metric"
        )
    out["spearman"] = (
        f"SELECT {r6('correlation', spearman)} FROM (SELECT {ranks('rx', 'l_quantity')}, {ranks('ry', 'l_extendedprice')} FROM lineitem)"
    )
    out["stratified_split"] = f"WITH {CORPUS}, {SPLIT} SELECT id, target, split FROM split"
    out["split_summary"] = (
        f"WITH {CORPUS}, {SPLIT} SELECT split, count(*) AS documents, CAST(sum(target) AS BIGINT) AS positives, "
        f"{r6('positive_pct', '100 * avg(target)')} FROM split GROUP BY split"
    )
    out["tfidf_weights"] = f"WITH {TFIDF} SELECT id, term, {r6('weight', 'w')} FROM weights"
    out["majority_baseline"] = (
        f"WITH {CORPUS}, {SPLIT}, {MAJORITY} SELECT id, target AS actual, p AS probability FROM split, constant WHERE split = 'test'"
    )
    out["complement_nb"] = (
        f"WITH {NAIVE_BAYES} SELECT id, actual, CAST(probability >= 0.5 AS INTEGER) AS predicted, {r6('probability')} FROM nb"
    )
    out["confusion_long"] = f"WITH {PREDICTED}, {CELLS} " + " UNION ALL ".join(
        f"SELECT model, {a} AS actual, {p} AS predicted, {c} AS documents FROM cells"
        for c, a, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    )
    out["model_metrics"] = f"WITH {METRICS} SELECT model, {METRIC_COLUMNS} FROM metrics"
    out["roc_auc"] = f"WITH {PREDICTED}, {AUC} SELECT model, {r6('roc_auc')} FROM auc"
    out["roc_points"] = (
        f"WITH {PREDICTED}, steps AS (SELECT model, probability AS v, count(*) FILTER (actual = 1) AS n1, count(*) FILTER (actual = 0) AS n0 "
        "FROM predictions GROUP BY ALL), walked AS (SELECT *, sum(n1) OVER d AS c1, sum(n0) OVER d AS c0, sum(n1) OVER (PARTITION BY model) AS t1, "
        "sum(n0) OVER (PARTITION BY model) AS t0, lead(n1) OVER d AS x1, lead(n0) OVER d AS x0, row_number() OVER d AS r FROM steps "
        "WINDOW d AS (PARTITION BY model ORDER BY v DESC)) "
        f"SELECT model, {r6('fpr', 'c0 / t0')}, {r6('tpr', 'c1 / t1')}, {r6('threshold', 'v')} FROM walked WHERE r = 1 OR x1 IS NULL OR x1 <> n1 OR x0 <> n0 "
        "UNION ALL SELECT DISTINCT model, 0.0::DOUBLE, 0.0::DOUBLE, 'inf'::DOUBLE FROM walked"
    )
    compared = ("accuracy", "precision", "recall", "f1", "f1_macro", "roc_auc", "tn", "fp", "fn", "tp")
    difference = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST(a.{m} AS DOUBLE) AS x, CAST(b.{m} AS DOUBLE) AS y, CAST({1 if m not in ('fp', 'fn') else -1} AS INTEGER) AS good FROM a, b"
        for m in compared
    )
    out["ab_differences"] = (
        f"WITH {METRICS}, a AS (SELECT * FROM metrics WHERE model = {text(V.BASELINE_MODEL)}), b AS (SELECT * FROM metrics WHERE model = {text(V.NAIVE_BAYES_MODEL)}), "
        f"pairs AS ({difference}) SELECT metric, {r6('model_a', 'x')}, {r6('model_b', 'y')}, {r6('difference', 'y - x')}, "
        f"CASE WHEN (y - x) * good > 0 THEN '{V.BETTER}' WHEN (y - x) * good < 0 THEN '{V.WORSE}' ELSE '{V.SAME}' END AS direction FROM pairs"
    )
    numbered = METRICS.replace(PREDICTED, with_numeric_model())
    out["model_catalogue"] = (
        f"WITH {numbered} SELECT model, {METRIC_COLUMNS}, CASE WHEN model = {text(V.MODEL_B)} THEN '{V.FAMILY_SECOND}' "
        f"ELSE '{V.FAMILY_FIRST}' END AS family, model = {text(V.MODEL_B)} AS uses_negativity FROM metrics"
    )
    for name, tolerance in (("model_selection", V.F1_TOLERANCE), ("model_selection_tied", 1.0)):
        out[name] = (
            f"WITH {METRICS}, best AS (SELECT max(f1) AS f FROM metrics), rivals AS (SELECT model, f1, roc_auc, "
            "row_number() OVER (ORDER BY roc_auc DESC, f1 DESC, model) AS r, count(*) OVER () AS k, "
            f"lead(roc_auc) OVER (ORDER BY roc_auc DESC, f1 DESC, model) AS second FROM metrics, best WHERE f1 >= f - {tolerance}), "
            f"below AS (SELECT max(f1) AS f FROM metrics WHERE f1 < (SELECT f FROM best) - {tolerance}) "
            f"SELECT model, CASE WHEN k = 1 THEN printf('F1 %.6f leads the next model by %.6f, more than {tolerance}', best.f, best.f - below.f) "
            f"ELSE printf('%d models lie within {tolerance} of the best F1; ROC-AUC %.6f is the highest of them, by %.6f', "
            "k, roc_auc, roc_auc - second) END AS reason FROM rivals, best, below WHERE r = 1"
        )
    out["error_table"] = (
        f"WITH {OUTCOMES} SELECT id, error_type, text, clean_text, actual, predicted, {r6('probability')}, sentiment_label, "
        f"{r6('sentiment_compound')}, {r6('negativity')}, keyword FROM (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY confidence DESC, id) AS r "
        f"FROM outcomes WHERE error_type <> '{V.CORRECT}') WHERE r <= 15"
    )
    out["hit_profile"] = (
        f"WITH {OUTCOMES} SELECT sentiment_label, count(*) AS cases, count(*) FILTER (actual = predicted) AS hits, "
        f"{r6('mean_negativity', 'avg(negativity)')}, {r6('mean_probability', 'avg(probability)')}, "
        f"{r6('hit_rate', 'count(*) FILTER (actual = predicted) / count(*)')} FROM outcomes GROUP BY sentiment_label"
    )
    out["errors_by_sentiment"] = (
        f"WITH {OUTCOMES} SELECT error_type, sentiment_label, count(*) AS cases FROM outcomes WHERE error_type <> '{V.CORRECT}' GROUP BY ALL"
    )
    out["histogram_by_class"] = (
        f"WITH {FEATURES}, span AS (SELECT min(char_count) AS lo, (max(char_count) - min(char_count)) / 35 AS wd FROM features), "
        "placed AS (SELECT target, least(floor((char_count - lo) / wd), 34) AS bin FROM features, span), "
        "filled AS (SELECT target, b AS bin, count(*) FILTER (bin = b) AS n, count(*) AS t FROM placed, range(35) r(b) GROUP BY ALL) "
        f"SELECT target, CAST(bin AS INTEGER) AS bin, {r6('bin_start', 'lo + bin * wd')}, n AS documents, {r6('density', 'n / (t * wd)')} FROM filled, span"
    )
    out["box_stats"] = (
        f"WITH {FEATURES}, boxes AS (SELECT target, quantile_cont(CAST(word_count AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(word_count AS DOUBLE), 0.5) AS median, "
        "quantile_cont(CAST(word_count AS DOUBLE), 0.75) AS q3 FROM features GROUP BY target) "
        f"SELECT target, {r6('q1')}, {r6('median')}, {r6('q3')}, {r6('whisker_low', 'CAST(min(word_count) FILTER (word_count >= q1 - 1.5 * (q3 - q1)) AS DOUBLE)')}, "
        f"{r6('whisker_high', 'CAST(max(word_count) FILTER (word_count <= q3 + 1.5 * (q3 - q1)) AS DOUBLE)')} FROM features JOIN boxes USING (target) GROUP BY target, q1, median, q3"
    )
    out["ecdf"] = (
        f"WITH {spoken} SELECT DISTINCT target, negativity + 0.0 AS value, {r6('proportion', 'cume_dist() OVER (PARTITION BY target ORDER BY negativity)')} FROM sentiment"
    )
    out["kde_grid"] = (
        f"WITH {spoken}, shape AS (SELECT target, count(*) AS n, stddev_samp(sentiment_compound) * pow(count(*), -0.2) AS h, "
        "min(sentiment_compound) AS lo, max(sentiment_compound) AS hi FROM sentiment GROUP BY target), "
        "grid AS (SELECT target, n, h, g AS point, lo - 3 * h + g * (hi - lo + 6 * h) / 199 AS x FROM shape, range(200) r(g)) "
        f"SELECT grid.target, CAST(point AS INTEGER) AS point, {r6('x')}, "
        f"{r6('density', 'sum(exp(-0.5 * pow((x - sentiment_compound) / h, 2))) / (n * h * sqrt(2 * pi()))')} FROM grid JOIN sentiment ON grid.target = sentiment.target GROUP BY ALL"
    ).replace("GROUP BY ALL", "GROUP BY grid.target, point, x, n, h")
    out["mann_whitney"] = mann_whitney_sql()
    out["score_unlabelled"] = out["stream_scores"] = score_unlabelled_sql()
    out["logistic_coefficients"] = reweighted_sql()
    return out


def score_unlabelled_sql() -> str:
    """Naive Bayes of all labelled documents applied to all others, with their sentiment."""
    halves = (
        "split AS MATERIALIZED (SELECT id, target, CASE WHEN target IS NULL THEN 'test' ELSE 'train' END AS split FROM corpus)"
    )
    bayes = NAIVE_BAYES.replace(CORPUS, PARTLY).replace(SPLIT, halves)
    return (
        f"WITH {bayes}, {sentiment_frame(False, True)} SELECT nb.id, clean_text, "
        f"CASE WHEN probability >= {V.DECISION_THRESHOLD} THEN {text(V.CATEGORY_NAMES[1])} ELSE {text(V.CATEGORY_NAMES[0])} END AS predicted_class, "
        f"{r6('probability')}, sentiment_label AS sentiment, {r6('compound', 'sentiment_compound')}, {r6('negativity')} "
        "FROM nb JOIN clean USING (id) JOIN sentiment USING (id)"
    )


def _determinant(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    parts = [f"{row[0]} * ({_determinant([r[1:] for k, r in enumerate(m) if k != at])})" for at, row in enumerate(m)]
    return " ".join(("- " if at % 2 else "+ " if at else "") + part for at, part in enumerate(parts))


def reweighted_steps(columns: tuple[str, ...], steps: int) -> str:
    """``step0`` to ``step<steps>`` with the coefficients b0, b1, …, each system solved by determinants.

    From a table ``rows`` with ``y``, the columns and the class weight ``s``.
    """
    c, x = V.LOGISTIC_C, ("1", *columns)
    size = range(len(x))
    matrix = [[f"h{min(i, j)}{max(i, j)}" for j in size] for i in size]
    whole = _determinant(matrix)
    solved = [f"({_determinant([[f'g{i}' if k == j else matrix[i][k] for k in size] for i in size])}) / ({whole}) AS b{j}" for j in size]
    sums = [f"{c} * sum(w * {x[i]} * {x[j]}){' + 1' if i == j and i else ''} AS h{i}{j}" for i in size for j in size if i <= j]
    sums += [f"{c} * sum(u * {x[i]}) AS g{i}" for i in size]
    line = " + ".join(f"b{i} * {x[i]}" for i in size)
    chain = [f"step0 AS (SELECT {', '.join(f'0.0::DOUBLE AS b{i}' for i in size)})"] + [
        f"step{k + 1} AS (SELECT {', '.join(solved)} FROM (SELECT {', '.join(sums)} FROM (SELECT *, s * p * (1 - p) AS w, "
        f"s * (p * (1 - p) * line + y - p) AS u FROM (SELECT *, 1 / (1 + exp(-line)) AS p FROM "
        f"(SELECT rows.*, {line} AS line FROM rows, step{k})))))"
        for k in range(steps)
    ]
    return ", ".join(chain)


BALANCE = "count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY target)) AS s"


def reweighted_sql(steps: int = 8) -> str:
    rows = (
        f"rows AS MATERIALIZED (SELECT CAST(target AS INTEGER) AS y, ln(1 + char_count) AS a, unique_word_ratio AS b, {BALANCE} FROM features)"
    )
    names = (("intercept", "b0"), ("log_chars", "b1"), ("unique_word_ratio", "b2"))
    last = " UNION ALL ".join(f"SELECT '{name}' AS term, {r6('coefficient', value)} FROM step{steps}" for name, value in names)
    return f"WITH {FEATURES}, {rows}, {reweighted_steps(('a', 'b'), steps)} {last}"


def with_numeric_model(steps: int = 8) -> str:
    """The predictions of the aggregated models and of a logistic regression on negativity."""
    rows = (
        f"rows AS MATERIALIZED (SELECT CAST(target AS INTEGER) AS y, negativity AS a, {BALANCE} "
        "FROM sentiment JOIN (SELECT id, split FROM split) USING (id) WHERE split = 'train')"
    )
    numbered = (
        "numbered AS (SELECT id, target, round(1 / (1 + exp(-(b0 + b1 * negativity))), 9) AS p "
        f"FROM sentiment JOIN (SELECT id, split FROM split) USING (id), step{steps} WHERE split = 'test')"
    )
    plain = PREDICTED.replace("predictions AS MATERIALIZED (", f"{sentiment_frame(False)}, {rows}, {reweighted_steps(('a',), steps)}, {numbered}, predictions AS MATERIALIZED (")
    return plain[:-1] + f" UNION ALL SELECT id, {text(V.MODEL_B)}, target, CAST(p >= 0.5 AS INTEGER), p FROM numbered)"


def _tail(z: str) -> str:
    """Upper normal tail by a rational approximation (error below 1.2e-7), enough for six digits."""
    t = f"(1 / (1 + 0.5 * abs({z}) / sqrt(2)))"
    terms = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    series = " + ".join(f"({c}) * pow({t}, {k})" for k, c in enumerate(terms))
    tail = f"({t} * exp(-{z} * {z} / 2 + {series}))"
    return f"CASE WHEN {z} >= 0 THEN {tail} / 2 ELSE 1 - {tail} / 2 END"


#: Standardised U for both alternatives, from the table u.
TAILS = (
    "spread AS (SELECT *, n_group_1 * n_group_0 / 2 AS mu, "
    "sqrt(n_group_1 * n_group_0 / 12 * (n_group_1 + n_group_0 + 1 - tie_term / ((n_group_1 + n_group_0) * (n_group_1 + n_group_0 - 1.0)))) AS sd FROM u), "
    "zs AS (SELECT *, (u_statistic - mu - 0.5) / sd AS zg, (greatest(u_statistic, n_group_1 * n_group_0 - u_statistic) - mu - 0.5) / sd AS zt FROM spread)"
)
P_VALUES = f"{r6('p_two_sided', 'least(1, 2 * (' + _tail('zt') + '))')}, {r6('p_greater', _tail('zg'))}"


def mann_whitney_sql() -> str:
    source = "flagged AS (SELECT CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 0 END AS target, value FROM events)"
    return (
        f"WITH {source}, {contrast_sql('flagged', ('value',))}, {TAILS} "
        f"SELECT metric, n_group_1, n_group_0, {r6('u_statistic')}, {r6('tie_term')}, {P_VALUES} FROM zs"
    )
