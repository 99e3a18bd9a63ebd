"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a Spark expression over one array of words and one array of lines, each bound
once per row; the table of rules becomes one boolean column of the same projection. There is
no user function, no shuffle and no join.

Repeated five-word windows are found by their 64-bit hashes: a text without equal hashes, the
usual case, is done after one distinct count. Only otherwise are the windows sorted, equal
neighbours kept, and the words under them counted. Two different windows of one text share a
hash with a probability below 1e-10 for a text of 20,000 words.

Defined results: null and empty texts have no words, all counts 0, fail the base rule and are
not kept; ties do not arise; repeated rows are judged alike; an empty table gives an empty
table. Ratios whose divisor is 0 count as 0. Input columns pass through ``keep_good`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.functions.expressions import bind

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
#: Frequent short words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by", "this",
    "are", "from", "or", "an", "at", "he",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein",
    "eine", "als",
    "de", "la", "le", "et", "les", "un", "une", "du", "que", "est", "pour", "qui", "dans", "par", "elle", "au",
    "el", "en", "y", "los", "se", "del", "las", "por", "con", "para", "su", "al", "lo", "no",
)


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [least, most] for texts of at least ``from_words`` words."""

    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The thresholds; ratios are per word, per character or per line as their names say.
RULES = (
    Rule("n_words", least=10),
    Rule("repeated_words_per_word", most=0.2),
    Rule("chars_per_word", least=2.0, most=14.0),
    Rule("symbols_per_word", most=0.1),
    Rule("duplicate_lines_per_line", most=0.5),
    Rule("stop_words_per_word", least=0.01, from_words=100),
)


def _array_sum(items: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda total, item: total + value(item))


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", " " * 5)
    return F.filter(F.split(spaced, " "), lambda word: word != "")


def repeated_words(tokens: Column, size: int = WINDOW) -> Column:
    """Words under windows of ``size`` words that occur at least twice; ``tokens`` must be bound."""
    starts = F.sequence(F.lit(0), F.size(tokens) - size)
    hashes = F.transform(starts, lambda at: F.xxhash64(*[F.get(tokens, at + k) for k in range(size)]))

    def covered(positions: Column) -> Column:
        after = lambda rank: F.coalesce(F.get(positions, rank + 1), F.lit(1 << 30))
        gaps = F.transform(positions, lambda at, rank: F.least(after(rank) - at, F.lit(size)).cast("long"))
        return _array_sum(gaps, lambda gap: gap)

    def positions(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda value, at: F.struct(value.alias("h"), at.alias("at"))))

        def equal_neighbours(ordered: Column) -> Column:
            value = lambda at: F.get(ordered, at).getField("h")
            again = F.filter(
                F.sequence(F.lit(0), F.size(ordered) - 1),
                lambda at: F.coalesce(value(at) == value(at + 1), F.lit(False))
                | ((at > 0) & (value(at) == value(F.greatest(at - 1, F.lit(0))))),
            )
            return F.sort_array(F.transform(again, lambda at: F.get(ordered, at).getField("at")))

        return bind(pairs, equal_neighbours)

    counted = bind(
        hashes,
        lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(
            bind(positions(found), covered)
        ),
    )
    return F.when(F.size(tokens) < size, F.lit(0).cast("long")).otherwise(counted)


def counts(text: Column) -> Column:
    """All counts of a text as one struct."""
    whole = F.coalesce(text, F.lit(""))
    symbols = F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return bind(
        F.struct(words(whole).alias("w"), lines.alias("l")),
        lambda both: bind(
            both.getField("w"),
            lambda tokens: F.struct(
                F.size(tokens).cast("long").alias("n_words"),
                _array_sum(tokens, F.length).alias("word_chars"),
                symbols.cast("long").alias("n_symbols"),
                F.size(both.getField("l")).cast("long").alias("n_lines"),
                (F.size(both.getField("l")) - F.size(F.array_distinct(both.getField("l")))).cast("long").alias("n_dup_lines"),
                repeated_words(tokens).alias("n_repeat_words"),
                F.size(F.filter(tokens, lambda word: word.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            ),
        ),
    )


def measures(c: Column) -> dict[str, Column]:
    """What rules can refer to, from the struct of counts."""
    ratio = lambda a, b: F.when(c[b] > 0, c[a] / c[b]).otherwise(F.lit(0.0))
    return {
        "n_words": c["n_words"],
        "chars_per_word": ratio("word_chars", "n_words"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "duplicate_lines_per_line": ratio("n_dup_lines", "n_lines"),
        "repeated_words_per_word": ratio("n_repeat_words", "n_words"),
        "stop_words_per_word": ratio("n_stop_words", "n_words"),
    }


def verdict(c: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The table of rules as one boolean expression."""
    known = measures(c)
    good = F.lit(True)
    for rule in rules:
        value, fits = known[rule.measure], F.lit(True)
        if rule.least is not None:
            fits = fits & (value >= rule.least)
        if rule.most is not None:
            fits = fits & (value <= rule.most)
        good = good & (fits | (c["n_words"] < rule.from_words))
    return good


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, counts, whether the base rule failed, and the verdict of the whole table."""
    c = F.col("c")
    counted = documents.select("doc_id", counts(F.col("text")).alias("c"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return counted.select(
        "doc_id",
        *[c[name].alias(name) for name in names],
        base_failed(c).alias("base_failed"),
        (~base_failed(c) & verdict(c, rules)).alias("kept"),
        c["n_lines"].alias("n_lines"),
        c["n_stop_words"].alias("n_stop_words"),
    )


def keep_good(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with all their columns."""
    judged = documents.select(F.struct("*").alias("row")).withColumn("c", counts(F.col("row.text")))
    passed = judged.where(~base_failed(F.col("c")) & verdict(F.col("c"), rules))
    return passed.select(*[F.col("row").getField(name).alias(name) for name in documents.columns])


_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)
ORACLE = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, pos, list_aggregate(w[pos:pos + 4], 'string_agg', ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS pos FROM split WHERE len(w) >= 5)),
again AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows) WHERE n >= 2),
covered AS (
  SELECT doc_id, CAST(sum(least(5, coalesce(next_pos - pos, 5))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS next_pos FROM again) GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(c.n_repeat_words, 0) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(list_filter(w, lambda x: x IN ({_STOP_LIST}))) AS BIGINT) AS n_stop_words
  FROM split s LEFT JOIN covered c USING (doc_id)),
based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_repeat_words / n_words <= 0.2
       AND word_chars / n_words >= 2.0 AND word_chars / n_words <= 14.0 AND n_symbols / n_words <= 0.1
       AND n_dup_lines / n_lines <= 0.5 AND (n_words < 100 OR n_stop_words / n_words >= 0.01) AS kept,
       n_lines, n_stop_words
FROM based
"""
