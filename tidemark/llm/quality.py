"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Nulls: a null text has no words, so it fails the base rule. Lines are split at
line feeds, words at ASCII white space; the whole text is measured. Each row is
judged by itself, so rows that repeat a document, or have no doc_id, get the
same verdict as any; without rows there is no result. Columns of the input stay,
but for those named like a measure or verdict, which give way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import held, released, table

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Common words of the four languages, in natural order.
STOP_WORDS = {
    "en": "a and as at be by for from in is it of on or that the this to was with".split(),
    "fr": "au avec ce dans de des du elle en est et il la le les par pas pour que qui sur un une".split(),
    "de": "auf das dem den der des die ein eine es für im in ist mit nicht sich und von zu".split(),
    "es": "con de del el en es la las lo los no para por que se su un una y".split(),
}


@dataclass(frozen=True)
class Rule:
    """A document goes if `metric` is outside of least..most; bounds of None are open."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: What the verdict asks beyond the base rule.
RULES = (
    Rule("word length", "chars_per_word", 1.5, 20.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("repeated lines", "dup_lines_per_line", None, 0.5),
    Rule("stop words", "stop_words_per_word", 0.02, None),
)


def _words(text: Column) -> Column:
    """Split at one plain character, which takes no regular expression; the other white space is made blank first."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _let(value: Column, body) -> Column:
    """body(value), where value is computed once, also for lambdas in body: an outer expression in a lambda is computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in windows of 8 found twice or more: by hashes of windows, and neighbours in sorted order where some are equal."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = _let(hashed, lambda h: F.slice(F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)])), 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))))

    def covered(placed: Column) -> Column:
        # places of windows that equal a neighbour in sorted order, then the words that they cover
        again = F.transform(placed, lambda x, k: F.when((F.get(placed, k - 1)["h"] == x["h"]) | (F.get(placed, k + 1)["h"] == x["h"]), x["i"]))
        places = F.array_sort(F.filter(again, lambda i: i.isNotNull()))
        each = _let(places, lambda ps: F.transform(ps, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(ps, k + 1) - i, F.lit(WINDOW)))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    def count(all_windows: Column) -> Column:
        return _let(F.array_sort(F.transform(all_windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(count(w)))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "chars_per_word", "symbols_per_word", "stop_words_per_word", "dup_lines_per_line"]


def _measured(docs: DataFrame) -> DataFrame:
    """held() rows with the counts and ratios that rules are about."""
    text = F.coalesce(F.col("held.text"), F.lit(""))
    with_lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws})
    per_word = lambda c: F.coalesce(F.try_divide(c, F.col("n_words")), F.lit(0.0))
    one = held(docs).withColumns({"q_words": _words(text), "q_lines": with_lines})
    two = one.withColumns({"n_repeat_words": _repeat_words(F.col("q_words")).cast("long"), "n_words": F.size("q_words").cast("long")})
    three = two.withColumns({
        "word_chars": F.char_length(F.array_join("q_words", "")).cast("long"),
        "n_symbols": (F.octet_length(text) - F.octet_length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))).cast("long"),
        "n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
        "n_stop_words": F.size(F.filter("q_words", lambda w: w.isin(stops))).cast("long"),
        "n_lines": F.size("q_lines").cast("long"),
    })
    return three.withColumns({
        "chars_per_word": per_word(F.col("word_chars")), "symbols_per_word": per_word(F.col("n_symbols")), "stop_words_per_word": per_word(F.col("n_stop_words")),
        "dup_lines_per_line": F.coalesce(F.try_divide(F.col("n_dup_lines"), F.col("n_lines")), F.lit(0.0)),
    }).select("held", *MEASURES)


def measured(docs: DataFrame) -> DataFrame:
    """docs with the counts and ratios that rules are about."""
    return released(_measured(docs), docs, *MEASURES)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """measured() with base_failed and kept."""
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    broken = F.lit(False)
    for rule in rules:
        if rule.least is not None:
            broken = broken | (F.col(rule.metric) < rule.least)
        if rule.most is not None:
            broken = broken | (F.col(rule.metric) > rule.most)
    verdicts = _measured(docs).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~broken)
    return released(verdicts, docs, *MEASURES, "base_failed", "kept")


BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op3_quality_rules(spark, sf_dir):
    """Counts and verdict of every whole text; a null text counts as empty and fails the base rule."""
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*BASE)


def _sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
    ws = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    verdict = " AND ".join(f"{r.metric} {op} {bound}" for r in RULES for op, bound in ((">=", r.least), ("<=", r.most)) if bound is not None)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: trim(x, {ws}) <> '') AS ls FROM d),
p AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM p) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(0, 8) AS o(k) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines, len(list_filter(w, lambda x: x IN ({stops}))) AS n_stop_words FROM w LEFT JOIN rep USING (r)),
v AS (SELECT *, coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS chars_per_word, coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0) AS symbols_per_word,
  coalesce(n_stop_words::DOUBLE / nullif(n_words, 0), 0) AS stop_words_per_word, coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) AS dup_lines_per_line,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m)
SELECT {', '.join(BASE[:-1])}, (NOT base_failed AND {verdict}) AS kept FROM v
"""


OP3_SQL = _sql()
