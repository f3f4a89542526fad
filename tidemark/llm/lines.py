"""Line dedup with a log-template tree, in built-in expressions only.

A line descends by its number of words and its first DEPTH words to a leaf;
words with a digit are fields there. In a leaf, a later position that shows
more than MOST_VALUES different words over the leaf's different lines is a
field too. A line's template is the line with its fields masked, if enough
constant words remain; else the line itself. Templates found in MIN_DOCS or
more documents are dropped everywhere but in the document with the smallest id;
fewer could be fields that only look alike. A line of LEAST_EXACT words or more
that recurs just as it stands is dropped from the second document on.

Nulls: a null text stays null; rows without doc_id are neither counted nor
changed. Lines without a word always stay. Rows that repeat a doc_id count as
one document. Without rows there is no result. Other columns stay as they are,
but for those named like what is added (n_lines, n_dropped), which give way.
Ties do not arise: the document with the smallest id keeps a template.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import held, released, store, table

DEPTH, MOST_VALUES, CONSTANT_TENTHS, MIN_DOCS = 3, 4, 6, 8
#: Words of a line from which on it is dropped as it stands where a smaller document has it too.
LEAST_EXACT = 5
SPACES = " \t\x0b\f\r"
FIELD = "<*>"
#: A word with a digit; anchored at its start and possessive, so that long words cost one pass.
_DIGIT_WORD = rf"(?<![^{SPACES}])[^{SPACES}0-9]*+[0-9][^{SPACES}]*+"


def _flags(places):
    """An array that is true at each of the sorted places, as long as the last of them: gap after gap, so that what walks beside it looks nothing up."""
    before = F.concat(F.array(F.lit(-1)), F.slice(places, F.lit(1), F.size(places) - 1))
    return F.flatten(F.zip_with(places, before, lambda p, q: F.concat(F.array_repeat(F.lit(False), p - q - 1), F.array(F.lit(True)))))


def _enough(words, n):
    return 10 * F.size(F.array_remove(words, FIELD)) >= CONSTANT_TENTHS * n


def parsed(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """A row per line with a word: doc_id, row_key, pos, words (masked), n, leaf, key (its template as far as the line alone tells), exact (of the line as it stands, if it has LEAST_EXACT words)."""
    texts = docs.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    lines = texts.select("doc_id", "row_key", F.posexplode(F.split("text", "\n")).alias("pos", "line"))  # the key is made below, once for each text and not for each line
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", _DIGIT_WORD, FIELD)).otherwise(F.col("line"))
    split = lambda c: F.array_remove(F.split(c, f"[{SPACES}]+"), "")
    # blank lines are told by the line itself: a filter on the words would split each line twice
    worded = lines.filter(F.col("line").rlike(f"[^{SPACES}]")).withColumn("words", split(masked)).withColumn("n", F.size("words"))
    return worded.withColumns({
        "leaf": F.xxhash64("n", F.slice("words", 1, depth)), "key": F.when(_enough(F.col("words"), F.col("n")), F.xxhash64("words")).otherwise(F.xxhash64(F.lit(1), split(F.col("line")))),
        "exact": F.when(F.col("n") >= LEAST_EXACT, F.xxhash64("line")),
    })


def templates(docs: DataFrame, facts: DataFrame, depth: int = DEPTH, most_values: int = MOST_VALUES) -> DataFrame:
    """(key, template) of lines whose leaf turns further positions into fields."""
    distinct = facts.groupBy("leaf", "key").count()
    busy = store(distinct.groupBy("leaf").count().filter(F.col("count") > most_values).select(F.col("leaf").alias("b_leaf")), "leaves")
    lines = parsed(docs, depth).join(busy, F.col("leaf") == F.col("b_leaf"), "left_semi").select("leaf", "key", "words", "n")
    lines = store(lines.groupBy("leaf", "key").agg(F.min("words").alias("words")), "leaf-lines")
    values = lines.select("leaf", F.posexplode("words").alias("p", "word")).filter(F.col("p") >= depth).groupBy("leaf", "p", F.xxhash64("word").alias("w")).count()
    fields = values.groupBy("leaf", "p").count().filter(F.col("count") > most_values).groupBy("leaf").agg(F.sort_array(F.collect_list("p")).alias("fields"))
    general = lines.join(fields, "leaf").withColumn("general", F.zip_with("words", _flags(F.col("fields")), lambda w, f: F.when(f, F.lit(FIELD)).otherwise(w)))
    return general.filter(_enough(F.col("general"), F.size("words"))).select("key", F.xxhash64(F.lit(2), "leaf", "general").alias("template"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, row_key, and the places of lines to drop."""
    facts = store(parsed(docs).select("doc_id", "row_key", "pos", "leaf", "key", "exact"), "lines")
    known = store(templates(docs, facts), "templates")
    keyed = facts.join(known, "key", "left").select("doc_id", "row_key", "pos", F.coalesce("template", "key").alias("t"))
    often = keyed.groupBy("t").agg(F.count_distinct("doc_id").alias("n"), F.min("doc_id").alias("first")).filter(F.col("n") >= min_docs)
    often = store(often.select(F.col("t").alias("o_t"), "first"), "recurring")
    again = facts.filter("exact is not null").groupBy("exact").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter(F.col("first") < F.col("last"))
    again = store(again.select(F.col("exact").alias("o_exact"), "first"), "repeated")
    by_template = keyed.join(often, (F.col("t") == F.col("o_t")) & (F.col("doc_id") > F.col("first")))
    by_line = facts.join(again, (F.col("exact") == F.col("o_exact")) & (F.col("doc_id") > F.col("first")))
    dropped = by_template.select("doc_id", "row_key", "pos").union(by_line.select("doc_id", "row_key", "pos"))
    return dropped.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set("pos")).alias("places"))


def deduped(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the text that is left, and n_lines (with a word) and n_dropped."""
    gone = recurring_lines(docs.select("doc_id", "text"), min_docs).select("doc_id", "row_key", "places")
    doc_id, own = F.col("held.doc_id"), F.col("held.text")
    joined = held(docs).join(gone, (doc_id == F.col("doc_id")) & (F.xxhash64(own) == F.col("row_key")), "left")
    lines = F.split(own, "\n")
    left = F.array_join(F.zip_with(lines, _flags(F.col("places")), lambda line, f: F.when(F.coalesce(~f, F.lit(True)), line)), "\n")  # nulls are not joined
    counted = F.size(F.filter(lines, lambda line: line.rlike(f"[^{SPACES}]")))
    text = F.when(F.col("places").isNull(), own).otherwise(left)
    made = joined.select("held", F.coalesce(counted, F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("text"))
    return released(made, docs, "n_lines", "n_dropped", "text")


def op1_line_dedup(spark, sf_dir):
    """Per document: its lines with a word, how many of them go, and the digest of the text that is left (null: empty)."""
    out = deduped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


_WORDS = "list_filter(regexp_split_to_array({}, '[ \\t\\x0b\\f\\r]+'), lambda x: x <> '')"
OP1_SQL = f"""
WITH d AS (SELECT doc_id, text FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d WHERE text IS NOT NULL),
w AS (SELECT doc_id, pos, line, {_WORDS.format('line')} AS raw FROM l),
m AS (SELECT *, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS words, len(raw) AS n FROM w WHERE len(raw) > 0),
k AS (SELECT *, array_to_string(list_concat([n::VARCHAR], words[1:{DEPTH}]), ' ') AS leaf,
  CASE WHEN 10 * len(list_filter(words, lambda x: x <> '{FIELD}')) >= {CONSTANT_TENTHS} * n THEN 'm ' || array_to_string(words, ' ') ELSE 'r ' || array_to_string(raw, ' ') END AS key FROM m),
b AS (SELECT leaf FROM k GROUP BY leaf HAVING count(DISTINCT key) > {MOST_VALUES}),
bl AS (SELECT DISTINCT leaf, key, words FROM k SEMI JOIN b USING (leaf)),
v AS (SELECT leaf, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM bl),
f AS (SELECT leaf, list(p) AS fields FROM (SELECT leaf, p FROM v WHERE p > {DEPTH} GROUP BY leaf, p HAVING count(DISTINCT word) > {MOST_VALUES}) GROUP BY leaf),
g AS (SELECT DISTINCT key, leaf, list_transform(words, lambda x, i: CASE WHEN list_contains(fields, i) THEN '{FIELD}' ELSE x END) AS general FROM bl JOIN f USING (leaf)),
t AS (SELECT key, 'g ' || leaf || ' ' || array_to_string(general, ' ') AS template FROM g WHERE 10 * len(list_filter(general, lambda x: x <> '{FIELD}')) >= {CONSTANT_TENTHS} * len(general)),
a AS (SELECT doc_id, pos, coalesce(template, k.key) AS tk FROM k LEFT JOIN t USING (key)),
o AS (SELECT tk, min(doc_id) AS first FROM a GROUP BY tk HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
e AS (SELECT line, min(doc_id) AS first FROM k WHERE n >= {LEAST_EXACT} GROUP BY line HAVING min(doc_id) < max(doc_id)),
y AS (SELECT doc_id, pos FROM a JOIN o USING (tk) WHERE doc_id > first UNION SELECT doc_id, pos FROM k JOIN e USING (line) WHERE doc_id > first),
x AS (SELECT doc_id, list(pos) AS places FROM y GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(len(places), 0)::BIGINT AS n_dropped,
  sha256(coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda s, i: NOT list_contains(coalesce(places, []), i - 1)), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN n USING (doc_id)
"""
