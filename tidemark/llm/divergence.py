"""Source divergence audit by inclusion and exclusion over supports.

In each language, prices of a source's terms are integers that depend only on a
term's count, the source's total and the language's number of kept terms. Terms
that a source lacks have one price. So the distance of two sources over all kept
terms is summed without a row for each source and term:

    terms that the first has, priced against the other's constant, from a histogram of its counts;
    the same for the terms that the other has;
    for terms that both have, what these two got wrong, from a join of postings;
    a constant for each kept term that neither has.

Nulls: a null text, lang or source is empty. Every row is a document, repeated
ids too. A source without kept terms has a total of 0. Equal values go by item
in byte order. Without documents there is no result; other columns are not
looked at. Totals may be beyond 64 bits once multiplied; they are decimals then.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runtime import small_batches, store, table

#: Documents of a language that a kept term is in, at least; what is added to each count; price of a whole; ranks told of terms.
LEAST_DOCS, ADDED, WHOLE, RANKS = 30, 5, 1_000_000_000, 50
#: Counts that a task holds before it passes them on.
MOST_KEYS = 300_000
#: Bytes of UTF-8: A-Z lower-cased, other ASCII but letters blank.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _count(batches):
    """Occurrences by language, source and term, and, with no source, documents by language and term."""
    groups: dict = {}

    def told():
        for (lang, source), counts in groups.items():
            for _ in range(1 if counts else 0):
                n = len(counts)
                terms = pa.array(list(counts), pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), terms, pa.array(list(counts.values()), pa.int64())], names=["lang", "source", "term", "n"])
        groups.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            terms = text.as_py().translate(_TERMS).split()
            own, docs = groups.setdefault((lang, source), Counter()), groups.setdefault((lang, None), Counter())
            held -= len(own) + len(docs)
            own.update(terms)
            docs.update(set(terms))
            held += len(own) + len(docs)
            if held > MOST_KEYS:
                yield from told()
                held = 0
    yield from told()


def postings(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """A row for each kept term and source that has it: lang, source, term, n, lang_n (occurrences in the language), head (true for one row of each term)."""
    small_batches(docs.sparkSession)
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    raw = docs.select(empty("lang").alias("lang"), empty("source").alias("source"), empty("text").cast("binary").alias("text")).mapInArrow(_count, "lang string, source string, term string, n long")
    # all that follows is by language and term, so rows move once
    counts = raw.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    same = Window.partitionBy("lang", "term")
    seen = counts.withColumns({"docs": F.max(F.when(F.col("source").isNull(), F.col("n"))).over(same), "lang_n": F.sum(F.when(F.col("source").isNotNull(), F.col("n"))).over(same), "first": F.min("source").over(same)})
    return seen.filter((F.col("docs") >= least_docs) & F.col("source").isNotNull()).select("lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("first")).alias("head"))


def price(n, total, kept):
    """1 + floor(WHOLE * (n + ADDED) / (total + ADDED * kept)), exactly."""
    above = F.lit(WHOLE).cast("decimal(10,0)") * (n + ADDED).cast("decimal(20,0)")
    return 1 + F.call_function("div", above, (total.cast("long") + ADDED * kept.cast("long")).cast("decimal(20,0)"))


def totals(docs: DataFrame, posted: DataFrame) -> DataFrame:
    """A row for each language and source that occurs: total, support (kept terms it has), kept and lang_total (of the language), none (price of a term it lacks; null without kept terms)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = docs.select(empty("lang").alias("lang"), empty("source").alias("source")).distinct()
    own = posted.groupBy(F.col("lang").alias("o_lang"), F.col("source").alias("o_source")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("support"))
    langs = posted.groupBy(F.col("lang").alias("l_lang")).agg(F.sum("n").alias("lang_total"), F.count_if("head").alias("kept"))
    joined = groups.join(own, (F.col("lang") == F.col("o_lang")) & (F.col("source") == F.col("o_source")), "left").join(langs, F.col("lang") == F.col("l_lang"), "left")
    known = joined.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "support", "kept", "lang_total")])
    return known.withColumn("none", F.when(F.col("kept") > 0, price(F.lit(0), F.col("total"), F.col("kept"))))


def priced(posted: DataFrame, groups: DataFrame) -> DataFrame:
    """Postings with their source's price p, its price for terms it lacks, and the language's price q."""
    g = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "total", "kept", "lang_total", "none")
    joined = posted.join(g, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")))
    return joined.select("lang", "source", "term", "n", "none", price(F.col("n"), F.col("total"), F.col("kept")).alias("p"), price(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))


def distances(prices: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language), value: the summed differences of their prices over all kept terms."""
    other = groups.select(F.col("lang").alias("i_lang"), F.col("source").alias("item"), F.col("none").alias("i_none"), F.col("support").alias("i_support"))
    apart = (F.col("lang") == F.col("i_lang")) & (F.col("source") != F.col("item"))
    neither = groups.join(other, apart).select("lang", "source", "item", F.coalesce((F.col("kept") - F.col("support") - F.col("i_support")) * F.abs(F.col("none") - F.col("i_none")), F.lit(0)).alias("value"))
    histogram = prices.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    one = histogram.join(other, apart).groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * F.abs(F.col("p") - F.col("i_none"))).alias("value"))
    a, b = (prices.select(F.col("lang").alias(f"{x}_lang"), F.col("term").alias(f"{x}_term"), F.col("source").alias(x), F.col("p").alias(f"{x}_p"), F.col("none").alias(f"{x}_none")) for x in "ab")
    both = a.join(b, (F.col("a_lang") == F.col("b_lang")) & (F.col("a_term") == F.col("b_term")) & (F.col("a") < F.col("b")))
    wrong = F.abs(F.col("a_p") - F.col("b_p")) - F.abs(F.col("a_p") - F.col("b_none")) - F.abs(F.col("a_none") - F.col("b_p")) + F.abs(F.col("a_none") - F.col("b_none"))
    overlap = both.groupBy(F.col("a_lang").alias("lang"), F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum(wrong).alias("value"))
    turned = one.union(overlap).select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return neither.union(one).union(overlap).union(turned).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """How far each source of a language is from each other (part `pair`), and the terms that it has more of than the language (part `term`, the first `ranks`)."""
    posted = store(postings(docs, least_docs), "postings")
    groups = store(totals(docs, posted), "totals")
    prices = store(priced(posted, groups), "prices")
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    pair = distances(prices, groups).withColumn("rank", ranked)
    term = prices.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")).withColumn("rank", ranked).filter(F.col("rank") <= ranks)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pair, "pair").union(columns(term, "term"))


def op11_source_divergence(spark, sf_dir):
    """The audit of all documents."""
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + {WHOLE}::HUGEINT * (coalesce(c.n, 0) + {ADDED}) // (coalesce(s.n, 0) + {ADDED} * v.v)::HUGEINT AS p,
  1 + {WHOLE}::HUGEINT * (k.n + {ADDED}) // (v.n + {ADDED} * v.v)::HUGEINT AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN s USING (lang, source)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM y)
SELECT * FROM z WHERE part = 'pair' OR rank <= {RANKS}
"""
