"""Spelling variant grouping by letter parities.

A word's mask has a bit for each letter: whether the word has it an odd number
of times. One edit flips at most two bits, so of three bands of the mask one at
least stays the same. Words meet in equal bands of equal lengths (or lengths
that differ by one), pass the count of flipped bits and are verified.

A band has few values, and its groups would grow with the square of the words.
They are split without loss: an edit leaves either the first half or the last
half of a word alone (halves of the shorter word, rounded down), so words meet
only where a band and a half are the same. A pair that meets more than once
counts where it meets first.

Nulls: a null text has no words, a null doc_id counts as an empty text where it
seeds the noise. Rows that repeat a doc_id are documents of their own. Among
near words of equal count the first in code-point order is taken. Without words
there is no result; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import small_batches, store, table

#: Of words: least code points, least occurrences in all. NOISE: one in so many pairs of document and run loses a code point in the query.
LEAST_LENGTH, LEAST_COUNT, NOISE = 5, 3, 97
#: A form is so many times as frequent as the word, at least.
TIMES = 2
#: Words that a task counts before it passes them on.
MOST_WORDS = 200_000
#: Bytes of Latin-1: A-Z lower-cased, letters from U+00C0 on as they are, all else blank.
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Letters by how common they are in European languages, so that the bands, to which they are dealt in turn, tell about as much each.
_COMMON = "eantirosldcumphgbvfyqzxjkw" + "".join(map(chr, range(0xC0, 0x100)))
BITS = {c: (k % 3, 1 << (k // 3)) for k, c in enumerate(_COMMON)}


def _counts(noise: int):
    def run(batches):
        seen: Counter = Counter()

        def told():
            kept = [(w.decode("latin-1"), n) for w, n in seen.items() if n and len(w) >= LEAST_LENGTH]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

        crc = zlib.crc32
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().encode("latin-1", "replace").translate(_RUNS).split()
                seen.update(words)
                if noise:
                    seed = crc(f"{'' if doc is None else doc}:".encode())
                    hit = {w: h for w in set(words) if not (h := crc(w if w.isascii() else w.decode("latin-1").encode(), seed)) % noise}
                    for w, n in Counter(filter(hit.__contains__, words)).items():
                        at = hit[w] % len(w)
                        seen[w] -= n
                        seen[w[:at] + w[at + 1 :]] += n
                if len(seen) > MOST_WORDS:
                    yield told()
        yield told()

    return run


def counted(docs: DataFrame, noise: int = 0, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z lower-cased. With noise, a run loses one code point where the checksum of document and run is divisible by it."""
    small_batches(docs.sparkSession)
    texts = docs.filter("text is not null").select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return texts.mapInArrow(_counts(noise), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def masked(words: DataFrame) -> DataFrame:
    """words with their number of code points and the three bands of their masks."""

    def run(batches):
        for batch in batches:
            bands = ([], [], [])
            for word in batch.column("word").to_pylist():
                own = [0, 0, 0]
                for c in word:
                    band, bit = BITS.get(c) or (ord(c) % 3, 1 << (ord(c) // 3 % 60))
                    own[band] ^= bit
                for band, value in zip(bands, own):
                    band.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(b, pa.int64()) for b in bands)], names=[*batch.schema.names, "b0", "b1", "b2"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, b0 long, b1 long, b2 long").withColumn("len", F.char_length("word"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of words, by (word, n), that are one edit apart; each pair once."""
    made = store(masked(words), "masks")

    def dealt(prefix: str, shorter: int) -> DataFrame:
        """Places where words meet: 0 to 5 those of their own length, 6 to 11 those one longer than the shorter word."""
        places = []
        for longer in (0, 1):
            least = F.col("len") - (longer if shorter else 0)
            half = F.floor(least / 2).cast("int")
            for band in range(3):
                places += [F.xxhash64(least, F.lit(side), f"b{band}", F.substring(F.col("word"), 1, half) if side == 0 else F.substring(F.col("word"), F.col("len") - half + 1, half)) for side in (0, 1)]
        rows = made.select("word", "n", "len", "b0", "b1", "b2", F.posexplode(F.array(*places)).alias("place", "key"))
        return rows.select("place", "key", *[F.col(c).alias(f"{prefix}_{c}") for c in ("word", "n", "len", "b0", "b1", "b2")])

    flips = sum((F.bit_count(F.col(f"a_b{k}").bitwiseXOR(F.col(f"b_b{k}"))) for k in range(3)), F.lit(0))
    band, last_half = F.floor(F.col("place") % 6 / 2), F.col("place") % 2 == 1
    differ = [F.col(f"a_b{k}") != F.col(f"b_b{k}") for k in range(3)]
    first = (band == 0) | (differ[0] & ((band == 1) | differ[1]))
    half = F.floor(F.col("a_len") / 2).cast("int")
    first &= ~last_half | (F.substring(F.col("a_word"), 1, half) != F.substring(F.col("b_word"), 1, half))
    length = F.when(F.col("place") < 6, (F.col("a_len") == F.col("b_len")) & (F.col("a_word") < F.col("b_word"))).otherwise(F.col("a_len") + 1 == F.col("b_len"))
    b = dealt("b", 1).select(F.col("place").alias("b_place"), F.col("key").alias("b_key"), *[f"b_{c}" for c in ("word", "n", "len", "b0", "b1", "b2")])
    met = dealt("a", 0).join(b, (F.col("key") == F.col("b_key")) & (F.col("place") == F.col("b_place")) & (flips <= 2) & length & first & (F.levenshtein("a_word", "b_word", 1) == 1))
    return met.select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n")


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form (its most frequent near word, if that is at least `times` as frequent) and form_n."""
    both = near_pairs(words).select(F.explode(F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("o"), F.col("b_n").alias("o_n")), F.struct(F.col("b").alias("w"), F.col("a").alias("o"), F.col("a_n").alias("o_n")))).alias("x"))
    best = both.groupBy(F.col("x.w").alias("w")).agg(F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("x.o_n")).alias("less"), F.col("x.o").alias("o"))).alias("best"))
    joined = words.join(best, F.col("word") == F.col("w"), "left")
    found = -F.col("best.less") >= times * F.col("n")
    return joined.select("word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(found, F.col("best.o")).alias("form"), F.when(found, -F.col("best.less")).alias("form_n"))


def rooted(found: DataFrame) -> DataFrame:
    """forms() with root, where a word's forms lead to. A form is more frequent than its word, so there are no circles, and each turn doubles the way."""
    step = store(found.filter("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while step.filter("moved").limit(1).count():
        ahead = step.select(F.col("word").alias("w"), F.col("root").alias("r"))
        step = store(step.join(ahead, F.col("root") == F.col("w"), "left").select("word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")), "roots")
    last = step.select(F.col("word").alias("w"), "root")
    return found.join(last, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, noise: int = 0) -> DataFrame:
    """Words of the documents with their forms and roots."""
    words = store(counted(docs, noise), "words")
    return rooted(store(forms(words), "forms"))


def op12_spelling_variants(spark, sf_dir):
    """Words of all documents, some of which have lost a code point, and the words that they are variants of."""
    return variants(table(spark, sf_dir, "documents"), NOISE)


# The checksum is worked out bit by bit. Near words share what is left without one code point: equal lengths at the same place, else one is what is left of the other.
_BYTE = "list_concat([{}], [-1, -1, -1, -1, -1, -1, -1, -1])"
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(doc_id::VARCHAR, '') AS d, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT r, d, unnest(regexp_extract_all(t, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM d),
k AS (SELECT d, run, count(*) AS n FROM o GROUP BY r, d, run),
h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(d || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN {_BYTE.format('unicode(c)')}
  ELSE list_concat({_BYTE.format('192 + (unicode(c) >> 6)')}, {_BYTE.format('128 + (unicode(c) & 63)')}) END))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x::BIGINT) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) AS h FROM k),
p AS (SELECT CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM p WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
l AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
q AS (SELECT a.word AS a, b.word AS b, b.n AS bn FROM l a JOIN l b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM l JOIN w ON l.rest = w.word UNION SELECT w.word, l.word, l.n FROM l JOIN w ON l.rest = w.word),
f AS (SELECT a, count(*) AS n_near, first(b ORDER BY bn DESC, b) AS b, max(bn) AS bn FROM q GROUP BY a),
x AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= {TIMES} * n THEN b END AS form, CASE WHEN bn >= {TIMES} * n THEN bn END AS form_n FROM w LEFT JOIN f ON word = a),
c AS (SELECT word, coalesce(form, word) AS up, form IS NULL AS done FROM x UNION ALL
  SELECT c.word, coalesce(x.form, c.up), x.form IS NULL FROM c JOIN x ON c.up = x.word WHERE NOT c.done)
SELECT x.word, form, up AS root, n, n_near, form_n FROM x JOIN c ON x.word = c.word AND done
"""
OP12_SQL = OP12_SQL.replace("WITH d", "WITH RECURSIVE d", 1)
