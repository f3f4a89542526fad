"""Benchmark decontamination with an FM-index for each training shard.

A shard is a block of documents. Its words become symbols; words that no
benchmark phrase has end a run, and runs shorter than every phrase can hold
none. The runs, each with a terminator of its own, are suffix sorted; backward
search takes all phrases at once through the wavelet matrix of the transformed
text, and rows of matches walk back to the nearest sampled suffix for their
place. The words so covered are merged into spans.

Nulls: a null text has no words, in documents and in the benchmark; items
without an id are skipped. Repeated item rows count once. Rows without doc_id,
and rows that repeat a document, are judged each by its own text. Without
documents there is no result, without a benchmark nothing is hit. Columns other
than doc_id, item_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import small_batches, table
from tidemark.llm.words import Words, blocks, delimiter_table, spread

WINDOW = 13
#: All of ASCII but digits and lower-case letters.
GAPS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
SHARD_BYTES = 8 << 20
#: Bytes of benchmark text that one pass holds, as arrays of some 12 times that and never over 50 times; a larger benchmark takes several passes.
PHRASE_BYTES = 4 << 20
SAMPLING = 16
_GAP_TABLE = delimiter_table(GAPS)


class WaveletMatrix:
    """Ranks of symbols in a sequence, for arrays of queries."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            packed = np.packbits(np.pad(bit, (0, 64 + -len(bit) % 64)), bitorder="little").view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            zeros = len(bit) - int(np.count_nonzero(bit))
            self.levels.append((packed, before, zeros))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        packed, before, _ = level
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        start, at = np.zeros_like(at), at.copy()
        for k, level in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            for x in (start, at):
                ones = self._ones(level, x)
                x[:] = np.where(one, level[2] + ones, x - ones)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol, at = np.zeros_like(at), at.copy()
        for level in self.levels:
            one = (level[0][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            ones = self._ones(level, at)
            at = np.where(one, level[2] + ones, at - ones)
            symbol = symbol << 1 | one
        return symbol


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of distinct suffixes, by prefix doubling over those not yet told apart."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    new = np.concatenate(([True], text[order][1:] != text[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    k = 1
    while True:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))  # rows of groups of two or more
        if not len(tied):
            return order
        suffix = order[tied]
        second = np.where(suffix + k < n, rank[np.minimum(suffix + k, n - 1)] + 1, 0)
        sort = np.lexsort((second, rank[suffix]))
        order[tied] = suffix[sort]
        first, second = rank[suffix][sort], second[sort]
        new[tied] = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        # a row's rank is the place where its group begins
        starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[tied]] = starts[tied]
        k *= 2


class FmIndex:
    """symbols: 1..size; ends: places of the runs' last symbols plus one. Places count symbols, terminators left out."""

    def __init__(self, symbols: np.ndarray, run_lengths: np.ndarray, size: int, sampling: int = SAMPLING):
        runs = len(run_lengths)
        ends = np.cumsum(run_lengths + 1) - 1
        text = np.zeros(len(symbols) + runs, np.int64)
        body = np.ones(len(text), bool)
        body[ends] = False
        text[body] = symbols + runs
        text[ends] = np.arange(runs)
        order = suffix_order(text)
        self.place = np.cumsum(body) - 1
        flat = np.where(text < runs, 0, text - runs)
        self.transformed = WaveletMatrix(flat[order - 1], int(size).bit_length())
        self.first = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=size + 1))))
        starts = np.zeros(len(text), bool)
        starts[np.concatenate(([0], ends[:-1] + 1))] = True
        self.sampled = (order % sampling == 0) | starts[order] | ~body[order]
        self.sample = order[self.sampled]
        self.sample_row = np.cumsum(self.sampled) - 1
        self.rows = len(text)

    def _back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.transformed.rank(symbol, at)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase numbers, low and high rows): phrases holds symbols, last first, padded with 0."""
        live = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.rows, np.int64)
        for step in range(phrases.shape[1]):
            go = lengths[live] > step
            which = np.flatnonzero(go)
            symbol = phrases[live[which], step]
            low[which], high[which] = self._back(symbol, low[which]), self._back(symbol, high[which])
            keep = low < high
            live, low, high = live[keep], low[keep], high[keep]
        return live, np.stack((low, high))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in these rows."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            done = self.sampled[rows[todo]]
            hit = todo[done]
            out[hit] = self.sample[self.sample_row[rows[hit]]] + steps[hit]
            todo = todo[~done]
            rows[todo] = self._back(self.transformed.access(rows[todo]), rows[todo])
            steps[todo] += 1
        return self.place[out]


class Phrases:
    """The benchmark's windows as rows of symbols, last first and padded with 0, and which items have each: arrays only, some 80 bytes a word."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.words = words = Words([(text or "").encode().lower() for _, text in items], _GAP_TABLE)
        self.vocabulary, self.first, symbols = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.names = [name for name, _ in items]
        counts = np.diff(words.bounds)
        each = np.where(counts > 0, np.maximum(1, counts - window + 1), 0)
        item = np.repeat(np.arange(len(items), dtype=np.int32), each)
        start = np.repeat(words.bounds[:-1], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        lengths = np.minimum(counts, window)[item]
        rows = np.zeros((len(start), window), np.int32)
        for k in range(window):
            inside = lengths > k
            rows[inside, k] = symbols[start[inside] + lengths[inside] - 1 - k] + 1
        keys = rows.view(f"V{4 * window}").ravel() if len(rows) else np.zeros(0, "V4")
        _, at, owned = np.unique(keys, return_index=True, return_inverse=True)
        self.rows, self.lengths = rows[at], lengths[at]
        pairs = np.unique(np.stack((owned.ravel(), item), 1), axis=0) if len(rows) else np.zeros((0, 2), np.int64)
        self.owners, self.cuts = pairs[:, 1].astype(np.int32), np.searchsorted(pairs[:, 0], np.arange(len(at) + 1))

    def runs(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol of each word, begins, lengths) of runs of known words in one text that can hold a phrase; words of runs are known by their bytes, not their hashes alone."""
        symbol = np.searchsorted(self.vocabulary, words.hashes)
        symbol[symbol == len(self.vocabulary)] = 0
        known = self.vocabulary[symbol] == words.hashes
        edge = np.zeros(len(known) + 1, bool)
        edge[words.bounds] = True
        while True:
            begin = known & (edge[:-1] | ~np.concatenate(([False], known[:-1])))
            end = known & (edge[1:] | ~np.append(known[1:], False))
            begins, lengths = np.flatnonzero(begin), np.flatnonzero(end) - np.flatnonzero(begin) + 1
            long = lengths >= self.lengths.min()
            begins, lengths = begins[long], lengths[long]
            places = spread(begins, lengths)
            other = ~words.same(places, self.words, self.first[symbol[places]])
            if not other.any():
                return symbol, begins, lengths
            known[places[other]] = False


def hits_of_shard(phrases: Phrases, texts: list[bytes]) -> tuple[Words, np.ndarray, list[set[str]]]:
    """The shard's words, which of them are hit, and by text the items that occur."""
    words = Words([t.lower() for t in texts], _GAP_TABLE)
    hit, items = np.zeros(len(words.hashes), bool), [set() for _ in texts]
    if not len(phrases.rows) or not len(words.hashes):
        return words, hit, items
    symbol, begins, lengths = phrases.runs(words)
    if not len(begins):
        return words, hit, items
    places = spread(begins, lengths)
    index = FmIndex(symbol[places] + 1, lengths, len(phrases.vocabulary))
    which, (low, high) = index.search(phrases.rows, phrases.lengths)
    if len(which):
        times = high - low
        at, phrase = places[index.locate(spread(low, times))], np.repeat(which, times)
        change = np.bincount(at, minlength=len(hit) + 1) - np.bincount(at + phrases.lengths[phrase], minlength=len(hit) + 1)
        hit = np.cumsum(change)[:-1] > 0
        text = np.searchsorted(words.bounds, at, side="right") - 1
        for t, p in np.unique(np.stack((text, phrase), 1), axis=0).tolist():
            items[t].update(phrases.names[k] for k in phrases.owners[phrases.cuts[p] : phrases.cuts[p + 1]].tolist())
    return words, hit, items


def cut_text(text: bytes, words: Words, t: int, found: list[dict]) -> str:
    """Text t of words without its spans, which are merged."""
    left, at, a, offset = [], 0, words.bounds[t], words.offsets[t]
    for s in found:
        left.append(text[at : words.begins[a + s["begin"]] - offset])
        at = words.ends[a + s["end"] - 1] - offset
    return b"".join([*left, text[at:]]).decode("utf-8", "surrogatepass")


def merged(spans):
    """Sorted spans with overlapping and touching ones made one."""
    last = lambda s: F.element_at(s, -1)
    grown = lambda s, x: F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.struct(last(s)["begin"].alias("begin"), F.greatest(last(s)["end"], x["end"]).alias("end"))))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<begin: int, end: int>>"), lambda s, x: F.when((F.size(s) > 0) & (F.try_element_at(s, F.lit(-1))["end"] >= x["begin"]), grown(s, x)).otherwise(F.concat(s, F.array(x))))


SPANS = "doc_id long, row_key long, n_words long, spans array<struct<begin: int, end: int>>, items array<string>, cut string"


def spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cut: bool = False) -> DataFrame:
    """By document: words, merged spans of hit words (begin, end), items that occur; with cut, the text without those spans."""
    named = benchmark.select(F.col("item_id").cast("string").alias("name"), "text").filter("name is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = 1 + size // PHRASE_BYTES
    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"))
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())), ("cut", pa.string())])

    def searcher(shared):
        def search(batches):
            phrases = shared.value
            for texts, ids, keys in blocks(batches, SHARD_BYTES, ["text", "doc_id", "row_key"]):
                words, hit, items = hits_of_shard(phrases, texts)
                counts, out, cuts = np.diff(words.bounds), [[] for _ in ids], [None] * len(ids)
                sums = np.concatenate(([0], np.cumsum(hit)))
                for t in np.flatnonzero(sums[words.bounds[1:]] > sums[words.bounds[:-1]]).tolist():
                    a, b = words.bounds[t], words.bounds[t + 1]
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].view(np.int8), [0]))))
                    out[t] = [{"begin": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                    if cut and passes == 1:
                        cuts[t] = cut_text(texts[t], words, t, out[t])
                values = (ids, keys, counts, out, [sorted(x) for x in items], cuts)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        return search

    small_batches(docs.sparkSession)
    found = None
    for k in range(passes):
        part = named.filter(F.pmod(F.xxhash64("name"), F.lit(passes)) == k) if passes > 1 else named
        shared = docs.sparkSession.sparkContext.broadcast(Phrases([(r[0], r[1]) for r in part.collect()], window))  # at most about PHRASE_BYTES
        one = rows.mapInArrow(searcher(shared), SPANS)
        found = one if found is None else found.union(one)
    if passes > 1:
        found = found.groupBy("doc_id", "row_key").agg(F.max("n_words").alias("n_words"), merged(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.count("*").alias("rows"))
        if cut:
            found = cut_again(rows, found.drop("rows"), schema)
        else:  # rows that repeat an id and text came once per pass each
            found = found.withColumn("again", F.explode(F.sequence(F.lit(1), (F.col("rows") / passes).cast("int")))).drop("again", "rows").withColumn("cut", F.lit(None).cast("string"))
    return found


def cut_again(rows: DataFrame, found: DataFrame, schema: pa.Schema) -> DataFrame:
    """found for each of the rows, with the text cut once from the merged spans of all passes."""
    named = found.withColumnsRenamed({"doc_id": "f_doc", "row_key": "f_row"})
    joined = rows.join(named, F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("row_key") == F.col("f_row"))).select("text", "doc_id", "row_key", "n_words", "spans", "items")

    def cutter(batches):
        for texts, *values in blocks(batches, SHARD_BYTES, ["text", "doc_id", "row_key", "n_words", "spans", "items"]):
            words = Words([t.lower() for t in texts], _GAP_TABLE)
            cuts = [cut_text(text, words, t, found) if found else None for t, (text, found) in enumerate(zip(texts, values[3], strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((*values, cuts), schema, strict=True)], schema=schema)

    return joined.mapInArrow(cutter, SPANS)


def verdicts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The digest of spans(): counts of words, of hit words and of items, and whether a twentieth of the words is hit."""
    found = spans(docs, benchmark, window)
    # spans of several passes may overlap
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")), lambda s, x: F.struct(F.greatest(s["at"], x["end"]).alias("at"), (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["begin"], s["at"]))).alias("n")), lambda s: s["n"])
    counted = found.select("doc_id", "row_key", "n_words", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"))
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op5_benchmark_decontamination(spark, sf_dir):
    """The verdict on every whole document against the whole benchmark."""
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_WORDS = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_SQL_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item, w, least(len(w), {WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k)),
o AS (SELECT doc_id, i, k, item FROM dw JOIN p USING (k, s)),
h AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM o, range(0, {WINDOW}) AS r(j) WHERE j < k GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
