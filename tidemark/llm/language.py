"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to DEPTH, grown on a bounded
sample, gives the exact length of a word's code under frozen counts: a symbol
is coded in the longest known context that has it, at the price of an escape
for each longer one that does not. Contexts begin at the blank before a word,
so a word's code length does not depend on its neighbours and is worked out
once per word and task, not once per occurrence.

Nulls: rows with a null text or lang teach nothing; a null text is `und`, and so
is one without a letter (`str.isalpha`, so neither digits nor superscripts nor
fractions). Without anything to learn from all texts are `und`. Rows without
doc_id are judged like others; rows that repeat a document are judged each for
itself, and may be sampled twice. Without rows there is no result; columns other
than doc_id, text and lang are not looked at. A whole text is scored, however
long it is.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import small_batches, table

DEPTH = 4
#: Most documents that one language's tree is grown on: one for each of so many hash buckets.
SAMPLE_ROWS = 256
#: Most bytes of sampled texts, all languages together, but for one document of each.
SAMPLE_BYTES = 24 << 20
CACHE = 400_000


class Tree:
    """Costs in bits: by context, of each symbol seen there and, under -1, of an escape."""

    def __init__(self, words: Counter, depth: int = DEPTH):
        counts: dict[bytes, Counter] = defaultdict(Counter)
        for word, times in words.items():
            coded = b" " + word + b" "
            for i in range(1, len(coded)):
                for k in range(min(depth, i) + 1):
                    counts[coded[i - k : i]][coded[i]] += times
        self.depth, self.costs = depth, {}
        for context, seen in counts.items():
            total = sum(seen.values()) + len(seen)  # method C: an escape counts as often as there are symbols
            self.costs[context] = {s: math.log2(total / n) for s, n in seen.items()} | {-1: math.log2(total / len(seen))}

    def bits(self, word: bytes) -> float:
        coded, costs, total = b" " + word + b" ", self.costs, 0.0
        for i in range(1, len(coded)):
            symbol = coded[i]
            for k in range(min(self.depth, i), -1, -1):
                here = costs.get(coded[i - k : i])
                if here is None:
                    continue
                cost = here.get(symbol)
                if cost is not None:
                    total += cost
                    break
                total += here[-1]
            else:
                total += 8.0
        return total


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


class Automaton:
    """All trees as one automaton: a state is the longest context that any tree knows; costs[state, symbol] has a column for each tree."""

    def __init__(self, trees: list[Tree]):
        depth = max((t.depth for t in trees), default=0)
        contexts = sorted({b""}.union(*(t.costs for t in trees)), key=lambda c: (len(c), c))
        number = {c: k for k, c in enumerate(contexts)}
        seen = sorted({s for t in trees for c in t.costs.values() for s in c if s >= 0})
        self.symbol = np.zeros(256, np.int32)  # 0: a byte that no tree has seen
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.costs = np.full((len(contexts), len(seen) + 1, len(trees)), 8.0, np.float32)
        self.after = np.zeros((len(contexts), len(seen) + 1), np.int32)
        for k, context in enumerate(contexts):
            if context:
                self.costs[k] = self.costs[number[context[1:]]]
            for j, tree in enumerate(trees):
                if (here := tree.costs.get(context)) is not None:
                    self.costs[k, :, j] += here[-1]
                    known = [x for x in here if x >= 0]
                    self.costs[k, self.symbol[known], j] = [here[x] for x in known]
            for x in seen:
                longest = (context + bytes([x]))[-depth:] if depth else b""
                while longest not in number:
                    longest = longest[1:]
                self.after[k, self.symbol[x]] = number[longest]
        self.start = number.get(b" ", 0) if depth else 0

    def bits(self, words: list[bytes]) -> np.ndarray:
        """Code lengths of words, a column for each tree: all words advance by a byte at a time, longest first."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        begins = (np.cumsum(lengths + 1) - lengths - 1)[order]
        coded = self.symbol[np.frombuffer(b" ".join(words) + b" ", np.uint8)]
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=-1) + 1), side="right")
        total, state = np.zeros((len(words), self.costs.shape[2])), np.full(len(words), self.start, np.int32)
        for step, n in enumerate(active.tolist()):
            at, symbol = state[:n], coded[begins[:n] + step]
            total[:n] += self.costs[at, symbol]
            state[:n] = self.after[at, symbol]
        out = np.empty_like(total)
        out[order] = total
        return out


class Scorer:
    """Code lengths of texts; those of a word are kept while there is room."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.number = automaton, {}
        self.rows = np.zeros((0, automaton.costs.shape[2]))

    def lengths(self, texts: list[list[bytes]]) -> np.ndarray:
        if len(self.number) > CACHE:
            self.number, self.rows = {}, self.rows[:0]
        new = list(set().union(*texts).difference(self.number))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.rows = np.concatenate((self.rows, self.automaton.bits(new)))
        out = np.zeros((len(texts), self.rows.shape[1]))
        for k, words in enumerate(texts):
            if words:
                out[k] = self.rows[list(map(self.number.__getitem__, words))].sum(0)
        return out


def fair_share(sizes: list[int], most: int) -> int:
    """What each may take at most so that all together take `most`: what small ones leave goes to the others."""
    left, share = most, most
    for k, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - k)
        left -= min(size, share)
    return share


def sample(labelled: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, str]]:
    """(lang, text) of at most `rows` documents a language: the one with the least hash of each bucket, by partial aggregation. A language has its share of the bytes, and one document in any case."""
    hashed = labelled.filter("lang is not null and text is not null").withColumn("h", F.xxhash64("doc_id", F.lit(1)))
    least = hashed.groupBy("lang", F.pmod("h", F.lit(rows)).alias("bucket")).agg(F.min(F.struct("h", "doc_id", F.octet_length("text").alias("size"))).alias("m"))
    share = fair_share([r[0] for r in least.groupBy("lang").agg(F.sum("m.size").alias("size")).select("size").collect()], most_bytes)
    ids = least.select(F.col("m.h").alias("h")).distinct()
    out, size, sizes = [], 0, Counter()
    for lang, text in hashed.join(F.broadcast(ids), "h").select("lang", "text").orderBy("h", "lang", "text").toLocalIterator():
        n = len(text.encode())
        if lang in sizes and (sizes[lang] + n > share or size + n > most_bytes):
            continue
        sizes[lang] += n
        size += n
        out.append((lang, text))
    return out


def learn(sampled: list[tuple[str, str]]) -> dict[str, Tree]:
    words: dict[str, Counter] = defaultdict(Counter)
    for lang, text in sampled:
        words[lang].update(words_of(text))
    return {lang: Tree(words[lang]) for lang in sorted(words)}


def identified(docs: DataFrame, trees: dict[str, Tree]) -> DataFrame:
    """doc_id, lang_pred, score: the posterior of the best language, all being as likely beforehand."""
    names = list(trees)
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(list(trees.values())))  # bounded by the sample
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def score(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = [t if t is not None and names and any(map(str.isalpha, t)) else None for t in batch.column(1).to_pylist()]
            langs, scores = [], []
            for text, bits in zip(texts, scorer.lengths([words_of(t or "") for t in texts]), strict=True):
                if text is None:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                best = int(np.argmin(bits))
                langs.append(names[best])
                scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema=schema)

    small_batches(docs.sparkSession, 8)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, lang_pred string, score double")


def op4_language_id(spark, sf_dir):
    """The language of every whole text, learnt from documents that are not held out; see the module for nulls and ties (the first language by name wins)."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
    trees = learn(sample(docs.select("doc_id", "text", "lang").filter(~held_out)))
    return identified(docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
