"""Best-fit packing of token sequences by linear grouping.

Lengths are integers up to the capacity, so a histogram of at most `capacity`
rows describes the whole corpus. From it the driver makes a run-length plan:
lengths over `small` are rounded up to the largest of their group (groups of
equal cardinality), configurations of the few rounded sizes are optimised by
filling each sequence around the largest size left, actual lengths are put in
place of the rounded ones, and small lengths go by best fit into what is left.
A plan's rows say which ranks of which length go to which sequences; pieces get
their rank within their length by salted counting and find their row by a join.
The plan's size depends on capacity and groups, not on the corpus.

Nulls: a null text is empty, a row without doc_id is packed like any other, and
rows that repeat a document are packed each for itself. Without rows there are
no sequences. Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import sys
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runtime import shuffle_partitions, small_batches, store
from tidemark.llm.words import release

CAPACITY, SMALL, GROUPS, END_ID = 2048, 512, 1000, 0
PIECES = "doc_id long, piece int, start long, length long, ids binary"
# The characters of Unicode's property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_RUN = re.compile(f"[{WHITE}]{{2,}}+")


class Encoder:
    """Byte-level BPE. Added tokens are cut out first, as longest matches from the left.

    The vocabulary's pattern looks ahead only for the last character of a run of
    white space before a word. Texts are cut before that character instead, and
    the pattern without its look-ahead, which never goes back, gives the same.
    """

    LOOK_AHEAD = r"\s+(?!\S)|"

    def __init__(self, vocabulary: str, pattern: str, added: dict[str, int] | None = None):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("vocabulary", pat_str=pattern.replace(self.LOOK_AHEAD, ""), mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = added or {}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else lambda text: [text]

    def _ordinary(self, text: str, out: array) -> None:
        at = 0
        for run in _SPACE_RUN.finditer(text):
            if (end := run.end()) < len(text):
                out.extend(self.plain(text[at : end - 1]))
                at = end - 1
        out.extend(self.plain(text[at:] if at else text))

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        out = array("I")
        for k, part in enumerate(self.cut(text)):
            if k % 2:
                out.append(self.added[part])
            elif part:
                self._ordinary(part, out)
        return out.tobytes() if sys.byteorder == "little" else np.array(out, "<u4").tobytes()


def added_tokens(path: str) -> dict[str, int]:
    """Added tokens of a vocabulary file and their ids; only such as are matched anywhere and just so."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if odd := [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"]]:
        raise ValueError(f"added tokens that are matched in another way: {odd}")
    return {t["content"]: t["id"] for t in tokens}


def pieces(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece with its ids; a null text is empty. Longer documents are cut from the end, so only the first piece is shorter."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json")) if added is None else added
    pattern = pattern or public_tokenizers.PATTERN
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def encode(batches):
        encoder = Encoder(vocabulary, pattern, added)
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            out = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.ids(text or "") + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for into, value in zip(out, (doc_id, k, a, b - a, ids[4 * a : 4 * b]), strict=True):
                        into.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)
        release()

    small_batches(docs.sparkSession, 8)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first_rank, count, first_sequence, offset): rank first_rank + i of that length goes to sequence first_sequence + i."""
    rows: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = defaultdict(int)
    free: list[tuple[int, int, int]] = []  # (slack, first sequence, count), ordered by slack
    sequences = 0

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        rows.append((length, used[length], count, sequence, offset))
        used[length] += count

    large = [(n, histogram[n]) for n in sorted(histogram, reverse=True) if n > small and histogram[n]]
    share = max(1, -(-sum(c for _, c in large) // groups))
    members: list[list[list[int]]] = []  # by group: [length, count], longest first; the first is what all are rounded up to
    room = 0
    for n, count in large:
        while count:
            if not room or n > capacity // 2 and members[-1][0][0] != n and count >= share:
                members.append([])
                room = share
            take = min(count, room)
            members[-1].append([n, take])
            count, room = count - take, room - take
    left = [sum(c for _, c in g) for g in members]
    size = [g[0][0] for g in members]

    first = 0
    while first < len(size):
        if not left[first]:
            first += 1
            continue
        # subset sums beside the largest size left, by bit sets; the fullest sum is traced back
        rest = capacity - size[first]
        sums, layers = 1, []
        for k in range(first, len(size)):
            count = min(left[k] - (k == first), rest // size[k])
            for _ in range(max(0, count)):
                more = sums | (sums << size[k] & ((1 << rest + 1) - 1))
                if more == sums:
                    break
                layers.append((k, sums))
                sums = more
        full = sums.bit_length() - 1
        need: dict[int, int] = defaultdict(int)
        need[first] = 1
        for k, before in reversed(layers):
            if full and not before >> full & 1:
                need[k] += 1
                full -= size[k]
        copies = min(left[k] // c for k, c in need.items())
        # actual lengths: each slot takes runs of equal lengths from its group, and the copies are split where any slot's run ends
        slots = [k for k, c in sorted(need.items()) for _ in range(c)]
        taken: list[list[list[int]]] = []
        for k in slots:
            runs, want = [], copies
            while want:
                n, count = members[k][0]
                take = min(count, want)
                runs.append([n, take])
                want -= take
                if take == count:
                    members[k].pop(0)
                else:
                    members[k][0][1] -= take
            taken.append(runs)
            left[k] -= copies
        done = 0
        while done < copies:
            run = min(t[0][1] for t in taken)
            offset = 0
            for t in taken:
                place(t[0][0], run, sequences, offset)
                offset += t[0][0]
                t[0][1] -= run
                if not t[0][1]:
                    t.pop(0)
            bisect.insort(free, (capacity - offset, sequences, run))
            sequences, done = sequences + run, done + run

    for n in sorted((n for n in histogram if n <= small), reverse=True):
        count = histogram[n]
        while count:
            at = bisect.bisect_left(free, (n,))
            if at == len(free):
                opened = -(-count // (capacity // n))
                free.append((capacity, sequences, opened))
                sequences += opened
                continue
            slack, sequence, copies = free.pop(at)
            each = min(slack // n, count)
            run = min(copies, count // each)
            for i in range(each):
                place(n, run, sequence, capacity - slack + i * n)
            count -= each * run
            if slack - each * n:
                bisect.insort(free, (slack - each * n, sequence, run))
            if copies > run:
                bisect.insort(free, (slack, sequence + run, copies - run))
    return rows


def ranged(rows: list[tuple[int, int, int, int, int]]) -> tuple[list[tuple], list[tuple]]:
    """A plan's rows by the ranges of ranks that they touch, and the width of a length's ranges: it has as many of them as rows, so a piece meets two rows on average and not all."""
    totals: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for length, _, n, *_ in rows:
        totals[length][0] += n
        totals[length][1] += 1
    width = {length: -(-n // k) for length, (n, k) in totals.items()}
    return list(width.items()), [(length, k, first, n, sequence, at) for length, first, n, sequence, at in rows for k in range(first // width[length], (first + n - 1) // width[length] + 1)]


def pack(measured: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to rows of pieces (doc_id, piece, length, and what else they have).

    Ranks within a length are counted by salted groups, so that one length that
    a third of all pieces have is spread over as many tasks as any other rows.
    """
    spark = measured.sparkSession
    histogram = {r["length"]: r["count"] for r in measured.groupBy("length").count().collect()}  # at most `capacity` rows
    planned = plan(histogram, capacity, small, groups)
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shuffle_partitions(spark))).cast("int"))
    counts = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("length").alias("b_length"), F.col("salt").alias("b_salt"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("place", F.row_number().over(order)).join(bases, (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt")))
    ranked = ranked.withColumn("rank", F.col("base") + F.col("place") - 1).drop("b_length", "b_salt", "base", "place", "salt")
    widths, rows = ranged(planned)
    widths = spark.createDataFrame(widths or [(0, 1)], "w_length long, width long")
    p = spark.createDataFrame(rows or [(0, 0, 0, 0, 0, 0)], "p_length long, p_range long, first_rank long, n long, first_sequence long, at long")
    placed = ranked.join(F.broadcast(widths), F.col("length") == F.col("w_length")).withColumn("range", F.floor(F.col("rank") / F.col("width")))
    found = placed.join(F.broadcast(p), (F.col("length") == F.col("p_length")) & (F.col("range") == F.col("p_range")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n")))
    return found.select(*measured.columns, (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), F.col("at").alias("offset"))


def op7_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens; null texts are empty, repeated rows are packed each for itself, no rows give none."""
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def packed(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Digest of the packed corpus, a row per piece. The ids stay where they were made; only their checksums are kept for the join."""
    made = pieces(docs, capacity=capacity)
    measured = store(made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(measured, capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id and ids, the pieces' ids one after the other."""
    placed = pack(store(pieces(docs, capacity=capacity), "piece-ids"), capacity)
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
