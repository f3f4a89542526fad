"""LM scoring with a hashed maximum-entropy model.

A token's probability is a product of three: that of its class in context, that
of its slot in the class and the context, and that of the word in its slot. The
first two are softmaxes over hashed features: the word before, the two words
before, and the word before the last (a skip), each kind in a table of its own;
for slots, features are hashed with the class. Words in a slot are as likely as
their training counts say, and every slot keeps room for a word that it has not
seen.

Classes are learnt: the TOP most frequent words are clustered by the words that
stand before and after them. In a class, the frequent words have a slot of their
own and the others share them evenly; the last slot is for all rarer words,
which go to a class by hash. The end of a text is a word.

Training is by distributed gradient updates: a task takes its texts in steps of
STEP tokens, moves the weights of the features that it meets (by Adagrad, in
sparse numpy batches), and the tasks' weights are averaged, each row by how
often a task has met it. The number of rows grows with the root of the number
of training tokens, up to 2**MOST_BITS for each kind.

Counts of words are no bounded table, so they are not broadcast: texts are dealt
out to chunks, each chunk asks the holders of the counts for its own words, and
the answers are joined to the chunk. Holders and chunks are as many as the bytes
of all texts ask for.

Nulls: a null text is empty; it is scored by its end token. Rows without doc_id
and rows that repeat a document are scored, and learnt from, each for itself.
Without rows there is no result; without training texts every token is as likely
as any. Other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import SLICE, salts_of, shuffle_partitions, slices, small_batches, store, summed, table
from tidemark.llm.substrings import _packed, _unpacked
from tidemark.llm.words import Words, blocks, mix, pair

CLASSES, SLOTS, TOP, CONTEXTS = 16, 32, 16_384, 16
#: A word with one in so many training tokens can be among the TOP; so at most so many words come to the driver.
OFTEN = 1 << 17
LEAST_BITS, MOST_BITS, KINDS = 10, 17, 3
ROUNDS, RATE, STEP = 1, 0.6, 8192
#: Exponents up to which neither they nor their sums leave the range of 32 bits.
SAFE = 80
#: Rows of a step that are added up one by one.
FEW = 24
BLOCK_BYTES = 4 << 20
#: Bytes of text for a chunk, and for a holder of counts.
CHUNK_BYTES, HOLDER_BYTES = 4 << 20, 64 << 20
_U = np.uint64
_END, _BEGIN = _U(0x51ED270B27B4F3CF), _U(0x2545F4914F6CDD1D)
_PAYLOAD = pa.schema([("target", pa.int32()), ("chunk", pa.int32()), ("payload", pa.binary())])
_PAYLOAD_SQL = "target int, chunk int, payload binary"


class Tokens:
    """Words and one end for each text, in one row: hashes, and those of one and two before; bounds[i]:bounds[i + 1] are text i's."""

    def __init__(self, texts: list[bytes]):
        words = Words([t.lower() for t in texts])
        self.bounds = np.concatenate(([0], np.cumsum(np.diff(words.bounds) + 1)))
        end = np.zeros(self.bounds[-1], bool)
        end[self.bounds[1:] - 1] = True
        self.hashes = np.full(len(end), _END, _U)
        self.hashes[~end] = words.hashes
        self.one = np.concatenate(([_BEGIN], self.hashes[:-1]))
        self.one[self.bounds[:-1]] = _BEGIN
        self.two = np.concatenate(([_BEGIN], self.one[:-1]))
        self.two[self.bounds[:-1]] = _BEGIN

    def histories(self) -> list[np.ndarray]:
        return [mix(self.one), pair(self.two, self.one), mix(self.two ^ _END)]


class Leaves:
    """Which class and slot a word has: class * SLOTS + slot."""

    def __init__(self, hashes: np.ndarray, leaf: np.ndarray):
        self.hashes, self.leaf = hashes, leaf

    def of(self, hashes: np.ndarray) -> np.ndarray:
        rare = (mix(hashes) % _U(CLASSES)).astype(np.int32) * SLOTS + SLOTS - 1
        if not len(self.hashes):
            return rare
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.leaf[at], rare)


class Softmax:
    """Weights of one level: a row for each hashed feature, KINDS tables of 2**bits one after the other, then a row of biases for each class that it is about (one for the level of classes)."""

    def __init__(self, bits: int, counts: np.ndarray):
        self.bits = bits
        share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
        self.weights = np.zeros(((KINDS << bits) + len(counts), counts.shape[1]), np.float32)
        self.weights[KINDS << bits :] = np.log(share)

    def rows(self, histories: list[np.ndarray], about: np.ndarray | None) -> list[np.ndarray]:
        """Row numbers of all tokens' features, and last of their biases."""
        if about is not None:
            salt = mix(about.astype(_U) + _U(1))
            histories = [mix(h ^ salt) for h in histories]
        out = [(k << self.bits) + (h >> _U(64 - self.bits)).astype(np.int32) for k, h in enumerate(histories)]
        return [*out, (KINDS << self.bits) + (np.zeros(len(out[0]), np.int32) if about is None else about)]

    def powers(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities before they are divided by their sums, and the sums."""
        z = self.weights.take(rows[0], 0)
        for r in rows[1:]:
            z += self.weights.take(r, 0)
        if len(z) and max(z.max(), -z.min()) > SAFE:
            z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        return z, z @ np.ones(z.shape[1], z.dtype)

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        z, total = self.powers(rows)
        z /= total[:, None]
        return z

    def right(self, rows: list[np.ndarray], right: np.ndarray) -> np.ndarray:
        """The probability of what is right alone."""
        z, total = self.powers(rows)
        return z[np.arange(len(right)), right] / total

    def start(self) -> None:
        """Ready to learn: squared gradients and numbers of tokens by row. The weights become its own."""
        self.weights = self.weights.copy()
        self.squares, self.met = (np.zeros(len(self.weights), np.float32) for _ in range(2))

    def update(self, rows: list[np.ndarray], right: np.ndarray) -> None:
        """One step: log likelihood's gradient by row, scaled by the root of the squares so far."""
        slope, total = self.powers(rows)
        slope /= -total[:, None]
        slope[np.arange(len(right)), right] += 1
        whole = self.weights.view(np.dtype((np.void, self.weights.itemsize * self.weights.shape[1]))).ravel()  # a row as one value: it is put several times as fast
        for r in rows:
            some, met, total = by_row(slope, r)
            self.squares[some] += np.einsum("ij,ij->i", total, total)
            self.met[some] += met
            total *= RATE
            total /= np.sqrt(self.squares[some] + 0.01)[:, None]
            total += self.weights.take(some, 0)
            np.put(whole, some, total.view(whole.dtype).ravel())


def by_row(slope: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, how often each is there, and the sum of its slopes. Rows that are there k times or more get their kth in one go; what is left when only FEW rows have more is added up row by row."""
    if rows[0] == rows[-1] and (rows == rows[0]).all():  # one bias for all
        return rows[:1], np.array([len(rows)]), slope.sum(0, keepdims=True)
    shift = len(rows).bit_length()
    key = np.sort((rows.astype(np.int64) << shift) | np.arange(len(rows)))  # several times as fast as argsort
    ordered, order = key >> shift, key & ((1 << shift) - 1)
    begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    met = np.diff(begin, append=len(rows))
    by = np.argsort(-np.minimum(met, 127).astype(np.int8), kind="stable")  # a radix sort
    begin, met = begin[by], met[by]
    total = slope.take(order[begin], 0)
    more, done = np.count_nonzero(met > 1), 1
    while more > FEW and done < 126:  # beyond, the order does not tell rows apart
        total[:more] += slope.take(order[begin[:more] + done], 0)
        done += 1
        more = np.count_nonzero(met[:more] > done)
    for k in range(more):
        total[k] += slope.take(order[begin[k] + done : begin[k] + met[k]], 0).sum(0)
    return ordered[begin], met, total


class Model:
    """All three levels. counts, kinds: training tokens and distinct words by leaf."""

    def __init__(self, leaves: Leaves, counts: np.ndarray, kinds: np.ndarray, bits: int):
        self.leaves, self.counts, self.kinds = leaves, counts, kinds
        by_class = counts.reshape(CLASSES, SLOTS)
        self.levels = [Softmax(bits, by_class.sum(1)[None, :]), Softmax(bits + 1, by_class)]

    def cases(self, t: Tokens) -> tuple[np.ndarray, list[tuple[Softmax, list[np.ndarray], np.ndarray]]]:
        """Leaves of the tokens, and by level its softmax, the rows of features, and what is right."""
        leaf, histories = self.leaves.of(t.hashes), t.histories()
        of_class, slot = np.divmod(leaf, SLOTS)
        first, second = self.levels
        return leaf, [(first, first.rows(histories, None), of_class), (second, second.rows(histories, of_class), slot)]

    def scores(self, t: Tokens, n: np.ndarray) -> np.ndarray:
        """log10 probabilities of tokens, whose training counts are n."""
        leaf, cases = self.cases(t)
        out = np.log10((n + 1) / (self.counts + self.kinds + 1)[leaf])
        for softmax, rows, right in cases:
            for a in range(0, len(right), STEP):
                p = softmax.right([r[a : a + STEP] for r in rows], right[a : a + STEP])
                out[a : a + STEP] += np.log10(np.maximum(p, 1e-30))
        return out

    def learn(self, t: Tokens) -> None:
        _, cases = self.cases(t)
        for softmax, rows, right in cases:
            for a in range(0, len(right), STEP):
                softmax.update([r[a : a + STEP] for r in rows], right[a : a + STEP])


def averaged(texts: DataFrame, model: Model) -> list[np.ndarray]:
    """Weights by level after a round over all texts: the tasks' weights, each row weighted by how often a task has met it. Averages are made in slices, in two steps."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    rows = [len(s.weights) for s in model.levels]
    number = max(16, sum(s.weights.nbytes for s in model.levels) >> 20)
    salts = salts_of(texts)

    def learn(batches):
        own, some = shared.value, False
        for softmax in own.levels:
            softmax.start()
        for (block,) in blocks(batches, BLOCK_BYTES, ["text"]):
            own.learn(Tokens(block))
            some = True
        for part in range(number if some else 0):
            pieces = []
            for softmax in own.levels:
                cut = slice(part * len(softmax.met) // number, (part + 1) * len(softmax.met) // number)
                met = softmax.met[cut]
                pieces += [met, np.where(met[:, None] > 0, softmax.weights[cut], 0).astype(np.float16).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([TaskContext.get().partitionId() % salts], pa.int32()), pa.array([_packed(*pieces)], pa.binary())], names=["part", "salt", "payload"])

    def mean(group: pa.Table) -> pa.Table:
        sums = None
        for x in group["payload"]:
            parts = [p.astype(np.float32) for p in _unpacked(x.as_py(), np.float32, np.float16, np.float32, np.float16)]
            weighted = [(met, w.reshape(len(met), -1) * met[:, None] if len(met) else w.reshape(0, 1)) for met, w in (parts[:2], parts[2:])]
            sums = weighted if sums is None else [(m + n, v + w) for (m, v), (n, w) in zip(sums, weighted, strict=True)]
        pieces = [y for met, w in sums for y in (met, (w / np.maximum(met, 1)[:, None]).astype(np.float16).ravel())]
        return pa.table({"part": group["part"][:1], "salt": pa.array([0], pa.int32()), "payload": pa.array([_packed(*pieces)], pa.binary())})

    found = texts.mapInArrow(learn, SLICE).groupBy("part", "salt").applyInArrow(mean, SLICE).groupBy("part").applyInArrow(mean, SLICE).collect()  # as much as the model, at most 63 MB
    shared.unpersist()
    out = [s.weights.copy() for s in model.levels]
    for r in found:
        parts = _unpacked(bytes(r["payload"]), np.float32, np.float16, np.float32, np.float16)
        for weights, n, met, w in zip(out, rows, parts[::2], parts[1::2], strict=True):
            at = r["part"] * n // number + np.flatnonzero(met)
            weights[at] = w.reshape(-1, weights.shape[1])[met > 0]
    return out


def word_counts(texts: DataFrame, targets: int) -> DataFrame:
    """(target, payload, n): by hash range, sorted word hashes and their counts, and how many tokens those are. A task counts its own words first."""

    def count(batches):
        for (block,) in blocks(batches, BLOCK_BYTES, ["text"]):
            hashes, n = np.unique(Tokens(block).hashes, return_counts=True)
            yield from _dealt(hashes, targets, None, n.astype(np.uint32))

    def merge(group: pa.Table) -> pa.Table:
        parts = [_unpacked(x.as_py(), _U, np.uint32) for x in group["payload"]]
        found, back = np.unique(np.concatenate([np.cumsum(p[0], dtype=_U) for p in parts]), return_inverse=True)
        n = np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
        return pa.table({"target": group["target"][:1], "payload": pa.array([_packed(np.diff(found, prepend=_U(0)), n)], pa.binary()), "tokens": pa.array([int(n.sum())], pa.int64()), "words": pa.array([len(n)], pa.int64())})

    return texts.mapInArrow(count, _PAYLOAD_SQL).groupBy("target").applyInArrow(merge, "target int, payload binary, tokens long, words long")


def _read_counts(payload) -> tuple[np.ndarray, np.ndarray]:
    steps, n = _unpacked(payload.as_py(), _U, np.int64)
    return np.cumsum(steps, dtype=_U), n


def frequent(counts: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the TOP most frequent words that have one in OFTEN tokens."""

    def pick(batches):
        for batch in batches:
            for payload in batch.column(0):
                hashes, n = _read_counts(payload)
                keep = n * OFTEN >= total
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[keep].view(np.int64)), pa.array(n[keep])], names=["h", "n"])

    found = counts.select("payload").mapInArrow(pick, "h long, n long").toPandas()  # at most OFTEN rows
    hashes, n = found["h"].to_numpy(np.int64).view(_U), found["n"].to_numpy(np.int64)
    order = np.lexsort((hashes, -n))[:TOP]
    order = order[np.argsort(hashes[order])]
    return hashes[order], n[order]


def neighbours(texts: DataFrame, words: np.ndarray) -> np.ndarray:
    """For each of the words, how often words of each hash bucket stand before it and after it."""
    salts = salts_of(texts)
    shared = texts.sparkSession.sparkContext.broadcast(words)  # at most TOP hashes

    def count(batches):
        known = shared.value
        total = np.zeros(len(known) * 2 * CONTEXTS, np.float32)
        for (block,) in blocks(batches, BLOCK_BYTES, ["text"]):
            t = Tokens(block)
            at = np.minimum(np.searchsorted(known, t.hashes), len(known) - 1)
            there = known[at] == t.hashes
            after = np.append(t.hashes[1:], _END)
            after[t.bounds[1:] - 1] = _BEGIN
            for side, near in enumerate((t.one, after)):
                bucket = (mix(near ^ _U(side + 1)) % _U(CONTEXTS)).astype(np.int64)
                total += np.bincount(((at * 2 + side) * CONTEXTS + bucket)[there], minlength=len(total)).astype(np.float32)
        yield slices(total, salts)

    out = summed(texts.mapInArrow(count, SLICE), len(words) * 2 * CONTEXTS).reshape(len(words), 2 * CONTEXTS)
    shared.unpersist()
    return out


def learnt_leaves(hashes: np.ndarray, n: np.ndarray, near: np.ndarray, rounds: int = 12) -> Leaves:
    """Classes of words with like neighbours (spherical k-means on roots of shares, from the most frequent words on), and slots in them."""
    if not len(hashes):
        return Leaves(hashes, np.zeros(0, np.int32))
    sides = near.reshape(len(near), 2, CONTEXTS)
    points = np.sqrt(sides / np.maximum(sides.sum(2, keepdims=True), 1)).reshape(len(near), -1)
    by_count = np.lexsort((hashes, -n))
    centres = points[by_count[:CLASSES]]
    for _ in range(rounds):
        of_class = (points @ centres.T).argmax(1)
        for c in range(len(centres)):
            total = (points[of_class == c] * n[of_class == c, None]).sum(0)
            if total.any():
                centres[c] = total / np.linalg.norm(total)
    leaf, load = np.zeros(len(hashes), np.int32), np.zeros((CLASSES, SLOTS - 1))
    for k in by_count.tolist():  # the slot with the least so far, so frequent words come to have one of their own
        c = int(of_class[k])
        slot = int(load[c].argmin())
        load[c, slot] += n[k]
        leaf[k] = c * SLOTS + slot
    return Leaves(hashes, leaf)


def leaf_counts(counts: DataFrame, leaves: Leaves) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct words by leaf."""
    n_leaves, salts = CLASSES * SLOTS, salts_of(counts)
    shared = counts.sparkSession.sparkContext.broadcast(leaves)  # at most TOP words

    def count(batches):
        total = np.zeros((2, n_leaves))
        for batch in batches:
            for payload in batch.column(0):
                hashes, n = _read_counts(payload)
                leaf = shared.value.of(hashes)
                total += np.stack((np.bincount(leaf, n, n_leaves), np.bincount(leaf, minlength=n_leaves)))
        yield slices(total, salts)

    both = summed(counts.select("payload").mapInArrow(count, SLICE), 2 * n_leaves).reshape(2, n_leaves)
    shared.unpersist()
    return both[0], both[1]


def _targets(hashes: np.ndarray, targets: int) -> np.ndarray:
    """Cuts of sorted hashes into ranges of equal width."""
    width = (1 << 64) // targets + 1
    return np.searchsorted(hashes, np.array([k * width for k in range(1, targets)], _U)) if targets > 1 else np.zeros(0, np.int64)


def _dealt(hashes: np.ndarray, targets: int, chunk: int | None, *more: np.ndarray):
    cuts = [0, *_targets(hashes, targets).tolist(), len(hashes)]
    rows = [(k, _packed(np.diff(hashes[a:b], prepend=_U(0)), *(m[a:b] for m in more))) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=_PAYLOAD)


def trained(learnt: DataFrame, counts: DataFrame, total: int, text_bytes: int, rounds: int = ROUNDS) -> Model:
    """The model of the texts whose word counts are given."""
    words, n = frequent(counts, total)
    leaves = learnt_leaves(words, n, neighbours(learnt, words) if len(words) else np.zeros((0, 2 * CONTEXTS)))
    bits = min(MOST_BITS, max(LEAST_BITS, int(math.log2(4 * math.sqrt(total + 1)))))
    model = Model(leaves, *leaf_counts(counts, leaves), bits)
    # what the tasks send is to stay under half of the texts, so a larger model has fewer and longer tasks
    tasks = max(learnt.sparkSession.sparkContext.defaultParallelism, text_bytes // sum(s.weights.nbytes for s in model.levels))
    for _ in range(rounds if total else 0):
        for softmax, weights in zip(model.levels, averaged(learnt.coalesce(tasks), model), strict=True):
            softmax.weights = weights
    return model


def scored(docs: DataFrame, training, rounds: int = ROUNDS) -> DataFrame:
    """docs' rows (doc_id) scored: n_tokens, n_known, train_tokens, base_score, score. training: a condition that selects the rows to learn from."""
    spark = docs.sparkSession
    small_batches(spark, 4)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learnt = docs.filter(training).select("text")
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    targets = max(shuffle_partitions(spark), text_bytes // HOLDER_BYTES)
    chunks = max(4 * shuffle_partitions(spark), text_bytes // CHUNK_BYTES)
    counts = store(word_counts(learnt, targets), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    model = spark.sparkContext.broadcast(trained(learnt, counts, total, text_bytes, rounds))
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")
    dealt = rows.withColumn("chunk", chunk).repartition(shuffle_partitions(spark), "chunk")

    def ask(batches):
        now, held = None, []
        for batch in batches:
            for text, at in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if at != now:
                    if held:
                        yield from _dealt(np.unique(Tokens(held).hashes), targets, now)
                    now, held = at, []
                held.append((text or "").encode("utf-8", "surrogatepass"))
        if held:
            yield from _dealt(np.unique(Tokens(held).hashes), targets, now)

    def answer(group: pa.Table) -> pa.Table:
        known, counted, out = np.zeros(0, _U), np.zeros(0, np.int64), []
        for chunk, payload in zip(group["chunk"].to_pylist(), group["payload"], strict=True):
            if chunk is None:
                known, counted = _read_counts(payload)
        for chunk, payload in zip(group["chunk"].to_pylist(), group["payload"], strict=True):
            if chunk is not None:
                (steps,) = _unpacked(payload.as_py(), _U)
                asked = np.cumsum(steps, dtype=_U)
                at = np.minimum(np.searchsorted(known, asked), max(0, len(known) - 1))
                n = np.where(known[at] == asked, counted[at], 0) if len(known) else np.zeros(len(asked), np.int64)
                out.append((chunk, _packed(n.astype(np.int64))))
        return pa.table({"target": pa.array([group["target"][0].as_py()] * len(out), pa.int32()), "chunk": pa.array([x[0] for x in out], pa.int32()), "payload": pa.array([x[1] for x in out], pa.binary())})

    asked = dealt.sortWithinPartitions("chunk").mapInArrow(ask, _PAYLOAD_SQL)
    held = counts.select("target", F.lit(None).cast("int").alias("chunk"), "payload")
    answers = asked.unionByName(held).groupBy("target").applyInArrow(answer, _PAYLOAD_SQL)

    def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
        t = Tokens([(x or "").encode("utf-8", "surrogatepass") for x in texts["text"].to_pylist()])
        back = np.unique(t.hashes, return_inverse=True)[1]
        ordered = sorted(zip(replies["target"].to_pylist(), replies["payload"].to_pylist(), strict=True))
        n = np.concatenate([_unpacked(p, np.int64)[0] for _, p in ordered])[back]
        per_text = lambda x: np.add.reduceat(x, t.bounds[:-1])
        return pa.table({
            "doc_id": texts["doc_id"], "n_tokens": pa.array(np.diff(t.bounds)), "n_known": pa.array(per_text((n > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(texts), total, np.int64)),
            "base_score": pa.array(per_text(np.log10((n + 1) / (total + distinct + 1)))), "score": pa.array(per_text(model.value.scores(t, n))),
        })

    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op6_lm_scoring(spark, sf_dir):
    """All whole texts scored by a model of those that are not held out; a null text is scored by its end token alone."""
    remainder = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7))
    out = scored(table(spark, sf_dir, "documents").select("doc_id", "text"), remainder != 2)
    return out.withColumn("held_out", remainder == 2)
