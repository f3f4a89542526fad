"""Substring dedup with prefix-partitioned suffix trees over words.

A suffix begins at every word that has WINDOW words from there on, and is cut
off after those. Its anchor is its first word of least hash, words that are not
common before those that are; so neighbours mostly have the same anchor. Suffixes
go to groups by variable-length prefixes at their anchors: of one word, and of
more where shorter ones alone would outgrow the memory of a task; small prefixes
share a group. Neighbours in one group travel as one stretch of text: prefixes at
the first words would send each word thirteen times. Equal suffixes have equal
anchors and meet. A group's subtree is its suffixes in lexicographic order
with the words that each shares with the one before (the LCP array): its
internal nodes of depth WINDOW are the runs of suffixes that share all of them.
Nodes that hold two or more documents are repeats, and the windows of all but
the smallest are removed; windows that overlap or touch make one maximal repeat
of a document. Suffixes are compared by words, byte by byte, not by hashes.

Only suffixes that can be in such a node travel with their words:

1. Documents are dealt to blocks. A block resolves the nodes of its own.
2. It tells digests of the windows that it has left, and hears which of them
   other blocks have, as a bit for each.
3. Those suffixes go to their groups, and the groups answer with places.
4. Each block removes what it has been told.

A node has at most one document's suffixes of each block, so a passage that a
third of all documents share costs a group no more than there are blocks; if
those are more than a group may hold, groups are resolved in two steps.

Nulls: a null text has no words. Rows without doc_id neither remove words from
others nor lose any. Rows that repeat a doc_id are one document to each other:
none loses a word to another. Without rows there is no result. Other columns are
not looked at. Whole texts take part, however long; one text is in one block.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import SLICE, salts_of, shuffle_partitions, slices, small_batches, summed, table
from tidemark.llm.words import LONG, Words, blocks, release, spread, window_places, windows

WINDOW = 13
PREFIXES = (1, 2, 4, 8)
BLOCK_BYTES = 8 << 20
#: Suffixes that a group may have, and digests that one task compares.
GROUP_SUFFIXES, TASK_DIGESTS = 2_000_000, 2_000_000
#: Words that all tasks know, and how many of them each task proposes.
COMMON, COMMON_OF_TASK = 1 << 14, 4096
#: Digests are cut to this many bits more than count all suffixes; equal ones only make suffixes travel, some of them for nothing.
SPARE_BITS = 9
#: Bytes of texts for a block.
BUCKET_BYTES = 6 << 20
BLOCK_SQL, PART_SQL = "block long, payload binary", "target long, block long, payload binary"
BLOCK = pa.schema([("block", pa.int64()), ("payload", pa.binary())])
PART = pa.schema([("target", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())])


def _planes(values: np.ndarray) -> bytes:
    """The numbers' bytes by significance, so that bytes that are mostly zero compress away."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _unplanes(data: memoryview, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _packed(*arrays: np.ndarray) -> bytes:
    bodies = [_planes(a) for a in arrays]
    return np.array([len(b) for b in bodies], np.int64).tobytes() + b"".join(bodies)


def _unpacked(data: bytes, *dtypes) -> list[np.ndarray]:
    view, out = memoryview(data), []
    at = 8 * len(dtypes)
    for size, dtype in zip(np.frombuffer(view[:at], np.int64).tolist(), dtypes, strict=True):
        out.append(_unplanes(view[at : at + size], dtype))
        at += size
    return out


def dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """(block, payload): documents by the hash of id and text. Rows of a task with the same id and text travel once, with their number."""

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for texts, ids in blocks(batches, BLOCK_BYTES, ["text", "doc_id"]):
            rows = Counter(zip(ids, texts, strict=True))
            parts: dict[int, list] = defaultdict(list)
            for (doc_id, text), times in rows.items():
                parts[xxhash.xxh3_64_intdigest(text, (doc_id or 0) & 0xFFFFFFFF) % buckets].append((doc_id, text, times))
            yield from _batches(BLOCK, ((bucket, pack(_documents(part))) for bucket, part in parts.items()))

    return docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(deal, BLOCK_SQL)


def _documents(rows: list[tuple[int | None, bytes, int]]) -> bytes:
    ids, texts, times = zip(*rows, strict=True)
    numbers = np.array([[i or 0, i is not None, len(t), n] for i, t, n in zip(ids, texts, times, strict=True)], np.int64)
    return _packed(numbers.ravel(), np.frombuffer(b"".join(texts), np.uint8))


def _read_documents(payloads) -> list[tuple[int | None, bytes, int]]:
    """Documents of a block with their numbers of rows, in an order that does not depend on how they came."""
    unpack, rows = zstandard.ZstdDecompressor().decompress, Counter()
    for payload in payloads:
        numbers, body = _unpacked(unpack(payload.as_py()), np.int64, np.uint8)
        at, body = 0, body.tobytes()
        for doc_id, known, n, times in numbers.reshape(-1, 4).tolist():
            rows[known, doc_id, body[at : at + n]] += times
            at += n
    return [(doc_id if known else None, text, rows[known, doc_id, text]) for known, doc_id, text in sorted(rows)]


class Block:
    """Documents of a block and their suffixes: places (of first words), text, docs, digests."""

    def __init__(self, rows: list[tuple[int | None, bytes, int]], window: int):
        known = np.array([i is not None for i, *_ in rows], bool)
        self.window, self.words = window, Words([t for _, t, _ in rows])
        places, text = window_places(self.words.bounds, window)
        taken = known[text]
        self.places, self.text = places[taken], text[taken]
        self.docs = np.array([i or 0 for i, *_ in rows], np.int64)[self.text]
        self.digests = windows(self.words.hashes, window)[self.places]
        self.symbols = None

    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        self.symbols = symbols_of(self.words) if self.symbols is None else self.symbols
        return self.symbols

    def resolved(self) -> tuple[np.ndarray, np.ndarray]:
        """(suffixes whose node has a smaller document here, the others)."""
        order = np.argsort(self.digests)
        ordered = self.digests[order]
        again = np.concatenate(([False], ordered[1:] == ordered[:-1]))[: len(order)]
        some = order[again | np.append(again[1:], False)[: len(order)]]
        later = np.zeros(len(order), bool)
        if len(some):
            later[some] = later_in_nodes(self.numbered()[0][self.places[some][:, None] + np.arange(self.window)], self.docs[some])
        return np.flatnonzero(later), np.flatnonzero(~later)

    def flags(self, at: np.ndarray) -> bytes:
        return _packed(self.text[at].astype(np.uint32), (self.places[at] - self.words.bounds[self.text[at]]).astype(np.uint32))


def symbols_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words, equal for equal bytes and only for those; and the place of one word of each number."""
    order = np.argsort(words.hashes)
    ordered = words.hashes[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))[: len(order)]
    first = order[new]
    number = np.empty(len(order), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    others: dict[bytes, int] = {}  # words that share their hash with another one
    more = []
    for k in np.flatnonzero(~words.same(np.arange(len(number)), words, first[number])).tolist():
        word = words.data[words.begins[k] : words.ends[k]]
        if word not in others:
            others[word] = len(first) + len(others)
            more.append(k)
        number[k] = others[word]
    return number, np.append(first, more).astype(np.int64)


def suffix_tree(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (rows of symbols) in lexicographic order, and how many symbols each shares with the one before."""
    column = lambda k: rows[:, k].astype(np.uint64) if k < rows.shape[1] else np.zeros(len(rows), np.uint64)
    order = np.lexsort([column(k) << np.uint64(32) | column(k + 1) for k in range(0, rows.shape[1], 2)][::-1])
    shared, same = np.zeros(len(rows), np.int64), np.ones(max(0, len(rows) - 1), bool)
    for k in range(rows.shape[1]):
        ordered = rows[order, k]
        same &= ordered[1:] == ordered[:-1]
        shared[1:] += same
    return order, shared


def later_in_nodes(rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which suffixes are of a document that is not the smallest of their node at full depth."""
    order, shared = suffix_tree(rows)
    begin = np.flatnonzero(shared < rows.shape[1])
    smallest = np.minimum.reduceat(docs[order], begin)
    out = np.zeros(len(rows), bool)
    out[order] = docs[order] > np.repeat(smallest, np.diff(np.append(begin, len(rows))))
    return out


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return np.minimum(values[: len(values) - width + size], values[width - size :])


def prefix_bins(words: Words, places: np.ndarray, window: int, bits: int, common: Common) -> list[np.ndarray]:
    """By prefix length, the bin of each suffix's prefix at its anchor; where the prefix would leave the suffix, its whole digest tells the bin."""
    if not len(places):
        return [places] * len(PREFIXES)
    rank = words.hashes >> np.uint64(33) | common.has(words.hashes).astype(np.uint64) << np.uint64(31)
    least = sliding_minimum(rank << np.uint64(32) | np.arange(len(rank), dtype=np.uint64), window)[places]
    anchor = (least & np.uint64((1 << 32) - 1)).astype(np.int64)
    out, whole = [], windows(words.hashes, window)[places]
    for k in PREFIXES:
        at_anchor = windows(words.hashes, k)
        found = np.where(anchor + k <= places + window, at_anchor[np.minimum(anchor, len(at_anchor) - 1)], whole) if len(at_anchor) else whole
        out.append((found >> np.uint64(64 - bits)).astype(np.int64))
    return out


def prefix_counts(docs: DataFrame, window: int, bits: int, common) -> list[np.ndarray]:
    """How many suffixes have each prefix bin, by prefix length; the tables' size depends on bits alone."""
    rows = docs.filter("doc_id is not null").select("text")
    salts = salts_of(rows)

    def count(batches):
        total = np.zeros((len(PREFIXES), 1 << bits))
        for (texts,) in blocks(batches, BLOCK_BYTES, ["text"]):
            words = Words(texts)
            for level, found in enumerate(prefix_bins(words, window_places(words.bounds, window)[0], window, bits, common.value)):
                total[level] += np.bincount(found, minlength=1 << bits)
        yield slices(total, salts)

    size = len(PREFIXES) << bits
    return list(summed(rows.mapInArrow(count, SLICE), size).reshape(len(PREFIXES), 1 << bits).astype(np.int64))


def prefix_groups(counts: list[np.ndarray], most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """By prefix length, the group of each bin, -1 where a longer prefix decides; and over how many groups, by digest, a bin of the longest is split."""
    out, group, held = [], 0, 0
    splits = np.ones(len(counts[-1]), np.uint64)
    for level, count in enumerate(counts):
        last = level + 1 == len(counts)
        groups = np.full(len(count), -1, np.int64)
        for at, n in enumerate(count.tolist()):
            if n > most and not last:
                continue
            if held and held + n > most:
                group, held = group + 1, 0
            groups[at], held = group, held + n
            if n > most:
                splits[at] = -(-n // most)
                group, held = group + int(splits[at]), 0
        out.append(groups)
    return out, splits


def _targets(bins: list[np.ndarray], groups: list[np.ndarray], splits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    target = groups[0][bins[0]]
    for found, group in zip(bins[1:], groups[1:], strict=True):
        target = np.where(target < 0, group[found], target)
    parts = splits[bins[-1]]
    longest = parts > 1
    longest &= np.logical_and.reduce([group[found] < 0 for found, group in zip(bins[:-1], groups[:-1], strict=True)])
    return target + np.where(longest, digests % parts, 0).astype(np.int64)


def _batches(schema: pa.Schema, rows):
    """Rows in Arrow batches of a few MB; the last of a row's values is its payload."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _parts(rows) -> pa.Table:
    return pa.Table.from_batches(list(_batches(PART, rows)), schema=PART)


def _cuts(sorted_values: np.ndarray):
    """(a, b) of runs of equal values."""
    cuts = np.flatnonzero(np.diff(sorted_values, prepend=-1, append=-1)).tolist() if len(sorted_values) else []
    return zip(cuts, cuts[1:], strict=False)


def _signature(digests: np.ndarray, bits: int, targets: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct digests, cut to so many bits, and the task that compares each)."""
    own = np.sort(digests >> np.uint64(64 - bits))
    own = own[np.concatenate(([True], own[1:] != own[:-1]))[: len(own)]]
    return own, (own // np.uint64((1 << bits) // targets + 1)).astype(np.int64)


def recurring(texts: DataFrame, window: int, bits: int, targets: int) -> DataFrame:
    """(target, block, payload): for each block and task, a bit for each digest that the block told, whether another block has it too."""

    def tell(group: pa.Table) -> pa.Table:
        block = group["block"][0].as_py()
        b = Block(_read_documents(group["payload"]), window)
        own, target = _signature(b.digests[b.resolved()[1]], bits, targets)
        out = _parts((int(target[x]), block, _packed(np.diff(own[x:y], prepend=np.uint64(0)))) for x, y in _cuts(target))
        del b
        release()
        return out

    def compare(group: pa.Table) -> pa.Table:
        told = [np.cumsum(_unpacked(x.as_py(), np.uint64)[0], dtype=np.uint64) for x in group["payload"]]
        flat = np.sort(np.concatenate(told))
        twice = flat[1:][flat[1:] == flat[:-1]]
        out = []
        for block, own in zip(group["block"].to_pylist(), told, strict=True):
            at = np.minimum(np.searchsorted(twice, own), max(0, len(twice) - 1))
            mine = twice[at] == own if len(twice) else np.zeros(0, bool)
            if mine.any():
                out.append((group["target"][0].as_py(), block, np.packbits(mine).tobytes()))
        return _parts(out)

    return texts.groupBy("block").applyInArrow(tell, PART_SQL).groupBy("target").applyInArrow(compare, PART_SQL)


class Common:
    """Words that need not travel with suffixes, most frequent first."""

    def __init__(self, words: list[bytes]):
        self.words = Words([b" ".join(words)])
        self.order = np.argsort(self.words.hashes)
        self.hashes = self.words.hashes[self.order]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)] == hashes

    def numbers(self, words: Words, some: np.ndarray) -> np.ndarray:
        """Number of each of some words, -1 if it is not common."""
        if not len(self.hashes):
            return np.full(len(some), -1, np.int64)
        at = self.order[np.minimum(np.searchsorted(self.hashes, words.hashes[some]), len(self.hashes) - 1)]
        return np.where(words.same(some, self.words, at), at, -1)


def common_words(docs: DataFrame) -> list[bytes]:
    """Words that are frequent in the first block of each task. They only save bytes: any others would give the same results."""

    def count(batches):
        for (texts,) in blocks(batches, BLOCK_BYTES, ["text"]):
            words = Words(texts)
            number, first = symbols_of(words)
            times = np.bincount(number, minlength=len(first))
            top = np.argsort(-times, kind="stable")[:COMMON_OF_TASK]
            top = top[(words.ends - words.begins)[first[top]] <= LONG]
            at = first[top]
            yield pa.RecordBatch.from_arrays([pa.array([words.data[i:j] for i, j in zip(words.begins[at].tolist(), words.ends[at].tolist(), strict=True)], pa.binary()), pa.array(times[top])], names=["word", "n"])
            return

    found = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(COMMON)
    return [bytes(r["word"]) for r in found.collect()]  # at most COMMON words of LONG bytes


def _suffix_rows(b: Block, at: np.ndarray, target: np.ndarray, block: int, common: Common):
    """PART rows with suffixes `at`, neighbours as one stretch of words; words that are not common once in each row."""
    pack = zstandard.ZstdCompressor(level=3).compress
    order = np.argsort(target, kind="stable")
    at, target = at[order], target[order]
    symbols, first = b.numbered()
    codes = common.numbers(b.words, first)
    for x, y in _cuts(target):
        places, text = b.places[at[x:y]], b.text[at[x:y]]
        begin = np.flatnonzero(np.concatenate(([True], (places[1:] != places[:-1] + 1) | (text[1:] != text[:-1]))))
        length = np.diff(np.append(begin, len(places)))
        flat = symbols[spread(places[begin], length + b.window - 1)]
        number = codes[flat]
        rare = number < 0
        used, local = np.unique(flat[rare], return_inverse=True)
        number[rare] = COMMON + local
        words = b" ".join([b.words.data[i:j] for i, j in zip(b.words.begins[first[used]].tolist(), b.words.ends[first[used]].tolist(), strict=True)])
        number = number.astype(np.uint16 if COMMON + len(used) <= 1 << 16 else np.uint32)
        where = b.words.bounds[text[begin]]
        yield int(target[x]), block, pack(_packed(np.array([number.itemsize], np.int64), np.frombuffer(words, np.uint8), number, length.astype(np.uint32), b.docs[at[x:y]][begin], text[begin].astype(np.uint32), (places[begin] - where).astype(np.uint32)))


def _read_suffixes(payload: bytes, window: int):
    """(words, suffixes as rows of numbers, and for each its document, its row in the block and its place there)."""
    data = zstandard.ZstdDecompressor().decompress(payload)
    width = _unpacked(data, np.int64, *[np.uint8] * 6)[0][0]
    _, words, number, length, docs, text, place = _unpacked(data, np.int64, np.uint8, {2: np.uint16, 4: np.uint32}[int(width)], np.uint32, np.int64, np.uint32, np.uint32)
    length = length.astype(np.int64)
    stretch = length + window - 1
    rows = number.astype(np.int32)[spread(np.cumsum(stretch) - stretch, length)[:, None] + np.arange(window)]
    return words.tobytes(), rows, np.repeat(docs, length), np.repeat(text, length), spread(place.astype(np.int64), length).astype(np.uint32)


def subtree(group: pa.Table, window: int, keep: bool) -> pa.Table:
    """A group's answers: (below 0, block, flags). With keep, also the suffixes that are left, for another step."""
    if group["target"][0].as_py() < 0:  # answers of an earlier step
        return group.select(PART.names)
    parts = [_read_suffixes(x.as_py(), window) for x in group["payload"]]
    words = Words([p[0] for p in parts])
    symbols, rows = symbols_of(words)[0] + COMMON, np.empty((sum(len(p[2]) for p in parts), window), np.int32)
    at = 0
    for first, (_, number, *_) in zip(words.bounds.tolist(), parts, strict=False):
        rare = number >= COMMON
        number[rare] = symbols[number[rare] - COMMON + first]
        rows[at : at + len(number)] = number
        at += len(number)
    later = later_in_nodes(rows, np.concatenate([p[2] for p in parts]))
    out, at = [], 0
    for block, target, payload, (_, _, docs, text, place) in zip(group["block"].to_pylist(), group["target"].to_pylist(), group["payload"], parts, strict=True):
        gone, at = later[at : at + len(docs)], at + len(docs)
        if gone.any():
            out.append((-1 - block, block, _packed(text[gone], place[gone])))
        if keep and not gone.all():
            out.append((target, block, payload.as_py()))
    del words, symbols, parts, rows
    release()
    return _parts(out)


def repeats(docs: DataFrame, texts: DataFrame, n_blocks: int, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(block, payload): rows and places of windows that also start in a document with a smaller id. texts: the documents as dealt to blocks."""
    partitions = shuffle_partitions(docs.sparkSession)
    bits = min(22, max(10, partitions.bit_length() + 6))
    common = docs.sparkSession.sparkContext.broadcast(Common(common_words(docs)))
    counts = prefix_counts(docs, window, bits, common)
    groups, splits = prefix_groups(counts, group_suffixes)
    total = int(counts[0].sum())
    targets = max(partitions, total // TASK_DIGESTS + 1)
    digest_bits = min(60, total.bit_length() + SPARE_BITS)
    answers = recurring(texts, window, digest_bits, targets)

    def send(documents: pa.Table, told: pa.Table) -> pa.Table:
        if not len(documents):
            return _parts([])
        block = documents["block"][0].as_py()
        b = Block(_read_documents(documents["payload"]), window)
        gone, left = b.resolved()
        own, target = _signature(b.digests[left], digest_bits, targets)
        twice = np.zeros(len(own), bool)
        heard = dict(zip(told["target"].to_pylist(), told["payload"], strict=True))
        for x, y in _cuts(target):
            if (answer := heard.get(int(target[x]))) is not None:
                twice[x:y] = np.unpackbits(np.frombuffer(answer.as_py(), np.uint8), count=y - x)
        own = own[twice]
        mine = b.digests[left] >> np.uint64(64 - digest_bits)
        some = left[own[np.minimum(np.searchsorted(own, mine), len(own) - 1)] == mine] if len(own) else left[:0]
        out = [(-1 - block, block, b.flags(gone))] if len(gone) else []
        if len(some):
            out += _suffix_rows(b, some, _targets(prefix_bins(b.words, b.places[some], window, bits, common.value), groups, splits, b.digests[some]), block, common.value)
        del b
        release()
        return _parts(out)

    sent = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send, PART_SQL)
    salts = -(-n_blocks // group_suffixes)
    if salts > 1:
        sent = sent.groupBy("target", F.pmod("block", F.lit(salts)).alias("salt")).applyInArrow(lambda g: subtree(g, window, True), PART_SQL)
    return sent.groupBy("target").applyInArrow(lambda g: subtree(g, window, False), PART_SQL).select("block", "payload")


def deduped(docs: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed words, as begin and end of each maximal repeat), text: the words that are left, joined by one space."""
    small_batches(docs.sparkSession)
    n_blocks = max(shuffle_partitions(docs.sparkSession), (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES)
    texts = dealt(docs, n_blocks)
    found = repeats(docs, texts, n_blocks, window, group_suffixes)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("text", pa.string())])

    def remove(documents: pa.Table, flags: pa.Table) -> pa.Table:
        marks = [_unpacked(x.as_py(), np.uint32, np.uint32) for x in flags["payload"]]
        text, place = (np.concatenate([m[k] for m in marks]).astype(np.int64) if marks else np.zeros(0, np.int64) for k in (0, 1))
        order = np.lexsort((place, text))
        text, place = text[order], place[order]
        spans = {int(text[a]): place[a:b] for a, b in _cuts(text)}
        out = [[] for _ in schema]
        for k, (doc_id, whole, times) in enumerate(_read_documents(documents["payload"])):
            words = whole.split()
            total, cut = len(words), []
            if (begins := spans.get(k)) is not None:
                new = np.flatnonzero(np.concatenate(([True], begins[1:] > begins[:-1] + window)))
                cut = list(zip(begins[new].tolist(), (begins[np.append(new[1:], len(begins)) - 1] + window).tolist(), strict=True))
                words = [w for a, b in zip([0, *(b for _, b in cut)], [*(a for a, _ in cut), total], strict=True) for w in words[a:b]]
            row = (doc_id, total, total - len(words), [{"begin": a, "end": b} for a, b in cut], b" ".join(words).decode("utf-8", "surrogatepass"))
            for into, value in zip(out, row, strict=True):
                into.extend([value] * times)
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, spans array<struct<begin: int, end: int>>, text string")


def op2_substring_dedup(spark, sf_dir):
    """Per document: its words, how many of them windows of smaller documents cover, and the digest of the others."""
    out = deduped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM p) WHERE m < doc_id),
g AS (SELECT doc_id, list(DISTINCT i + k) AS places FROM f, range(0, {WINDOW}) AS r(k) GROUP BY doc_id),
k AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM f, range(0, {WINDOW}) AS r(k)),
t AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM k ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN t USING (doc_id)
"""
