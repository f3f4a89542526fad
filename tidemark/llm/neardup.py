"""Near duplicates by a count-vector R-tree.

A document's shingles are hashed into DIMENSIONS groups; the counts of the
groups are its point, and the sum of the smaller coordinates of two points is
an upper bound of their overlap. Documents meet in blocks: those that share one
of their rarest shingles, as many as any linked pair must have one of in
common. In a block, a bulk-loaded R-tree whose nodes hold coordinate maxima
finds the pairs whose bound allows a link. What such pairs connect is verified
on whole sets in one place, and verified links give the components.

Equal sets are one class from the start. Blocks and connected groups that are
too large for a task are dealt out to tiles; tiles meet only for members that
are not yet in one component. Links between members of a component that is
already known are not written.

Nulls: a null or empty text has no shingles and links with nothing; a row
without doc_id takes part, and its component is that of the smallest id there
is. Rows that repeat a doc_id are judged by their own texts. Without rows there
is no result; columns other than doc_id and text are not looked at. Whole texts
take part, however long: a group's count that does not fit 8 bits bounds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.runtime import shuffle_partitions, small_batches, store, table
from tidemark.llm.substrings import _packed, _unpacked
from tidemark.llm.words import Words, blocks, mix, release, window_places, windows

SHINGLE, DIMENSION_BITS, FAN_OUT = 5, 10, 16
#: With so many, unrelated texts of up to some 16,000 words fall below the bound; fewer tell only shorter ones apart.
DIMENSIONS = 1 << DIMENSION_BITS
SATURATED = (1 << 8) - 1
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
BLOCK_BYTES = 8 << 20
#: Bytes of texts in which a shingle is counted before it is told; more tell frequent ones apart better.
FREQUENT_BYTES = 12 << 20
#: Bytes of texts whose rare shingles one task gathers.
TARGET_BYTES = 16 << 20
#: Members of a block, or shingles of a connected group, that one task takes at once.
MOST_MEMBERS, MOST_SHINGLES = 4096, 8_000_000
#: Classes up to which their ids are sent to all tasks rather than joined by a shuffle.
BROADCAST_CLASSES = 1_000_000
FREQUENT_BITS, FREQUENT_LOCAL = 20, 4
#: Shingles that occur 2**SPLIT_RANK times or more have their postings split over tasks, of some half as many each.
SPLIT_RANK = 13
_U = np.uint64


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles; a text of fewer words has one, of all its words."""
    words = Words([t.lower() for t in texts])
    places, text = window_places(words.bounds, k)
    found = windows(words.hashes, k)[places]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    out = []
    for i, n in enumerate(np.diff(words.bounds).tolist()):
        if 0 < n < k:
            own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
            out.append(windows(own, n) ^ _U(n))
        else:
            out.append(np.unique(found[cuts[i] : cuts[i + 1]]))
    return out


def class_id(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def points(sets: list[np.ndarray]) -> np.ndarray:
    """Count vectors."""
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.zeros(0, _U)
    cell = np.repeat(np.arange(len(sets)), lengths) * DIMENSIONS + (flat >> _U(64 - DIMENSION_BITS)).astype(np.int64)
    return np.bincount(cell, minlength=len(sets) * DIMENSIONS).reshape(len(sets), DIMENSIONS).astype(np.int32)


def saturated(vectors: np.ndarray) -> np.ndarray:
    """Count vectors in 8 bits; a count that does not fit becomes the largest number, which stands for any."""
    return np.minimum(vectors, SATURATED).astype(np.uint8)


def overlap_bounds(vectors: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Sums of the smaller coordinates; where both are saturated there is no bound."""
    bound = np.minimum(vectors, own).sum(1, dtype=np.int64)
    if (full := own == SATURATED).any():
        bound += (vectors[:, full] == SATURATED).sum(1) << 22
    return bound


def packing_order(vectors: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order in which points are packed to nodes: slabs of sizes that can link (a factor of 4/3), in them by the groups that stand out most, so that like points share nodes and the nodes' maxima stay close to them."""
    slab = np.floor(np.log(np.maximum(sizes, 1)) / np.log(100 / PERCENT)).astype(np.int64)
    offset = vectors.astype(np.float32) - vectors.mean(0, dtype=np.float32) if len(vectors) else vectors.astype(np.float32)
    first = offset.argmax(1)
    offset[np.arange(len(vectors)), first] = -np.inf
    return np.lexsort((sizes, offset.argmax(1), first, slab))


class RTree:
    """Points in packing order, FAN_OUT to a node, nodes likewise; a node has coordinate maxima and its least and largest size."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.vectors, self.sizes = vectors, sizes
        self.levels = [(vectors, sizes, sizes)]
        while len(self.levels[-1][0]) > FAN_OUT:
            most, low, high = self.levels[-1]
            at = np.arange(0, len(most), FAN_OUT)
            self.levels.append((np.maximum.reduceat(most, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def near(self, k: int) -> np.ndarray:
        """Points before point k whose overlap with it may be large enough for a link."""
        own, size = self.vectors[k], int(self.sizes[k])
        rows = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            most, low, high = self.levels[level]
            rows = rows[rows * FAN_OUT**level < k]
            fits = (100 * low[rows] * PERCENT <= 10_000 * size) & (100 * size * PERCENT <= 10_000 * high[rows])
            rows = rows[fits]
            bound = overlap_bounds(most[rows], own)
            rows = rows[(100 + PERCENT) * bound >= PERCENT * (size + low[rows])]
            if level:
                rows = (rows[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                rows = rows[rows < len(self.levels[level - 1][0])]
        return rows


def connected(vectors: np.ndarray, sizes: np.ndarray, ids: np.ndarray, linked=None, sides: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Star-shaped links (smallest id, id) of what pairs connect that the tree finds and `linked` confirms.

    Pairs already connected are not looked at again. With sides, only pairs of different sides count.
    """
    order = packing_order(vectors, sizes)
    tree, label = RTree(vectors[order], sizes[order]), np.arange(len(order))
    for k in range(1, len(order)):
        near = tree.near(k)
        if sides is not None:
            near = near[sides[order[near]] != sides[order[k]]]
        near = near[label[near] != label[k]]
        while len(near):
            j, near = near[-1], near[:-1]
            if linked is None or linked(order[k], order[j]):
                low, high = sorted((label[k], label[j]))
                label[label == high] = low
                near = near[label[near] != low]
    by_label = np.lexsort((ids[order], label))
    cuts = np.flatnonzero(np.diff(label[by_label], prepend=-1, append=-1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        members = ids[order][by_label[a:b]]
        for member in members[1:].tolist():
            yield int(members[0]), member


def overlap_links(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test, on sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < PERCENT * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int(np.count_nonzero(b[at] == a))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _groups(batches, key: list[str], values: list[str]):
    """Consecutive rows with equal keys: (key, lists of values); batches may cut a group."""
    now, held = None, None
    for batch in batches:
        keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in key), strict=True))
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in values]
        for k, *row in zip(keys, *columns, strict=True):
            if k != now:
                if held:
                    yield now, held
                now, held = k, [[] for _ in values]
            for into, value in zip(held, row, strict=True):
                into.append(value)
    if held:
        yield now, held


def _tile(member: str, tiles) -> Column:
    return F.pmod(F.xxhash64(F.col(member)), tiles).cast("int")


def _all_pairs(rows: DataFrame, own: Column, tiles: Column, first: Column) -> DataFrame:
    """rows with tile_a <= tile_b for all pairs of a group's tiles, which are numbered from `first`."""
    each = rows.withColumn("own", own + first).withColumn("other", F.explode(F.sequence(first, first + tiles - 1)))
    return each.withColumns({"tile_a": F.least("own", "other"), "tile_b": F.greatest("own", "other")}).drop("other")


def linked_by(rows: DataFrame, weights: DataFrame, key: str, blob: str, most: int, make) -> DataFrame:
    """Components of what `make` links within groups: (node, label).

    rows: key, cid and blob; weights: key, cid, weight. A group heavier than `most`
    is dealt out to tiles of half that weight, and pairs are looked for in steps:
    in each tile first. Where the components that come of it are mostly single
    members, all tiles meet. Else one member of each component meets the others;
    and then, as members of one component need no more links, the heaviest
    component's tiles meet the members of all others, and those each other. So a
    group that is one component costs its size, not the square of its tiles; no
    pair of members of different components is left out.
    """
    heavy = store(weights.groupBy(key).agg(F.sum("weight").alias("w")).filter(F.col("w") > most).select(F.col(key).alias("h_key"), F.ceil(F.col("w") * 2 / most).cast("int").alias("tiles")), "heavy")
    joined = rows.join(heavy, F.col(key) == F.col("h_key"), "left").drop("h_key")
    own = joined.withColumn("own", _tile("cid", F.coalesce("tiles", F.lit(1)))).withColumns({"tile_a": F.col("own"), "tile_b": F.col("own")})
    links = _links_of_groups(own, key, blob, make)
    if not heavy.limit(1).count():
        return components(links)
    links = store(links, "links-of-tiles")
    hot_rows = store(rows.join(heavy, F.col(key) == F.col("h_key"), "left_semi").select(key, "cid", blob), "hot")
    hot = weights.join(heavy, F.col(key) == F.col("h_key")).select(key, "cid", "weight", "tiles")

    def labelled_hot() -> DataFrame:
        label = components(links).select(F.col("node").alias("l_node"), "label")
        return hot.join(label, F.col("cid") == F.col("l_node"), "left").withColumn("label", F.coalesce("label", "cid")).drop("l_node")

    def dealt(members: DataFrame) -> DataFrame:
        """hot_rows of members (key, cid and more), whose keys get other names."""
        named = members.withColumnsRenamed({key: "m_key", "cid": "m_cid"})
        return hot_rows.join(named, (F.col(key) == F.col("m_key")) & (F.col("cid") == F.col("m_cid"))).drop("m_key", "m_cid")

    columns = [key, "tile_a", "tile_b", "cid", blob, "own"]
    one = labelled_hot().groupBy(key, "label", "tiles").agg(F.min_by(F.struct("cid", "weight"), "cid").alias("m"), F.sum("weight").alias("w"))
    one = store(one.select(key, "tiles", "m.cid", "m.weight", "w"), "standing")
    kinds = one.groupBy(F.col(key).alias("k_key"), "tiles").agg((2 * F.sum("weight") > F.sum("w")).alias("scattered"), F.ceil(F.sum("weight") * 2 / most).cast("int").alias("parts"))
    kinds = store(kinds, "kinds")
    everyone = hot_rows.join(kinds.filter("scattered"), F.col(key) == F.col("k_key"))
    everyone = _all_pairs(everyone, _tile("cid", F.col("tiles")), F.col("tiles"), F.lit(0)).filter("tile_a < tile_b")
    standing = dealt(one.select(key, "cid").join(kinds.filter("not scattered"), F.col(key) == F.col("k_key")).select(key, "cid", "parts"))
    standing = _all_pairs(standing, _tile("cid", F.col("parts")), F.col("parts"), F.lit(0))
    links = links.union(store(_links_of_groups(everyone.select(*columns).union(standing.select(*columns)), key, blob, make), "links-between"))
    lumped = kinds.filter("not scattered").select("k_key")
    if not lumped.limit(1).count():
        return components(links)
    found = store(labelled_hot().join(lumped, F.col(key) == F.col("k_key"), "left_semi"), "labelled")
    sums = found.groupBy(key, "label").agg(F.sum("weight").alias("w"))
    main = sums.groupBy(F.col(key).alias("g_key")).agg(F.max_by("label", F.struct("w", "label")).alias("main"), F.ceil((F.sum("w") - F.max("w")) * 2 / most).cast("int").alias("parts")).filter("parts > 0")
    main = store(main, "main-components")
    if not main.limit(1).count():
        return components(links)
    sided = store(found.join(main, F.col(key) == F.col("g_key")).select(key, "cid", "tiles", "parts", (F.col("label") == F.col("main")).alias("is_main")), "sided")
    own_part = _tile("cid", F.col("parts"))
    of_main = dealt(sided.filter("is_main")).withColumn("own", _tile("cid", F.col("tiles"))).withColumn("tile_b", F.explode(F.sequence(F.col("tiles"), F.col("tiles") + F.col("parts") - 1))).withColumn("tile_a", F.col("own"))
    others = dealt(sided.filter("not is_main"))
    to_main = others.withColumn("own", own_part + F.col("tiles")).withColumn("tile_a", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("tile_b", F.col("own"))
    among = _all_pairs(others, own_part, F.col("parts"), F.col("tiles"))
    last = _links_of_groups(of_main.select(*columns).union(to_main.select(*columns)).union(among.select(*columns)), key, blob, make)
    return components(links.union(store(last, "links-of-others")))


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links_of_groups(rows: DataFrame, key: str, blob: str, make) -> DataFrame:
    """Runs make(ids, blobs, sides) over each group; sides is None where a group is one tile with itself."""

    def run(batches):
        a, b = [], []
        for (_, tile_a, tile_b), (ids, blobs, own) in _groups(batches, [key, "tile_a", "tile_b"], ["cid", blob, "own"]):
            for x, y in make(np.array(ids, np.int64), blobs, np.array(own) if tile_a != tile_b else None):
                a.append(x)
                b.append(y)
            if len(a) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=LINKS)
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=LINKS)
        release()

    n = shuffle_partitions(rows.sparkSession)
    dealt = rows.select(key, "tile_a", "tile_b", "cid", blob, "own").repartition(n, key, "tile_a", "tile_b").sortWithinPartitions(key, "tile_a", "tile_b", "cid")
    return dealt.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, cid (null without shingles), point (the number of shingles, then the count vector)."""
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_shingles", pa.int64()), ("cid", pa.int64()), ("point", pa.binary())])

    def measure(batches):
        for texts, ids, keys in blocks(batches, BLOCK_BYTES, ["text", "doc_id", "row_key"]):
            sets = shingle_sets(texts)
            vectors = [v for k in range(0, len(sets), 512) for v in saturated(points(sets[k : k + 512]))]
            cids = [class_id(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(cids, pa.int64()), pa.array([len(s).to_bytes(8, "little") + v.tobytes() for s, v in zip(sets, vectors, strict=True)], pa.binary())], schema=schema)

    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"))
    return rows.mapInArrow(measure, "doc_id long, row_key long, n_shingles long, cid long, point binary")


def frequent(texts: DataFrame) -> np.ndarray:
    """How often shingles occur that a task often meets, by hash slot; the order by it only decides which shingles count as rare."""
    schema = pa.schema([("slot", pa.int32()), ("n", pa.int64())])

    def count(batches):
        for (block,) in blocks(batches, FREQUENT_BYTES, ["text"]):
            found, n = np.unique(np.concatenate(shingle_sets(block) or [np.zeros(0, _U)]), return_counts=True)
            often = n >= FREQUENT_LOCAL
            slots, at = np.unique((found[often] >> _U(64 - FREQUENT_BITS)).astype(np.int32), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(np.bincount(at, n[often], len(slots)).astype(np.int64))], schema=schema)

    out = np.zeros(1 << FREQUENT_BITS, np.int64)
    summed = texts.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # at most 2**FREQUENT_BITS rows
    out[summed["slot"].to_numpy(np.int64)] = summed["n"].to_numpy(np.int64)
    return out


def _joined(member: np.ndarray, begin: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """Labels of 0..n - 1 such that the members of each list have one label."""
    label = np.arange(n)
    while len(begin):
        least = np.minimum.reduceat(label[member], begin)
        new = label.copy()
        np.minimum.at(new, member, np.repeat(least, size))
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def rare_blocks(texts: DataFrame, often: np.ndarray, text_bytes: int) -> DataFrame:
    """(block, cid): classes that share one of their rarest shingles.

    A task merges lists of its shingles that overlap, which loses no pair, and
    blocks with the same members, of whatever task, are one: a group of copies
    is then about one block and not one for each shingle.

    A shingle of very many classes is split: each of its parts, by class, goes to
    a task of its own, and the parts together are one block. Parts have digests
    that add up to the block's, so blocks with the same members are found and
    kept once here too, without any task that sees a whole one.
    """
    n_targets, split_rank = max(shuffle_partitions(texts.sparkSession), text_bytes // TARGET_BYTES), SPLIT_RANK
    rank = texts.sparkSession.sparkContext.broadcast(np.floor(np.log2(often + 1.0)).astype(np.uint8))
    schema = pa.schema([("target", pa.int32()), ("payload", pa.binary())])

    def emit(batches):
        for (block,) in blocks(batches, BLOCK_BYTES, ["text"]):
            prefixes, cids = [], {}
            for s in shingle_sets(block):
                if not len(s) or (cid := class_id(s)) in cids:
                    continue
                cids[cid] = len(cids)
                keys = (rank.value[s >> _U(64 - FREQUENT_BITS)].astype(_U) << _U(58)) | (s >> _U(6))
                count = len(s) - -(-PERCENT * len(s) // 100) + 1
                prefixes.append(np.partition(keys, count - 1)[:count] if count < len(s) else keys)
            if not prefixes:
                continue
            keys = np.concatenate(prefixes)
            owner = np.repeat(np.arange(len(prefixes), dtype=np.uint32), [len(p) for p in prefixes])
            names = np.fromiter(cids, np.int64, len(cids))
            rank_of = (keys >> _U(58)).astype(np.int64)
            parts = _U(1) << np.maximum(rank_of - split_rank + 1, 0).astype(_U)
            with np.errstate(over="ignore"):
                part = mix(names.view(_U))[owner] & (parts - _U(1))
                target = (mix(keys + part * _U(0x9E3779B97F4A7C15)) % _U(n_targets)).astype(np.int32)
            order = np.lexsort((keys, target))
            keys, owner, target = keys[order], owner[order], target[order]
            cuts = np.flatnonzero(np.diff(target, prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:], strict=False):
                used, at = np.unique(owner[a:b], return_inverse=True)
                payload = _packed(np.diff(keys[a:b], prepend=_U(0)), at.astype(np.uint32), names[used])
                yield pa.RecordBatch.from_arrays([pa.array([target[a]], pa.int32()), pa.array([payload], pa.binary())], schema=schema)

    def gather(group: pa.Table) -> pa.Table:
        parts = [_unpacked(x.as_py(), _U, np.uint32, np.int64) for x in group["payload"]]
        keys = np.concatenate([np.cumsum(p[0], dtype=_U) for p in parts])
        cids = np.concatenate([p[2][p[1]] for p in parts])
        order = np.lexsort((cids, keys))
        keys, cids = keys[order], cids[order]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (cids[1:] != cids[:-1])))
        keys, cids = keys[new], cids[new]
        hot = (keys >> _U(58)).astype(np.int64) >= split_rank
        hot_keys, hot_cids, keys, cids = keys[hot], cids[hot], keys[~hot], cids[~hot]
        begin = np.flatnonzero(np.diff(keys, prepend=~keys[:1])) if len(keys) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(keys)))
        several = np.repeat(size > 1, size)
        names, member = np.unique(cids[several], return_inverse=True)
        size = size[size > 1]
        label = _joined(member, np.cumsum(size) - size, size, len(names))
        order = np.lexsort((names, label))
        label, names = label[order], names[order]
        begin = np.flatnonzero(np.diff(label, prepend=-1))
        with np.errstate(over="ignore"):
            block = mix(np.add.reduceat(mix(names.view(_U)), begin)) if len(begin) else np.zeros(0, _U)
        first = np.flatnonzero(np.diff(hot_keys, prepend=~hot_keys[:1])) if len(hot_keys) else np.zeros(0, np.int64)
        digest = np.bitwise_xor.reduceat(mix(hot_cids.view(_U)), first) if len(first) else np.zeros(0, _U)
        ends = np.concatenate((np.append(begin, len(names)), len(names) + np.append(first, len(hot_cids))[1:])).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate((names, hot_cids)), pa.int64()))
        key = pa.concat_arrays([pa.nulls(len(block), pa.int64()), pa.array(hot_keys[first].view(np.int64))])
        return pa.table({"block": pa.array(np.concatenate((block, digest)).view(np.int64)), "cids": lists, "key": key})

    found = texts.select("text").mapInArrow(emit, "target int, payload binary").groupBy("target").applyInArrow(gather, "block long, cids array<long>, key long")
    if int(rank.value.max()) < split_rank:
        return found.dropDuplicates(["block"]).select("block", F.explode("cids").alias("cid"))
    found = store(found.dropDuplicates(["block", "key"]), "postings")
    whole = found.filter("key is not null").groupBy("key").agg(F.bit_xor("block").alias("whole")).groupBy("whole").agg(F.min("key").alias("w_key"))  # of shingles with the same classes one is enough
    parts = found.join(whole, F.col("key") == F.col("w_key")).select(F.xxhash64("whole").alias("block"), "cids")
    return found.filter("key is null").select("block", "cids").union(parts).select("block", F.explode("cids").alias("cid"))


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id for each row of docs."""
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    own = store(classes(texts), "classes")
    each = own.filter("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("point").alias("point"))
    text_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    members = rare_blocks(texts, frequent(texts), text_bytes).join(each.select("cid", "point"), "cid")

    def in_block(ids, blobs, sides):
        vectors = np.frombuffer(b"".join(x[8:] for x in blobs), np.uint8).reshape(len(blobs), DIMENSIONS)
        return connected(vectors, np.frombuffer(b"".join(x[:8] for x in blobs), np.int64), ids, sides=sides)

    members = store(members, "blocks")
    maybe = linked_by(members, members.select("block", "cid", F.lit(1).alias("weight")), "block", "point", MOST_MEMBERS, in_block)
    # whole sets of the classes that may be linked, from the row that stands for each
    group = store(maybe.select(F.col("node").alias("cid"), F.col("label").alias("linked")), "maybe")
    stand = own.join(group, "cid").groupBy("cid", "linked").agg(F.min(F.struct("doc_id", "row_key")).alias("r"), F.max("n_shingles").alias("weight"))
    stand = store(stand.select("cid", "linked", "weight", F.col("r.doc_id").alias("s_doc"), F.col("r.row_key").alias("s_row")), "stand-ins")
    small = stand.count() <= BROADCAST_CLASSES
    rows = texts.join(F.broadcast(stand) if small else stand, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.xxhash64("text") == F.col("s_row"))).select("text", "cid", "linked", "weight")
    schema = pa.schema([("cid", pa.int64()), ("linked", pa.int64()), ("weight", pa.int64()), ("shingles", pa.binary())])

    def whole(batches):
        for block, *rest in blocks(batches, BLOCK_BYTES, ["text", "cid", "linked", "weight"]):
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in rest), pa.array([s.tobytes() for s in shingle_sets(block)], pa.binary())], schema=schema)

    def in_group(ids, blobs, sides):
        ids, first = np.unique(ids, return_index=True)  # a row that stands for a class may be there twice
        sets = [np.frombuffer(blobs[k], _U) for k in first]
        sides = sides[first] if sides is not None else None
        return connected(saturated(points(sets)), np.array(list(map(len, sets)), np.int64), ids, lambda i, j: overlap_links(sets[i], sets[j]), sides)

    sets = rows.mapInArrow(whole, "cid long, linked long, weight long, shingles binary")
    sure = linked_by(sets, stand.select("linked", "cid", "weight"), "linked", "shingles", MOST_SHINGLES, in_group)
    joined = each.select("cid", "rep").join(sure.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = joined.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = joined.join(least, "label").select("cid", "component_id")
    return own.select("doc_id", "row_key", "n_shingles", "cid").join(named, "cid", "left").select("doc_id", "row_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op10_ngram_jaccard_join(spark, sf_dir):
    """The component of every document by links of five-word shingle sets; texts without words link with nothing."""
    return labelled(table(spark, sf_dir, "documents")).drop("row_key")
