"""Self-join of documents by n-gram Jaccard similarity: T-occurrence search with DivideSkip.

A document is the set of its distinct word shingles. Equal sets are one *node*, so copies
never meet each other. Nodes find their company without losing a pair: two similar
sets differ in at most H shingles, so if shingles are dealt over H + 1 buckets
the sets agree on a whole bucket. H depends on the size; sizes fall into classes so narrow
that similar sets are in the same class or in neighbouring ones, and each set gives its
buckets' digests for both.

Links are found by T-occurrence search in bounded cells. A cell holds inverted lists of its
sets. For a query set, the lists of its shingles are ordered by length; the short ones are
merged over a heap that skips what cannot reach the count (T less the number of long
lists), the long ones are only probed by binary search for what is left. Sets with the
required overlap are links.

Most company is by chance, so sets travel last. Digests that only one set holds are left out
first, by a filter over packed counts (texts are cut a second time rather than all digests
kept). Then cells are made of *counts*: how many shingles a set has in each of some groups of
one to four shingles, half a byte each. The sum of the lesser
counts of two sets is never below their overlap, so it tells which could reach the similarity.
Only nodes that have such a partner go on, as whole sets, into the search.

Two passes keep groups of near copies cheap. First each node meets one node only, the one it
shares most digests with; such a group becomes one component in linear work. Then the sets
that share a digest meet by their counts, where they are still of several components, each such
group once. What could be linked hangs together in *clusters*, which are searched whole, split
into cells of at most 2 * ``SETS`` sets; parts of one component do not meet. The result is the
components, not all links.

Null and empty texts have no shingles and are linked with nothing; a text of fewer words
than a shingle is one shingle. doc_id names a document: rows that repeat it with other
texts are linked through all of them. Rows with null doc_id are returned with null
component and are linked with nothing. An empty table gives no rows. Columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import mix64, table, text_chunks
from riskloom.llm.components import components
from riskloom.llm.frequent import Filter, frequent, ranges_for
from riskloom.session import Scratch, materialize

#: Words of a shingle and similarity in percent, where the caller names no others.
SHINGLE, PERCENT = 3, 90
#: Nodes, and whole sets, in one part of a group; a cell joins two parts.
CELL, SETS = 1_000, 200
#: Lesser counts that are summed up at a time.
STEP = 4_000_000
#: Weight of merging against probing: the more, the fewer lists count as long.
MERGE_WEIGHT = 0.0085
CACHE_WORDS = 300_000
#: Bytes of text for a digest, to guess their number.
BYTES_A_DIGEST = 8

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def smallest(percent: int) -> int:
    """Sets smaller than this are similar to equal ones only."""
    return max(1, percent // (100 - percent))


def size_classes(largest: int, percent: int = PERCENT) -> list[int]:
    """First size of each class: sets two classes apart cannot reach the similarity."""
    first = [smallest(percent)]
    while first[-1] <= largest:
        first.append(-(-first[-1] * 100 // percent))
    return first


def buckets(size_class: int, first: list[int], percent: int = PERCENT) -> int:
    """Buckets of a class, one more than similar sets can differ in; larger classes have one spare."""
    differ = 2 * (first[size_class + 1] - 1) * (100 - percent) // (100 + percent)
    return differ + 1 + (differ >= 8)


class Shingler:
    """Sorted hashes of a text's distinct shingles."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.words = size, {}

    def shingles(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # lowers A-Z and cuts at ASCII white space only
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(hashed))
        if not size:
            return hashed
        total = np.full(len(hashed) - size + 1, size, np.uint64)
        for k in range(size):
            total = mix64(total * _ODD[4] + hashed[k : len(hashed) - size + 1 + k] * _ODD[k % 4])
        return np.unique(total)


def digests(shingles: np.ndarray, first: list[int], percent: int = PERCENT) -> list[int]:
    """Digests of the set's buckets in its own size class and the next."""
    if len(shingles) < smallest(percent):
        return []
    mixed, out = mix64(shingles ^ _ODD[3]), []
    own = int(np.searchsorted(first, len(shingles), side="right")) - 1
    for size_class in (own, own + 1):
        number = buckets(size_class, first, percent)
        # A bucket is a range of the leading bits, so sorted shingles lie in buckets one after the other.
        bucket = ((shingles >> np.uint64(32)) * np.uint64(number)) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, np.diff(bucket) > 0))
        digest = np.zeros(number, np.uint64)
        digest[bucket[starts].astype(np.int64)] = np.add.reduceat(mixed, starts)
        keys = mix64(digest + mix64(np.arange(number, dtype=np.uint64) + np.uint64(size_class << 32)))
        empty = number - len(starts)
        # With no more empty buckets than spare ones, similar sets also agree on a bucket that is not empty.
        spare = number - 1 - 2 * (first[size_class + 1] - 1) * (100 - percent) // (100 + percent)
        out.append(keys if empty > spare else keys[bucket[starts].astype(np.int64)])
    return np.concatenate(out).astype(np.int64).tolist()


def _cut(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[int]]]:
    """Parts of the batches (doc_id and text) with the shingles of their texts and the size classes."""
    shingler, first = Shingler(size), size_classes(1_000, percent)
    for part, texts in text_chunks(batches):
        sets = [shingler.shingles(text) for text in texts]
        largest = max(map(len, sets))
        if largest * 2 > first[-1]:
            first = size_classes(largest * 4, percent)
        yield part, sets, first


def shingle_sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size and two digests of the set, its counts, and the digests of its buckets.

    With ``scratch``, only digests that several rows have; the first of two passes over the
    texts finds out which.
    """
    kinds = "doc_id long, n long, set_a long, set_b long, digests array<long>, counts binary"
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("digests", pa.list_(pa.int64())), ("counts", pa.binary())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = None
    if scratch:
        def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for _, sets, first in _cut(batches, size, percent):
                yield np.array([d for s in sets for d in digests(s, first, percent)], np.int64).view(np.uint64)

        characters = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        ranges = ranges_for(characters // BYTES_A_DIGEST)
        again = scratch.table(frequent(rows.where("doc_id IS NOT NULL"), hashes, ranges, 2), "digests-again")
        shared = docs.sparkSession.sparkContext.broadcast(Filter.of(again, ranges).parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(*shared.value) if shared else None
        for part, sets, first in _cut(batches, size, percent):
            out = []
            for doc_id, s in zip(part.column(0).to_pylist(), sets):
                own = np.array(digests(s, first, percent), np.int64)
                out.append((doc_id, len(s), *_set_digests(s), own[known.has(own.view(np.uint64))] if known else own, counts(s)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, kinds)


def _set_digests(shingles: np.ndarray) -> tuple[int, int]:
    a, b = mix64(shingles ^ _ODD[0]).sum(dtype=np.uint64), mix64(shingles ^ _ODD[1]).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def groups(n: int) -> int:
    """Groups in which a set of n shingles is counted, a power of two: one to two shingles in each on average, two to four in a large set."""
    return 1 << max(0, (n // (1 if n < 200 else 2)).bit_length() - 1)


def counts(shingles: np.ndarray) -> bytes:
    """Shingles in each of the groups, two groups in a byte unless one of them holds more than 15."""
    number = groups(len(shingles))
    if number == 1:
        return bytes([len(shingles)])
    group = mix64(shingles ^ _ODD[2]) >> np.uint64(64 - number.bit_length() + 1)
    # Groups are random: none of so few shingles on average holds more than a byte can tell.
    each = np.bincount(group.astype(np.int64), minlength=number).astype(np.uint8)
    return each.tobytes() if each.max() > 15 else (each[::2] << 4 | each[1::2]).tobytes()


def counted(texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Counts of some sets, a row each, in as many groups as the set with the fewest has."""
    number = [groups(n) for n in sizes.tolist()]
    least, alike = min(number), defaultdict(list)
    for row, kind in enumerate(zip(number, map(len, texts))):
        alike[kind].append(row)
    own = np.empty((len(texts), least), np.uint16 if sizes.max() < 1 << 16 else np.uint32)
    for (of, length), rows in alike.items():
        each = np.frombuffer(b"".join([texts[r] for r in rows]), np.uint8)
        if length < of:
            each = np.stack([each >> 4, each & 15], axis=1)
        # Groups are leading bits, so counts of more groups add up to those of fewer.
        own[rows] = each.reshape(len(rows), least, -1).sum(axis=2)
    return own


def close(own: np.ndarray, sizes: np.ndarray, component: np.ndarray, asking: np.ndarray, asked: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of a cell might link by their counts, asking by asked, if they are of different components."""
    may = np.zeros((len(asking), len(asked)), bool)
    step = max(1, STEP // max(1, len(asked) * own.shape[1]))
    for start in range(0, len(asking), step):
        rows = asking[start : start + step]
        most = np.minimum(own[rows][:, None, :], own[asked][None, :, :]).sum(axis=2, dtype=np.int64)
        both = sizes[rows][:, None] + sizes[asked][None, :]
        may[start : start + step] = (100 * most >= percent * (both - most)) & (component[rows][:, None] != component[asked][None, :])
    return may


def connected(may: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of each part of a matrix that hangs together."""
    left = may.any(axis=1)
    while left.any():
        rows, columns = np.zeros(len(left), bool), np.zeros(may.shape[1], bool)
        rows[left.argmax()] = True
        while True:
            columns = may[rows].any(axis=0)
            more = may[:, columns].any(axis=1)
            if (more == rows).all():
                break
            rows = more
        left &= ~rows
        yield np.flatnonzero(rows), np.flatnonzero(columns)


def close_cells(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that connect, within a cell, nodes that may be linked. Rows: cell, role, node, component, n, counts."""
    names = ["cell", "role", "node", "component"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def cells(held: pa.Table, last: bool) -> Iterator[pa.Table]:
            nonlocal kept
            key = held["cell"].to_numpy()
            starts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()] if len(key) else []
            for start, stop in zip(starts, [*starts[1:], len(key) if last else None]):
                if stop is None:
                    kept = held.slice(start)
                else:
                    yield held.slice(start, stop - start)

        def search(held: pa.Table) -> Iterator[pa.RecordBatch]:
            component, role, node = (held[c].to_numpy() for c in ("component", "role", "node"))
            if held.num_rows < 2 or component.min() == component.max():
                return
            sizes = held["n"].to_numpy()
            own = counted(held["counts"].to_pylist(), sizes)
            asking, asked = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
            for rows, columns in connected(close(own, sizes, component, asking, asked, percent)):
                first = node[asking[rows[0]]]
                others = np.unique(np.append(node[asking[rows]], node[asked[columns]]))
                yield pa.RecordBatch.from_arrays([pa.array(others), pa.array(np.full(len(others), first))], names=["a", "b"])

        for batch in batches:
            whole = pa.Table.from_batches([batch])
            whole, kept = pa.concat_tables([kept, whole]).combine_chunks() if kept else whole, None
            for held in cells(whole, False):
                yield from search(held)
        if kept:
            yield from search(kept.combine_chunks())

    dealt = rows.select(*names, "n", "counts").repartition("cell").sortWithinPartitions("cell", "role", "node")
    return dealt.mapInArrow(run, "a long, b long")


class Lists:
    """Inverted lists of some sets, and DivideSkip over them."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.sets, self.percent = sets, percent
        shingles = np.concatenate([*sets, np.zeros(0, np.int64)])
        owners = np.repeat(np.arange(len(sets)), list(map(len, sets)))
        order = np.argsort(shingles, kind="stable")  # keeps owners in order within a list
        self.shingles, self.starts = np.unique(shingles[order], return_index=True)
        self.owners = owners[order]
        self.stops = np.append(self.starts[1:], len(owners))

    def search(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """(set, overlap) of all sets that share enough shingles with the query."""
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        held = np.flatnonzero(self.shingles[at] == query) if len(self.shingles) else at[:0]
        least = -(-self.percent * len(query) // 100)  # the overlap with any similar set
        if len(held) < least:
            return
        length = (self.stops - self.starts)[at[held]]
        held = held[np.argsort(length, kind="stable")]
        long = min(int(least / (MERGE_WEIGHT * log2(max(2, length.max())) + 1)), least - 1)
        short, probed = held[: len(held) - long], np.sort(query[held[len(held) - long :]])
        lists = [self.owners[self.starts[a] : self.stops[a]].tolist() for a in at[short]]
        for owner, found in merge_skip(lists, least - long):
            own = self.sets[owner]
            if self.percent * max(len(own), len(query)) > 100 * min(len(own), len(query)):
                continue
            place = np.searchsorted(own, probed)
            place[place == len(own)] = 0
            overlap = found + int((own[place] == probed).sum())
            if 100 * overlap >= self.percent * (len(own) + len(query) - overlap):
                yield owner, overlap


def merge_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(value, number of lists that hold it) of values in at least ``least`` of the sorted lists."""
    heap = [(values[0], i) for i, values in enumerate(lists)]
    heapq.heapify(heap)
    place = [0] * len(lists)
    while len(heap) >= least:
        top, taken = heap[0][0], []
        while heap and heap[0][0] == top:
            taken.append(heapq.heappop(heap)[1])
        if len(taken) >= least:
            yield top, len(taken)
            target = top + 1
        else:  # anything below the least-th value of the heap is held by too few lists
            while len(taken) < least - 1:
                taken.append(heapq.heappop(heap)[1])
            target = heap[0][0]
        for i in taken:
            place[i] = bisect_left(lists[i], target, place[i])
            if place[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][place[i]], i))


def cell_links(asking: list[tuple], asked: list[tuple] | None, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Links that connect components of a cell. Rows are (node, component, set).

    Without ``asked`` the rows are searched among themselves.
    """
    own = asking if asked is None else asked
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    if len({c for _, c, _ in [*asking, *(asked or [])]}) < 2:
        return
    lists = Lists([s for _, _, s in own], percent)
    for i, (node, component, shingles) in enumerate(asking):
        for j, _ in lists.search(shingles):
            if asked is None and j <= i:
                continue
            a, b = find(component), find(own[j][1])
            if a != b:
                root[max(a, b)] = min(a, b)
                yield node, own[j][0]


def search_cells(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) within cells. Rows: cell, role (0 asks, 1 is asked, 2 both), node, component, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cells() -> Iterator[list[tuple]]:
            current, held = None, []
            for batch in batches:
                values = batch.column(4)
                for row, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                    if key[0] != current:
                        if held:
                            yield held
                        current, held = key[0], []
                    held.append((key[1], key[2], key[3], values[row].values.to_numpy()))
            if held:
                yield held

        for held in cells():
            alone = held[0][0] == 2
            asking = [r[1:] for r in held if r[0] != 1]
            found = list(cell_links(asking, None if alone else [r[1:] for r in held if r[0] == 1], percent))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    dealt = rows.select("cell", "role", "node", "component", "shingles").repartition("cell").sortWithinPartitions("cell", "role", "node")
    return dealt.mapInArrow(run, "a long, b long")


def node_sets(docs: DataFrame, wanted: DataFrame, size: int = SHINGLE) -> DataFrame:
    """node and shingles of the wanted nodes, cut anew from the text that stands for each."""
    known = Filter.of(wanted.select(F.xxhash64("node").alias("h")))
    shared = docs.sparkSession.sparkContext.broadcast(known.parts())

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array(known.has(batch.column(2).to_numpy().view(np.uint64)))).select([0, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for part, texts in text_chunks(batches):
            nodes, sets = [], []
            for node, a, b, text in zip(*(part.column(c).to_pylist() for c in ("node", "set_a", "set_b")), texts):
                s = shingler.shingles(text)
                if _set_digests(s) == (a, b):
                    nodes.append((node, a, b))
                    sets.append(np.sort(s.astype(np.int64)))
            stops = np.append(0, np.cumsum(list(map(len, sets)))).astype(np.int32)
            columns = [pa.array([n[k] for n in nodes], pa.int64()) for k in range(3)]
            values = np.concatenate([*sets, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(values))], names=["node", "set_a", "set_b", "shingles"])

    of_doc = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("node"), "text")
    # Only texts that the filter lets through need be brought to their nodes.
    some = of_doc.select("node", "text", F.xxhash64("node").alias("h")).mapInArrow(held, "node long, text string")
    texts = some.join(wanted.select("node", "set_a", "set_b").hint("merge"), "node")
    cut = texts.select("node", "set_a", "set_b", "text").mapInArrow(run, "node long, set_a long, set_b long, shingles array<long>")
    return cut.groupBy("node", "set_a", "set_b").agg(F.first("shingles").alias("shingles")).select("node", "shingles")


def cluster_cells(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """cell, role, node and component: all nodes of a cluster meet but for those of one component.

    A large component has parts of its own, small ones are dealt over parts together; each
    pair of parts is a cell unless both are of one component.
    """
    sizes = scratch.table(placed.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n")), "component-sizes")
    large = F.when(F.col("n") >= SETS, F.col("component"))
    owners = sizes.select("cluster", large.alias("owner"), "n").groupBy("cluster", "owner").agg(F.ceil(F.sum("n") / SETS).cast("int").alias("parts"))
    owners = scratch.table(owners, "owners")
    owned = placed.join(sizes.select("cluster", "component", large.alias("owner")).hint("merge"), ["cluster", "component"])
    same = F.col("cluster").eqNullSafe(F.col("c")) & F.col("owner").eqNullSafe(F.col("o"))
    own = owned.join(owners.select(F.col("cluster").alias("c"), F.col("owner").alias("o"), "parts").hint("merge"), same).drop("c", "o")
    own = own.withColumn("part", F.struct("owner", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("at")))
    every = owners.select("cluster", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("at"), "owner").select("cluster", F.struct("owner", "at").alias("other"))
    met = own.join(every.hint("merge"), "cluster").where(F.col("part.owner").isNull() | F.col("other.owner").isNull() | (F.col("part.owner") != F.col("other.owner")))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    role = F.when(low == high, 2).when(F.col("part") == low, 0).otherwise(1)
    return met.select(F.xxhash64("cluster", low, high).alias("cell"), role.alias("role"), "node", "component")


def link_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Linked are documents with ``percent`` of 100 shingles of ``size`` words in common.
    """
    with Scratch(docs.sparkSession) as scratch:
        sets = scratch.table(shingle_sets(docs, size, percent, scratch), "shingle-sets")
        named = sets.where("doc_id IS NOT NULL AND n > 0")
        by_set = named.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("node"), F.min_by(F.struct("counts", "digests"), "doc_id").alias("own"))
        nodes = scratch.table(by_set.select("set_a", "set_b", "n", "node", "own.*"), "nodes")
        dealt = nodes.select("node", F.explode("digests").alias("digest"))

        def close_pairs(cells: DataFrame) -> DataFrame:
            """Edges between nodes that may be linked. Rows: cell, role, node and component."""
            return close_cells(cells.join(nodes.select("node", "n", "counts").hint("merge"), "node"), percent)

        def links(cells: DataFrame, label: str) -> DataFrame:
            """Links within cells of such rows."""
            wanted = nodes.select("set_a", "set_b", "node").join(cells.select("node").distinct().hint("merge"), "node", "left_semi")
            shingles = scratch.table(node_sets(docs, scratch.table(wanted, f"{label}-nodes"), size), f"{label}-sets")
            return scratch.table(search_cells(cells.join(shingles.hint("merge"), "node"), percent), f"{label}-links")

        # First pass: each node asks the one it shares most with.
        # Written, so that joins see two plain exchanges and can split a hot digest or head.
        sharing = dealt.groupBy("digest").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("who"))
        # Digests that the same nodes share are one group.
        alike = sharing.where("n > 1").groupBy("who", "n").agg(F.min("digest").alias("digest"), F.min("head").alias("head"), F.count(F.lit(1)).alias("times"))
        groups = scratch.table(alike.drop("who"), "groups")
        company = scratch.table(dealt.join(groups.hint("merge"), "digest"), "company")
        met = company.where("head <> node").groupBy("node", "head").agg(F.sum("times").alias("shared"))
        best = scratch.table(met.groupBy("node").agg(F.max_by("head", F.struct("shared", -F.col("head"))).alias("head")), "best-company")
        meet = scratch.table(best.groupBy("head").agg(F.count(F.lit(1)).alias("n")), "heads-company")
        part = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / SETS))
        parted = best.join(meet.hint("merge"), "head").select("head", "node", part.alias("part"))
        cell = F.xxhash64("head", "part").alias("cell")

        def stars(of: DataFrame) -> DataFrame:
            asking = of.select(cell, F.lit(0).alias("role"), F.col("head").alias("node"), F.col("head").alias("component")).distinct()
            return asking.unionByName(of.select(cell, F.lit(1).alias("role"), "node", F.col("node").alias("component")))

        near = scratch.table(close_pairs(stars(parted)), "first-close").select(F.col("a").alias("node")).distinct()
        joined = scratch.table(components(links(scratch.table(stars(parted.join(near.hint("merge"), "node", "left_semi")), "first-cells"), "first")), "joined")

        # Second pass: groups that share a digest and are still of several components, each group once.
        of_node = joined.select("node", "component")
        inside = company.join(of_node.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        inside = scratch.table(inside.select("digest", "n", "node", "component"), "inside")
        several = inside.groupBy("digest", "n").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        open_ = scratch.table(several.select("digest", "n"), "open-groups")
        parts = F.ceil(F.col("n") / CELL).cast("int")
        split = inside.select("digest", "node", "component").join(open_.select("digest", "n").hint("merge"), "digest").withColumn("parts", parts)
        split = split.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        pairs = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        low, high = F.least("part", "other"), F.greatest("part", "other")
        role = F.when(low == high, 2).when(F.col("part") == low, 0).otherwise(1)
        may = scratch.table(close_pairs(pairs.select(F.xxhash64("digest", low, high).alias("cell"), role.alias("role"), "node", "component")), "second-close")
        clusters = components(may).withColumnRenamed("component", "cluster")
        placed = scratch.table(clusters.join(of_node.hint("merge"), "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("component")), "clusters")
        second = links(scratch.table(cluster_cells(placed, scratch), "second-cells"), "second")
        linked = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second))

        of_set = nodes.join(linked.hint("merge"), "node", "left").select("set_a", "set_b", "n", F.coalesce("component", "node").alias("component_id"))
        by_doc = named.select("doc_id", "set_a", "set_b", "n").join(of_set.hint("merge"), ["set_a", "set_b", "n"])
        rest = sets.where("doc_id IS NULL OR n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        return materialize(by_doc.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(rest), "components")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every one of the ``documents``."""
    return link_components(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""
