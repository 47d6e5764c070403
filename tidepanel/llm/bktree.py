"""SimHash near-dedup: fingerprints of 64 bits, and BK-trees that find all links within a Hamming radius."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.graph import components
from tidepanel.session import settle

SEED = 42
BITS = 64
TREE = 2_048  # most fingerprints of a tree
AT_ONCE = 65_536  # rows that a task works on together
VISITS = 2_000_000  # most pairs of a query and a node on one level of the trees


def fingerprint(text: str | None, size: int = 4) -> int:
    """Each bit is 1 if it is set in over half the hashes of the text's runs of ``size`` words, repeats included.

    A text of fewer words is one run; one without words gives zero. Only A to Z are lower-cased.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends.tolist()[min(size, len(words)) - 1 :]
    hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(starts, ends)], "<u8")
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed long. Texts do not move, and repeated ones are hashed again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "print": pa.array(prints.view(np.int64))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, print long")


class Forest:
    """One BK-tree per group: children are keyed by their Hamming distance to the parent.

    Level by level over all groups at once: the first fingerprint of a slot becomes its node, the others go on to
    the slot of that node and their distance to it.
    """

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        self.prints = prints
        order = np.argsort(group, kind="stable")
        slot = group[order].astype(np.int64)
        self.levels = []  # (slots in order, their nodes)
        while len(order):
            first = np.r_[True, slot[1:] != slot[:-1]]
            nodes = order[first]
            self.levels.append((slot[first], nodes))
            parent = nodes[np.cumsum(first) - 1][~first]
            order = order[~first]
            slot = parent * (BITS + 1) + np.bitwise_count(prints[order] ^ prints[parent])
            by = np.argsort(slot, kind="stable")
            order, slot = order[by], slot[by]

    def near(self, asks: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(ask, node) of all pairs of one group within the radius."""
        found = []
        ask = np.arange(len(asks))
        low = high = group.astype(np.int64)
        for slots, nodes in self.levels:
            begin, end = np.searchsorted(slots, low), np.searchsorted(slots, high, side="right")
            count = end - begin
            at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            ask, node = np.repeat(ask, count), nodes[at]
            if not len(ask):
                break
            gap = np.bitwise_count(asks[ask] ^ self.prints[node]).astype(np.int64)
            hit = gap <= radius
            found.append((ask[hit], node[hit]))
            # an edge of another length cannot lead to a fingerprint within the radius
            low = node * (BITS + 1) + np.maximum(gap - radius, 0)
            high = node * (BITS + 1) + np.minimum(gap + radius, BITS)
        pairs = [np.concatenate(x) for x in zip(*found)]
        return (pairs[0], pairs[1]) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def spanned(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same fingerprints as the pairs do, one at most for each."""
    nodes, ends = np.unique(np.r_[prints[a], prints[b]], return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)  # roots first, so that whole sets move
        np.minimum.at(label, label[b], least)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _masks(radius: int, blocks: int) -> list[int]:
    """The bits that each table keeps: blocks - radius of the blocks, as signed longs."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    own = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    kept = [sum(own[i] for i in choice) for choice in combinations(range(blocks), blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in kept]


def blocks_for(count: int, radius: int) -> int:
    """So many blocks that a key of evenly spread fingerprints has a quarter of a tree of them at most."""
    blocks = radius + 1
    while blocks < 2 * radius + 4 and count >> (BITS * (blocks - radius) // blocks) > TREE // 4:
        blocks += 1
    return blocks


def links(prints: DataFrame, radius: int, blocks: int | None = None, tree: int = TREE) -> DataFrame:
    """(x, y) such that links connect the same fingerprints as all pairs within the radius do.

    ``prints`` has different longs in the column print. Two fingerprints within the radius agree in blocks - radius
    blocks of bits or more, so each choice of that many blocks deals the fingerprints out to shards by these bits,
    and a near pair meets in one shard or more. A shard has a BK-tree for each ``tree`` fingerprints, chosen by
    hash. A tree goes to its own members and to those of each earlier tree of its shard, so a task holds two parts
    of bounded size however large the shard is. The trees travel by the shuffle and not by the driver, as all of
    them together grow with the corpus. What a task finds leaves it as one link for each fingerprint at most.
    """
    count = prints.count()
    masks = _masks(radius, blocks or blocks_for(count, radius))
    tables = F.array(*[F.lit(m) for m in masks])
    rows = prints.select("print", F.posexplode(tables).alias("t", "mask"))
    rows = rows.select("print", "t", F.col("print").bitwiseAND(F.col("mask")).alias("key"))
    sizes = rows.groupBy("t", "key").count().filter("count > 1")
    rows = rows.join(sizes, ["t", "key"])  # a fingerprint that is alone in its shard has no work there
    rows = rows.withColumn("trees", F.ceil(F.col("count") / tree).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("print"), F.col("trees")).cast("int"))
    # unit (p, q): the tree of part p with the members of part q <= p; for q = p its own members
    rows = rows.select("print", "t", "key", "own", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("o"))
    rows = rows.select(
        "t", "key", F.greatest("own", "o").alias("p"), F.least("own", "o").alias("q"),
        (F.col("own") < F.col("o")).alias("asks"), "print",
    )

    def work(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        t, key, p, q = (table.column(c).to_numpy() for c in unit_key)
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        codes = table.column("print").to_numpy().view(np.uint64)
        fresh = np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])]
        unit = np.cumsum(fresh) - 1
        own = (p == q)[fresh][unit]
        members = np.flatnonzero(~asks)
        forest = Forest(codes[members], unit[members])
        sizes = np.bincount(unit[members], minlength=unit[-1] + 1)
        asking = np.flatnonzero(asks | own)
        chunk = np.cumsum(sizes[unit[asking]]) // VISITS
        found = []
        for begin, end in zip(starts := np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]), [*starts[1:], len(asking)]):
            some = asking[begin:end]
            i, j = forest.near(codes[some], unit[some], radius)
            found.append(spanned(codes, some[i], members[j]))
        if found:
            x, y = (np.concatenate(z) for z in zip(*found))
            yield pa.RecordBatch.from_pydict({"x": pa.array(x.view(np.int64)), "y": pa.array(y.view(np.int64))})

    unit_key = ["t", "key", "p", "q"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < AT_ONCE:
                continue
            # units are whole before the last one that has begun
            table = pa.Table.from_batches(held).combine_chunks()
            same = np.all([table.column(c).to_numpy() == table.column(c)[-1].as_py() for c in unit_key], axis=0)
            cut = int(np.argmax(same))
            if cut:
                yield from work(table.slice(0, cut).to_batches())
            held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if size:
            yield from work(held)

    total = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), count * len(masks) >> 19)
    dealt = rows.repartition(total, *unit_key).sortWithinPartitions(*unit_key)
    return dealt.mapInArrow(run, "x long, y long").distinct()


def linked(docs: DataFrame, radius: int = 4, size: int = 4) -> DataFrame:
    """The fingerprint of each row of ``docs`` (doc_id, text) and the component that links of fingerprints make.

    Fingerprints link when at most ``radius`` bits differ. Columns: doc_id, fingerprint (16 lowercase hex digits),
    component_id: the smallest doc_id that links reach, the row's own included.

    Equal fingerprints are one node, so a large group of copies costs one row in the search; the search is exact.

    Null or empty text, or one without words: fingerprint zero, which links like any other. Repeated rows: each gives
    its own row. A null doc_id counts as none; a component of null ids alone has a null component_id. Empty table:
    no rows. Other columns are ignored.
    """
    rows = settle(fingerprints(docs, size), "fingerprints")
    nodes = settle(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    joined = components(links(nodes.select("print"), radius)).withColumnRenamed("node", "print")
    nodes = nodes.join(joined, "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = nodes.select("print", "component").join(least, "component").select("print", "component_id")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return rows.join(classes, "print").select("doc_id", digits.alias("fingerprint"), "component_id")
