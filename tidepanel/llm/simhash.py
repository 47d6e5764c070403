"""SimHash fingerprints, and the search for all fingerprints within a Hamming radius."""

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.vector import gram_hashes, lower_ascii, mixed, text_bytes, word_bounds, word_hashes
from tidepanel.session import settle

BITS = 128
RADIUS = 10  # of the documents of sf0.01, 92 % of the copies with one other word are that near, 78 % are within 7
DEAL = 30  # comparisons that take as long as putting a fingerprint into one table
AT_ONCE = 100_000  # fingerprints compared with one at once
RANGES = 20_000  # most ranges of doc_id; their bounds pass through the driver


def fingerprint(text: str | None) -> np.ndarray:
    """16 bytes: each bit is the sign of the weighted vote of the text's pairs of neighbouring words.

    A pair that stands n times votes with weight 1 + ln n. The text's begin and end count as words, so a single
    word has pairs too. A text without words gives zeros; a tied bit is 0.
    """
    data = lower_ascii(text_bytes(text))
    starts, ends = word_bounds(data, terms=True)
    if not len(starts):
        return np.zeros(BITS // 8, np.uint8)
    words = word_hashes(data, starts, ends)
    edge = np.zeros(1, np.uint64)
    terms, counts = np.unique(gram_hashes(np.concatenate([edge, words, edge]), 2), return_counts=True)
    lanes = np.stack([terms, mixed(terms ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    bits = np.unpackbits(lanes.view(np.uint8).reshape(len(terms), BITS // 8), axis=1)
    weight = (1 + np.log(counts)).astype(np.float32)
    votes = weight @ bits.astype(np.float32)
    return np.packbits(2 * votes > weight.sum(dtype=np.float32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bits."""
    return 1.0 - int(np.unpackbits(a ^ b).sum()) / BITS


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many code points of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as hex, f0, f1: its halves as signed longs) of each row of ``docs`` (doc_id, text).

    Null or empty text: zeros. Repeated rows: each its own row. Empty table: no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [fingerprint(t) for t in batch["text"]]
            halves = np.array(prints, np.uint8).reshape(-1, 16).view(">i8").astype(np.int64)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "fingerprint": [p.tobytes().hex() for p in prints],
                "f0": halves[:, 0], "f1": halves[:, 1],
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, fingerprint string, f0 long, f1 long"
    )


def _tables(radius: int, blocks: int) -> list[tuple[int, int]]:
    """Masks of the two halves, one pair per table: the blocks that must agree exactly."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for kept in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in kept)
        masks.append(tuple(x - (1 << 64) if x >> 63 else x for x in (mask >> 64, mask & ((1 << 64) - 1))))
    return masks


def cheapest_blocks(radius: int, rows: int, asks: int) -> int:
    """Into how many blocks to cut the bits: more blocks make more tables with longer keys, where fewer fingerprints
    meet. Every choice finds the same pairs."""
    def work(blocks: int) -> float:
        meet = asks / 2 ** (BITS * (blocks - radius) / blocks)
        return comb(blocks, radius) * rows * (DEAL + meet)

    return min(range(radius + 1, radius + 6), key=work)


class Tables:
    """The passes of the block tables: prints are dealt out by each table's key, and compared where keys meet."""

    def __init__(self, radius: int, blocks: int, buckets: int):
        self.radius, self.buckets = radius, buckets
        self.masks = np.array(_tables(radius, blocks), np.int64).view(np.uint64)

    def _keys(self, prints: np.ndarray, table: int) -> np.ndarray:
        """A hash of the blocks that the table keeps; prints of one key are compared, so collisions only cost work."""
        a, b = self.masks[table]
        return mixed((prints[:, 0] & a) ^ mixed((prints[:, 1] & b) + np.uint64(table + 1)))

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(bucket, table, asks, prints of 16 bytes each); the key follows from the print, so it does not move."""
        for batch in batches:
            prints = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in ("f0", "f1")], axis=1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            rows = []
            for role in (False, True):
                own = prints[asks == role]
                for n in range(len(self.masks) if len(own) else 0):
                    bucket = (self._keys(own, n) >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)
                    order = np.argsort(bucket, kind="stable")
                    names, starts = np.unique(bucket[order], return_index=True)
                    parts = np.split(own[order], starts[1:])
                    rows += [(int(k), n, role, part.tobytes()) for k, part in zip(names, parts)]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([r[0] for r in rows], pa.int32()), "table": pa.array([r[1] for r in rows], pa.int32()),
                "asks": pa.array([r[2] for r in rows], pa.bool_()), "prints": pa.array([r[3] for r in rows], pa.binary()),
            })

    def meet(self, table: pa.Table) -> pa.Table:
        """The near pairs of a bucket, once per bucket."""
        packed: dict[tuple[int, bool], list[bytes]] = {}
        for n, asks, data in zip(*(table.column(c).to_pylist() for c in ("table", "asks", "prints"))):
            packed.setdefault((n, asks), []).append(data)
        found = [np.zeros((0, 4), np.uint64)]
        for n in range(len(self.masks)):
            if (n, True) not in packed or (n, False) not in packed:
                continue
            ask, own = (np.frombuffer(b"".join(packed[n, r]), np.uint64).reshape(-1, 2) for r in (True, False))
            order = np.argsort(keys := self._keys(own, n))
            keys, own, wanted = keys[order], own[order], self._keys(ask, n)
            begin, end = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, side="right")
            for q, i, j in zip(ask, begin.tolist(), end.tolist()):
                for at in range(i, j, AT_ONCE):
                    other = own[at : min(at + AT_ONCE, j)]
                    near = other[np.bitwise_count(other ^ q).sum(axis=1, dtype=np.int64) <= self.radius]
                    if len(near):
                        found.append(np.concatenate([np.broadcast_to(q, near.shape), near], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        signed = pairs.view(np.int64)
        gap = np.bitwise_count(pairs[:, :2] ^ pairs[:, 2:]).sum(axis=1, dtype=np.int32)
        return pa.table({**{c: signed[:, i] for i, c in enumerate(("q0", "q1", "f0", "f1"))}, "distance": gap})


def within(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """All fingerprints at most ``radius`` bits from each query: (q0, q1, f0, f1, distance), each pair once.

    Both tables have f0 and f1 and are reduced to different fingerprints first, so copies cost one row; join the
    result back on them for the documents. The bits are cut into ``blocks``; two fingerprints within the radius
    agree in at least blocks - radius of them, so each choice of that many blocks is a table, keyed by its
    blocks' bits, and a near pair meets in one table or more. A fingerprint moves as 16 bytes per table. Without
    ``blocks``, the number of fingerprints and queries tells how many take the least work.
    """
    asks = queries.select("f0", "f1").distinct().withColumn("asks", F.lit(True))
    rows = settle(prints.select("f0", "f1").distinct().withColumn("asks", F.lit(False)).unionByName(asks), "prints")
    asked, count = rows.agg(F.count_if("asks"), F.count(F.lit(1))).first()
    blocks = blocks or cheapest_blocks(radius, count - asked, asked)
    moved = count * comb(blocks, radius) * BITS // 8
    steps = Tables(radius, blocks, max(16, moved >> 23))  # buckets of 8 MB
    dealt = rows.mapInArrow(lambda b: steps.deal(b), "bucket int, table int, asks boolean, prints binary")
    pairs = dealt.groupBy("bucket").applyInArrow(
        lambda t: steps.meet(t), "q0 long, q1 long, f0 long, f1 long, distance int"
    )
    return pairs.distinct()


def _range_of(bounds: list[int]) -> Column:
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = np.searchsorted(edges, ids.fillna(0).astype(np.int64).to_numpy(), side="right")
        return pd.Series(np.where(known, out, 0).astype(np.int32))

    return place("doc_id")


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` in ranges of doc_id, each range followed by the first document of the next: (_range, _tail, …).

    Only the bounds of the ranges and their smallest ids pass through the driver, RANGES of each at most.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = ids.count()
    ranges = max(1, min(RANGES, max(shuffles, count // 2_000), count // 500))
    bounds = []
    if ranges > 1:
        at = [i / ranges for i in range(1, ranges)]
        found = ids.agg(F.percentile_approx("doc_id", at, max(10_000, 10 * ranges))).first()[0]
        bounds = sorted(set(found or []))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    place = _range_of(bounds)
    least = ids.withColumn("_range", place).groupBy("_range").agg(F.min(F.struct("doc_id")).alias("_m"))
    firsts = least.select("_range", F.col("_m.doc_id").alias("doc_id")).orderBy("_range").collect()
    tails = [(firsts[i]["doc_id"], firsts[i - 1]["_range"]) for i in range(len(firsts))]
    table = docs.sparkSession.createDataFrame(tails, "_first long, _before int")
    rows = rows.withColumn("_range", place)
    rows = rows.join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("_first")), "left")  # RANGES rows at most
    both = F.array(
        F.struct(F.col("_range").alias("_range"), F.lit(0).alias("_tail")),
        F.when(F.col("_before").isNotNull(), F.struct(F.col("_before").alias("_range"), F.lit(1).alias("_tail"))),
    )
    out = rows.select("doc_id", "text", F.explode(F.array_compact(both)).alias("_p"))
    out = out.select("doc_id", "text", F.col("_p._range").alias("_range"), F.col("_p._tail").alias("_tail"))
    return out.repartition(max(ranges, 1), "_range").sortWithinPartitions("_range", "_tail", "doc_id", "text")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how near they are.

    The edited text has its last quarter replaced by the begin of the next document by doc_id (after the last:
    the first). Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Texts are dealt out once, by ranges of doc_id; each task streams through its documents in order.

    Null or empty text: empty, fingerprint of zeros. Null doc_id: first in order. Repeated ids: in order of their
    text. A single row is its own next. Empty table: no rows. Other columns are ignored.
    """

    def pair(first: tuple, following: str, following_print: np.ndarray) -> tuple:
        doc, text, own = first
        new = edited(text, following)
        changed = fingerprint(new)
        return (
            doc, len(text), hashlib.sha256(new.encode()).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(),
            likeness(own, changed), likeness(own, following_print),
        )

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, place, closed = None, None, True
        for batch in batches:
            rows = []
            for doc, text, where, tail in zip(batch["doc_id"], batch["text"], batch["_range"], batch["_tail"]):
                if where != place:
                    place, last, closed = where, None, False
                if closed:  # repeated rows of the next range's first id
                    continue
                own = fingerprint(text)
                if last is not None:
                    rows.append(pair(last, text, own))
                last = (None if pd.isna(doc) else int(doc), text, own)
                closed = bool(tail)
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return with_next(docs).mapInPandas(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def searched(docs: DataFrame, radius: int = RADIUS, every: int = 100) -> DataFrame:
    """``compared``, and for each row whose doc_id is divisible by ``every`` the near copies among all rows.

    near_count: other rows with a fingerprint at most ``radius`` bits away. nearest_id, nearest_bits: the one at the
    least distance, ties to the smaller doc_id; null if none is that near. All three are null on the other rows.

    All different fingerprints are searched, by permuted block tables. Equal fingerprints count together, so a
    large group of copies costs one row.
    """
    rows = settle(compared(docs), "compared")
    halves = [F.conv(F.substring("fingerprint", at, 16), 16, -10).cast("long").alias(f"f{i}") for i, at in enumerate((1, 17))]
    asks = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    own = rows.select("*", *halves)
    groups = own.groupBy("f0", "f1").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"))
    groups = settle(groups, "groups")
    pairs = settle(within(groups, own.filter(asks), radius), "near")
    near = pairs.join(groups, ["f0", "f1"]).groupBy("q0", "q1").agg(
        (F.sum("n") - 1).alias("near_count"),
        F.min(F.when(F.col("distance") > 0, F.struct("distance", F.coalesce("least", F.lit(2**63 - 1)).alias("big"), "least"))).alias("o"),
    )
    copies = groups.filter("n > 1").withColumnsRenamed({"f0": "q0", "f1": "q1"})
    copies = copies.join(near.select("q0", "q1"), ["q0", "q1"], "left_semi")
    second = own.select(F.col("f0").alias("q0"), F.col("f1").alias("q1"), "doc_id").join(copies, ["q0", "q1"])
    second = second.groupBy("q0", "q1").agg(
        F.min(F.when(F.col("doc_id") > F.col("least"), F.col("doc_id"))).alias("second"),
        F.count_if(F.col("doc_id") == F.col("least")).alias("same"),
    )
    copies = copies.join(second, ["q0", "q1"])
    found = near.join(copies, ["q0", "q1"], "left").withColumnsRenamed({"q0": "f0", "q1": "f1"})
    copy = F.when((F.col("doc_id") != F.col("least")) | (F.col("same") > 1), F.col("least"))
    copy = copy.otherwise(F.col("second"))
    asked = own.filter(asks).join(found, ["f0", "f1"]).select(
        *rows.columns, "near_count",
        F.when(F.col("n") > 1, copy).otherwise(F.col("o.least")).alias("nearest_id"),
        F.when(F.col("n") > 1, 0).otherwise(F.col("o.distance")).cast("int").alias("nearest_bits"),
    )
    none = {"near_count": "long", "nearest_id": "long", "nearest_bits": "int"}
    rest = rows.filter(~asks).select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()])
    return asked.unionByName(rest)
