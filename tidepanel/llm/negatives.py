"""Hard negatives for anchors of an embedding table, by an inverted multi-index."""

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import settle

SAMPLE = 20_000  # most rows that the codebooks are fitted on
ROWS_A_CELL = 64  # wanted; decides how many codewords a half has
CODEWORDS = 256  # most of one half, so there are 65,536 cells at most
SHARD = 8_192  # most rows of a shard
STEP = 1_024  # rows scored between two looks at the bound, doubled each time
EXACT = 2.0**53  # doubles hold all integers below
LONG = 2**63 - 1


def quantised(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * vectors.astype(np.float64))


def products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of integers that are stored as doubles; beyond a long they end at its limits."""
    if not len(rows) or np.abs(rows).max(initial=0) * np.abs(anchor).max(initial=0) * len(anchor) < EXACT:
        return (rows @ anchor).astype(np.int64)
    own = [int(x) for x in anchor]
    sums = (sum(int(x) * y for x, y in zip(row, own)) for row in rows)
    return np.array([max(-LONG, min(LONG, s)) for s in sums], np.int64)


def centres(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Codewords of one half: Lloyd's rounds from evenly spread rows of the sample."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    found = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        near, _ = nearest(points, found)
        sums = np.zeros_like(found)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=len(found))
        found = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], found)
    return found


def nearest(points: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codeword of each point and the distance to it."""
    square = (words**2).sum(axis=1)
    near = np.argmin(square - 2 * (points @ words.T), axis=1)
    return near, np.sqrt(((points - words[near]) ** 2).sum(axis=1))


class Codebooks:
    """Two codebooks of half vectors, and how far a codeword's rows reach from it."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray]):
        self.words = words
        self.reach = tuple(np.zeros(len(w)) for w in words)
        self.half = words[0].shape[1]

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[..., : self.half], vectors[..., self.half :]

    def bounds(self, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each half: the least and the largest score that a codeword's rows can have with the anchor."""
        out = []
        for part, words, reach in zip(self.halves(anchor), self.words, self.reach):
            middle, size = words @ part, math.sqrt(float(part @ part))
            slack = 1e-9 * (1 + size * (np.sqrt((words**2).sum(axis=1)) + reach))  # rounding of the sums
            out.append((middle - size * reach - slack, middle + size * reach + slack))
        return out


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(bound, i, j) by falling sum of two half bounds; a heap holds the border of the visited pairs."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)] if len(a) and len(b) else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):  # a pair is reached along its row only, so it enters once
            heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))


class Shard:
    """Rows of a few cells, cell by cell."""

    def __init__(self, table: pa.Table, width: int):
        c1, c2 = (table.column(c).to_numpy() for c in ("c1", "c2"))
        order = np.lexsort((c2, c1))
        self.ids = table.column("vec_id").to_numpy()[order]
        self.rows = table.column("row").to_numpy()[order]
        self.labels = table.column("label").to_numpy()[order]
        self.vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<f8").reshape(-1, width)[order]
        c1, c2 = c1[order], c2[order]
        self.firsts, self.seconds = np.unique(c1), np.unique(c2)
        starts = np.flatnonzero(np.r_[True, (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])]) if len(c1) else []
        ends = [*starts[1:], len(c1)]
        self.cells = {(c1[s], c2[s]): (int(s), int(e)) for s, e in zip(starts, ends)}

    def visit(self, books: Codebooks, anchor: np.ndarray, need: list[float], most: float = math.inf) -> Iterator[tuple]:
        """(places, scores) of the cells by falling bound; none lies wholly above ``most``.

        ``need`` holds the least score that still matters, which the caller raises; a cell below it ends the visit.
        """
        (low1, high1), (low2, high2) = books.bounds(anchor)
        step, found, size = STEP, [], 0
        for bound, i, j in multi_sequence(high1[self.firsts], high2[self.seconds]):
            cell = self.cells.get((key := (self.firsts[i], self.seconds[j])))
            if cell is None or low1[key[0]] + low2[key[1]] > most:
                continue
            if found and (size >= step or bound < need[0]):
                at = np.concatenate(found)
                yield at, products(self.vectors[at], anchor)
                step, found, size = 2 * step, [], 0
            if bound < need[0]:
                return  # certified: neither this cell nor a later one can change a list
            found.append(np.arange(*cell))
            size += cell[1] - cell[0]
        if found:
            at = np.concatenate(found)
            yield at, products(self.vectors[at], anchor)


def best(shard: Shard, at: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count``: higher scores, then smaller ids, then the earlier row."""
    if len(at) > 4 * count:  # all that can be among them
        keep = scores >= np.partition(scores, len(scores) - count)[len(scores) - count]
        at, scores = at[keep], scores[keep]
    order = np.lexsort((shard.rows[at], shard.ids[at], -scores))[:count]
    return at[order], scores[order]


def positives_in(shard: Shard, books: Codebooks, anchor: dict, count: int) -> list[tuple]:
    """The shard's best other rows of the anchor's label, as far as they reach anchor["least"]."""
    at, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    need = [anchor["least"]]
    for more, got in shard.visit(books, anchor["vector"], need):
        fits = (shard.labels[more] == anchor["label"]) & (shard.rows[more] != anchor["row"]) & (got >= anchor["least"])
        at, scores = best(shard, np.r_[at, more[fits]], np.r_[scores, got[fits]], count)
        if len(at) == count:
            need[0] = scores[-1]
    return [(0, int(shard.ids[i]), int(shard.rows[i]), int(s)) for i, s in zip(at, scores)]


def negatives_in(shard: Shard, books: Codebooks, anchor: dict, count: int) -> list[tuple]:
    """The shard's best rows of other labels in each of the windows [low, high] that belong to the positives."""
    windows = {n: w for n, w in enumerate(anchor["windows"]) if w[0] <= w[1]}
    found = {n: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for n in windows}
    need = [min(low for low, _ in windows.values())]
    for more, got in shard.visit(books, anchor["vector"], need, max(high for _, high in windows.values())):
        other = shard.labels[more] != anchor["label"]
        more, got = more[other], got[other]
        for n, (low, high) in windows.items():
            fits = (got >= low) & (got <= high)
            found[n] = best(shard, np.r_[found[n][0], more[fits]], np.r_[found[n][1], got[fits]], count)
        need[0] = min(f[1][-1] if len(f[0]) == count else windows[n][0] for n, f in found.items())
    return [(n, int(shard.ids[i]), int(shard.rows[i]), int(s)) for n in found for i, s in zip(*found[n])]


class Index:
    """The multi-index of a table: rows dealt out into shards of neighbouring cells; large cells have several."""

    def __init__(self, vectors: DataFrame, scale: float):
        spark = vectors.sparkSession
        kind = "vec_id long, label long, asks boolean, row long, vector binary"
        rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "asks", "embedding").filter(
            F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
        )
        size, self.width = rows.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
        self.width = max(2, self.width or 0)
        width = self.width

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = np.zeros((batch.num_rows, width))  # shorter vectors end in zeros
                lists = batch.column("embedding")
                sizes = np.diff(lists.offsets.to_numpy())
                inside = np.arange(width) < sizes[:, None]
                table[inside] = quantised(lists.flatten().to_numpy(zero_copy_only=False), scale)
                own = {name: batch.column(name) for name in ("vec_id", "label", "asks", "row")}
                yield pa.RecordBatch.from_pydict(own | {"vector": pa.array([r.tobytes() for r in table], pa.binary())})

        numbered = rows.withColumn("row", F.monotonically_increasing_id())
        rows = settle(numbered.mapInArrow(packed, kind), "vectors")
        # the smallest hashes are the sample, so that it does not depend on the order of rows
        hashed = F.xxhash64("vec_id", "vector")
        share = F.pmod(hashed, F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, 2 * SAMPLE / max(size, 1)))
        sample = rows.filter(share).orderBy(hashed, "row").limit(SAMPLE).select("vector").collect()
        points = np.frombuffer(b"".join(r[0] for r in sample), "<f8").reshape(-1, width)
        count = max(4, min(CODEWORDS, math.ceil(math.sqrt(size / ROWS_A_CELL))))
        half = width // 2
        books = Codebooks((centres(points[:, :half], count), centres(points[:, half:], count)))

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data = b"".join(batch.column("vector").to_pylist())
                out = {name: batch.column(name) for name in batch.schema.names}
                for n, part in enumerate(books.halves(np.frombuffer(data, "<f8").reshape(-1, width))):
                    near, away = nearest(part, books.words[n])
                    out |= {f"c{n + 1}": pa.array(near.astype(np.int32)), f"r{n + 1}": pa.array(away)}
                yield pa.RecordBatch.from_pydict(out)

        rows = settle(rows.mapInArrow(placed, f"{kind}, c1 int, r1 double, c2 int, r2 double"), "cells")
        # one row per cell that is not empty: CODEWORDS ** 2 at most
        cells = sorted(rows.groupBy("c1", "c2").agg(F.count(F.lit(1)), F.max("r1"), F.max("r2")).collect())
        for c1, c2, _, r1, r2 in cells:
            books.reach[0][c1] = max(books.reach[0][c1], r1)
            books.reach[1][c2] = max(books.reach[1][c2], r2)
        shards, room, last = [], 0, -1  # of each cell: its first shard and its number of shards
        for c1, c2, n, _, _ in cells:
            parts = math.ceil(n / SHARD)
            if parts > 1 or n > room:
                last, room = last + 1, SHARD
            shards.append((c1, c2, last, parts))
            last, room = last + parts - 1, (room - n if parts == 1 else 0)
        where = spark.createDataFrame(shards, "c1 int, c2 int, first int, parts int")
        shard = F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
        self.rows = rows.join(F.broadcast(where), ["c1", "c2"]).withColumn("shard", shard)  # CODEWORDS ** 2 rows
        self.books, self.shards, self.cells = books, last + 1, np.array([s[:2] for s in shards], int).reshape(-1, 2)
        self.places = [(s[2], s[3]) for s in shards]

    def home(self) -> Callable[[dict], list[int]]:
        """The shards of the first cell in the order of the bounds."""
        books, at = self.books, {tuple(c): p for c, p in zip(self.cells.tolist(), self.places)}

        def route(anchor: dict) -> list[int]:
            (_, high1), (_, high2) = books.bounds(anchor["vector"])
            for _, i, j in multi_sequence(high1, high2):
                if (i, j) in at:
                    first, parts = at[i, j]
                    return list(range(first, first + parts))
            return []

        return route

    def within(self) -> Callable[[np.ndarray, float, float], list[int]]:
        """The shards with a cell that can hold scores between two limits."""
        books, cells = self.books, self.cells
        first, parts = np.array(self.places, int).reshape(-1, 2).T

        def route(anchor: np.ndarray, least: float, most: float) -> list[int]:
            (low1, high1), (low2, high2) = books.bounds(anchor)
            high, low = high1[cells[:, 0]] + high2[cells[:, 1]], low1[cells[:, 0]] + low2[cells[:, 1]]
            good = (high >= least) & (low <= most)
            wanted = {(f, p) for f, p in zip(first[good].tolist(), parts[good].tolist())}
            return sorted({f + k for f, p in wanted for k in range(p)})

        return route

    def search(self, asks: DataFrame, kernel: Callable, count: int) -> DataFrame:
        """What ``kernel`` finds for each ask (shard, row, label, vector, least, windows) in its shard.

        A task holds one shard, and its asks stream past it. Columns: row, slot, vec_id, found, score.
        """
        nothing = {"least": F.lit(None).cast("long"), "windows": F.lit(None).cast("array<array<long>>")}
        own = self.rows.select("shard", F.lit(0).alias("kind"), "row", "label", "vector", "vec_id", "c1", "c2")
        own = own.withColumns(nothing)
        none = {"vec_id": F.lit(None).cast("long"), "c1": F.lit(None).cast("int"), "c2": F.lit(None).cast("int")}
        both = own.unionByName(asks.withColumns(none | {"kind": F.lit(1)}).select(*own.columns))
        books, width = self.books, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, parts, shard = -1, [], None
            for batch in batches:
                at = batch.column("shard").to_numpy() * 2 + batch.column("kind").to_numpy()
                starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
                out = []
                for begin, end in zip(starts, [*starts[1:], len(at)]):
                    part = batch.slice(begin, end - begin)
                    if at[begin] // 2 != number:
                        number, parts, shard = at[begin] // 2, [], None
                    if at[begin] % 2 == 0:
                        parts.append(part)
                        continue
                    if shard is None:
                        empty = pa.table({c: batch.column(c).slice(0, 0) for c in batch.schema.names})
                        shard, parts = Shard(pa.Table.from_batches(parts) if parts else empty, width), []
                    for ask in part.select(["row", "label", "vector", "least", "windows"]).to_pylist():
                        ask["vector"] = np.frombuffer(ask["vector"], "<f8")
                        ask["least"] = -math.inf if ask["least"] is None else ask["least"]
                        out += [(ask["row"], *hit) for hit in kernel(shard, books, ask, count)]
                names = {"row": pa.int64(), "slot": pa.int32(), "vec_id": pa.int64(), "found": pa.int64(), "score": pa.int64()}
                yield pa.RecordBatch.from_pydict({
                    name: pa.array([r[i] for r in out], kind) for i, (name, kind) in enumerate(names.items())
                })

        dealt = both.repartition(max(1, min(self.shards, 20_000)), "shard").sortWithinPartitions("shard", "kind")
        return dealt.mapInArrow(run, "row long, slot int, vec_id long, found long, score long")


def routed(asks: DataFrame, route: Callable[[dict], list[int]]) -> DataFrame:
    """One row of ``asks`` for each shard that ``route`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                shards = [route(ask | {"vector": np.frombuffer(ask["vector"], "<f8")}) for ask in part.to_pylist()]
                at = np.repeat(np.arange(part.num_rows), [len(s) for s in shards])
                own = part.take(pa.array(at))
                numbers = pa.array([n for s in shards for n in s], pa.int32())
                yield pa.RecordBatch.from_arrays([numbers, *own.columns], names=["shard", *own.schema.names])

    schema = ", ".join(f"{name} {kind}" for name, kind in asks.dtypes)
    return asks.mapInArrow(run, f"shard int, {schema}")


def mined(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: float = 256,
) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id, embedding, label) that satisfy ``anchors``.

    Components become floor(scale * x). A score is the integer inner product with the anchor; higher ones come
    first, ties by smaller vec_id. The anchor's positives are its first other rows of the same label; for each, the
    negatives are the first rows of another label with low <= 100 * score / positive's score <= high.

    Two codebooks of half vectors form cells; a heap visits the cells of a shard by falling sum of the half bounds
    (the codeword's score plus the anchor's size times the reach of the codeword's rows), until no later cell can
    change a list. An anchor asks the shards of its best cell first; what it finds there bounds which shards it asks
    afterwards, and the windows of its positives bound which it asks for negatives. The result is exact. The
    codebooks come from SAMPLE rows at most, every row is indexed, and a cell larger than a shard is split.

    Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a null label, a null vector, or a null or non-finite component take no part; vectors shorter than the
    longest end in zeros. A null vec_id is largest in ties. Repeated rows: each is a row of its own, so an anchor's
    copy can be its positive, and repeated anchors repeat their result. Scores beyond a long end at its limits.
    Empty table, or an anchor without positives: no rows. Other columns are ignored.
    """
    # in the index a null id is the largest long; it is a null again in the result
    number = F.coalesce(F.col("vec_id").cast("long"), F.lit(LONG))
    index = Index(
        vectors.select(number.alias("vec_id"), "embedding", "label", F.coalesce(anchors, F.lit(False)).alias("asks")),
        scale,
    )
    asks = settle(index.rows.filter("asks").select("row", "vec_id", "label", "vector"), "asks")
    plain = asks.withColumns({"least": F.lit(None).cast("long"), "windows": F.lit(None).cast("array<array<long>>")})
    plain = plain.drop("vec_id")
    home, within = index.home(), index.within()
    near = settle(index.search(routed(plain, home), positives_in, positives), "near")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "found")
    kth = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") == positives)
    further = plain.drop("least").join(kth.select("row", F.col("score").alias("least")), "row", "left")

    def rest(ask: dict) -> list[int]:
        least = -math.inf if ask["least"] is None else ask["least"]
        seen = set(home(ask))
        return [s for s in within(ask["vector"], least, math.inf) if s not in seen]

    far = index.search(routed(further.select(*plain.columns), rest), positives_in, positives)
    first = near.unionByName(far).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives)
    first = settle(first.select("row", (F.col("n") - 1).alias("slot"), "vec_id", "score"), "positives")

    # integer bounds of the windows, by exact decimals
    wide = F.col("score").cast("decimal(24,0)")
    limits = F.array(F.ceil(wide * low / 100).cast("long"), F.floor(wide * high / 100).cast("long"))
    windows = first.withColumn("w", limits).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("slot", "w"))).alias("w"))
    windows = windows.select("row", F.transform("w", lambda x: x["w"]).alias("windows"))
    banded = plain.drop("windows").join(windows, "row").select(*plain.columns)

    def banding(ask: dict) -> list[int]:
        real = [w for w in ask["windows"] if w[0] <= w[1]]  # a score below zero has none
        return within(ask["vector"], min(w[0] for w in real), max(w[1] for w in real)) if real else []

    hits = index.search(routed(banded, banding), negatives_in, negatives)
    ranked = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "vec_id", "found")
    hits = hits.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= negatives)
    named = hits.select("row", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = named.join(first.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["row", "slot"])
    named = named.join(asks.select("row", F.col("vec_id").alias("anchor_id")), "row")
    ids = [F.nullif(F.col(c), F.lit(LONG)).alias(c) for c in ("anchor_id", "positive_id", "negative_id")]
    return named.select(ids[0], ids[1], "rank", ids[2], "positive_score", "negative_score")
