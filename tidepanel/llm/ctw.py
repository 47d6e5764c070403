"""Language model scores by context-tree weighting over bytes, and a word-count baseline."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.exchange import batched, bucket_bits, cut, texts
from tidepanel.llm.vector import ODD, lower_ascii, mixed, word_bounds, word_hashes

DEPTH = 6  # bytes of context
FOLDS, HELD = 7, 2  # documents whose CRC-32 leaves this remainder do not train
END = 255  # a byte that UTF-8 never has: it ends a text and fills the context before it
END_WORD = np.uint64(0x9E3779B97F4A7C15)
WORD_SHIFT = 6  # words go by 58 bits of their hash
SMALL = 4096
BATCH_BYTES = 16 << 20
PART_BYTES = 2 << 20  # bytes whose contexts are sorted together
TREES = 256  # groups of subtrees
_U = np.uint64


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log(Gamma(n + 1/2) / Gamma(1/2)) for whole numbers n."""
    steps = np.r_[0.0, np.cumsum(np.log(np.arange(SMALL) + 0.5))]
    x = np.maximum(n, 1) + 0.5
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - 0.5 * np.log(np.pi)
    return np.where(n <= SMALL, steps[np.minimum(n, SMALL).astype(np.int64)], far)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    steps = np.r_[0.0, np.cumsum(np.log(np.arange(1, SMALL + 1)))]
    x = np.maximum(n, 1) + 1.0
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n <= SMALL, steps[np.minimum(n, SMALL).astype(np.int64)], far)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - _log_factorial(zeros + ones)


def log_weighted(own: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Log of the even mixture of a node's own estimate and the product of the nodes below."""
    return np.logaddexp(own, deeper) - np.log(2)


class Level:
    """The binary nodes of all contexts of one depth, for one bit of the symbol."""

    def __init__(self, context: np.ndarray, symbol: np.ndarray, count: np.ndarray, bit: int):
        node = (context << _U(8)) | (_U(1 << bit) | (symbol >> _U(8 - bit)))
        one = ((symbol >> _U(7 - bit)) & _U(1)).astype(bool)
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
        self.node = node[starts]
        self.place = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(node)]))
        both = np.add.reduceat(count, starts) if len(starts) else count
        self.ones = np.add.reduceat(np.where(one, count, 0), starts) if len(starts) else count
        self.zeros = both - self.ones
        self.own = log_estimate(self.zeros, self.ones)
        self.weighted = self.own

    def mix(self, deeper: "Level", entry: np.ndarray) -> None:
        """Weights this depth with the next one. ``entry`` has the place of each deeper entry among this depth's."""
        first = np.flatnonzero(np.r_[True, deeper.place[1:] != deeper.place[:-1]])
        parent = self.place[entry[first]]
        self.weighted = log_weighted(self.own, np.bincount(parent, deeper.weighted, len(self.node)))

    def share(self) -> np.ndarray:
        """The weight of the node's own estimate against the deeper ones."""
        return np.exp(self.own - self.weighted - np.log(2))


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different sorted keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts)


def _both(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return _merge(*(np.concatenate(x) for x in zip(a, b)))


def _counted(keys: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different sorted keys below 2**63, and how often each occurs where ``used``."""
    both = (keys << _U(1)) | used
    both.sort()
    starts = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    counts = np.diff(np.r_[starts, len(both)])
    each = both[starts]
    return _merge(each >> _U(1), np.where(each & _U(1), counts, 0).astype(np.uint32))


class Tree:
    """The part of the context tree from depth ``top`` on, for entries (context, symbol) with their counts.

    A key is the context, its last byte first, and the symbol: the keys of a context's subtree are neighbours.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, top: int):
        self.keys, self.depth, self.top = keys, depth, top
        symbol = keys & _U(255)
        entries, self.entry = [(keys >> _U(8), symbol, counts.astype(np.int64))], {}
        for d in range(depth - 1, top - 1, -1):  # entries of shorter contexts
            context, own, count = entries[-1]
            name = ((context >> _U(8)) << _U(8)) | own
            each, place = np.unique(name, return_inverse=True)
            self.entry[d] = place
            entries.append((each >> _U(8), each & _U(255), np.bincount(place, count, len(each)).astype(np.int64)))
        self.entries = dict(zip(range(depth, top - 1, -1), entries))
        self.symbol = symbol

    def levels(self, bit: int) -> dict[int, Level]:
        found = {self.depth: Level(*self.entries[self.depth], bit)}
        for d in range(self.depth - 1, self.top - 1, -1):
            found[d] = Level(*self.entries[d], bit)
            found[d].mix(found[d + 1], self.entry[d])
        return found

    def tops(self) -> tuple[np.ndarray, ...]:
        """Of each node at depth ``top``: context, node, zeros, ones, log weighted probability."""
        parts = []
        for bit in range(8):
            level = self.levels(bit)[self.top]
            parts.append((level.node >> _U(8), level.node & _U(255), level.zeros, level.ones, level.weighted))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def log10(self, above: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """log10 of each entry's probability. ``above``: of the depths below ``top``, by context and node, the
        weight of the own estimate, zeros and ones."""
        total = np.zeros(len(self.keys))
        for bit in range(8):
            one = ((self.symbol >> _U(7 - bit)) & _U(1)).astype(bool)
            found = self.levels(bit)
            p, place = None, np.arange(len(self.keys))
            for d in range(self.depth, self.top - 1, -1):
                if d < self.depth:
                    place = self.entry[d][place]
                level = found[d]
                node = level.place[place]
                z, o = level.zeros[node], level.ones[node]
                own = (np.where(one, o, z) + 0.5) / (z + o + 1.0)
                w = level.share()[node] if d < self.depth else 1.0
                p = own if p is None else w * own + (1 - w) * p
            for d in range(self.top - 1, -1, -1):
                share, zeros, ones = above[d]
                context = (self.keys >> _U(8 * (self.depth + 1 - d))).astype(np.int64) if d else np.zeros(len(p), np.int64)
                node = ((_U(1 << bit)) | (self.symbol >> _U(8 - bit))).astype(np.int64)
                z, o, w = zeros[context, node], ones[context, node], share[context, node]
                own = (np.where(one, o, z) + 0.5) / (z + o + 1.0)
                p = w * own + (1 - w) * p
            total += np.log10(p)
        return total


def roof(context: np.ndarray, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray) -> list:
    """Depths 0 and 1 from the sums over depth 2, by last byte and node: at most 256 x 255 rows."""
    shape = (256, 256)
    z, o, below = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    z[context, node], o[context, node], below[context, node] = zeros, ones, deeper
    own = log_estimate(z, o)
    weighted = log_weighted(own, below)
    z0, o0 = z.sum(0, keepdims=True), o.sum(0, keepdims=True)
    own0 = log_estimate(z0, o0)
    weighted0 = log_weighted(own0, weighted.sum(0, keepdims=True))
    half = np.log(2)
    return [(np.exp(own0 - weighted0 - half), z0, o0), (np.exp(own - weighted - half), z, o)]


def byte_keys(bodies: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of each byte and of the end of each text, all in a row, and where each text begins."""
    pad = np.full(depth, END, np.uint8)
    end = np.array([END], np.uint8)
    if not bodies:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    data = np.concatenate([x for b in bodies for x in (pad, b, end)])
    sizes = np.array([len(b) + 1 for b in bodies])
    n = len(data)
    keys = data[depth - 1 : n - 1].astype(_U)
    for k in [*range(2, depth + 1), 0]:
        np.left_shift(keys, _U(8), out=keys)
        np.bitwise_or(keys, data[depth - k : n - k], out=keys)
    keep = np.ones(len(keys), bool)  # places 0 to depth - 1 of each text are fill
    begin = np.cumsum(sizes + depth)[:-1] - depth
    for k in range(depth):
        keep[begin + k] = False
    return keys[keep], np.cumsum(sizes) - sizes


def _words(body: np.ndarray) -> np.ndarray:
    """The words' hashes, and the end."""
    return np.concatenate([word_hashes(body, *word_bounds(body)), [END_WORD]]) >> _U(WORD_SHIFT)


def _parts(bodies: list[np.ndarray]) -> Iterator[slice]:
    """Runs of texts of PART_BYTES or one text."""
    begin = size = 0
    for n, b in enumerate(bodies):
        size += len(b)
        if size >= PART_BYTES:
            yield slice(begin, n + 1)
            begin, size = n + 1, 0
    if begin < len(bodies):
        yield slice(begin, len(bodies))


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, equal bytes of all side by side."""
    return _planes(np.diff(keys, prepend=_U(0)), "<u8")


def _planes(values: np.ndarray, kind: str) -> bytes:
    values = np.ascontiguousarray(values.astype(kind))
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, "<u8"), dtype=_U)


class Lookup:
    """Values of keys, in an open-addressed table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, 2 * len(keys))))))
        self.last = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, _U(2**64 - 1))  # no key is that large
        self.values = np.zeros(1 << self.bits, values.dtype)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == _U(2**64 - 1))
            self.keys[slot[free]] = keys[free]  # of several, the last one gets the slot
            self.values[slot[free]] = values[free]
            stay = self.keys[slot] != keys
            keys, values, slot = keys[stay], values[stay], (slot[stay] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * ODD) >> _U(64 - self.bits)).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        slot = self._slot(wanted)
        out = self.values[slot]
        left = np.flatnonzero(self.keys[slot] != wanted)
        slot, wanted = slot[left], wanted[left]
        while len(left):
            if (self.keys[slot] == _U(2**64 - 1)).any():
                raise KeyError("a key that was never asked for")
            slot = (slot + 1) & self.last
            out[left] = self.values[slot]
            stay = self.keys[slot] != wanted
            left, slot, wanted = left[stay], slot[stay], wanted[stay]
        return out


class Scorer:
    def __init__(self, depth: int, total: int):
        if not 2 <= depth <= 6:
            raise ValueError("contexts have 2 to 6 bytes")
        self.depth, self.bits = depth, bucket_bits(total)

    def _bucket(self, kind: int, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> _U(64 - self.bits)).astype(np.int64) * 2 + kind

    def _tree(self, keys: np.ndarray) -> np.ndarray:
        """Contexts go by their last two bytes, so a group has whole subtrees."""
        return (mixed(keys >> _U(8 * (self.depth - 1))) % _U(TREES)).astype(np.int64)

    def _asked(self, bodies: list[np.ndarray], train: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The different keys of some texts, by bucket, and how often the training texts have them."""
        found = []
        for part in _parts(bodies):
            if kind == 0:
                keys, starts = byte_keys(bodies[part], self.depth)
                sizes = np.diff(np.r_[starts, len(keys)])
            else:
                words = [_words(b) for b in bodies[part]]
                keys, sizes = np.concatenate(words), [len(w) for w in words]
            found.append(_counted(keys, np.repeat(train[part], sizes)))
            del keys
            while len(found) > 1 and len(found[-2][0]) < 2 * len(found[-1][0]):  # alike sizes merge, so few wait
                found[-2:] = [_both(*found[-2:])]
        while len(found) > 1:
            found[-2:] = [_both(*found[-2:])]
        if not found:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        keys, counts = found[0]
        order = np.argsort(self._bucket(kind, keys), kind="stable")
        return keys[order], counts[order]

    def ask(self, table: pa.Table) -> pa.Table:
        """The batch's different byte contexts with their symbol, and its different words."""
        bodies = [lower_ascii(t) for t in texts(table)]
        train = ~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        rows = []
        for kind in (0, 1):
            keys, counts = self._asked(bodies, train, kind)
            rows += [
                (b, _packed(keys[i:j]), _planes(counts[i:j], "<u4")) for b, i, j in cut(self._bucket(kind, keys))
            ]
        batch = table.column("_batch")[0].as_py()
        pa.default_memory_pool().release_unused()
        return pa.table({
            "_bucket": pa.array([r[0] for r in rows], pa.int64()),
            "_batch": pa.array([batch] * len(rows), pa.int32()),
            "keys": pa.array([r[1] for r in rows], pa.binary()),
            "counts": pa.array([r[2] for r in rows], pa.binary()),
        })

    def _bucket_sums(self, table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        keys = [_unpacked(k) for k in table.column("keys").to_pylist()]
        counts = [_unplanes(c, "<u4") for c in table.column("counts").to_pylist()]
        return keys, *_merge(np.concatenate(keys), np.concatenate(counts).astype(np.int64))

    def merge(self, table: pa.Table) -> pa.Table:
        """A bucket's byte contexts, summed over the batches, by tree; of words only how many there are."""
        _, keys, counts = self._bucket_sums(table)
        bucket = table.column("_bucket")[0].as_py()
        if bucket % 2:
            rows = [(-1, b"", np.array([counts.sum(), (counts > 0).sum()], "<i8").tobytes())]
        else:
            tree = self._tree(keys)
            order = np.argsort(tree, kind="stable")
            keys, counts = keys[order], counts[order]
            rows = [(t, _packed(keys[i:j]), _planes(counts[i:j], "<i8")) for t, i, j in cut(tree[order])]
        return pa.table({
            "_tree": pa.array([r[0] for r in rows], pa.int32()),
            "_bucket": pa.array([bucket] * len(rows), pa.int64()),
            "keys": pa.array([r[1] for r in rows], pa.binary()),
            "counts": pa.array([r[2] for r in rows], pa.binary()),
        })

    def _whole_tree(self, table: pa.Table) -> tuple[list[np.ndarray], Tree]:
        keys = [_unpacked(k) for k in table.column("keys").to_pylist()]
        counts = [_unplanes(c, "<i8") for c in table.column("counts").to_pylist()]
        return keys, Tree(*_merge(np.concatenate(keys), np.concatenate(counts)), self.depth, 2)

    def sums(self, table: pa.Table) -> pa.Table:
        """What the first depths need of a group of subtrees; context -1 has the numbers of words."""
        if table.column("_tree")[0].as_py() < 0:
            both = np.sum([np.frombuffer(c, "<i8") for c in table.column("counts").to_pylist()], axis=0)
            found = [np.array([-1]), np.array([0]), both[:1], both[1:], np.zeros(1)]
        else:
            context, node, zeros, ones, weighted = self._whole_tree(table)[1].tops()
            name = ((context >> _U(8)) << _U(8) | node).astype(np.int64)
            each, place = np.unique(name, return_inverse=True)
            found = [each >> 8, each & 255, *(np.bincount(place, x, len(each)) for x in (zeros, ones, weighted))]
        kinds = {"context": np.int32, "node": np.int32, "zeros": np.int64, "ones": np.int64, "weighted": np.float64}
        return pa.table({n: pa.array(x.astype(k)) for x, (n, k) in zip(found, kinds.items())})

    def roof(self, table: pa.Table) -> pa.Table:
        """One row: the first two depths of the tree, and the numbers of all and of different words."""
        columns = [table.column(c).to_numpy() for c in ("context", "node", "zeros", "ones", "weighted")]
        words = columns[0] < 0
        data = zlib.compress(b"".join(x.astype("<f8").tobytes() for level in roof(*(c[~words] for c in columns)) for x in level))
        return pa.table({
            "roof": pa.array([data], pa.binary()),
            "tokens": pa.array([int(columns[2][words].sum())], pa.int64()),
            "different": pa.array([int(columns[3][words].sum())], pa.int64()),
        })

    def values(self, table: pa.Table, above: pa.Table) -> pa.Table:
        """log10 probabilities of a group of subtrees, for the buckets that asked."""
        if not table.num_rows or table.column("_tree")[0].as_py() < 0:
            return pa.table({"_bucket": pa.array([], pa.int64()), "keys": pa.array([], pa.binary()),
                             "values": pa.array([], pa.binary())})
        asked, tree = self._whole_tree(table)
        numbers = np.frombuffer(zlib.decompress(above.column("roof")[0].as_py()), "<f8")
        low, high = numbers[: 3 * 256].reshape(3, 1, 256), numbers[3 * 256 :].reshape(3, 256, 256)
        value = tree.log10([tuple(low), tuple(high)])
        return pa.table({
            "_bucket": table.column("_bucket"),
            "keys": table.column("keys"),
            "values": pa.array([value[np.searchsorted(tree.keys, a)].astype("<f4").tobytes() for a in asked], pa.binary()),
        })

    def reply(self, table: pa.Table, values: pa.Table) -> pa.Table:
        """For each batch's keys: the log10 probability, or how often training has the word."""
        schema = {"_batch": pa.int32(), "_bucket": pa.int64(), "values": pa.binary(), "tokens": pa.int64(), "different": pa.int64()}
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in schema.items()})
        asked, keys, value = self._bucket_sums(table)
        if table.column("_bucket")[0].as_py() % 2 == 0:
            names = np.concatenate([_unpacked(k) for k in values.column("keys").to_pylist()])
            value = np.frombuffer(b"".join(values.column("values").to_pylist()), "<f4")
            order = np.argsort(names)
            keys, value = names[order], value[order]
        found = [value[np.searchsorted(keys, a)] for a in asked]
        return pa.table({
            "_batch": table.column("_batch"),
            "_bucket": table.column("_bucket"),
            "values": pa.array([_planes(f, f.dtype.str) for f in found], pa.binary()),
            "tokens": pa.nulls(len(found), pa.int64()),
            "different": pa.nulls(len(found), pa.int64()),
        })

    def score(self, table: pa.Table, replies: pa.Table) -> pa.Table:
        bodies = [lower_ascii(t) for t in texts(table)]
        train = np.zeros(len(bodies), bool)
        order = np.argsort(replies.column("_bucket").fill_null(-1).to_numpy(), kind="stable")
        buckets = replies.column("_bucket").to_pylist()
        packed = replies.column("values").to_pylist()
        values = []
        for kind, dtype in ((0, "<f4"), (1, "<i8")):
            parts = [_unplanes(packed[i], dtype) for i in order if buckets[i] is not None and buckets[i] % 2 == kind]
            values.append(np.concatenate([*parts, np.zeros(0, dtype)]))
        tokens = pc.max(replies.column("tokens")).as_py() or 0
        different = pc.max(replies.column("different")).as_py() or 0
        symbols, words = (Lookup(self._asked(bodies, train, kind)[0], values[kind]) for kind in (0, 1))
        n_tokens, n_known, base, score = [], [], [], []
        for part in _parts(bodies):
            keys, starts = byte_keys(bodies[part], self.depth)
            score += np.add.reduceat(symbols(keys).astype(np.float64), starts).tolist()
            own = [_words(b) for b in bodies[part]]
            sizes = np.array([len(w) for w in own])
            starts = np.cumsum(sizes) - sizes
            count = words(np.concatenate(own))
            n_tokens += sizes.tolist()
            n_known += np.add.reduceat(count > 0, starts, dtype=np.int64).tolist()
            base += np.add.reduceat(np.log10((count + 1) / (tokens + different + 1)), starts).tolist()
        return pa.table({
            "doc_id": table.column("doc_id"),
            "held_out": table.column("held_out"),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([tokens] * len(bodies), pa.int64()),
            "base_score": pa.array(base, pa.float64()),
            "score": pa.array(score, pa.float64()),
            "bits_per_byte": pa.array(
                [-s / np.log10(2) / (len(b) + 1) for s, b in zip(score, bodies)], pa.float64()
            ),
        })


def scored(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Scores of each row of ``docs`` (doc_id, text) under a context-tree model and under word counts.

    Both learn from the documents whose CRC-32 of doc_id does not leave HELD modulo FOLDS. Texts are lower-cased in
    A-Z. Each byte, and an end after the last, is eight binary decisions; each decision has a tree over the up to
    ``depth`` bytes before it. A node mixes its Krichevsky-Trofimov estimate evenly with the product of its children,
    and the weights that the training texts give to each depth carry on to the scored text.

    Batches send the byte contexts and words they have, with counts; buckets of them add up the batches. Groups of
    contexts that end in the same two bytes build whole subtrees; the two depths above, 65,280 nodes at most, are
    one small row. The probabilities go back the same way, so each batch gets those of its own contexts and no
    model is sent to all tasks.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text
    and its end), bits_per_byte (code length).

    Null or empty text: only the end. Null doc_id: as an empty one, so it trains. No training documents: all
    counts are 0. Repeated rows: each counts and gives its own row. Empty table: no rows. Other columns are ignored.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = (F.crc32(name.cast("binary")) % FOLDS) == HELD
    rows, total, batches = batched(docs.select("doc_id", "text", held.alias("held_out")), size=BATCH_BYTES)
    steps = Scorer(depth, total)
    packed = "keys binary, counts binary"
    asked = rows.groupBy("_batch").applyInArrow(lambda t: steps.ask(t), f"_bucket long, _batch int, {packed}")
    trees = asked.groupBy("_bucket").applyInArrow(lambda t: steps.merge(t), f"_tree int, _bucket long, {packed}")
    sums = trees.groupBy("_tree").applyInArrow(
        lambda t: steps.sums(t), "context int, node int, zeros long, ones long, weighted double"
    )
    sums = sums.groupBy("context", "node").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted")
    )
    top = sums.groupBy(F.lit(0).alias("_all")).applyInArrow(
        lambda t: steps.roof(t), "roof binary, tokens long, different long"
    )
    each_tree = top.select(F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("_tree"), "roof")
    values = trees.groupBy("_tree").cogroup(each_tree.groupBy("_tree")).applyInArrow(
        lambda t, a: steps.values(t, a), "_bucket long, keys binary, values binary"
    )
    replies = asked.groupBy("_bucket").cogroup(values.groupBy("_bucket")).applyInArrow(
        lambda t, v: steps.reply(t, v), "_batch int, _bucket long, values binary, tokens long, different long"
    )
    totals = top.select(
        F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("_batch"),
        F.lit(None).cast("long").alias("_bucket"), F.lit(None).cast("binary").alias("values"), "tokens", "different",
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("_batch").cogroup(replies.unionByName(totals).groupBy("_batch")).applyInArrow(
        lambda t, r: steps.score(t, r),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, bits_per_byte double",
    )
