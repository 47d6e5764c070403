"""Boosted trees on large panels: one job fits many candidates, one pass scores many lengths of each ensemble.

A candidate is one booster that all rows of the panel share, whatever their number. Features are binned by quantiles of
all rows, and errors are whole multiples of a unit, so that sums are exact: a booster does not depend on how rows are
dealt out to tasks. Rows with the same bins always end in the same leaves. Where the bins have fewer combinations than
there are rows, or a tree takes a part of the rows, rows of one combination are therefore summed up first. A booster is
fitted by one task if these sums are few, else by tasks that run together, each with a part of the rows, and add up
their histograms. The first k trees of a booster are the booster of k trees.
"""

import base64
import math
import os
import pickle
import tempfile
import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from functools import cached_property
from threading import Lock
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidepanel.config import DAY, DEFAULTS, KEY, TARGET
from tidepanel.operators.features import Calendar, Spec, lagged, reach
from tidepanel.operators.folds import Folds, fold_context, unpack
from tidepanel.session import fresh_path, settle

COHORT_ROWS = 2_000_000  # training rows of a cohort of series, on average; forecasts of a cohort share their tasks
PARTS = 8  # tasks that forecast a cohort
CHUNK = 131_072  # rows that are binned, summed up and moved at once
WORD = 8_192  # joint bins of features that are counted in one pass
HELD = 256 << 20  # bytes of a task's rows that stay in memory
BUCKETS = 32  # of summed rows; each draws its own rows for a tree
WHOLE = 4_000_000  # summed rows that a task takes whole when several candidates are fitted
PART_ROWS = 100_000  # rows of a part of a fit, at least
PRECISION = 40  # low bits of a number that quantiles leave out, so 12 of its fraction stay
CELLS = 100_000  # trees times rows that are walked at once
BATCH = 16_384  # rows whose errors are spread at once


@dataclass(frozen=True)
class Booster:
    """Complete binary trees of one depth, as arrays: row = tree, column = node, children of i at 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray
    above: np.ndarray  # a value above it goes to the second child
    leaf: np.ndarray
    labels: tuple[dict, ...]  # of each label column: the number that stands for a label

    def matrix(self, numbers: np.ndarray, labels: list[list]) -> np.ndarray:
        coded = [np.array([codes.get(x, np.nan) for x in own], float) for codes, own in zip(self.labels, labels)]
        return np.column_stack([numbers, *coded]) if coded else numbers

    @cached_property
    def _tests(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different pairs of a feature and a threshold, and which of them each node has."""
        pairs = np.stack([self.feature.ravel().astype(float), self.above.ravel()])
        tests, at = np.unique(pairs, axis=1, return_inverse=True)
        return tests[0].astype(int), tests[1][:, None], at.ravel()

    def predict(self, x: np.ndarray, trees: int) -> np.ndarray:
        """Sums over the first ``trees`` trees, which are walked side by side.

        Trees share their few thresholds, so each is compared with the rows once and the walk looks up the answers.
        """
        leaf = self.leaf[:trees]
        out = np.full(len(x), self.base)
        if not len(leaf) or not len(x):
            return out
        nodes, leaves = self.feature.shape[1], leaf.shape[1]
        depth = leaves.bit_length() - 1
        columns, limits, at = self._tests
        at, values = at[: leaf.shape[0] * nodes], leaf.ravel()
        tree = np.arange(len(leaf))[:, None]
        # bounds of parts of even size: no part of one row, whose trees would be added in another order
        bounds = np.linspace(0, len(x), max(1, len(x) // max(2, CELLS // len(leaf))) + 1).astype(int)
        for begin, end in zip(bounds[:-1], bounds[1:]):
            width = end - begin
            numbers = np.ascontiguousarray(x[begin:end].T)
            right = (numbers[columns] > limits).view(np.int8).ravel()
            start, row = at * width, np.arange(width)
            node = np.zeros((len(leaf), width), np.intp)
            first = tree * nodes
            for _ in range(depth):
                asked = start.take(node + first)
                asked += row
                node *= 2
                node += right.take(asked)
                node += 1
            node += tree * leaves - (leaves - 1)
            out[begin:end] += values.take(node).sum(axis=0)
        return out


def _numbered(labels: list, y: np.ndarray) -> dict:
    """Labels by their mean target, so that one threshold splits them into two sets."""
    names, at = np.unique(np.array([str(x) for x in labels]), return_inverse=True)
    means = np.bincount(at, y) / np.bincount(at)
    return dict(zip(names.tolist(), means.tolist()))


def _sums(cells: np.ndarray, error: np.ndarray, width: int, bins: int) -> np.ndarray:
    """Sum of all errors of each feature and bin. ``cells`` has the features of a row side by side, so that rows of one
    bin, which must be added in order, do not wait for each other."""
    sums = np.zeros(width * bins)
    for begin in range(0, len(error), BATCH):
        part = error[begin : begin + BATCH]
        np.add.at(sums, cells[begin * width : (begin + len(part)) * width], np.repeat(part, width))
    return sums.reshape(width, 1, bins)


def _histograms(codes: list[np.ndarray], some: np.ndarray, error: np.ndarray, node: np.ndarray, count: int, bins: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Sum of errors and number of rows of each feature, node and bin, over ``some`` rows with their nodes."""
    pairs = error.take(some) + 1j  # the error and the row are counted in one pass
    base = node.astype(np.intp) * bins
    cells = np.zeros((len(codes), count * bins), complex)
    for own, row in zip(codes, cells):
        np.add.at(row, own.take(some) + base, pairs)
    cells = cells.reshape(len(codes), count, bins)
    return cells.real.copy(), cells.imag.astype(np.int64)


def _both(whole: np.ndarray, part: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """The children of all nodes in order, given one child of each."""
    other = whole - part
    second = (smaller == 1)[None, :, None]
    pairs = np.stack([np.where(second, other, part), np.where(second, part, other)], axis=2)
    return pairs.reshape(len(whole), -1, whole.shape[2])


def _splits(sums: np.ndarray, sizes: np.ndarray, min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node the best gain, and the feature and the last bin of the first child that give it."""
    sums, left = sums.cumsum(axis=2), sizes.cumsum(axis=2)
    whole, size = sums[:, :, -1:], left[:, :, -1:]
    right = size - left
    gain = sums**2 / np.maximum(left, 1) + (whole - sums) ** 2 / np.maximum(right, 1) - whole**2 / np.maximum(size, 1)
    gain = np.where((left >= min_rows) & (right >= min_rows), gain, 0.0)
    flat = gain.transpose(1, 0, 2).reshape(gain.shape[1], -1)
    at = flat.argmax(axis=1)
    return flat[np.arange(len(flat)), at], at // gain.shape[2], at % gain.shape[2]


def fit_booster(x: np.ndarray, y: np.ndarray, params, seed: int, labels: tuple[dict, ...] = (),
                begun: Booster | None = None) -> Booster:
    """Squared-error boosting on binned features; all nodes of a level are split at once.

    A split needs ``min_rows`` on both sides and a gain; a node without one sends all its rows to the first child.
    Ties of gain go to the first feature and the lowest threshold. ``begun`` is the booster of fewer trees on the same
    rows with the same settings: its trees are taken as they are, and the fit goes on with what they leave.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, params.bins + 1)[1:-1])) for c in x.T]
    bins = max(len(e) for e in edges) + 1
    small = np.min_scalar_type(bins)
    codes = [np.searchsorted(e, c).astype(small) for e, c in zip(edges, x.T)]  # a value equal to an edge is below it
    limits = np.full((width, bins), np.inf)
    for f, e in enumerate(edges):
        limits[f, : len(e)] = e
    able = [f for f in range(width) if codes[f].min() < codes[f].max()]  # the others cannot split
    cells = np.column_stack([np.add(codes[f], k * bins, dtype=np.intp) for k, f in enumerate(able)]).ravel() if able else None
    whole = np.stack([np.bincount(codes[f], minlength=bins) for f in able])[:, None] if able else None
    kind = np.min_scalar_type(2**params.depth)
    nodes, leaves = 2**params.depth - 1, 2**params.depth
    feature = np.zeros((params.trees, nodes), np.int16)
    above = np.full((params.trees, nodes), np.inf, np.float64)
    leaf = np.zeros((params.trees, leaves), np.float64)
    base = float(y.mean())
    rest = y - base
    every = np.arange(n)
    done = min(len(begun.leaf), params.trees) if begun else 0
    for t in range(done):
        feature[t], above[t], leaf[t] = begun.feature[t], begun.above[t], begun.leaf[t]
        node = np.zeros(n, kind)
        for level in range(params.depth):
            own = slice(2**level - 1, 2 ** (level + 1) - 1)
            splits = np.isfinite(above[t, own])
            at = [np.searchsorted(edges[f], limit) for f, limit in zip(feature[t, own], above[t, own])]
            node, _ = _moved(codes, node, feature[t, own], at, splits, np.ones(2**level, int))
        rest = rest - leaf[t].take(node)
    for t in range(done, params.trees):
        random = np.random.default_rng((seed, params.seed, t))  # a tree does not depend on how many follow
        taken = random.random(n) < params.row_share if params.row_share < 1 else None
        rows = every if taken is None else np.flatnonzero(taken)
        some = max(1, round(width * params.feature_share))
        used = np.sort(random.permutation(width)[:some]) if some < width else np.arange(width)
        used = np.array([f for f in used if f in able], int)
        own = [codes[f] for f in used]
        node = np.zeros(n, kind)
        ended = np.array([len(rows)])  # rows of each node
        for level in range(params.depth):
            count = 2**level
            if not own:
                node, ended = 2 * node, np.column_stack([ended, np.zeros_like(ended)]).ravel()
                continue
            if level == 0:
                if taken is None and len(own) == len(able):
                    sums, sizes = _sums(cells, rest, len(able), bins), whole
                else:
                    sums, sizes = _histograms(own, rows, rest, np.zeros(len(rows), kind), 1, bins)
            else:  # only the smaller child of each node is counted, the other one is the rest of the parent
                part = _histograms(own, few, rest, node.take(few) >> 1, count // 2, bins)
                sums, sizes = (_both(parent, child, smaller) for parent, child in zip((sums, sizes), part))
            best, at_feature, at = _splits(sums, sizes, params.min_rows)
            splits = best > 1e-12
            split = np.where(splits, used[at_feature], 0)
            at = np.where(splits, at, bins - 1)
            first = count - 1
            feature[t, first : first + count] = split
            above[t, first : first + count] = limits[split, at]
            low = np.where(splits, sizes.cumsum(axis=2)[at_feature, np.arange(count), at], ended)
            ended = np.column_stack([low, ended - low]).ravel()
            smaller = ended.reshape(-1, 2).argmin(axis=1)
            node, less = _moved(codes, node, split, at, splits, smaller)
            few = np.flatnonzero(less if taken is None else less & taken)
        mine = node if taken is None else node.take(rows)
        sums = np.bincount(mine, rest if taken is None else rest.take(rows), leaves)
        leaf[t] = params.rate * sums / np.maximum(ended, 1)
        rest = rest - leaf[t].take(node)
    return Booster(base, feature, above, leaf, labels)


def _moved(codes: list[np.ndarray], node: np.ndarray, split: np.ndarray, at: np.ndarray, splits: np.ndarray,
           smaller: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The child of each row, and whether that is the smaller child of its node. One pass of small numbers per node."""
    right, less = np.zeros(len(node), bool), np.zeros(len(node), bool)
    inside, second = np.empty(len(node), bool), np.empty(len(node), bool)
    for j in np.flatnonzero(splits):  # of the others all rows go to the first child, the second is empty
        np.equal(node, j, out=inside)
        np.greater(codes[split[j]], at[j], out=second)
        second &= inside
        right |= second
        if not smaller[j]:
            inside ^= second
        less |= second if smaller[j] else inside
    return 2 * node + right, less


def _cohort(cohorts: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(cohorts)).cast("int")


def _columns(table: pa.Table | pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Numbers as doubles, unknown ones NaN."""
    if not names:
        return np.zeros((table.num_rows, 0))
    return np.column_stack([table.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names])


@dataclass(frozen=True)
class Rows:
    """How training rows become numbers: features, and labels by their mean target."""

    features: list[str]
    labels: list[str]
    numbered: tuple[dict, ...] = ()

    @property
    def width(self) -> int:
        return len(self.features) + len(self.labels)

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """Features (a line each), targets and, if given, days of up to CHUNK rows and a batch at a time."""
        kept, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                kept, rows = [*kept, batch], rows + batch.num_rows
            if rows >= CHUNK:
                yield self._of(kept)
                kept, rows = [], 0
        if kept:
            yield self._of(kept)

    def _of(self, batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        table = pa.Table.from_batches(batches)
        coded = [[codes[str(v)] for v in table.column(c).to_pylist()] for codes, c in zip(self.numbered, self.labels)]
        x = np.vstack([_columns(table, self.features).T, *np.array(coded, float).reshape(len(coded), table.num_rows)])
        days = table.column(DAY).cast(pa.int32()).to_numpy() if DAY in table.column_names else None
        return np.ascontiguousarray(x), table.column(TARGET).cast(pa.float64()).to_numpy(), days


def _steps(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values by their sign, exponent and first bits: those, how many share them, and the largest of each."""
    ordered = np.sort(values[~np.isnan(values)]) + 0.0  # no negative zero
    bits = ordered.view(np.int64)
    bits = np.where(bits < 0, np.iinfo(np.int64).min - bits, bits) >> PRECISION
    last = np.flatnonzero(np.append(bits[1:] != bits[:-1], True)) if len(bits) else np.empty(0, int)
    return bits[last], np.diff(last, prepend=-1), ordered[last]


def _quantiles(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """The different quantiles between ``bins`` bins of ``counts`` times ``values``, as of np.quantile."""
    ends = np.cumsum(counts)
    place = np.linspace(0, 1, bins + 1)[1:-1] * (ends[-1] - 1)
    low = np.floor(place)
    share = place - low
    a, b = (values[np.searchsorted(ends, np.minimum(i, ends[-1] - 1), side="right")] for i in (low, low + 1))
    return np.unique(np.where(share < 0.5, a + (b - a) * share, b - (b - a) * (1 - share)))


@dataclass(frozen=True)
class Layout:
    """The bins of all features, the joint bins (words) that hold several features each, and the unit of errors.

    The first child of a split has the values up to an edge. Unknown values are in the first bin.
    """

    edges: tuple[np.ndarray, ...]
    bins: int
    base: float
    unit: float  # a power of two: sums over all rows are exact in a double, an error fits into four bytes

    @cached_property
    def words(self) -> list[list[tuple[int, int, int]]]:
        """Of each word its features, with their number of bins and their stride; many bins find their place first."""
        words, sizes = [], []
        for f in sorted(range(len(self.edges)), key=lambda f: -len(self.edges[f])):
            own = len(self.edges[f]) + 1
            w = next((w for w, size in enumerate(sizes) if size * own <= WORD), len(words))
            if w == len(words):
                words.append([])
                sizes.append(1)
            words[w].append((f, own, sizes[w]))
            sizes[w] *= own
        return words

    @cached_property
    def sizes(self) -> list[int]:
        return [math.prod(own for _, own, _ in word) for word in self.words]

    @cached_property
    def keys(self) -> list[list[int]]:
        """The words that a whole number holds each."""
        keys, size = [], 1 << 62
        for w, own in enumerate(self.sizes):
            if size * own >= 1 << 62:
                keys.append([])
                size = 1
            keys[-1].append(w)
            size *= own
        return keys

    @cached_property
    def kind(self) -> type:
        return np.min_scalar_type(max(self.sizes, default=1))

    def coded(self, x: np.ndarray) -> np.ndarray:
        """The words of rows, a line each."""
        out = np.zeros((len(self.words), x.shape[1]), self.kind)
        for word, line in zip(self.words, out):
            for f, _, stride in word:
                known = np.where(np.isnan(x[f]), -np.inf, x[f])
                line += (np.searchsorted(self.edges[f], known) * stride).astype(self.kind)
        return out

    def errors(self, y: np.ndarray) -> np.ndarray:
        return np.rint((y - self.base) / self.unit)

    def packed(self, words: np.ndarray) -> list[np.ndarray]:
        out = []
        for own in self.keys:
            key = np.zeros(words.shape[1], np.int64)
            for w in reversed(own):
                key = key * self.sizes[w] + words[w]
            out.append(key)
        return out

    def unpacked(self, keys: list[np.ndarray], rows: int) -> np.ndarray:
        out = []
        for own, key in zip(self.keys, keys):
            for w in own:
                key, word = np.divmod(key, self.sizes[w])
                out.append(word.astype(self.kind))
        return np.array(out, self.kind).reshape(len(out), rows)

    @cached_property
    def _members(self) -> list[np.ndarray]:
        """Of each word which of its joint bins (lines) make up each bin of its features."""
        return [np.hstack([np.arange(size)[:, None] // stride % own == np.arange(own) for _, own, stride in word]).astype(float)
                for word, size in zip(self.words, self.sizes)]

    def singled(self, joint: np.ndarray, word: int) -> Iterator[tuple[int, np.ndarray]]:
        """The features of a word and their bins of each node, from its joint bins of each node."""
        cells, begin = joint @ self._members[word], 0  # exact, as all numbers are whole
        for f, own, _ in self.words[word]:
            yield f, cells[:, begin : begin + own]
            begin += own

    def asked(self, feature: np.ndarray, at: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each node the word to look at, and which of its joint bins go to the second child."""
        place = {f: (w, own, stride) for w, word in enumerate(self.words) for f, own, stride in word}
        size = max(self.sizes)
        second, words = np.zeros((len(feature), size), bool), np.zeros(len(feature), np.intp)
        for j in np.flatnonzero(splits):
            words[j], own, stride = place[int(feature[j])]
            second[j] = np.arange(size) // stride % own > at[j]
        return words, second.ravel(), size


class Scratch:
    """Arrays of a task: the first HELD bytes in memory, the others in a file without a name."""

    def __init__(self, file):
        self.file, self.held = file, 0

    def keep(self, values: np.ndarray) -> np.ndarray:
        self.held += values.nbytes
        if self.held <= HELD:
            return values.copy()
        at = self.file.seek(0, os.SEEK_END)
        self.file.write(values.tobytes())
        self.file.flush()
        return np.asarray(np.memmap(self.file, values.dtype, "r+", at, values.shape))


@dataclass(frozen=True)
class Chunk:
    """Some rows of a fit: their words, how many rows each stands for (None: one), and the sums of their errors."""

    bucket: int
    words: np.ndarray
    count: np.ndarray | None
    error: np.ndarray


class Fit:
    """A booster of the chunks of this task and those of others, whose numbers ``gather`` adds up."""

    def __init__(self, chunks: list[Chunk], layout: Layout, params, gather: Callable[[np.ndarray], np.ndarray],
                 scratch: Scratch, last: bool):
        """``last``: nobody reads the errors of the chunks after this fit."""
        self.chunks, self.layout, self.params, self.gather = chunks, layout, params, gather
        self.rest = [c.error if last else scratch.keep(c.error) for c in chunks]
        kind = np.min_scalar_type(2**params.depth)
        self.node = [scratch.keep(np.zeros(len(r), kind)) for r in self.rest]
        self.whole = None  # rows of each bin before the first split, if all rows take part in each tree

    def _drawn(self, tree: int) -> list[np.ndarray | None]:
        """Errors and, as imaginary numbers, rows that take part in a tree (None: each row of the chunk)."""
        if self.params.row_share >= 1:
            return [None if c.count is None else rest + 1j * c.count for c, rest in zip(self.chunks, self.rest)]
        out, random, bucket = [], None, None
        for c, rest in zip(self.chunks, self.rest):
            if c.bucket != bucket:
                random, bucket = np.random.default_rng((self.params.seed, tree, c.bucket)), c.bucket
            drawn = (random.random(len(c.count)) < self.params.row_share).astype(float)
            several = np.flatnonzero(c.count > 1)
            drawn[several] = random.binomial(c.count[several].astype(np.int64), self.params.row_share)
            out.append(rest / c.count * drawn + 1j * drawn)  # rows of a sum have the same error
        return out

    def _histograms(self, drawn: list, used: np.ndarray, parents: int, step: tuple | None, less: np.ndarray | None
                    ) -> tuple[np.ndarray, np.ndarray]:
        """Errors and rows of each feature, node and bin: of all rows, or, after the splits ``step`` of the level above,
        of one child of each node there (``less``)."""
        layout = self.layout
        words = [w for w, word in enumerate(layout.words) if any(f in used for f, _, _ in word)]
        known = step is None and self.whole is not None
        joint = [np.zeros(parents * layout.sizes[w], float if known else complex) for w in words]
        for i, (c, rest, pairs) in enumerate(zip(self.chunks, self.rest, drawn)):
            if step is None:
                values = (rest.astype(float) if pairs is None else pairs.real) if known else rest + 1j if pairs is None else pairs
                for w, own in zip(words, joint):
                    np.add.at(own, c.words[w].astype(np.intp), values)
                continue
            node = self._moved(i, step)
            some = np.flatnonzero(less.take(node))
            base = node.take(some) >> 1
            values = rest.take(some) + 1j if pairs is None else pairs.take(some)  # errors and rows are added in one pass
            for w, own in zip(words, joint):
                np.add.at(own, c.words[w].take(some) + base * layout.sizes[w], values)
        out = np.zeros((2, len(layout.edges), parents, layout.bins))
        for w, own in zip(words, joint):
            own = own.reshape(parents, -1)
            for f, cells in layout.singled(own if known else np.vstack([own.real, own.imag]), w):
                out[: 1 if known else 2, f, :, : cells.shape[1]] = cells.reshape(-1, parents, cells.shape[1])
        if known:
            return self.gather(out[0])[used], self.whole[used]
        sums, sizes = self.gather(out)
        if step is None and self.params.row_share >= 1 and len(used) == sum(len(e) > 0 for e in layout.edges):
            self.whole = sizes
        return sums[used], sizes[used]

    def _moved(self, i: int, step: tuple) -> np.ndarray:
        """The children that the rows of a chunk go to."""
        (words, second, size), chunk, node = step, self.chunks[i], self.node[i].astype(np.intp)
        n = len(node)
        if len(words) == 1:
            node += second.take(chunk.words[words[0]])
            self.node[i][:] = node
            return node
        if len(chunk.words) > 1:
            at = (words * n).take(node)
            at += np.arange(n)
            own = chunk.words.ravel().take(at)
        else:
            own = chunk.words[0]
        right = second.take(node * size + own)
        node *= 2
        node += right
        self.node[i][:] = node
        return node

    def _left(self, step: tuple | None, leaf: np.ndarray) -> None:
        """What the leaves leave of the errors."""
        for i, (c, rest) in enumerate(zip(self.chunks, self.rest)):
            node = self._moved(i, step) if step is not None else self.node[i].astype(np.intp)
            given = leaf.take(node)
            rest -= (given if c.count is None else given * c.count).astype(rest.dtype)
            self.node[i][:] = 0

    def _again(self, begun: Booster, tree: int) -> None:
        for level in range(self.params.depth):
            own = slice(2**level - 1, 2 ** (level + 1) - 1)
            feature, above = begun.feature[tree, own], begun.above[tree, own]
            at = np.array([np.searchsorted(self.layout.edges[f], v) for f, v in zip(feature, above)])
            step = self.layout.asked(feature, at, np.isfinite(above))
            if level < self.params.depth - 1:
                for i in range(len(self.chunks)):
                    self._moved(i, step)
        self._left(step, np.rint(begun.leaf[tree] / self.layout.unit))

    def booster(self, labels: tuple[dict, ...], begun: Booster | None = None) -> Booster:
        """Squared-error boosting as of :func:`fit_booster`, on the bins of the layout."""
        params, layout = self.params, self.layout
        depth, width, unit = params.depth, len(layout.edges), layout.unit
        feature = np.zeros((params.trees, 2**depth - 1), np.int16)
        above = np.full(feature.shape, np.inf)
        leaf = np.zeros((params.trees, 2**depth))
        done = min(len(begun.leaf), params.trees) if begun else 0
        for t in range(done):
            feature[t], above[t], leaf[t] = begun.feature[t], begun.above[t], begun.leaf[t]
            self._again(begun, t)
        able = np.array([f for f, e in enumerate(layout.edges) if len(e)], int)
        some = max(1, round(width * params.feature_share))
        for t in range(done, params.trees):
            used = able
            if some < width:
                random = np.random.default_rng((params.seed, t))  # a tree does not depend on how many follow
                used = np.intersect1d(random.permutation(width)[:some], able)
            if not len(used):
                continue
            drawn, step = self._drawn(t), None
            for level in range(depth):
                count = 2**level
                if level == 0:
                    sums, sizes = self._histograms(drawn, used, 1, None, None)
                    ended, errors = sizes[0].sum(axis=1), sums[0].sum(axis=1)
                else:
                    part = self._histograms(drawn, used, count // 2, step, less)
                    sums, sizes = (_both(parent, child, smaller) for parent, child in zip((sums, sizes), part))
                best, at_feature, at = _splits(sums * unit, sizes, params.min_rows)
                splits = best > 1e-12
                split = np.where(splits, used[at_feature], 0)
                nodes = np.arange(count)
                own = slice(count - 1, 2 * count - 1)
                feature[t, own] = split
                above[t, own] = [layout.edges[f][k] if s else np.inf for f, k, s in zip(split, at, splits)]
                low = np.where(splits, sizes.cumsum(axis=2)[at_feature, nodes, at], ended)
                low_errors = np.where(splits, sums.cumsum(axis=2)[at_feature, nodes, at], errors)
                ended = np.column_stack([low, ended - low]).ravel()
                errors = np.column_stack([low_errors, errors - low_errors]).ravel()
                smaller = ended.reshape(-1, 2).argmin(axis=1)
                less = np.arange(2 * count) % 2 == np.repeat(smaller, 2)
                step = layout.asked(split, at, splits)
            given = np.rint(params.rate * errors / np.maximum(ended, 1))
            leaf[t] = given * unit
            self._left(step, given)
        return Booster(layout.base, feature, above, leaf, labels)


class Meeting:
    """Adds up arrays of whole numbers over the tasks of a barrier stage.

    The first task reads those of all others from the shared folder and writes the sum for them; a file is replaced as
    a whole and names its round. Without a folder the scheduler carries the arrays, which takes about a second a round.
    """

    def __init__(self, folder: str | None):
        self.task, self.round = BarrierTaskContext.get(), 0
        self.rank, self.tasks = self.task.partitionId(), len(self.task.getTaskInfos())
        if folder and self.tasks > 1:  # a folder for each attempt, which its first task names
            folder = f"{folder}/{self.task.allGather(str(self.task.taskAttemptId()))[0]}"
            os.makedirs(folder, exist_ok=True)
        self.folder = folder

    def _write(self, name: str, values: np.ndarray) -> None:
        path = f"{self.folder}/{name}"
        with open(f"{path}.new", "wb") as f:
            f.write(self.round.to_bytes(8) + values.tobytes())
        os.replace(f"{path}.new", path)

    def _read(self, name: str, like: np.ndarray) -> np.ndarray:
        head = self.round.to_bytes(8)
        while True:
            try:
                with open(f"{self.folder}/{name}", "rb") as f:
                    found = f.read()
                if found[:8] == head:
                    return np.frombuffer(found, like.dtype, offset=8).reshape(like.shape)
            except FileNotFoundError:
                pass
            time.sleep(0.001)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        self.round += 1
        if self.tasks == 1:
            return values
        if not self.folder:
            said = self.task.allGather(base64.b64encode(values.tobytes()).decode())
            return sum(np.frombuffer(base64.b64decode(x), values.dtype) for x in said).reshape(values.shape)
        if self.rank:
            self._write(str(self.rank), values)
            return self._read("sum", values)
        for other in range(1, self.tasks):
            values = values + self._read(str(other), values)
        self._write("sum", values)
        return values


_fitting = Lock()  # stages whose tasks run together take turns


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at the same time."""
    context = spark.sparkContext._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


PACKED = "bucket int, at int, size int, words binary, count binary, error binary"


def _pack(parts: list[tuple[int, int, np.ndarray, np.ndarray | None, np.ndarray]]) -> pa.RecordBatch:
    bucket, at, words, count, error = zip(*parts)
    return pa.RecordBatch.from_arrays([
        pa.array(bucket, pa.int32()), pa.array(at, pa.int32()), pa.array([len(e) for e in error], pa.int32()),
        pa.array([w.tobytes() for w in words], pa.binary()),
        pa.array([None if c is None else c.tobytes() for c in count], pa.binary()),
        pa.array([e.tobytes() for e in error], pa.binary()),
    ], ["bucket", "at", "size", "words", "count", "error"])


@dataclass(frozen=True)
class Prepared:
    """Training rows as a fit reads them: ``packed`` has ``packs`` rows, or sums of them, some thousands in one."""

    rows: Rows
    layout: Layout
    count: int
    packed: DataFrame | None
    packs: int


def prepare(matrix: DataFrame, features: list[str], labels: list[str], candidates: dict[int, object],
            cutoffs: list[date] | None = None) -> list[Prepared]:
    """The rows of ``matrix`` up to each of the cutoffs, oldest first (None: all rows). It is read twice or more often.

    Fits at several cutoffs share their passes over the rows. The driver holds the mean target of each label and some
    thousand quantile steps a feature.
    """
    if labels and cutoffs:  # labels have other numbers at each cutoff
        return [prepare(matrix.filter(F.col(DAY) <= F.lit(c)), features, labels, candidates)[0] for c in cutoffs]
    names = [F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("name") for c in labels]
    means = [matrix.groupBy(c).agg(F.avg(TARGET)).collect() for c in names]
    rows = Rows(features, labels, tuple(dict(map(tuple, m)) for m in means))
    kept = matrix.select(TARGET, *features, *labels, *[DAY] * bool(cutoffs))
    days = [(c - date(1970, 1, 1)).days for c in cutoffs] if cutoffs else None
    (bins,) = {p.bins for p in candidates.values()}
    laid = _laid(kept, rows, bins, days)
    shares = any(p.row_share < 1 for p in candidates.values())
    summed = [i for i, (layout, n) in enumerate(laid) if n and (shares or math.prod(layout.sizes) < n)]
    sums = _summed(kept, rows, {i: laid[i][0] for i in summed}, shares, days) if summed else {}
    out = []
    for i, (layout, count) in enumerate(laid):
        own = kept.filter(F.col(DAY) <= F.lit(cutoffs[i])) if cutoffs else kept
        out.append(Prepared(rows, layout, count, *(sums[i] if i in sums else (_dealt(own, rows, layout), count))))
    return out


def _since(day: np.ndarray | None, days: list[int] | None, rows: int) -> np.ndarray:
    """The first fit that a row takes part in."""
    return np.zeros(rows, int) if days is None else np.searchsorted(days, day)


def _laid(kept: DataFrame, rows: Rows, bins: int, days: list[int] | None) -> list[tuple[Layout, int]]:
    """The layouts of the rows up to each cutoff, and their numbers. A feature's quantiles are those of its values'
    first bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, day in rows.chunks(batches):
            since = _since(day, days, len(y))
            for fit in np.unique(since).tolist():
                own = since == fit
                x_own, y_own = (x, y) if own.all() else (x[:, own], y[own])
                found = [_steps(line) for line in x_own]
                # beside the steps: sums of the target and of its squares, and the largest one
                column = np.concatenate([np.full(len(s[0]), f) for f, s in enumerate(found)] + [[-1, -1]])
                step = np.concatenate([s[0] for s in found] + [[0, 1]])
                size = np.concatenate([s[1] for s in found] + [[len(y_own), len(y_own)]])
                top = np.concatenate([s[2] for s in found] + [[np.abs(y_own).max(), 0.0]])
                total = np.concatenate([np.zeros(len(step) - 2), [y_own.sum(), (y_own * y_own).sum()]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(step), fit), pa.int32()), pa.array(column, pa.int32()), pa.array(step, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(top, pa.float64()), pa.array(total, pa.float64())], names)

    names = ["fit", "column", "step", "size", "top", "total"]
    steps = kept.mapInArrow(run, "fit int, column int, step long, size long, top double, total double")
    steps = steps.groupBy("fit", "column", "step").agg(F.sum("size").alias("size"), F.max("top").alias("top"), F.sum("total").alias("total"))
    found = steps.toArrow().to_pandas()
    out = []
    for fit in range(len(days) if days else 1):
        own = found[found["fit"] <= fit].groupby(["column", "step"], as_index=False).agg({"size": "sum", "top": "max", "total": "sum"})
        out.append(_layout(*(own[c].to_numpy() for c in ("column", "size", "top", "total")), rows.width, bins))
    return out


def _layout(column: np.ndarray, size: np.ndarray, top: np.ndarray, total: np.ndarray, width: int, bins: int
            ) -> tuple[Layout, int]:
    count = int(size[0]) if len(size) else 0
    if not count:
        return Layout((), bins, 0.0, 1.0), 0
    mean, edges = total[0] / count, []
    for f in range(width):
        own = column == f
        own_edges = _quantiles(top[own], size[own], bins) if own.any() else np.empty(0)
        # an edge that no value is above splits nothing
        edges.append(own_edges[own_edges < top[own].max()] if len(own_edges) else own_edges)
    # no sum of errors is larger than this (Cauchy and Schwarz); some bits are left, as also in four bytes
    most = count * math.sqrt(max(total[1] / count - mean * mean, 0.0))
    far = top[0] + abs(mean)
    unit = 2.0 ** max(math.frexp(most)[1] - 50, math.frexp(far)[1] - 28) if most > 0 else 2.0**-30
    base = float(np.rint(mean / unit) * unit)
    return Layout(tuple(edges), max(len(e) for e in edges) + 1 if edges else 1, base, unit), count


def _dealt(kept: DataFrame, rows: Rows, layout: Layout) -> DataFrame:
    """The words and errors of all rows, some thousands packed into one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for at, (x, y, _) in enumerate(rows.chunks(batches)):
            yield _pack(0, task + at, at, layout.coded(x), None, layout.errors(y).astype(np.int32))

    return kept.mapInArrow(run, PACKED)


def _summed(kept: DataFrame, rows: Rows, layouts: dict[int, Layout], shares: bool, days: list[int] | None
            ) -> dict[int, tuple[DataFrame, int]]:
    """The same of the sums over rows with equal words (and, if trees take a part of the rows, equal errors)."""
    width = max(len(layout.keys) for layout in layouts.values())
    keys = [f"k{i}" for i in range(width)] + ["e"] * shares

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, day in rows.chunks(batches):
            since = _since(day, days, len(y))
            for fit, layout in layouts.items():
                take = since <= fit
                if not take.any():
                    continue
                x_own, y_own = (x, y) if take.all() else (x[:, take], y[take])
                error = layout.errors(y_own).astype(np.int64)
                own = layout.packed(layout.coded(x_own))
                own += [np.zeros(len(error), np.int64)] * (width - len(own)) + [error] * shares
                order = np.lexsort(own) if len(own) > 1 else np.argsort(own[0]) if own else np.arange(len(error))
                own = [k[order] for k in own]
                first = np.zeros(len(error), bool)
                first[0] = True
                for k in own:
                    first[1:] |= k[1:] != k[:-1]
                at = np.flatnonzero(first)
                sums = np.add.reduceat(error[order], at), np.diff(at, append=len(error)), np.full(len(at), fit)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*[k[at] for k in own], *sums)],
                                                 [*keys, "error", "count", "fit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        table = pa.Table.from_batches(table)
        fit, bucket, error, count, *own = (table.column(c).to_numpy() for c in ("fit", "bucket", "error", "count", *keys))
        starts = [*np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(fit, prepend=-1) != 0)).tolist(), len(bucket)]
        for begin, end in zip(starts[:-1], starts[1:]):
            layout = layouts[int(fit[begin])]
            for at in range(begin, end, CHUNK):
                part = slice(at, min(at + CHUNK, end))
                words = layout.unpacked([k[part] for k in own[: len(layout.keys)]], part.stop - at)
                yield _pack(int(fit[begin]), int(bucket[begin]), at - begin, words, count[part].astype(float), error[part].astype(float))

    longs = ", ".join(f"{k} long" for k in [*keys, "error", "count", "fit"])
    sums = kept.mapInArrow(run, longs).groupBy("fit", *keys).agg(F.sum("error").alias("error"), F.sum("count").alias("count"))
    bucket = F.pmod(F.xxhash64(*keys) if keys else F.lit(0), F.lit(BUCKETS)).cast("int")
    dealt = sums.withColumn("bucket", bucket).repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", "fit", *keys)
    packed = settle(dealt.mapInArrow(pack, PACKED), "sums")
    sizes = dict(map(tuple, packed.groupBy("fit").agg(F.sum("size")).collect()))
    return {i: (packed.filter(F.col("fit") == i), sizes.get(i, 0)) for i in layouts}


PACKED = "fit int, bucket int, at int, size int, words binary, count binary, error binary"


def _pack(fit: int, bucket: int, at: int, words: np.ndarray, count: np.ndarray | None, error: np.ndarray) -> pa.RecordBatch:
    numbers = [pa.array([v], pa.int32()) for v in (fit, bucket, at, len(error))]
    arrays = [pa.array([None if v is None else v.tobytes()], pa.binary()) for v in (words, count, error)]
    return pa.RecordBatch.from_arrays([*numbers, *arrays], ["fit", "bucket", "at", "size", "words", "count", "error"])


class Ensemble:
    """Boosters of several candidates (trial -> parameters) on the same features, as a table.

    Rows (trial, shard, booster) with one shard, which all series share. ``features`` are numbers, ``labels`` are strings.
    """

    def __init__(self, matrix: DataFrame, features: list[str], labels: list[str], candidates: dict[int, object],
                 stored: bool = False, begun: "Ensemble | None" = None, prepared: Prepared | None = None):
        """``stored``: the matrix is a table already, which several ensembles read. ``begun``: an ensemble of fewer
        trees on the same matrix, whose boosters the fits of the same trials go on with. ``prepared``: its rows."""
        self.features, self.labels, self.candidates, self.spark = features, labels, candidates, matrix.sparkSession
        if begun is not None:
            prepared = begun.prepared
        if prepared is None:
            kept = matrix if stored else settle(matrix.select(DAY, TARGET, *features, *labels), "matrix")
            (prepared,) = prepare(kept, features, labels, candidates)
        self.prepared = prepared
        self.cohorts = max(1, round(prepared.count / COHORT_ROWS))
        schema = "trial long, shard int, booster binary"
        self.models = self._fitted(schema, begun) if prepared.count else self.spark.createDataFrame([], schema)

    def _fitted(self, schema: str, begun: "Ensemble | None") -> DataFrame:
        layout, labels, packs = self.prepared.layout, self.prepared.rows.numbered, self.prepared.packs
        width = len(layout.words)
        trials = sorted(self.candidates.items(), key=lambda t: -t[1].trees * t[1].depth)  # the longest begins first
        slots = _slots(self.spark)
        alone = len(trials) > 1 and packs <= WHOLE
        tasks = len(trials) if alone else max(1, min(slots, packs // PART_ROWS))
        place = F.pmod(F.col("bucket"), F.lit(tasks)).alias("_place")
        if alone:
            place = F.explode(F.array(*[F.lit(i) for i in range(tasks)])).alias("_place")
        rows = self.prepared.packed.select("*", place)
        if begun is not None:
            every = [i for i, (t, _) in enumerate(trials)] if alone else range(tasks)
            of = F.create_map(*[x for i, (t, _) in enumerate(trials) for x in (F.lit(t), F.lit(i))])[F.col("trial")]
            where = of if alone else F.explode(F.array(*[F.lit(i) for i in every]))
            older = begun.models.filter(F.col("trial").isin(*self.candidates))
            older = older.select(where.alias("_place"), F.lit(-1).alias("bucket"), F.col("trial").cast("int").alias("at"), F.col("booster").alias("words"))
            rows = rows.unionByName(older, allowMissingColumns=True)
        root = fresh_path(self.spark, "fit")
        folder = root.removeprefix("file://").removeprefix("file:")
        folder = None if ":" in folder.split("/")[0] else folder

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with tempfile.TemporaryFile() as file:
                found, earlier, own, scratch = {}, {}, None, Scratch(file)
                for row in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                    own = row["_place"]
                    if row["bucket"] < 0:
                        earlier[row["at"]] = pickle.loads(row["words"])
                        continue
                    words = np.frombuffer(row["words"], layout.kind).reshape(width, row["size"])
                    count = None if row["count"] is None else np.frombuffer(row["count"])
                    error = np.frombuffer(row["error"], np.int32 if count is None else float)
                    found[row["bucket"], row["at"], len(found)] = Chunk(
                        row["bucket"], scratch.keep(words), None if count is None else scratch.keep(count), scratch.keep(error))
                chunks = [found[at] for at in sorted(found)]
                if alone:
                    gather, mine = (lambda x: x), [] if own is None else [trials[own]]
                else:
                    gather, mine = Meeting(folder), trials
                for i, (trial, params) in enumerate(mine):
                    with tempfile.TemporaryFile() as state:
                        fit = Fit(chunks, layout, params, gather, Scratch(state), i == len(mine) - 1)
                        booster = fit.booster(labels, earlier.get(trial))
                    if alone or not gather.rank:
                        yield pa.RecordBatch.from_arrays([pa.array([trial], pa.int64()), pa.array([0], pa.int32()),
                                                          pa.array([pickle.dumps(booster)], pa.binary())], ["trial", "shard", "booster"])

        dealt = rows.repartitionById(tasks, "_place")
        if alone:
            return settle(dealt.mapInArrow(run, schema), "boosters")
        with _fitting:  # a stage that ends in a shuffle is run again when one of its tasks is lost
            return settle(dealt.mapInArrow(run, schema, barrier=True).repartition(1), "boosters")

    def _met(self, rows: DataFrame, work: Callable[[list[Booster], int, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``work`` on each part of a cohort's rows, with the boosters of one candidate, which travel to all parts."""
        trials = F.array(*[F.lit(t).cast("long") for t in self.candidates])
        keys = ["cohort", "trial", "part"]
        part = F.pmod(F.xxhash64(F.lit(1), KEY), F.lit(PARTS)).cast("int")
        left = rows.select("*", _cohort(self.cohorts).alias("cohort"), part.alias("part"), F.explode(trials).alias("trial"))
        every = F.explode(F.sequence(F.lit(0), F.lit(self.cohorts * PARTS - 1))).alias("_each")
        right = self.models.select("*", every).withColumns({
            "cohort": F.floor(F.col("_each") / PARTS).cast("int"), "part": F.pmod("_each", F.lit(PARTS))}).drop("_each")

        def run(own: pa.Table, models: pa.Table) -> pa.Table:
            models = models.sort_by("shard")
            boosters = [pickle.loads(b) for b in models.column("booster").to_pylist()]
            if not boosters or not own.num_rows:
                return empty
            return work(boosters, models.column("trial")[0].as_py(), own.drop_columns(keys)).cast(empty.schema)

        empty = to_arrow_schema(self.models.sparkSession.createDataFrame([], schema).schema).empty_table()
        count = self.cohorts * PARTS * len(self.candidates)
        left = left.repartition(min(count, 20_000), *keys)
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)

    def lengths(self, stages: tuple[int, ...] = ()) -> dict[int, list[int]]:
        """Of each candidate: the lengths among ``stages`` that are shorter than its ensemble, and its own."""
        return {t: [*sorted(s for s in set(stages) if s < p.trees), p.trees] for t, p in self.candidates.items()}

    def scored(self, rows: DataFrame, stages: tuple[int, ...] = ()) -> DataFrame:
        """``rows`` once per candidate and length, with trial, trees and y_hat."""
        lengths, features, labels = self.lengths(stages), self.features, self.labels
        schema = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes) + ", trial long, trees int, y_hat double"

        def work(boosters: list[Booster], trial: int, own: pa.Table) -> pa.Table:
            numbers, names = _columns(own, features), [[str(v) for v in own.column(c).to_pylist()] for c in labels]
            parts = []
            for trees in lengths[trial]:
                y = np.mean([b.predict(b.matrix(numbers, names), trees) for b in boosters], axis=0)
                parts.append(own.append_column("trial", pa.array([trial] * len(y), pa.int64()))
                             .append_column("trees", pa.array([trees] * len(y), pa.int32()))
                             .append_column("y_hat", pa.array(y)))
            return pa.concat_tables(parts)

        return self._met(rows, work, schema)

    def recursed(self, panel: DataFrame, folds: Folds, specs: list[Spec], static: dict[str, Column] | None = None,
                 stages: tuple[int, ...] = ()) -> DataFrame:
        """Forecasts of the folds once per candidate and length: (unique_id, ds, cutoff, h, y, y_hat, trial, trees).

        A task holds the contexts of one part and walks the steps of the horizon; each step's forecasts enter the
        contexts for the next one. So the recursion shuffles the contexts once, whatever the smallest lag is.
        """
        days = F.sequence(F.lit(1), F.lit(folds.horizon))
        calendars = [s for s in specs if isinstance(s, Calendar)]

        def by_step(spec: Calendar) -> Column:
            return F.transform(days, lambda i: spec.of(F.date_add("cutoff", i)).cast("double"))

        known = {s.name: by_step(s) for s in calendars}
        contexts = fold_context(panel, folds, reach(specs)).withColumns(known | (static or {}))
        lengths, labels, horizon = self.lengths(stages), self.labels, folds.horizon
        back = lagged(specs)

        def work(boosters: list[Booster], trial: int, own: pa.Table) -> pa.Table:
            past = np.array([[np.nan if v is None else v for v in p] for p in own.column("past").to_pylist()], float)
            later = {s.name: np.array(own.column(s.name).to_pylist(), float) for s in calendars}
            names = [[str(v) for v in own.column(c).to_pylist()] for c in labels]
            parts = []
            for trees in lengths[trial]:
                seen, path = past, np.empty((len(past), horizon))
                for h in range(horizon):
                    values = {s.name: s.last(seen) for s in back} | {c: v[:, h] for c, v in later.items()}
                    numbers = np.column_stack([values[s.name] for s in specs])
                    y = np.full(len(past), np.nan)  # a series that is too short for a feature gets no forecast
                    full = np.flatnonzero(~np.isnan(numbers).any(axis=1))
                    if len(full):
                        some = [[c[i] for i in full] for c in names]
                        y[full] = np.mean([b.predict(b.matrix(numbers[full], some), trees) for b in boosters], axis=0)
                    path[:, h] = y
                    seen = np.column_stack([seen[:, 1:], y])
                flat = pa.array(path.ravel(), from_pandas=True)
                ends = pa.array(np.arange(0, path.size + 1, horizon, dtype=np.int32))
                parts.append(own.select([KEY, "cutoff", "future"])
                             .append_column("path", pa.ListArray.from_arrays(ends, flat))
                             .append_column("trial", pa.array([trial] * len(past), pa.int64()))
                             .append_column("trees", pa.array([trees] * len(past), pa.int32())))
            return pa.concat_tables(parts)

        schema = f"{KEY} string, cutoff date, future array<double>, path array<double>, trial long, trees int"
        paths = self._met(contexts, work, schema)
        out = unpack(paths, folds, lambda h: F.get("path", h - 1), {"trial": F.col("trial"), "trees": F.col("trees")})
        return out.filter(F.col("y_hat").isNotNull())
