"""Questions that batches of documents put to the whole corpus, and the answers.

Documents are dealt out into batches of bounded size. A batch sends packed keys (hashes of words, shingles or byte
strings), reduced within the batch first, to buckets; a bucket sees each key of its range once per batch, however
often it occurs; its answers go back to the batches. All passes over the texts of one plan read the same shuffle.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import settle

BATCH_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
ROW_BYTES = 64  # what a row takes beside its text
LOW = 24  # bits of a key beside its bucket, where a rare false match only costs work


def batched(docs: DataFrame, text: str = "text", size: int = BATCH_BYTES) -> tuple[DataFrame, int, int]:
    """``docs`` with the column _batch, how many bytes of text there are, and how many batches.

    The batch follows from doc_id and text, so a repeated task deals its rows out as before. Rows that agree in both
    and together fill a quarter of a batch or more are dealt out one by one; such rows may change places, as they
    are alike. Null ids and texts count as equal.
    """
    key = F.xxhash64("doc_id", text)
    length = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    each = docs.groupBy(key.alias("_key")).agg(F.sum(length).alias("bytes"), F.sum(length + ROW_BYTES).alias("weight"))
    total, weight, most = each.agg(F.sum("bytes"), F.sum("weight"), F.max("weight")).first()
    total, count = total or 0, max(1, math.ceil((weight or 0) / size))
    if (most or 0) < size // 4 or count == 1:
        return docs.withColumn("_batch", F.pmod(key, F.lit(count)).cast("int")), total, count
    often = settle(each.filter(F.col("weight") >= size // 4).select("_key", F.lit(True).alias("_often")), "often")
    own = F.when(F.col("_often"), F.monotonically_increasing_id())
    rows = docs.withColumn("_key", key).join(often, "_key", "left")
    rows = rows.withColumn("_batch", F.pmod(F.xxhash64("_key", own), F.lit(count)).cast("int"))
    return rows.drop("_key", "_often"), total, count


def bucket_bits(total: int, least: int = 8) -> int:
    """So many leading bits of a key give its bucket; grows with the bytes of text."""
    return max(least, math.ceil(math.log2(max(1, total / BUCKET_BYTES))))


def texts(table: pa.Table, column: str = "text") -> list[np.ndarray]:
    """The UTF-8 bytes of each row; a null is empty."""
    out = []
    for chunk in table.column(column).chunks:
        chunk = chunk.cast(pa.large_binary())
        offsets = np.frombuffer(chunk.buffers()[1], np.int64, len(chunk) + 1 + chunk.offset)[chunk.offset :]
        data = chunk.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        known = chunk.is_valid().to_numpy(zero_copy_only=False)
        out += [data[a:b] if ok else data[:0] for a, b, ok in zip(offsets[:-1], offsets[1:], known)]
    return out


def ids(table: pa.Table, column: str = "doc_id") -> np.ndarray:
    """The ids as 64-bit integers; a null is the smallest."""
    return table.column(column).cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()


def squeezed(sorted_keys: np.ndarray) -> bytes:
    """Sorted 32-bit values as differences, equal bytes of all side by side: shuffles compress that well."""
    gaps = np.diff(sorted_keys, prepend=sorted_keys.dtype.type(0)).astype("<u4")
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes()


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def cut(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of the runs of a sorted array."""
    if len(buckets):
        starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
        yield from zip(buckets[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(buckets)])


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands in the sorted keys, and whether it does."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted
