"""Words of Arrow string batches, computed column-wise (used inside Spark's Arrow functions)."""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def release() -> None:
    """Give memory that a batch no longer needs back to the system, as it counts beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
        if trim is not None:
            trim(0)


def slices(batch: pa.RecordBatch, col: str, max_bytes: int = 2 << 20):
    """Row ranges of ``batch`` whose texts come to about ``max_bytes`` (at least one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // max_bytes
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(sizes)]):
        if b > a:
            yield batch.slice(int(a), int(b - a))
    release()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat array of all words and the number of words of each text (null: none)."""
    texts = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    if empty.any():
        flat = flat.filter(pc.not_equal(flat, ""))
        counts = np.where(empty, 0, counts)
    return flat, counts


def word_codes(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes into the distinct words of the batch."""
    d = flat.dictionary_encode() if len(flat) else pa.array([], pa.string()).dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def segment_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments of the given lengths (0 for empty ones)."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


#: Classes of code points: bit 0 letter, bit 1 upper case, bit 2 digit.
_CLASSES: list = []


def char_classes() -> np.ndarray:
    if not _CLASSES:
        chars = [chr(i) for i in range(0x20000)]
        _CLASSES.append(np.fromiter(((c.isalpha()) | (c.isupper() << 1) | (c.isdigit() << 2) for c in chars),
                                    np.uint8, len(chars)))
    return _CLASSES[0]


def class_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Letters, capitals, digits and code points of each text (null: none)."""
    texts = pc.fill_null(texts, "")
    n = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "")[0].as_py()
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    table = char_classes()
    cls = table[np.minimum(codes, len(table) - 1)]
    return {"chars": n, "letters": segment_sum(cls & 1, n), "capitals": segment_sum((cls >> 1) & 1, n),
            "digits": segment_sum((cls >> 2) & 1, n)}


def hashed_counts(flat: pa.Array, counts: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(features per text, hashed word, occurrences)``: the distinct hashed words of each text."""
    codes, dictionary = word_codes(flat)
    digest = xxhash.xxh32_intdigest
    slot = np.fromiter((digest(w) % dims for w in dictionary.to_pylist()), np.int64, len(dictionary))
    doc = np.repeat(np.arange(len(counts)), counts)
    key, n = np.unique(doc * dims + slot[codes], return_counts=True)
    return np.bincount(key // dims, minlength=len(counts)), key % dims, n
