"""Token ids as Simple-8b words: file images written by tasks, read back vectorised.

A 64-bit word holds a 4-bit selector (top bits) and 60 data bits: as many ids
as fit at the selector's width.  Ids are coded in blocks of ``BLOCK``; the
offset of every block's first word is stored, so all blocks are coded and
decoded side by side.  Values of 60 bits or more are escapes: an all-ones word
stands in their place and the value itself is kept in a list beside the words.

An image is a header, the documents' ids and token counts, block offsets,
words and escapes, little-endian.  Images are rows of a Parquet table in a
shared folder, the only kind of file that Spark commits task by task on any
store; a row is one image.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm.arrowtext import segment_sum, slices, split_words, word_codes
from tastebud.llm.common import join_small, staged
from tastebud.llm.piece_viterbi import ragged

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Words of Latin letters (no combining marks, nor U+0130, which has one in lower case) with ASCII punctuation behind them.
PLAIN_WORD = r"^(?P<stem>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+)(?P<tail>[.,;:!?]*)$"
BLOCK = 1024
#: (ids per word, bits per id) of selectors 0 to 15; width 0: all of them zero.
SELECTORS = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10),
             (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = np.uint64(0xFFFFFFFFFFFFFFFF)
_COUNT = np.array([c for c, _ in SELECTORS])
_WIDTH = np.array([w for _, w in SELECTORS])
_HEAD = struct.Struct("<4sIQQQQQ")
_MAGIC = b"S8BT"


def _bit_length(v: np.ndarray) -> np.ndarray:
    """Bits needed by each value (0 for 0)."""
    low = (v & np.uint64(0xFFFFFFFF)).astype(np.float64)
    out = np.frexp(low)[1].astype(np.int8)  # exact: 32 bits fit in a double
    high = v >> np.uint64(32)
    big = np.flatnonzero(high)
    out[big] = 32 + np.frexp(high[big].astype(np.float64))[1]
    return out


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, first word of each block, escapes)`` of unsigned 64-bit values.

    In every block the selector that takes the most ids is chosen, word after
    word; the last word of a block may be filled up with zeros.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    bits = _bit_length(ids)
    escaped = (bits > 60) | (ids == np.uint64((1 << 60) - 1))
    bits[escaped] = 60
    # widest value of the next c ids, by doubling windows, for every c of a selector
    n_blocks = -(-n // block)
    padded = np.zeros(n_blocks * block, np.int8)
    padded[:n] = bits
    grid = padded.reshape(n_blocks, block)
    choice = np.full(grid.shape, 15, np.int8)
    window, widest = 1, grid.copy()
    spans = {1: grid}
    while window < 240:
        nxt = widest.copy()
        nxt[:, :block - window] = np.maximum(widest[:, :block - window], widest[:, window:])
        window, widest = window * 2, nxt
        spans[window] = widest
    for s in range(15, -1, -1):  # from one id per word to the most
        c, w = SELECTORS[s]
        half = 1 << (c.bit_length() - 1)
        most = spans[half].copy()
        if c > half:
            shift = c - half
            most[:, :block - shift] = np.maximum(most[:, :block - shift], spans[half][:, shift:])
        choice[most <= w] = s
    # all blocks advance together
    at = np.zeros(n_blocks, np.int64)
    size = np.full(n_blocks, block)
    size[-1] = n - (n_blocks - 1) * block
    live = np.arange(n_blocks)
    out_block, out_pos, out_sel = [], [], []
    while len(live):
        s = choice[live, at[live]]
        out_block.append(live)
        out_pos.append(at[live])
        out_sel.append(s)
        at[live] = at[live] + _COUNT[s]
        live = live[at[live] < size[live]]
    blk, pos, sel = (np.concatenate(x) for x in (out_block, out_pos, out_sel))
    order = np.lexsort((pos, blk))
    blk, pos, sel = blk[order], pos[order], sel[order].astype(np.int64)
    words = sel.astype(np.uint64) << np.uint64(60)
    values = np.zeros(n_blocks * block + 240, np.uint64)
    values[:n] = ids
    start = blk * block + pos
    for s in range(2, 16):
        m = np.flatnonzero(sel == s)
        c, w = SELECTORS[s]
        for j in range(c):
            inside = pos[m] + j < size[blk[m]]
            v = np.where(inside, values[start[m] + j], np.uint64(0))
            if s < 15:
                words[m] |= v << np.uint64(w * j)
            else:
                words[m] = np.where(escaped[np.minimum(start[m], n - 1)], ESCAPE, words[m] | (v & np.uint64((1 << 60) - 1)))
    first = np.searchsorted(blk, np.arange(n_blocks)).astype(np.uint32)
    return words, first, ids[escaped]


def unpack(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The values again: every selector's words are opened at once and put at their places."""
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[sel]
    n_blocks = len(first)
    bounds = np.r_[first.astype(np.int64), len(words)]
    blk = np.repeat(np.arange(n_blocks), np.diff(bounds))
    before = np.cumsum(count) - count
    pos = before - before[bounds[:-1]][blk]  # within its block
    size = np.full(n_blocks, block)
    size[-1] = n - (n_blocks - 1) * block
    out = np.zeros(n_blocks * block, np.uint64)
    for s in range(2, 16):
        m = np.flatnonzero(sel == s)
        c, w = SELECTORS[s]
        mask = np.uint64((1 << w) - 1)
        for j in range(c):
            inside = m[pos[m] + j < size[blk[m]]]
            out[blk[inside] * block + pos[inside] + j] = (words[inside] >> np.uint64(w * j)) & mask
    at = np.flatnonzero(words == ESCAPE)
    out[blk[at] * block + pos[at]] = escapes
    return out[:n]


def write_image(doc_ids: np.ndarray, null_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, first, escapes = pack(ids)
    head = _HEAD.pack(_MAGIC, BLOCK, len(counts), len(ids), len(words), len(first), len(escapes))
    body = b"".join(x.tobytes() for x in (doc_ids.astype("<i8"), null_ids.astype("u1"), counts.astype("<u8"),
                                          first.astype("<u4"), words.astype("<u8"), escapes.astype("<u8")))
    return head + body + struct.pack("<I", zlib.crc32(body))


def read_image(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(doc ids, which are null, counts, ids)``; raises if the image is damaged."""
    magic, block, n_docs, n_ids, n_words, n_blocks, n_escapes = _HEAD.unpack_from(image)
    body = memoryview(image)[_HEAD.size:-4]
    if magic != _MAGIC or zlib.crc32(body) != struct.unpack("<I", image[-4:])[0]:
        raise ValueError("not an intact Simple-8b image")
    parts, at = [], 0
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs), ("<u4", n_blocks), ("<u8", n_words), ("<u8", n_escapes)):
        size = np.dtype(kind).itemsize * n
        parts.append(np.frombuffer(body[at:at + size], kind))
        at += size
    doc_ids, null, counts, first, words, escapes = parts
    return doc_ids, null.astype(bool), counts.astype(np.int64), unpack(words, first, escapes, n_ids, block)


class HashedWords:
    """Distinct words with 64-bit hashes of their bytes."""

    MAX_BYTES = 64
    _POWERS = np.cumprod(np.full(MAX_BYTES, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

    def __init__(self, words: pa.Array):
        self.size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "")[0].as_buffer()
        self.data = np.frombuffer(joined, np.uint8)
        self.start = np.cumsum(self.size) - self.size
        place = np.arange(len(self.data)) - np.repeat(self.start, self.size)
        mixed = (self.data.astype(np.uint64) + np.uint64(1)) * self._POWERS[np.minimum(place, self.MAX_BYTES - 1)]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
        h = sums[self.start + self.size] - sums[self.start]
        h ^= h >> np.uint64(29)
        self.hash = h * np.uint64(0xBF58476D1CE4E5B9)
        self.short = self.size <= self.MAX_BYTES


class WordStore:
    """Ids of known words under the hashes of their bytes, with the bytes: flat arrays, no objects, about 45 bytes a word.

    Two words may share a hash; the bytes decide, and the word that came later
    is not kept.
    """

    MAX_WORDS = 1_500_000

    def __init__(self):
        self.key, self.word = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and the word of each
        self.start, self.len, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.text_start, self.size, self.text = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def _hashed(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The word under each hash, and whether there is one."""
        if not len(self.key):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        return self.word[at].astype(np.int64), self.key[at] == h

    def find(self, words: HashedWords) -> np.ndarray:
        """The known word of each word, -1 where there is none."""
        at, hit = self._hashed(words.hash)
        out = np.full(len(at), -1, np.int64)
        if not hit.any():
            return out
        some = np.flatnonzero(hit & words.short)
        some = some[self.size[at[some]] == words.size[some]]
        size = words.size[some]
        other = words.data[ragged(words.start[some], size)] != self.text[ragged(self.text_start[at[some]], size)]
        some = some[segment_sum(other.astype(np.int64), size) == 0]
        out[some] = at[some]
        return out

    def add(self, words: HashedWords, which: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> None:
        """Keep the words ``which`` with their ids, ``lens`` of them each, where their hash is free."""
        if len(self.key) + len(which) > self.MAX_WORDS:
            self.__init__()
        _, first = np.unique(words.hash[which], return_index=True)
        first = first[words.short[which[first]]]
        first = np.sort(first[~self._hashed(words.hash[which[first]])[1]])
        keep = np.zeros(len(which), bool)
        keep[first] = True
        ids, lens, which = ids[np.repeat(keep, lens)], lens[keep], which[keep]
        n, size = len(self.len), words.size[which]
        self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(lens) - lens))
        self.text_start = np.concatenate((self.text_start, len(self.text) + np.cumsum(size) - size))
        self.len, self.size = np.concatenate((self.len, lens.astype(np.int32))), np.concatenate((self.size, size))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.text = np.concatenate((self.text, words.data[ragged(words.start[which], size)]))
        order = np.argsort(words.hash[which])
        at = np.searchsorted(self.key, words.hash[which][order])
        self.key = np.insert(self.key, at, words.hash[which][order])
        self.word = np.insert(self.word, at, (n + order).astype(np.int32))


class WordTokenizer:
    """Ids of whole texts; a distinct run of non-white-space is given to the library once and then remembered.

    The tokenizer never joins characters across white space (it drops it), so
    the ids of a text are those of its words in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok, self.store = Tokenizer.from_file(path), WordStore()

    def _library(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words and their numbers, by the library.

        Words are handed over 1000 at a time with a special token between them,
        which the library cuts out before anything else, so each word is
        encoded by itself; words that hold such a token go one by one.
        """
        special = [(i, t.content) for i, t in self.tok.get_added_tokens_decoder().items() if t.special]
        odd = np.zeros(len(words), bool)
        for _, content in special:
            odd |= pc.match_substring(words, content).to_numpy(zero_copy_only=False)
        if not special:
            odd[:] = True
        lens = np.zeros(len(words), np.int64)
        whole = words.filter(pa.array(~odd)).to_pylist()
        ids = np.zeros(0, np.int32)
        if whole:
            mark, content = special[0]
            texts = [content.join(whole[i:i + 1000]) for i in range(0, len(whole), 1000)]
            got = [np.array([*e.ids, mark], np.int32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            got = np.concatenate(got)
            ends = np.flatnonzero(got == mark)
            lens[~odd] = np.diff(np.r_[-1, ends]) - 1
            ids = got[got != mark]
        for i in np.flatnonzero(odd):
            one = self.tok.encode(words[int(i)].as_py(), add_special_tokens=False).ids
            at = int(lens[:i].sum())
            ids, lens[i] = np.insert(ids, at, one), len(one)
        return ids.astype(np.int32), lens

    def _new_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of unremembered words and their numbers.

        Latin letters and the ASCII punctuation behind them are words of their
        own to the tokenizer, which also lower-cases them, so such a word is
        its lower-case letters, most often remembered, and its punctuation.
        """
        parts = pc.extract_regex(words, PLAIN_WORD)
        plain = pc.is_valid(parts)
        stem = pc.if_else(plain, pc.ascii_lower(pc.struct_field(parts, "stem")), words)
        tail = pc.if_else(plain, pc.struct_field(parts, "tail"), "")
        both = pa.concat_arrays([stem, tail])
        codes, distinct = word_codes(both)
        hashed = HashedWords(distinct)
        at = self.store.find(hashed)
        new = np.flatnonzero(at < 0)
        ids, lens = self._library(distinct.take(pa.array(new)))
        start, size = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        known = at >= 0
        start[known], size[known] = self.store.start[at[known]], self.store.len[at[known]]
        start[new], size[new] = len(self.store.ids) + np.cumsum(lens) - lens, lens
        pool = np.concatenate((self.store.ids, ids))
        self.store.add(hashed, new, ids, lens)
        order = codes.reshape(2, -1).T.ravel()  # letters, punctuation, letters, ...
        return pool[ragged(start[order], size[order])], size[codes].reshape(2, -1).sum(axis=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, number of ids of each)``."""
        flat, counts = split_words(texts)
        if not len(flat):
            return np.zeros(0, np.int64), np.zeros(len(counts), np.int64)
        codes, words = word_codes(flat)
        hashed = HashedWords(words)
        at = self.store.find(hashed)
        new, known = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        # the words' ids: the remembered ones, then the new ones
        size = np.empty(len(words), np.int64)
        size[known] = self.store.len[at[known]]
        old = self.store.ids[ragged(self.store.start[at[known]], size[known])]
        ids, size[new] = self._new_words(words.take(pa.array(new)))
        start = np.empty(len(words), np.int64)
        start[known] = np.cumsum(size[known]) - size[known]
        start[new] = len(old) + np.cumsum(size[new]) - size[new]
        per_word = size[codes]
        out = np.concatenate((old, ids))[ragged(start[codes], per_word)]
        self.store.add(hashed, new, ids, size[new])
        return out, segment_sum(per_word, counts)


#: One tokenizer with what it remembers per file and worker process, as a worker runs many tasks.
_TOKENIZERS: dict[str, WordTokenizer] = {}


def worker_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def write_token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                      end_id: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Write all documents' ids in ascending ``doc_id`` order; returns the table of images.

    Columns: ``part`` (ascending ranges of ids), ``seq`` (image within the
    part), ``part_start`` (ids before it in the part), ``n_docs, n_ids,
    image``.  ``path`` names the tokenizer file, which every executor has at
    the same place (the default is the installed package's).  Null ids come
    first; rows with equal ids are ordered by their text's hash.
    """
    spark = docs.sparkSession
    tokenizer = path or tokenizer_path()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.octet_length("text").asc()]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = src.repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def run(batches):
        tok, seq, start = worker_tokenizer(tokenizer), 0, 0
        part_no = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                ids, counts = tok.encode(part.column("text"))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                d = part.column("doc_id")
                image = write_image(d.fill_null(0).to_numpy(zero_copy_only=False),
                                    d.is_null().to_numpy(zero_copy_only=False), counts + 1, ids)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part_no], pa.int32()), "seq": pa.array([seq], pa.int64()),
                    "part_start": pa.array([start], pa.int64()), "n_docs": pa.array([len(part)], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()), "image": pa.array([image], pa.binary())})
                seq, start = seq + 1, start + len(ids)

    schema = "part int, seq long, part_start long, n_docs long, n_ids long, image binary"
    return staged(src.mapInArrow(run, schema), "tokens")


def read_token_files(images: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, decoded from the images.

    ``start`` counts the ids of all documents before it: the totals of the
    parts (one row each) are summed up in order and added to the position
    within the part.
    """
    totals = images.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = staged(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "tokenbase")

    def run(batches):
        for batch in batches:
            for part, start, image in zip(*(batch.column(c).to_pylist() for c in ("part", "part_start", "image"))):
                doc_ids, null, counts, ids = read_image(image)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(counts), part, np.int32)), "doc_id": pa.array(doc_ids, mask=null),
                    "at": pa.array(start + ends - counts), "n_tokens": pa.array(counts),
                    "ids": pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)),
                                                    pa.array(ids.astype(np.int64)))})

    rows = images.select("part", "part_start", "image").mapInArrow(
        run, T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("at", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.LongType()))]))
    out = join_small(rows, base, ["part"], "inner")
    return out.select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids")


def id_checksums(decoded: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: unsigned CRC-32 of the ids as little-endian 32-bit integers."""
    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = np.fromiter((zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])), np.int64, len(lists))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "start", "n_tokens")] + [pa.array(crc)],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return decoded.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
