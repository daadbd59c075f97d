"""Byte-level BPE: encoding by ranks with segment trees, and decoding.

A text is cut by the tokenizer's pattern; the cuts of a whole batch come from
the classes of its characters.  The distinct pieces of a batch are merged side
by side: every piece has a segment tree over its byte positions whose nodes hold
the leftmost minimum pair rank of their range.  The root names the next merge;
a merge changes the pair at its own place, at its left neighbour and at the
token it swallows, each a point update of logarithmic cost.  Long pieces use the
same tree one by one.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm.arrowtext import slices
from tastebud.llm.piece_viterbi import ragged

RANKS = "byte_bpe_50k.tiktoken"
#: The pattern whose matches are encoded apart; :func:`piece_starts` finds its cuts by character classes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTER, NUMBER, OTHER, SPACE = range(4)
#: Longest piece (bytes) that is merged side by side with others; pieces merged at once.
MAX_TOGETHER, MAX_ROWS = 64, 1 << 16
NONE = np.int32(0x7FFFFFFF)


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


class Pairs:
    """The rank that two ranks merge into, for every pair that does: ``first * n + second`` to rank, in probed slots."""

    def __init__(self, n: int, ranks: dict[int, int]):
        self.n, self.ranks = n, ranks
        self._bits = max(4, (4 * len(ranks)).bit_length())
        self._key = self._rank = None

    def __getstate__(self):
        return {**self.__dict__, "_key": None, "_rank": None}

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _build(self) -> None:
        key, rank = np.full(1 << self._bits, -1, np.int64), np.full(1 << self._bits, NONE, np.int32)
        todo = np.fromiter(self.ranks, np.int64, len(self.ranks))
        value = np.fromiter(self.ranks.values(), np.int32, len(self.ranks))
        slot = self._slot(todo)
        while len(todo):
            free = np.flatnonzero(key[slot] < 0)
            key[slot[free]], rank[slot[free]] = todo[free], value[free]  # of several the last stays
            rest = key[slot] != todo
            todo, value, slot = todo[rest], value[rest], (slot[rest] + 1) & len(key) - 1
        # equal slots were written in the same order twice, so a key has its own rank
        self._key, self._rank = key, rank

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that ``a`` and ``b`` merge into (``NONE``: they do not)."""
        if self._key is None:
            self._build()
        key = a.astype(np.int64) * self.n + b
        slot = self._slot(key)
        there = self._key[slot]
        out = np.where(there == key, self._rank[slot], NONE)
        more = np.flatnonzero((there != key) & (there >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & len(self._key) - 1
            there = self._key[slot[more]]
            hit = there == key[more]
            out[more[hit]] = self._rank[slot[more[hit]]]
            more = more[~hit & (there >= 0)]
        return out


@dataclass
class ByteTable:
    """Tokens by rank, the merges, the ranks of the bytes, and the classes of all characters as runs."""

    tokens: pa.Array
    pairs: Pairs
    byte_rank: np.ndarray
    class_starts: np.ndarray
    classes: np.ndarray

    def __post_init__(self):
        self._class_of = None

    def __getstate__(self):
        return {**self.__dict__, "_class_of": None}

    @property
    def class_of(self) -> np.ndarray:
        """Class of every code point."""
        if self._class_of is None:
            self._class_of = np.repeat(self.classes, np.diff(np.r_[self.class_starts, 0x110000]))
        return self._class_of


def character_classes() -> tuple[np.ndarray, np.ndarray]:
    """``(first code points, class)`` of the runs of letters, numbers, white space and the rest, as the library has them."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    chars = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    cls = np.full(0x110000, OTHER, np.uint8)
    for kind, pat in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        one = tiktoken.Encoding(f"class{kind}", pat_str=pat, mergeable_ranks=single, special_tokens={})
        found = bytes(one.encode_ordinary(chars)).decode()  # only what the pattern matches is encoded
        cls[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    starts = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
    return starts, cls[starts]


def load_ranks(path: str | None = None) -> ByteTable:
    """Read a rank file: a line per token, its bytes in base 64 and its rank."""
    with open(path or ranks_path(), "rb") as f:
        rank = {base64.b64decode(tok): int(r) for tok, r in map(bytes.split, f.read().splitlines())}
    tokens = sorted(rank, key=rank.get)
    if [rank[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks are not 0 to n - 1")
    pairs = {rank[t[:k]] * len(tokens) + rank[t[k:]]: r for t, r in rank.items() for k in range(1, len(t))
             if t[:k] in rank and t[k:] in rank}
    return ByteTable(pa.array(tokens, pa.binary()), Pairs(len(tokens), pairs),
                     np.array([rank[bytes([i])] for i in range(256)], np.int32), *character_classes())


def piece_starts(data: np.ndarray, text_starts: np.ndarray, t: ByteTable) -> np.ndarray:
    """First bytes of all matches of the pattern in texts that lie end to end in ``data`` (UTF-8)."""
    if not len(data):
        return np.zeros(0, np.int64)
    char_at = np.flatnonzero((data & 0xC0) != 0x80)  # every character's first byte
    first = data[char_at]
    point = first.astype(np.int32)
    width = np.diff(np.r_[char_at, len(data)])
    for w, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
        some = np.flatnonzero(width == w)
        code = first[some].astype(np.int32) & mask
        for j in range(1, w):
            code = code << 6 | data[char_at[some] + j] & 0x3F
        point[some] = code
    cls = t.class_of[point]
    n = len(point)
    opens = np.zeros(n + 1, bool)  # a text starts here
    opens[np.searchsorted(char_at, text_starts)] = True
    opens[n] = True
    run = opens[:n].copy()
    run[1:] |= cls[1:] != cls[:-1]
    start = np.r_[run, True, True, True]
    # the last white space before anything else stands apart, or in front of the next run if it is a space
    after = np.flatnonzero(run & ~opens[:n] & (cls != SPACE))
    after = after[cls[after - 1] == SPACE]
    start[after - 1] = True
    start[after[point[after - 1] == 0x20]] = False
    # an apostrophe at the start of a match, with the letters of a contraction behind it in the same text
    mark = np.flatnonzero((point == 0x27) & start[:n])
    code = np.r_[point, -1, -1, -1]
    shut = np.r_[opens, True, True]
    one, two = code[mark + 1], code[mark + 2]
    near = ~shut[mark + 1]
    short = near & np.isin(one, [ord(c) for c in "stmd"])
    long = near & ~shut[mark + 2] & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
                                     | (one == ord("l")) & (two == ord("l")))
    start[mark[short] + 1], start[mark[short] + 2] = False, True
    start[mark[long] + 1], start[mark[long] + 2], start[mark[long] + 3] = False, False, True
    return char_at[start[:n]]


def merge_together(token: np.ndarray, lens: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Merge many pieces, ``token`` (pieces x width, the width a power of two) of the ranks they begin with, and their lengths.

    Returns the token at every position (``token`` itself) and whether one starts there.
    """
    n, width = token.shape
    inside = np.arange(width) < lens[:, None]
    live_start = inside.copy()
    after = np.minimum(np.arange(1, width + 1), lens[:, None]).astype(np.int32)  # where the next token starts
    before = np.tile(np.arange(-1, width - 1, dtype=np.int32), (n, 1))
    shift = np.int64(width.bit_length())

    def key(rank, place):  # orders by rank, then from the left
        return np.where(rank == NONE, np.int64(1) << 62, (rank.astype(np.int64) << shift) | place)

    tree = np.full((n, 2 * width), np.int64(1) << 62)
    if width > 1:
        row, col = np.nonzero(inside[:, 1:])
        tree[row, width + col] = key(pairs.of(token[row, col], token[row, col + 1]), col)
        for i in range(width - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
    flat, span = tree.reshape(-1), 2 * width

    def update(piece, place, value):
        base, node = piece * span, place + width
        flat[base + node] = value
        while len(node) and width > 1 and node[0] > 1:  # all nodes are on one level
            node = node >> 1
            at = base + node
            flat[at] = np.minimum(flat[at + node], flat[at + node + 1])

    live = np.arange(n)
    while len(live):
        top = tree[live, 1]
        some = top < np.int64(1) << 62
        live, top = live[some], top[some]
        at = (top & ((np.int64(1) << shift) - 1)).astype(np.int64)
        gone = after[live, at].astype(np.int64)
        end = after[live, gone].astype(np.int64)
        token[live, at] = top >> shift
        live_start[live, gone] = False
        after[live, at] = end
        more = end < lens[live]
        follow = np.minimum(end, width - 1)
        before[live[more], end[more]] = at[more]
        rank = np.where(more, pairs.of(token[live, at], token[live, follow]), NONE)
        update(live, gone, np.int64(1) << 62)
        update(live, at, key(rank, at))
        left = before[live, at].astype(np.int64)
        r = left >= 0
        rank = pairs.of(token[live[r], left[r]], token[live[r], at[r]])
        update(live[r], left[r], key(rank, left[r]))
    return token, live_start


def merge_long(piece: bytes, t: ByteTable) -> list[int]:
    """As :func:`merge_together` for one piece of any length, in time ``n log n``."""
    n = len(piece)
    rank, pairs, v = t.byte_rank.tolist(), t.pairs.ranks, t.pairs.n
    token = [rank[c] for c in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    width, none = 1 << max(1, (n - 1).bit_length()), (1 << 62, 0)
    tree = [none] * (2 * width)

    def pair(i: int):
        j = after[i]
        r = pairs.get(token[i] * v + token[j]) if j < n else None
        return none if r is None else (r, i)

    def update(i: int, value) -> None:
        i += width
        tree[i] = value
        while i > 1:
            i >>= 1
            best = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == best:
                return
            tree[i] = best

    for i in range(n):
        tree[width + i] = pair(i)
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    while tree[1] is not none and tree[1] != none:
        r, i = tree[1]
        gone = after[i]
        token[i], after[i] = r, after[gone]
        token[gone] = -1
        if after[i] < n:
            before[after[i]] = i
        update(gone, none)
        update(i, pair(i))
        if before[i] >= 0:
            update(before[i], pair(before[i]))
    return [x for x in token if x >= 0]


def merge_pieces(first: np.ndarray, start: np.ndarray, size: np.ndarray, pairs: Pairs):
    """Merge pieces of at most ``MAX_TOGETHER`` ranks, ``size[i]`` ranks from ``first[start[i]]`` on.

    Yields the pieces of one width at a time with their numbers of tokens and all their tokens in a row.
    """
    level = np.maximum(1, np.frexp(np.maximum(size - 1, 0).astype(np.float64))[1])  # the width is 2 ** level
    for k in np.unique(level):
        same = np.flatnonzero(level == k)
        for a in range(0, len(same), MAX_ROWS):
            some = same[a:a + MAX_ROWS]
            token = first[np.minimum(start[some][:, None] + np.arange(1 << k), len(first) - 1)]
            token, begins = merge_together(token, size[some], pairs)
            yield some, begins.sum(axis=1), token[begins]


def gathered(n: int, parts: list) -> tuple[np.ndarray, np.ndarray]:
    """``(all ids in the order of the pieces, number of ids of each)`` of ``(pieces, numbers of ids, ids)``."""
    lens = np.zeros(n, np.int64)
    for some, count, _ in parts:
        lens[some] = count
    begin = np.cumsum(lens) - lens
    out = np.empty(int(lens.sum()), np.int32)
    for some, count, ids in parts:
        out[ragged(begin[some], lens[some])] = ids
    return out, lens


def encode_pieces(pieces: pa.Array, t: ByteTable) -> tuple[np.ndarray, np.ndarray]:
    """``(ids of all pieces, number of ids of each)``; a piece that is a token is that token."""
    whole = pc.index_in(pieces, value_set=t.tokens).fill_null(-1).to_numpy(zero_copy_only=False)
    size = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets, data = flat_bytes(pieces)
    known = np.flatnonzero(whole >= 0)
    parts: list[tuple] = [(known, 1, whole[known])]
    todo = np.flatnonzero((whole < 0) & (size <= MAX_TOGETHER))
    for some, count, ids in merge_pieces(t.byte_rank[data], offsets[todo], size[todo], t.pairs):
        parts.append((todo[some], count, ids))
    for i in np.flatnonzero((whole < 0) & (size > MAX_TOGETHER)):
        ids = merge_long(data[offsets[i]:offsets[i + 1]].tobytes(), t)
        parts.append((np.array([i]), len(ids), np.array(ids, np.int64)))
    return gathered(len(pieces), parts)


def flat_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary or string array without nulls; the offsets start at 0."""
    if not len(values):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset).astype(np.int64)
    if offsets[-1] == offsets[0]:
        return np.zeros(len(values) + 1, np.int64), np.zeros(0, np.uint8)
    return offsets - offsets[0], np.frombuffer(values.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]


def gather_texts(starts: np.ndarray, data: np.ndarray, offsets: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
    """``(ids of all texts, number of ids of each)``: the pieces that start at ``starts`` are encoded once each by ``encode``."""
    bounds = np.r_[starts, len(data)].astype(np.int32)
    d = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
    code = d.indices.to_numpy(zero_copy_only=False)
    ids, lens = encode(d.dictionary)
    begin = (np.cumsum(lens) - lens)[code]
    per_piece = lens[code]
    upto = np.r_[0, np.cumsum(per_piece)][np.searchsorted(starts, offsets)]
    return ids[ragged(begin, per_piece)], np.diff(upto)


def encode_texts(texts: pa.Array, t: ByteTable) -> tuple[np.ndarray, np.ndarray]:
    """``(ids of all texts, number of ids of each)``; null and empty texts have none."""
    offsets, data = flat_bytes(pc.fill_null(texts, ""))
    starts = piece_starts(data, offsets[:-1][np.diff(offsets) > 0], t)
    return gather_texts(starts, data, offsets, lambda pieces: encode_pieces(pieces, t))


def encode_documents(docs: DataFrame, table: ByteTable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row: the ranks of its text's tokens.

    Null and empty texts have no ids.  Rows that repeat a text or an id are rows
    of their own with the same ids, columns of any other name are left out (two
    named like the outputs do not clash), an empty table gives no rows, and a
    text of any length is encoded whole: one long match costs ``n log n``, and
    of equal ranks the leftmost pair is merged first.  Strings of special tokens
    are ordinary text.  The table travels with the function: it has the size of
    the vocabulary.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                ids, counts = encode_texts(part.column("text"), table)
                ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts),
                                                  pa.ListArray.from_arrays(ends, pa.array(ids))],
                                                 names=["doc_id", "n_tokens", "ids"])

    schema = T.StructType([src.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return src.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, table: ByteTable, carry: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``decoded``, the bytes of each row's ``ids`` (null ids: no bytes).

    Ids may cut a character in two, so the result is bytes.
    """
    keep = list(carry)

    def run(batches):
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), [])
            raw = table.tokens.take(lists.flatten())
            first = lists.offsets.to_numpy()
            ends = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1)[first - first[0]]
            whole = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), raw.buffers()[2]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), whole], names=[*keep, "decoded"])

    schema = T.StructType([*(encoded.schema[c] for c in keep), T.StructField("decoded", T.BinaryType())])
    return encoded.select(*keep, "ids").mapInArrow(run, schema)
