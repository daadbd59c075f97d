"""SentencePiece encoding and decoding by batched merges or a batched Viterbi in numpy.

A text gets one space in front and spaces play the part of the word mark.  No
piece crosses from a word into the next run of spaces, so a text is cut into
units (spaces and the word after them) and the best segmentation of a text is
that of its units.  Distinct units of the same length are one matrix of code
points and advance together: rolling substring hashes of every length probe
the sorted hashes of the pieces of that length.  What follows depends on the
kind of the model.  The scores of a BPE model are minus the rank of a merge, so
their sum means nothing: the units' best adjacent pairs are merged step by step
(the highest score, then the leftmost), as the library does.  The scores of a
unigram model are log-probabilities: for each end position the maximum over the
piece lengths gives the best score and the backpointer.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm.arrowtext import segment_sum, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNIT = re.compile(" +[^ ]*")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Distinct units remembered by a worker before it starts anew, and the longest one remembered.
CACHE_UNITS, CACHE_CHARS = 300_000, 64
#: Matrix cells (units times length) advanced at once.
MAX_CELLS = 1 << 17
#: Longer units are merged one by one with a heap, as the batched merges look at the whole unit for each of them.
MAX_MERGED_TOGETHER = 128


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``starts[i] .. starts[i] + lens[i]``."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class PieceTable:
    """Piece keys by length (sorted), their ids and scores, byte pieces, and the bytes of every id."""

    keys: dict[int, np.ndarray]
    ids: dict[int, np.ndarray]
    points: dict[int, np.ndarray]
    scores: np.ndarray
    byte_ids: np.ndarray
    unk_id: int
    unk_score: float
    raw: np.ndarray
    raw_start: np.ndarray
    raw_len: np.ndarray
    bpe: bool

    def cache(self, merge: bool) -> dict[str, bytes]:
        """Ids (32-bit, as bytes) of units that this worker process has met, whatever its task."""
        return _CACHES.setdefault((len(self.scores), float(self.scores.sum()), self.unk_id, merge), {})

    def by_text(self) -> dict[str, int]:
        """Ids of the pieces by their text."""
        key = len(self.scores), float(self.scores.sum()), self.unk_id
        if key not in _PIECES:
            _PIECES[key] = {"".join(map(chr, row)): i for k in self.points
                            for row, i in zip(self.points[k].tolist(), self.ids[k].tolist())}
        return _PIECES[key]


_CACHES: dict[tuple, dict[str, bytes]] = {}
_PIECES: dict[tuple, dict[str, int]] = {}


def load_pieces(path: str | None = None) -> PieceTable:
    """Read a model file with the sentencepiece library (pieces, scores, kinds)."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    sp = sentencepiece.SentencePieceProcessor(model_file=path or model_path())
    spec = pb.ModelProto.FromString(sp.serialized_model_proto()).trainer_spec
    n = sp.vocab_size()
    scores = np.array([sp.get_score(i) for i in range(n)])
    byte_ids, text, raw = np.full(256, -1, np.int64), {}, []
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            raw.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            raw.append(b"" if sp.is_control(i) else " ⁇ ".encode())
        else:
            shown = piece.replace(MARK, " ")
            text[shown] = i
            raw.append(shown.encode())
    keys, ids, points = {}, {}, {}
    for length in sorted({len(t) for t in text}):
        some = [t for t in text if len(t) == length]
        codes = np.array([[ord(c) for c in t] for t in some], np.uint32)
        h = np.zeros(len(some), np.uint64)
        for j in range(length):
            h = h * _BASE + codes[:, j]
        order = np.argsort(h)
        if len(np.unique(h)) != len(h):
            raise ValueError("two pieces of one length share a hash")
        keys[length], ids[length] = h[order], np.array([text[t] for t in some])[order]
        points[length] = codes[order]
    lens = np.array([len(r) for r in raw])
    normal = scores[list(text.values())]
    return PieceTable(keys, ids, points, scores, byte_ids, sp.unk_id(), float(normal[normal > -1e8].min()) - 10,
                      np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lens) - lens, lens,
                      spec.model_type == pb.TrainerSpec.BPE)


def probe(codes: np.ndarray, t: PieceTable) -> dict[int, np.ndarray]:
    """By piece length, the id of the piece (-1: none) at every start of units of one length, ``codes`` (units x length)."""
    n, length = codes.shape
    usable = [k for k in t.keys if k <= length]
    found = {k: np.full((n, length - k + 1), -1, np.int32) for k in usable}
    h = np.zeros((n, length), np.uint64)
    for k in range(1, max(usable, default=0) + 1):
        h = h[:, : length - k + 1] * _BASE + codes[:, k - 1:]
        if k not in found:
            continue
        keys = t.keys[k]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        r, c = np.nonzero(keys[at] == h)
        if len(r):
            p = at[r, c]
            same = (codes[r[:, None], c[:, None] + np.arange(k)] == t.points[k][p]).all(axis=1)
            found[k][r[same], c[same]] = t.ids[k][p[same]]
    return found


def merges(codes: np.ndarray, t: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Segmentations by rank of units of one length, ``codes`` (units x length).

    Every unit merges its best adjacent pair (the leftmost of equal ones) until
    no pair is a piece.  Returns whether a symbol starts at a position and the
    id of its piece (-1: the unknown character).
    """
    n, length = codes.shape
    found = probe(codes, t)
    ids = np.full((n, length, max(found, default=1) + 1), -1, np.int32)
    for k, x in found.items():
        ids[:, : length - k + 1, k] = x
    widest = ids.shape[2] - 1
    scores = np.append(t.scores, -np.inf).astype(np.float32)  # id -1: not a piece

    def pair(rows, start, end):
        size = end - start
        return np.where(size <= widest, scores[ids[rows, start, np.minimum(size, widest)]], -np.inf)

    after = np.tile(np.arange(1, length + 1, dtype=np.int32), (n, 1))  # where the symbol at a start ends
    before = np.tile(np.arange(-1, length, dtype=np.int32), (n, 1))  # where the one in front of a start starts
    starts = np.ones((n, length), bool)
    gain = np.full((n, length), -np.inf, np.float32)
    if length > 1 and widest > 1:
        gain[:, :-1] = scores[ids[:, :-1, 2]]
    live = np.arange(n)
    while len(live):
        at = gain[live].argmax(axis=1)  # the leftmost of equal scores
        more = gain[live, at] > -np.inf
        live, at = live[more], at[more]
        mid = after[live, at]
        end = after[live, mid]
        starts[live, mid] = False
        gain[live, mid] = -np.inf
        after[live, at] = end
        before[live, end] = at
        last = end == length
        gain[live, at] = np.where(last, -np.inf, pair(live, at, after[live, np.minimum(end, length - 1)]))
        left = before[live, at]
        r = left >= 0
        gain[live[r], left[r]] = pair(live[r], left[r], end[r])
    r, c = np.nonzero(starts)
    out = np.full((n, length), -1, np.int32)
    size = after[r, c] - c
    out[r, c] = ids[r, c, np.minimum(size, widest)]
    return starts, out


def merge_long(unit: str, t: PieceTable) -> list[tuple[int, int]]:
    """As :func:`merges` for one unit, in time ``n log n``: ``(start, id)`` of every symbol."""
    pieces, n = t.by_text(), len(unit)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    heap: list[tuple[float, int, int, int]] = []

    def offer(start: int, mid: int, end: int) -> None:
        i = pieces.get(unit[start:end])
        if i is not None:
            heapq.heappush(heap, (-float(t.scores[i]), start, mid, end))

    for i in range(n - 1):
        offer(i, i + 1, i + 2)
    gone = bytearray(n)
    while heap:
        _, start, mid, end = heapq.heappop(heap)
        if gone[start] or after[start] != mid or after[mid] != end:
            continue  # one of the two has been merged
        gone[mid] = 1
        after[start], before[end] = end, start
        if end < n:
            offer(start, end, after[end])
        if before[start] >= 0:
            offer(before[start], start, end)
    return [(i, pieces.get(unit[i:after[i]], -1)) for i in range(n) if not gone[i]]


def viterbi(codes: np.ndarray, t: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Best segmentations of units of one length, ``codes`` (units x length).

    Returns for every end position the chosen piece's length and id (-1: the
    unknown character).  Of equal scores the longest piece is chosen.
    """
    n, length = codes.shape
    found = probe(codes, t)
    usable = list(found)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    back_len, back_id = np.ones((n, length + 1), np.int32), np.full((n, length + 1), -1, np.int32)
    scores = np.append(t.scores, -np.inf)  # id -1: not a piece
    rows = np.arange(n)
    for e in range(1, length + 1):
        ks = [k for k in reversed(usable) if k <= e]
        ids = np.stack([found[k][:, e - k] for k in ks] + [np.full(n, -1, np.int32)], axis=1)
        gain = scores[ids]
        gain[:, -1] = np.where(ids[:, -2] >= 0, -np.inf, t.unk_score) if ks and ks[-1] == 1 else t.unk_score
        total = best[:, [e - k for k in ks] + [e - 1]] + gain
        pick = total.argmax(axis=1)
        best[:, e] = total[rows, pick]
        back_len[:, e] = np.array([*ks, 1])[pick]
        back_id[:, e] = ids[rows, pick]
    return back_len, back_id


def _unknown(char: str, t: PieceTable) -> list[int]:
    """A character without a piece: its bytes."""
    got = [int(t.byte_ids[b]) for b in char.encode("utf-8", "surrogatepass")]
    return got if min(got) >= 0 else [t.unk_id]


def encode_units(units: list[str], t: PieceTable, merge: bool = False) -> list[bytes]:
    """Ids of every unit (32-bit, as bytes) by Viterbi or by merges; equal-length units advance together."""
    out: list = [None] * len(units)
    by_len: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        if merge and len(u) > MAX_MERGED_TOGETHER:
            chain = [y for a, x in merge_long(u, t) for y in ([x] if x >= 0 else _unknown(u[a], t))]
            out[i] = np.array(chain, np.int32).tobytes()
        else:
            by_len.setdefault(len(u), []).append(i)
    for length, members in by_len.items():
        step = max(1, MAX_CELLS // max(1, length))
        for a in range(0, len(members), step):
            some = members[a:a + step]
            codes = np.frombuffer("".join(units[i] for i in some).encode("utf-32-le", "surrogatepass"),
                                  np.uint32).reshape(len(some), length)
            if merge:
                starts, ids = merges(codes, t)
                flat, ends = ids[starts], np.cumsum(starts.sum(axis=1))
                odd = set(np.flatnonzero((starts & (ids < 0)).any(axis=1)).tolist())
                for u, (i, e0, e1) in enumerate(zip(some, [0, *ends.tolist()], ends.tolist())):
                    if u in odd:
                        where = np.flatnonzero(starts[u]).tolist()
                        chain = [y for a, x in zip(where, flat[e0:e1].tolist())
                                 for y in ([x] if x >= 0 else _unknown(chr(codes[u, a]), t))]
                        out[i] = np.array(chain, np.int32).tobytes()
                    else:
                        out[i] = flat[e0:e1].tobytes()
                continue
            back_len, back_id = viterbi(codes, t)
            pos = np.full(len(some), length)
            steps = []  # all units walk back together
            while (pos > 0).any():
                live = np.flatnonzero(pos > 0)
                steps.append((live, pos[live], back_id[live, pos[live]]))
                pos[live] -= back_len[live, pos[live]]
            chains: list[list[int]] = [[] for _ in some]
            for live, end, ids in reversed(steps):
                for u, e, i in zip(live.tolist(), end.tolist(), ids.tolist()):
                    if i >= 0:
                        chains[u].append(i)
                    else:
                        chains[u].extend(_unknown(chr(codes[u, e - 1]), t))
            for i, chain in zip(some, chains):
                out[i] = np.array(chain, np.int32).tobytes()
    return out


def encode_texts(texts: pa.Array, t: PieceTable, merge: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(ids of all texts, number of ids of each)``, by Viterbi or by merges; null and empty texts have none."""
    lists = [UNIT.findall(" " + x) if x else [] for x in texts.to_pylist()]
    n_units = np.fromiter(map(len, lists), np.int64, len(lists))
    d = pa.array([u for x in lists for u in x], pa.string()).dictionary_encode()
    codes = d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    units = d.dictionary.to_pylist()
    cache = t.cache(merge)
    if len(cache) > CACHE_UNITS:
        cache.clear()
    ids = [cache.get(u) for u in units]
    new = [i for i, x in enumerate(ids) if x is None]
    for i, x in zip(new, encode_units([units[i] for i in new], t, merge)):
        ids[i] = x
        if len(units[i]) <= CACHE_CHARS:
            cache[units[i]] = x
    lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    store = np.frombuffer(b"".join(ids), np.int32)
    start = np.cumsum(lens) - lens
    per_unit = lens[codes]
    return store[ragged(start[codes], per_unit)], segment_sum(per_unit, n_units)


def decode_ids(ids: np.ndarray, counts: np.ndarray, t: PieceTable) -> pa.Array:
    """Texts of id sequences; the space in front is taken off and bytes that are no UTF-8 become U+FFFD."""
    lens = t.raw_len[ids]
    data = t.raw[ragged(t.raw_start[ids], lens)]
    size = segment_sum(lens, counts)
    ends = np.cumsum(size)
    starts = ends - size
    lead = np.zeros(len(counts), np.int64)
    some = size > 0
    lead[some] = data[starts[some]] == 0x20
    body = data[ragged(starts + lead, size - lead)]
    offsets = np.r_[0, np.cumsum(size - lead)]
    whole = body.tobytes()
    try:
        whole.decode()
        return pa.Array.from_buffers(pa.string(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)),
                                                                pa.py_buffer(whole)])
    except UnicodeDecodeError:
        return pa.array([whole[a:b].decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def encode_documents(docs: DataFrame, table: PieceTable, id_col: str = "doc_id", text_col: str = "text",
                     carry: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row (``carry``: also ``text``).

    The ids of a BPE model are those of its merges, the ids that the library
    gives; those of another model maximise the sum of scores.  Null and empty
    texts have no ids.  A character that no piece covers is
    encoded as its UTF-8 bytes, so every text decodes to itself (a literal
    word mark, U+2581, is such a character; the library reads it as a space).  The piece table travels with the
    function: it has the size of the vocabulary.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = encode_texts(part.column("text"), table, table.bpe)
                ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                cols = [part.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(ends, pa.array(ids))]
                yield pa.RecordBatch.from_arrays(cols + ([part.column("text")] if carry else []),
                                                 names=["doc_id", "n_tokens", "ids"] + (["text"] if carry else []))

    schema = T.StructType([src.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           *([src.schema["text"]] if carry else [])])
    return src.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, table: PieceTable, carry: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``decoded``, the text of each row's ``ids`` (null ids: empty text)."""
    keep = list(carry)

    def run(batches):
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), [])
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), decode_ids(ids, counts, table)],
                                             names=[*keep, "decoded"])

    schema = T.StructType([*(encoded.schema[c] for c in keep), T.StructField("decoded", T.StringType())])
    return encoded.select(*keep, "ids").mapInArrow(run, schema)
