"""Alignment of two tokenizers over a corpus: which ids of one meet which ids of the other.

The tokens of both cut the same bytes.  Offsets where both end cut a text into
groups; every offset where either ends is one link, of the two tokens that hold
the byte before it.  Most groups are one token of each with the same bytes, so
the ids of A have an identity map to the ids of B with their bytes: links along
the map are counted in vectors of the vocabulary's length, and only the others
enter the shuffle of id pairs.

Three passes over the documents' ids (a stage output): counts of documents by
id pair, the best count of every id of A, and sums over each document's links.
The last reads the pair counts in slices of bounded size, as many as there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm import byte_bpe, piece_viterbi
from tastebud.llm.arrowtext import segment_sum, slices
from tastebud.llm.common import staged

#: Id pairs that a task remembers before it hands their counts on, and those of one slice of the last pass.
MAX_REMEMBERED, SLICE_PAIRS = 1 << 20, 1 << 22
#: Texts are looked at in parts of about so many ids of A.
PART_IDS = 1 << 18


class PieceMerges:
    """The merges of a piece model of the BPE kind as ranks, so that its units are merged as the bytes of A are."""

    def __init__(self, t: piece_viterbi.PieceTable):
        self.table = t
        text = t.by_text()
        order = sorted(text.values(), key=lambda i: -t.scores[i])
        merged = [t.scores[i] for x, i in text.items() if x.strip(" ") and len(x) > 1]
        if not t.bpe or len(set(merged)) < len(merged):
            raise ValueError("not a BPE model with one score for each merge")  # but for spaces, see encode_units
        self.ids = np.array(order, np.int32)  # of the ranks
        rank = {i: r for r, i in enumerate(order)}
        self.pairs = byte_bpe.Pairs(len(order), {
            rank[text[x[:k]]] * len(order) + rank[i]: rank[j] for x, j in text.items() for k in range(1, len(x))
            for i in (text.get(x[k:]),) if i is not None and x[:k] in text})
        self.chars = np.array([ord(x) for x in text if len(x) == 1], np.int64)
        self.char_ranks = np.array([rank[text[chr(c)]] for c in self.chars], np.int32)
        self._rank_of = None

    def __getstate__(self):
        return {**self.__dict__, "_rank_of": None}

    @property
    def rank_of(self) -> np.ndarray:
        """Rank of every code point that is a piece (-1: it is none)."""
        if self._rank_of is None:
            self._rank_of = np.full(0x110000, -1, np.int32)
            self._rank_of[self.chars] = self.char_ranks
        return self._rank_of

    def encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all units, number of ids of each)``.

        Long units, those with an unknown character, and those with several
        spaces, whose pieces may have one score, are merged by their texts.
        """
        units = units.cast(pa.string())
        data = byte_bpe.flat_bytes(units)[1].tobytes()
        first = self.rank_of[np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)]
        size = pc.utf8_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        start = np.cumsum(size) - size
        unknown = np.r_[0, np.cumsum(first < 0)]
        plain = (unknown[start + size] == unknown[start]) & (size <= byte_bpe.MAX_TOGETHER)
        plain &= ~pc.starts_with(units, "  ").to_numpy(zero_copy_only=False)
        todo, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        parts = [(todo[some], count, self.ids[ranks])
                 for some, count, ranks in byte_bpe.merge_pieces(first, start[todo], size[todo], self.pairs)]
        odd = piece_viterbi.encode_units(units.take(pa.array(rest)).to_pylist(), self.table, True)
        for i, ids in zip(rest.tolist(), odd):
            ids = np.frombuffer(ids, np.int32)
            parts.append((np.array([i]), len(ids), ids))
        return byte_bpe.gathered(len(units), parts)

    def encode_spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, number of ids of each)`` of texts that begin with the added space, or are empty.

        No piece crosses from a word into the next run of spaces, so these begin the units.
        """
        offsets, data = byte_bpe.flat_bytes(texts)
        space = data == 0x20
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        opens[offsets[:-1][np.diff(offsets) > 0]] = True
        return byte_bpe.gather_texts(np.flatnonzero(opens), data, offsets, self.encode_units)


@dataclass
class Pair:
    """Both tables, the bytes' lengths of their ids, and the id of B with the bytes of each id of A (-1: none)."""

    a: byte_bpe.ByteTable
    b: PieceMerges
    a_len: np.ndarray
    b_len: np.ndarray
    same: np.ndarray


def load_pair(a_path: str | None = None, b_path: str | None = None) -> Pair:
    """Byte-level ranks as A, pieces as B.  Of two ids of B with equal bytes the piece goes before the byte."""
    a, b = byte_bpe.load_ranks(a_path), piece_viterbi.load_pieces(b_path)
    raw = b.raw.tobytes()
    by_bytes: dict[bytes, int] = {}
    is_byte = set(b.byte_ids.tolist())
    for i in sorted(range(len(b.raw_len)), key=lambda i: i not in is_byte):
        if b.raw_len[i] and i != b.unk_id:
            by_bytes[raw[b.raw_start[i]:b.raw_start[i] + b.raw_len[i]]] = i
    same = np.array([by_bytes.get(x, -1) for x in a.tokens.to_pylist()], np.int64)
    return Pair(a, PieceMerges(b), pc.binary_length(a.tokens).to_numpy().astype(np.int64), b.raw_len.astype(np.int64), same)


def encode_both(docs: DataFrame, pair: Pair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, a_ids, b_ids``: the ids of space and text by A and by B, which adds the space itself.

    A null or empty text has no ids, nor has one whose tokens' bytes are not
    the space and the text: B's library reads a literal word mark (U+2581) as
    a space.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                text = pc.fill_null(part.column("text"), "")
                usable = pc.and_(pc.not_equal(text, ""), pc.invert(pc.match_substring(text, piece_viterbi.MARK)))
                spaced = pc.if_else(usable, pc.binary_join_element_wise("", text, " "), "")
                a, n_a = byte_bpe.encode_texts(spaced, pair.a)
                b, n_b = pair.b.encode_spaced(spaced)
                size = pc.binary_length(spaced).to_numpy(zero_copy_only=False)
                whole = (segment_sum(pair.a_len[a], n_a) == size) & (segment_sum(pair.b_len[b], n_b) == size)
                if not whole.all():
                    a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
                    n_a, n_b = n_a * whole, n_b * whole
                ends = [pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)) for n in (n_a, n_b)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(ends[0], pa.array(a.astype(np.int32))),
                     pa.ListArray.from_arrays(ends[1], pa.array(b.astype(np.int32)))], names=["doc_id", "a_ids", "b_ids"])

    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType([src.schema["doc_id"], T.StructField("a_ids", ids), T.StructField("b_ids", ids)])
    return src.mapInArrow(run, schema)


@dataclass
class Links:
    """The links of some documents in order, and where their groups end."""

    doc: np.ndarray  # of each link
    a: np.ndarray  # ids
    b: np.ndarray
    a_ends: np.ndarray  # whether the token of A ends with the link
    b_ends: np.ndarray
    n_docs: int

    @property
    def joint(self) -> np.ndarray:
        """Whether a group ends with the link."""
        return self.a_ends & self.b_ends

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=values, minlength=self.n_docs).astype(np.int64)


def links_of(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, pair: Pair) -> Links:
    """Links of documents whose ids lie end to end; their bytes are as many by A as by B."""
    a_end, b_end = np.cumsum(pair.a_len[a]), np.cumsum(pair.b_len[b])
    kind = np.zeros(int(a_end[-1]) + 1 if len(a) else 1, np.uint8)
    kind[a_end] = 1
    kind[b_end] |= 2
    at = np.flatnonzero(kind)
    a_ends, b_ends = (kind[at] & 1).astype(bool), (kind[at] & 2).astype(bool)
    ia, ib = np.cumsum(a_ends) - a_ends, np.cumsum(b_ends) - b_ends  # the tokens that hold the byte before the offset
    return Links(np.repeat(np.arange(len(n_a)), n_a)[ia], a[ia].astype(np.int64), b[ib].astype(np.int64), a_ends, b_ends,
                 len(n_a))


def _parts(batch: pa.RecordBatch, pair: Pair):
    """Row ranges of a batch of ids with their links."""
    lists = [pc.fill_null(batch.column(c), []) for c in ("a_ids", "b_ids")]
    first = [x.offsets.to_numpy().astype(np.int64) for x in lists]
    ids = [x.values.to_numpy(zero_copy_only=False) for x in lists]
    counts = [np.diff(x) for x in first]
    block = np.cumsum(counts[0]) // PART_IDS
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for s, z in zip(cuts[:-1], cuts[1:]):
        if z > s:
            a, b = (i[f[s]:f[z]] for i, f in zip(ids, first))
            yield batch.slice(s, z - s), counts[0][s:z], counts[1][s:z], a, b, links_of(a, counts[0][s:z], b, counts[1][s:z], pair)


class Distinct:
    """Marks the first of equal (document, id) pairs without sorting: the last writer of a cell is the one."""

    ROWS = 32

    def __init__(self, width: int):
        self.width, self.cell = width, np.zeros(self.ROWS * width, np.int64)

    def one_of_each(self, doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Indices of one of every distinct pair; ``doc`` ascends."""
        out = []
        cuts = np.searchsorted(doc, np.arange(0, (int(doc[-1]) if len(doc) else 0) + self.ROWS + 1, self.ROWS))
        for s, z in zip(cuts[:-1], cuts[1:]):
            if z > s:
                key = (doc[s:z] % self.ROWS) * self.width + ids[s:z]
                place = np.arange(s, z)
                self.cell[key] = place
                out.append(place[self.cell[key] == place])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def pair_counts(coded: DataFrame, pair: Pair) -> tuple[np.ndarray, DataFrame]:
    """How many documents hold an id pair linked: a vector along the identity map, and ``a, b, n`` of all other pairs.

    A task counts the links along the map in one vector and hands it on once;
    the counts of other pairs are summed before they are shuffled.
    """
    v_a, v_b = len(pair.a_len), len(pair.b_len)

    def run(batches):
        vector, distinct = np.zeros(v_a, np.int64), Distinct(v_a)
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n)],
                                              names=["a", "b", "n"])

        for batch in batches:
            for *_, x in _parts(batch, pair):
                mapped = pair.same[x.a] == x.b
                one = distinct.one_of_each(x.doc[mapped], x.a[mapped])
                vector += np.bincount(x.a[mapped][one], minlength=v_a)
                rest = np.unique((x.doc[~mapped] * v_a + x.a[~mapped]) * v_b + x.b[~mapped])  # once a document
                new, n = np.unique(rest % (v_a * v_b), return_counts=True)
                pairs, back = np.unique(np.concatenate((pairs, new)), return_inverse=True)
                counts = np.bincount(back, weights=np.concatenate((counts, n)), minlength=len(pairs)).astype(np.int64)
                if len(pairs) > MAX_REMEMBERED:
                    yield rows(pairs // v_b, pairs % v_b, counts)
                    pairs, counts = pairs[:0], counts[:0]
        if len(pairs):
            yield rows(pairs // v_b, pairs % v_b, counts)
        some = np.flatnonzero(vector)
        if len(some):
            yield rows(some, np.full(len(some), -1), vector[some])

    seen = staged(coded.select("a_ids", "b_ids").mapInArrow(run, "a int, b int, n long"), "tokenpairs")
    vector = np.zeros(v_a, np.int64)
    mapped = seen.where("b < 0").groupBy("a").agg(F.sum("n").alias("n")).toPandas()  # a row per id of A at most
    vector[mapped["a"].to_numpy()] = mapped["n"]
    return vector, staged(seen.where("b >= 0").groupBy("a", "b").agg(F.sum("n").alias("n")), "paircounts")


def _pair_slices(counts: DataFrame, v_b: int):
    """The pair counts as sorted arrays, by hash in slices of at most about ``SLICE_PAIRS``; one empty slice of none."""
    n = counts.count()
    k = -(-n // SLICE_PAIRS) or 1
    for i in range(k):
        got = counts.where(F.pmod(F.xxhash64("a", "b"), F.lit(k)) == i).toArrow()
        key = got.column("a").to_numpy().astype(np.int64) * v_b + got.column("b").to_numpy()
        order = np.argsort(key)
        yield key[order], got.column("n").to_numpy().astype(np.int64)[order]


def _groups_text(x: Links, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, words: list) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group of every document."""
    group = np.cumsum(x.joint) - x.joint
    last = np.r_[x.doc[1:] != x.doc[:-1], True] if len(x.doc) else np.zeros(0, bool)  # a document's last link
    # what follows an id: 0 a comma, 1 a bar (A) or a semicolon (B), 2 nothing
    after_a = x.joint[x.a_ends].astype(np.int64)
    after_b = np.where(last[x.b_ends], 2, x.joint[x.b_ends])
    code = np.concatenate((a * 3 + after_a, len(words[0]) * 3 + b * 3 + after_b))
    order = np.argsort(np.concatenate((group[x.a_ends] * 2, group[x.b_ends] * 2 + 1)), kind="stable")
    table = pa.array([f"{i}{end}" for side, ends in zip(words, ((",", "|", ""), (",", ";", ""))) for i in side for end in ends])
    text = table.take(pa.array(code[order]))
    upto = np.r_[0, np.cumsum(n_a + n_b)]
    at = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1)[upto]
    return pa.Array.from_buffers(pa.string(), len(n_a), [None, pa.py_buffer(at.astype(np.int32)), text.buffers()[2]])


def align_documents(docs: DataFrame, pair: Pair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` for every row.

    ``groups`` lists the ids of A and B of every group; ``count_sum`` adds, over
    the document's links, how many documents hold the link's id pair;
    ``n_best`` counts the links whose pair has the highest such count of its id
    of A, all of equal ones.  Texts without ids (null, empty, holding a literal
    word mark) have zeros and an empty ``groups``.  Rows that repeat an id or a
    text are documents of their own, long texts are aligned whole, other
    columns are left out, and an empty table gives no rows.
    """
    coded = encode_both(docs, pair, id_col, text_col).withColumn("rid", F.monotonically_increasing_id())
    coded = staged(coded, "aligned")
    vector, counts = pair_counts(coded, pair)
    return link_sums(coded, pair, vector, counts)


def link_sums(coded: DataFrame, pair: Pair, vector: np.ndarray, counts: DataFrame) -> DataFrame:
    """The result of :func:`align_documents` for ids with a row number ``rid``, given their :func:`pair_counts`.

    Every slice of the pair counts is one pass over the ids; the sums of the
    passes after the first, if any, are joined to its rows.
    """
    spark, v_a, v_b = coded.sparkSession, len(pair.a_len), len(pair.b_len)
    best = vector.copy()
    other = counts.groupBy("a").agg(F.max("n").alias("n")).toPandas()  # a row per id of A at most
    best[other["a"].to_numpy()] = np.maximum(best[other["a"].to_numpy()], other["n"])
    words = [np.arange(n) for n in (v_a, v_b)]
    sums, names = ["n_best", "count_sum"], ["n_a", "n_b", "n_groups", "n_links"]
    number = lambda c: T.StructField(c, T.LongType())

    more = [*map(number, names), coded.schema["doc_id"], T.StructField("groups", T.StringType())]
    schema = {first: T.StructType([number("rid"), *map(number, sums), *(more if first else [])]) for first in (True, False)}
    fields = {first: x.names for first, x in schema.items()}

    def summing(sent, first: bool):
        def run(batches):
            key, n = sent.value
            for batch in batches:
                for rows, n_a, n_b, a, b, x in _parts(batch, pair):
                    mapped = pair.same[x.a] == x.b
                    count = np.where(mapped, vector[x.a], 0) if first else np.zeros(len(x.a), np.int64)
                    if len(key):
                        rest = np.flatnonzero(~mapped)
                        want = x.a[rest] * v_b + x.b[rest]
                        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
                        count[rest] = np.where(key[at] == want, n[at], 0)
                    cols = [x.per_doc((count > 0) & (count == best[x.a])), x.per_doc(count)]
                    if first:
                        cols += [n_a, n_b, x.per_doc(x.joint), np.bincount(x.doc, minlength=x.n_docs)]
                    cols = [rows.column("rid"), *(pa.array(c.astype(np.int64)) for c in cols)]
                    if first:
                        cols += [rows.column("doc_id"), _groups_text(x, a, n_a, b, n_b, words)]
                    yield pa.RecordBatch.from_arrays(cols, names=fields[first])
        return run

    passes = [coded.mapInArrow(summing(spark.sparkContext.broadcast(part), i == 0), schema[i == 0])
              for i, part in enumerate(_pair_slices(counts, v_b))]
    out = passes[0]
    if len(passes) > 1:
        rest = passes[1]
        for one in passes[2:]:
            rest = rest.unionByName(one)
        rest = rest.groupBy("rid").agg(*(F.sum(c).alias(f"more_{c}") for c in sums))
        out = out.join(rest, "rid").withColumns({c: F.col(c) + F.col(f"more_{c}") for c in sums})
    return out.select("doc_id", *names, *sums, "groups")
