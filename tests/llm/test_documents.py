"""Operators on documents against plain versions, with odd inputs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tastebud.llm import licenses, mixing, piece_viterbi, quality_rules, sharding, simhash, simple8b, toxicity, weak_quality
from tastebud.llm.common import prepare
from tests.llm import brute as B

LONG = " ".join(f"w{i % 900}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here today "


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    prepare(spark)
    rows = [(1, "a b c a b c d", "h1", "x"), (2, None, "h1", None), (3, "", None, "y"), (None, "null id text", None, None),
            (4, LONG, "h2", "z"), (5, PROSE * 8, "h2", "z"), (6, PROSE * 8, "h2", "z"), (6, PROSE * 8, "h2", "z"),
            (7, "line one\nline one\n \nline two\r\n#$% <|>", "h3", "q"), (8, " \t\x0b\x0c\r\n", "h3", "q"),
            (9, "été 日本語 \U0001f600 " * 30, "h4", None), (None, None, None, None),
            (10, PROSE * 7 + "one two three four five six seven", "h4", "q")]
    schema = "doc_id long, text string, source string, fp string"
    extra = ["kept", "row", "h", "copies", "size", "score", "slot", "shard", "rid", "root", "n_words", "host"]
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)])


def empty(df):
    return df.where("doc_id = -1")


def keyed(df):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0), r) for r in df.collect())


def test_quality_rules(spark, odd):
    out = quality_rules.host_quality_rules(odd, carry=True)
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = B.base_stats(r.row.text)
        assert {k: r[k] for k in want} == want, r.doc_id
        assert r.kept == (not r.base_failed and not (r.host_failed or False))
        assert (r.host is None) == (r.host_rate is None)
    assert set(out.select("row.*").columns) == set(odd.columns)
    assert quality_rules.host_quality_rules(empty(odd)).count() == 0


def test_host_verdicts_shrink_to_the_prior(spark):
    prepare(spark)
    rows = [("big", True)] * 95 + [("big", False)] * 5 + [("tiny", True)] + [(f"ok{i}", j == 0) for i in range(30) for j in range(20)]
    got = {r.host: r for r in quality_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    rate = np.array([r.n_failed / r.n_docs for r in got.values()])
    m, v = rate.mean(), rate.var()
    s = min(1000, max(1, m * (1 - m) / v - 1))
    for r in got.values():
        assert abs(r.host_rate - (r.n_failed + m * s) / (r.n_docs + s)) < 1e-9
    assert got["big"].host_failed and not got["ok3"].host_failed and got["tiny"].host_rate < 1


def test_mixing_tells_rows_of_one_id_apart(spark):
    prepare(spark)
    rows = [(i % 3, f"{'w ' * (1 + i % 5)}{i}", "ab"[i % 7 > 4]) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sizes(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(out) == 2 and all(abs(r.taken - r.target) <= 6 for r in out)


def test_mixing(spark, odd):
    out = mixing.mix_sizes(odd).collect()
    assert len(out) == odd.count() and all(r.taken == r.copies * r["size"] and r.copies <= 3 for r in out)
    size = {}
    for r in out:
        size[r.source] = size.get(r.source, 0) + r["size"]
    assert all(r.source_size == size[r.source] and r.target <= 3 * r.source_size + 1e-9 for r in out)
    assert abs(sum({r.source: r.target for r in out}.values()) - sum(size.values())) < 1e-6
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix_sizes(empty(odd)).count() == 0 and mixing.mix_documents(empty(odd)).count() == 0


def test_mixing_targets_and_thresholds(spark):
    prepare(spark)
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(n)), s) for i, (n, s) in enumerate(zip(rng.integers(1, 60, 900), rng.choice(list("aaaaabc"), 900)))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = (sorted((r.doc_id, r.taken) for r in mixing.mix_sizes(df.repartition(n)).collect()) for n in (3, 7))
    assert first == again
    out = mixing.mix_sizes(df).collect()
    for s in "abc":
        some = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in some) - some[0].target) <= max(r["size"] for r in some)
    # water filling, one step after the other
    size = {s: sum(r["size"] for r in out if r.source == s) for s in "abc"}
    weight, left, free, want = {"a": 5, "b": 2, "c": 1}, sum(size.values()), set("abc"), {}
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * size[s]}
        if not over:
            want.update({s: level * weight[s] for s in free})
            break
        want.update({s: 3.0 * size[s] for s in over})
        left -= sum(want[s] for s in over)
        free -= over
    assert all(abs(r.target - want[r.source]) < 1e-6 for r in out)


def test_simhash_fingerprints_and_components(spark, odd):
    out = simhash.near_duplicates(odd, carry=True).collect()
    assert len(out) == odd.count()
    assert all(r.fingerprint == f"{B.simhash(r.row.text):016x}" for r in out)
    ids = [r.doc_id if r.doc_id is not None else 10 ** 9 for r in out]
    want = B.hamming_components(ids, [int(r.fingerprint, 16) for r in out])
    assert [r.component_id if r.component_id is not None else 10 ** 9 for r in out] == want
    by = {}
    for r in out:
        by.setdefault(r.root, []).append(r.keeper)
    assert all(sum(k) == 1 for k in by.values())
    assert simhash.near_duplicates(empty(odd)).count() == 0


def test_simhash_links_at_up_to_four_bits(spark):
    """Planted fingerprints: all pairs compared by brute force, hot bands included."""
    prepare(spark)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 300, dtype=np.uint64)
    fps = [int(x) for x in base]
    for b in base[:120]:
        flips = rng.choice(64, int(rng.integers(1, 7)), replace=False)
        fps.append(int(b) ^ sum(1 << int(f) for f in flips))
    fps += [int(base[0]) ^ (1 << i) ^ (1 << j) for i in range(0, 40, 3) for j in range(41, 64, 4)]  # one large group
    fps = sorted(set(fps))
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = B.hamming_components(list(range(len(fps))), fps)
    for cap in (4096, 12):
        simhash.CELL_ROWS, kept = cap, simhash.CELL_ROWS
        try:
            edges = [(r.a, r.b) for r in simhash.fingerprint_edges(df).collect()]
        finally:
            simhash.CELL_ROWS = kept
        at = {int(np.uint64(f).view(np.int64)): i for i, f in enumerate(fps)}
        assert B.components(len(fps), [(at[a], at[b]) for a, b in edges]) == want
        assert len(edges) <= 15 * len(fps)  # a forest of each cell, not its pairs


def test_link_cells_prunes_only_unlinked_pairs():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**64, 200, dtype=np.uint64)
    fp[100:] = fp[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    label = simhash.link_cells(np.zeros(200, np.int64), fp, 4, simhash.pivots())
    assert label.tolist() == B.hamming_components(list(range(200)), fp.tolist())


def test_sharding(spark, odd):
    table = sharding.write_shards(odd, shards=5)
    rows = table.collect()
    assert len(rows) == odd.count()
    counts = [sum(r.shard == s for r in rows) for s in range(5)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s])) for s in range(5))
    key = lambda r: (r.row.doc_id or -1, r.row.text or "")
    assert sorted(map(key, rows)) == sorted((r.doc_id or -1, r.text or "") for r in odd.collect())
    assert sharding.write_shards(empty(odd)).count() == 0
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    one, two = (sorted((r.shard, r.slot, r.row.doc_id) for r in sharding.write_shards(many.repartition(n), bucket_bytes=500).collect())
                for n in (2, 5))
    assert one == two
    order = [d for _, _, d in one]
    assert abs(np.corrcoef(order, range(5000))[0, 1]) < 0.1  # shuffled
    shards = [r.shard for r in sharding.write_shards(spark.range(7).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))).collect()]
    assert len(set(shards)) == 7  # fewer rows than shards


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    cases = [np.zeros(0), np.zeros(5000), np.arange(70), rng.integers(0, 2, 3000), rng.integers(0, 49_408, 5000),
             np.where(rng.random(4000) < 0.02, 2**60 - 1, 3), rng.integers(0, 2**60, 1500)]
    cases.append(rng.integers(0, 2**64, 2500, dtype=np.uint64))
    cases.append(np.full(1030, 2**64 - 1, np.uint64))
    for a in cases:
        a = np.asarray(a).astype(np.uint64)
        words, first, escapes = simple8b.pack(a)
        assert (simple8b.unpack(words, first, escapes, len(a)) == a).all()
        assert len(first) == -(-len(a) // simple8b.BLOCK)
    counts = np.array([3, 0, 2])
    image = simple8b.write_image(np.array([5, 6, 7]), np.array([0, 1, 0]), counts, np.arange(5))
    ids, null, n, tokens = simple8b.read_image(image)
    assert (ids.tolist(), null.tolist(), n.tolist(), tokens.tolist()) == ([5, 6, 7], [False, True, False], [3, 0, 2], [0, 1, 2, 3, 4])
    with pytest.raises(ValueError, match="intact"):
        simple8b.read_image(image[:60] + b"\xff" + image[61:])


def test_words_are_encoded_as_in_the_whole_text():
    tok = simple8b.WordTokenizer(simple8b.tokenizer_path())
    texts = ["don't I'M x<|endoftext|>y <|startoftext|> z", "", None, "日本語 Éé ΣΑΣ İ", "a" * 500 + " b",
             "< <| <|end 123 ½", "é " * 5, PROSE, "x.,y a.b. Straße! 'S. I'M. .. ?! ,a É. Ǆ. Ĳ;"]
    texts.append(" ".join(f"{chr(c)}. X{chr(c)}y!?" for c in range(0x21, 0x250)))
    for _ in range(2):  # the second time from memory
        ids, counts = tok.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        whole = tok.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert [ids[e - c:e].tolist() for e, c in zip(ends, counts)] == [x.ids for x in whole]


def test_words_that_share_a_hash_keep_their_own_ids():
    """The two words have one multiply-add hash; the second must not get the ids of the first."""
    words = ["nnlmmmolknlmnpkoonkl", "mmonmmknomnnmkolllpo"]
    h = simple8b.HashedWords(pa.array(words)).hash
    assert h[0] == h[1]
    for order in (words, words[::-1]):
        tok = simple8b.WordTokenizer(simple8b.tokenizer_path())
        for text in (order[0], order[1], " ".join(order), f"{order[1]}! {order[0]}."):
            ids, counts = tok.encode(pa.array([text]))
            assert ids.tolist() == tok.tok.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]


def test_token_files(spark, odd):
    out = simple8b.id_checksums(simple8b.read_token_files(simple8b.write_token_files(odd, partitions=4))).collect()
    tok = simple8b.WordTokenizer(simple8b.tokenizer_path()).tok
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    crc = lambda t: zlib.crc32(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())
    assert sorted((r.doc_id or 0, r.ids_crc32) for r in out) == sorted((d or 0, crc(t)) for d, t in docs)
    assert simple8b.read_token_files(simple8b.write_token_files(empty(odd))).count() == 0


def test_rows_of_one_id_are_spread_over_buckets(spark):
    rows = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    n = [r["count"] for r in rows.groupBy(sharding.bucket_of(F.col("doc_id"), F.col("text"), 42, 48)).count().collect()]
    assert len(n) == 48 and max(n) < 100
    out = sharding.write_shards(rows).collect()
    assert sorted(r.row.text for r in out) == sorted(f"t{i}" for i in range(2000))


def license_brute(text, templates=None):
    t = templates or licenses.TEMPLATES
    decide = {k: [licenses.normal_words(x) for x in v] for k, v in licenses.DECIDING.items()} if templates is None else {}
    got = B.license_windows(licenses.normal_words(text or ""), {k: licenses.normal_words(x) for k, x in t.items()}, decide,
                            licenses.MIN_DICE)
    top = min(got) if got else None
    return top and top[2], top and -top[0], len(got), sorted({x[2] for x in got})


def same_licenses(r, want):
    return (r.license, r.matches, r.licenses) == (want[0], *want[2:]) and (r.dice or 0) == (want[1] or 0)


def test_license_scan(spark, odd):
    t = licenses.TEMPLATES
    apache = t["Apache-2.0"]
    texts = [("plain", "some words\nthat are no licence"), ("line", f"prose before\n{apache}\nprose after"), ("case", apache.upper()),
             ("other version", "Licensed under the Apache License, Version 2.1."), ("header", t["Apache-2.0-header"].replace(". ", ".\n")),
             ("both", f"{t['MIT']}\n{t['CC-BY-NC-4.0']}"), ("long", LONG), ("empty", ""), ("null", None), ("one", "word"),
             ("thrice", f"{t['MIT']}\n" * 3)]
    df = spark.createDataFrame([(*x, "n", 1) for x in texts], "doc_id string, text string, license string, rid int")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    for name, text in texts:
        assert same_licenses(got[name], license_brute(text)), name
    assert got["line"].license == got["case"].license == "Apache-2.0" and got["header"].license == "Apache-2.0-header"
    assert got["both"].matches == 2 and got["thrice"].matches == 3 and got["other version"].license is None
    assert licenses.scan_licenses(odd).count() == odd.count() and licenses.scan_licenses(empty(odd)).count() == 0
    own = {"mine": "you may do with this what you like"}
    one = licenses.scan_licenses(df.withColumn("text", F.lit("here you may do with this what you please")), templates=own).first()
    assert same_licenses(one, license_brute("here you may do with this what you please", own)) and one.license == "mine"


def test_licenses_are_told_apart(spark):
    gnu = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} Public License as "
           "published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version.")
    cases = [(gnu.format("program", ";", "General", ";", "2"), "GPL-2.0-header"), (gnu.format("program", ":", "General", ",", "3"), "GPL-header"),
             (gnu.format("program", ";", "Lesser General", ";", "2.1"), "LGPL-2.1-header"),
             (gnu.format("library", ":", "Lesser General", ",", "3"), "LGPL-3.0-header"),
             (gnu.format("program", ":", "Affero General", ",", "3"), "AGPL-3.0-header"),
             (gnu.format("program", ":", "General", ",", "4"), None),
             ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0-notice"),
             ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0-notice"),
             ("Licensed under CC BY-NC-ND 3.0", "CC-BY-NC-ND-3.0"), ("Licensed under CC BY 2.0", None),
             ("This work is released under CC0 1.0", "CC0-1.0"),
             ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
              "following conditions are met", "BSD-opening"),
             (licenses.TEMPLATES["BSD-2-Clause"], "BSD-2-Clause"), (licenses.TEMPLATES["BSD-3-Clause"], "BSD-3-Clause"),
             ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
              "provided that the above copyright notice and this permission notice appear in all copies", "ISC-permission")]
    prose = "words that have nothing to do with it " * 9
    df = spark.createDataFrame([(i, f"{prose}\n{x}\n{prose}") for i, (x, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(cases))] == [k for _, k in cases]


def test_a_text_of_many_notices_costs_no_square(spark):
    import time
    took = {}
    for n in (1000, 4000, 64_000):
        df = spark.createDataFrame([(1, f"{licenses.TEMPLATES['MIT']}\n" * n)], "doc_id long, text string")
        t0 = time.time()
        assert licenses.scan_licenses(df).first().matches == n
        took[n] = time.time() - t0
    assert took[64_000] < 8 * took[4000], took  # the square would be 256


def test_license_notices_wrapped_inline_and_embedded(spark):
    import random
    import textwrap
    t = licenses.TEMPLATES
    prose = "some other words that go on for a while and have nothing to do with it at all " * 6
    wrap = lambda x, mark: "\n".join(mark + y for y in textwrap.wrap(x, 72 - len(mark)))
    texts = [(f"wrapped {k}", f"{prose}\n{wrap(x, '')}\n{prose}", k) for k, x in t.items()]
    texts += [(f"header {k}", f"{wrap(x, '# ')}\nimport os\n{prose}", k) for k, x in t.items()]
    texts += [(f"inline {k}", f"{prose}{x} {prose}", k) for k, x in t.items()]
    texts += [("two", f"{prose}\nThis work is licensed under the GNU\nGeneral Public License, version 3.\n{prose}", "GPL-3.0"),
              ("twice", f"{prose}{t['MIT']} {prose}{t['MIT']}", "MIT"),
              ("beside", f"{t['MIT-permission']} {t['MIT']}", "MIT"), ("none", prose, None)]
    rng = random.Random(5)
    for i in range(60):  # notices with words lost, added and repeated
        k = rng.choice(sorted(t))
        ws = [w for w in licenses.normal_words(t[k]) for _ in range(rng.choice((0, 1, 1, 1, 1, 1, 1, 1, 2)))]
        texts.append((f"odd {i}", f"{prose} {' '.join(ws)}\n{prose}", None))
    df = spark.createDataFrame([x[:2] for x in texts], "doc_id string, text string").repartition(8)
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    some = set()
    for name, text, k in texts:
        r = got[name]
        assert k is None or k in r.licenses, (name, r)
        assert same_licenses(r, license_brute(text)), (name, r, license_brute(text))
        if name.startswith("odd"):
            some.add(bool(r.licenses))
    assert some == {True, False} and got["twice"].matches == 2 and got["none"].matches == 0


def test_piece_viterbi_finds_the_best_segmentation():
    t = piece_viterbi.load_pieces()
    pieces = {}
    for k in t.keys:
        for row, i in zip(t.points[k], t.ids[k]):
            pieces["".join(map(chr, row))] = int(i)

    def best(unit):
        score, back = [0.0], [None]
        for e in range(1, len(unit) + 1):
            options = [(score[e - k] + t.scores[pieces[unit[e - k:e]]], k, pieces[unit[e - k:e]])
                       for k in range(min(16, e), 0, -1) if unit[e - k:e] in pieces]
            if not any(k == 1 for _, k, _ in options):
                options.append((score[e - 1] + t.unk_score, 1, None))
            top = max(options, key=lambda o: o[0])  # the first of equals: the longest
            score.append(top[0])
            back.append(top)
        out, e = [], len(unit)
        while e:
            _, k, i = back[e]
            out = ([i] if i is not None else [int(t.byte_ids[b]) for b in unit[e - 1].encode()]) + out
            e -= k
        return out

    texts = [PROSE, "  two  spaces ", "tab\there\nline", "日本語テスト 梦", "▁ x ▁", "\U0001f600\x00 ok", "a" * 300, "Whéthér"]
    ids, counts = piece_viterbi.encode_texts(pa.array(texts), t)
    ends = np.cumsum(counts)
    for text, e, c in zip(texts, ends, counts):
        want = [i for u in piece_viterbi.UNIT.findall(" " + text) for i in best(u)]
        assert ids[e - c:e].tolist() == want, text
    assert piece_viterbi.decode_ids(ids, counts, t).to_pylist() == texts


def test_piece_ids_are_those_of_the_library(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.model_path())
    t = piece_viterbi.load_pieces()
    texts = [PROSE, "the these running", "  two  spaces ", "tab\there\nline", "日本語テスト 梦", "\U0001f600\x00 ok", "a" * 300,
             "Whéthér", " " * 40 + "x", "ab" * 63 + "a", "ab" * 64, "abcde" * 2000 + "①", "", " "]
    odd = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id int, text string")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for df in (odd, docs):
        out = piece_viterbi.encode_documents(df, t, carry=True).collect()
        assert len(out) and [r.ids for r in out] == [sp.encode((r.text or "")) for r in out]


def test_piece_coding_of_odd_documents(spark, odd):
    t = piece_viterbi.load_pieces()
    coded = piece_viterbi.encode_documents(odd, t, carry=True)
    back = piece_viterbi.decode_documents(coded, t, ("doc_id", "n_tokens", "text")).collect()
    assert len(back) == odd.count() and all(r.decoded == (r.text or "") for r in back)
    assert all((r.n_tokens == 0) == (not r.text) for r in back)
    assert piece_viterbi.encode_documents(empty(odd), t).count() == 0


def _held_out(spark, name):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    half = F.pmod(F.xxhash64(F.lit(99), "doc_id"), F.lit(2)) == 0
    return docs, labels.where(half), labels.where(~half).select("doc_id", F.col(name).alias("label"))


def test_quality_agrees_with_labels_it_never_saw(spark):
    prepare(spark)
    docs, _, _ = _held_out(spark, "quality")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    out = weak_quality.quality_scores(docs, weak_quality.fit_quality(docs)).join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.95
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.995
    assert out.where("kept = (weak_label >= 0.5)").count() / out.count() > 0.99


def test_every_vote_pattern_is_trained_on(spark):
    n = np.array([1.0, 3, 50, 9e6, 1e6])
    drawn = np.minimum(n, weak_quality.draw_rates(n, 12_000) * n)
    assert weak_quality.TRAIN_DOCS == 12_000 and (drawn[:3] == n[:3]).all() and 11_000 < drawn.sum() <= 12_000.5
    assert (weak_quality.draw_rates(n[:3], 12_000) == 1).all()
    prepare(spark)
    prose = PROSE.replace("\n", " ") + " "
    good = spark.range(4000).selectExpr("id AS doc_id", "concat('word', id % 7, ' ', id, ' ') AS t").select(
        "doc_id", F.concat("t", F.lit(prose * 2)).alias("text"))
    shouting = spark.createDataFrame([(-i, (prose * 2).replace(" ", "! ") + str(i)) for i in (1, 2, 3)], "doc_id long, text string")
    copies = spark.createDataFrame([(None, "x | " * 60)] * 300, "doc_id long, text string")
    docs = good.unionByName(shouting).unionByName(copies).repartition(6)
    model = weak_quality.fit_quality(docs, train_docs=200)
    kept = {r.doc_id: r.kept for r in weak_quality.quality_scores(docs, model).collect()}
    assert [kept[-i] for i in (1, 2, 3)] == [False] * 3 and kept[None] is False
    assert sum(kept[i] for i in range(4000)) > 3980
    # the scorer has no votes: it learned the shape of a shouted word
    assert model.weights[xxhash.xxh32_intdigest("shape a!") % weak_quality.DIMS] < 0


def test_label_model_recovers_planted_accuracies():
    rng = np.random.default_rng(0)
    k, n = len(weak_quality.LABELLERS), 40_000
    y = (rng.random(n) < 0.8).astype(int)
    good, bad = np.linspace(0.9985, 0.9995, k), np.linspace(0.1, 0.8, k)
    right = np.where(y[:, None] == 1, rng.random((n, k)) < good, rng.random((n, k)) < bad)
    v = np.where(right, y[:, None], 1 - y[:, None])
    v = np.where(rng.random((n, k)) < 0.2, 2, v)
    pattern, count = np.unique(weak_quality.pattern_of(v), return_counts=True)
    m = weak_quality.fit_label_model(pattern, count.astype(float))
    assert abs(m.prior - 0.8) < 0.01 and np.abs(m.accuracy[1] - good).max() < 0.002 and np.abs(m.accuracy[0] - bad).max() < 0.05


def test_label_model_finds_a_labeller_that_errs_on_good_documents():
    rng = np.random.default_rng(1)
    k, n = len(weak_quality.LABELLERS), 200_000
    y = rng.random(n) < 0.8
    good = np.r_[0.95, np.full(k - 1, 0.999)]
    right = np.where(y[:, None], rng.random((n, k)) < good, rng.random((n, k)) < 0.7)
    v = np.where(right, y[:, None], ~y[:, None]).astype(np.int8)
    pattern, count = np.unique(weak_quality.pattern_of(v), return_counts=True)
    m = weak_quality.fit_label_model(pattern, count.astype(float))
    assert abs(m.accuracy[1, 0] - 0.95) < 0.01 and np.abs(m.accuracy[1, 1:] - 0.999).max() < 0.002
    assert np.abs(m.accuracy[0] - 0.7).max() < 0.02 and abs(m.prior - 0.8) < 0.01


def test_label_model_equals_plain_em_over_documents():
    rng = np.random.default_rng(2)
    v = rng.choice([0, 1, 2], size=(300, len(weak_quality.LABELLERS)), p=[0.1, 0.7, 0.2]).astype(np.int8)
    pattern, count = np.unique(weak_quality.pattern_of(v), return_counts=True)
    m = weak_quality.fit_label_model(pattern, count.astype(float), rounds=40)
    prior, good, bad = B.plain_em(v.tolist(), 40, weak_quality.ERROR_PRIOR, weak_quality.PRIOR_SHARE)
    assert abs(m.prior - prior) < 1e-9 and np.abs(m.accuracy - [bad, good]).max() < 1e-9


def test_scorer_judges_documents_without_votes(spark):
    prepare(spark)
    prose = PROSE.replace("\n", " ") + " "
    rows = [(i, f"word{i % 7} {i} " + prose) for i in range(400)]
    rows += [(1000 + i, f"{i} " + prose.replace(" ", "! ")) for i in range(100)]
    quiet = [(5000, "ok! yes! wow!"), (5001, "and so it was")]  # too short for every labeller that votes on them
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = weak_quality.fit_quality(docs)
    model.labels = weak_quality.LabelModel(0.5, np.full((2, len(weak_quality.LABELLERS)), 0.5))  # votes say nothing
    out = weak_quality.quality_scores(spark.createDataFrame(quiet, docs.schema), model).collect()
    got = {r.doc_id: r for r in out}
    assert all(r.weak_label == 0.5 for r in out) and not got[5000].kept and got[5001].kept


def test_quality_of_odd_documents(spark, odd):
    model = weak_quality.fit_quality(odd)
    out = weak_quality.quality_scores(odd, model, carry=True).collect()
    assert len(out) == odd.count()
    assert all(r.kept is False and r.score == 0 for r in out if not B.WORD.search(r.row.text or ""))
    none = weak_quality.fit_quality(empty(odd))
    assert weak_quality.quality_scores(empty(odd), none).count() == 0


def test_toxicity_of_held_out_documents(spark):
    prepare(spark)
    docs, train, held = _held_out(spark, "toxic")
    out = toxicity.severity(docs, toxicity.fit_severity(docs, train)).join(held, "doc_id")
    n = {(r.label, r.toxic): r["count"] for r in out.groupBy("label", "toxic").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.85
    assert n.get((0, True), 0) / (n[0, False] + n.get((0, True), 0)) < 0.03
    s = {r.label: r.s for r in out.groupBy("label").agg(F.avg("severity").alias("s")).collect()}
    assert s[1] > 1 > 0.2 > s[0]


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(3)
    n = 3000
    x = rng.integers(0, 4, (n, 2)).astype(float)
    z = 2.0 * x[:, 0] - 1.0 * x[:, 1] + rng.logistic(size=n)
    grade = np.digitize(z, [1.0, 3.0, 5.0])
    w, theta = toxicity.fit_ordinal(np.full(n, 2), np.tile([0, 1], n), x.ravel(), grade, 2, steps=1500)
    assert w[0] > 0 > w[1] and abs(w[0] / w[1] + 2) < 0.3 and (np.diff(theta) > 0).all()


def test_toxicity_of_odd_documents(spark, odd):
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, 0), (6, None), (None, 1), (99, 1), (10, 1)], "doc_id long, toxic int")
    out = toxicity.severity(odd, toxicity.fit_severity(odd, labels)).collect()
    assert len(out) == odd.count() and all(0 <= r.severity <= 3 for r in out)
    for some in (labels.where("toxic = 0"), labels.where("toxic = 7")):
        assert not any(r.toxic for r in toxicity.severity(odd, toxicity.fit_severity(odd, some)).collect())
    assert toxicity.severity(empty(odd), toxicity.fit_severity(empty(odd), labels)).count() == 0
