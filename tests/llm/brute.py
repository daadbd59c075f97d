"""Plain Python versions of the corpus operators' results (small inputs)."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_stats(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = {}
    for x in win:
        count[x] = count.get(x, 0) + 1
    cover = set()
    for i, x in enumerate(win):
        if count[x] > 1:
            cover.update((i, i + 1, i + 2))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(cover),
            "base_failed": len(w) < 50 or 100 * len(cover) > 50 * len(w)}


def lower_az(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def simhash(text, k=4):
    w = WORD.findall(lower_az(text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def hamming_components(ids, fps, bits=4):
    """Smallest id of each row's component (ids without nulls)."""
    f = np.array(fps, dtype=np.uint64)
    pairs = []
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= bits):
            pairs.append((i, i + 1 + int(j)))
    root = components(len(f), pairs)
    low = {}
    for r, d in zip(root, ids):
        low[r] = min(low.get(r, d), d)
    return [low[r] for r in root]


def _byte_letters():
    """The bytes behind the letters of a byte-level vocabulary: printable ones stand for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def aligned(rows):
    """Alignment of the two libraries' tokens for rows of (id, text), by comparing all byte ranges."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    letters = _byte_letters()
    a_bytes = {i: bytes(letters[c] for c in s) for s, i in tok.get_vocab().items() if i != 50256}

    def b_bytes(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def ranges(tokens):
        out, at = [], 0
        for i, raw in tokens:
            out.append((at, at + len(raw), i))
            at += len(raw)
        return out
    docs, held = [], {}
    for doc, text in rows:
        a = b = []
        if text:
            want = (" " + text).encode()
            a = [(i, a_bytes[i]) for i in tok.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, b_bytes(i)) for i in sp.encode(text)]
            if any(b"".join(raw for _, raw in x) != want for x in (a, b)):
                a = b = []
        a, b = ranges(a), ranges(b)
        links = [(i, j) for s, e, i in a for s2, e2, j in b if s < e2 and s2 < e]
        for x in set(links):
            held[x] = held.get(x, 0) + 1
        ends, at, groups = sorted({e for _, e, _ in a} & {e for _, e, _ in b}), 0, []
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, _, i in x if at <= s < e) for x in (a, b)))
            at = e
        docs.append((doc, len(a), len(b), len(ends), links, ";".join(groups)))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return [(d, na, nb, g, len(x), sum(held[y] == best[y[0]] for y in x), sum(held[y] for y in x), s)
            for d, na, nb, g, x, s in docs]


def license_windows(words, templates, decide, min_dice):
    """Windows of a list of words that are licences: ``(-coefficient, -bigrams, name, start, end)``, by trying all of them."""
    own = []
    for name, text in templates.items():
        m, want = len(text) - 1, {}
        for pair in zip(text, text[1:]):
            want[pair] = want.get(pair, 0) + 1
        need = {pair for x in decide.get(name, ()) for pair in zip(x, x[1:])}
        found = []
        for a, first in enumerate(zip(words, words[1:])):
            if first not in want:
                continue
            have, shared, best = {}, 0, None
            for n, pair in enumerate(zip(words[a:], words[a + 1:]), 1):
                if n > 4 * m:
                    break
                have[pair] = have.get(pair, 0) + 1
                shared += have[pair] <= want.get(pair, 0)
                if best is None or 2 * shared / (n + m) > best[0]:
                    best = 2 * shared / (n + m), a + n - 1, set(have)
            if best[0] >= min_dice and best[2] >= need:
                found.append((-best[0], -m, name, a, best[1]))
        own += unbeaten(found)
    return unbeaten(own)


def unbeaten(windows):
    """Those that share no word with a better one."""
    return [x for x in windows if not any(y < x and y[3] <= x[4] + 1 and x[3] <= y[4] + 1 for y in windows)]


def plain_em(votes, rounds, error_prior, prior_share):
    """Weak-label EM, a document at a time: ``(prior of good, accuracies on good, accuracies on bad)``."""
    k, n = len(votes[0]), len(votes)
    p = [0.1 if 0 in v else 0.9 for v in votes]

    def accuracies(share):
        good, bad = [], []
        for j in range(k):
            gr = sum(q for q, v in zip(p, votes) if v[j] == 1)
            gw = sum(q for q, v in zip(p, votes) if v[j] == 0)
            br = sum(1 - q for q, v in zip(p, votes) if v[j] == 0)
            bw = sum(1 - q for q, v in zip(p, votes) if v[j] == 1)
            s = 1 + share * (gr + gw)
            good.append(min(max((gr + (1 - error_prior) * s) / (gr + gw + s), 0.001), 0.99999))
            bad.append(max(min(max((br + 1) / (br + bw + 2), 0.001), 0.99999), 1 - good[-1]))
        return good, bad

    for _ in range(rounds):
        good, bad = accuracies(prior_share)
        prior = min(max((sum(p) + 1) / (n + 2), 0.01), 0.99)
        for i, v in enumerate(votes):
            yes, no = prior, 1 - prior
            for j, x in enumerate(v):
                if x != 2:
                    yes, no = yes * (good[j] if x else 1 - good[j]), no * (1 - bad[j] if x else bad[j])
            p[i] = yes / (yes + no)
    return prior, *accuracies(0.0)
