"""Licence scans: normalised text against licence templates by Dice coefficient over word bigrams.

Compared are windows of words, so a notice is found in a line of its own, in the
whole text, wrapped, inline or embedded.  A text is looked into only if it holds
an anchor of a template: bigrams so rare and so many that no window reaches the
limit without one, or a bigram of the words that decide about the template.  In
these texts the places of the templates' bigrams (hits) become rows; joins by
document, template and block of places find every best window in time
proportional to the hits, and blocks of one long text are spread over tasks.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastebud.llm.common import staged

MIN_DICE = 0.8

_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:")
_BSD_HEAD = _BSD_OPENING + (
    " 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_BSD_CLAUSE_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
_MIT_REST = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License.")
_GNU = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} Public License as "
        "published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version.")
_GNU_LINE = "This work is licensed under the GNU {} Public License, version {}."

#: Public licence notices and texts (fixed values).
TEMPLATES = {
    "AGPL-3.0": _GNU_LINE.format("Affero General", "3"),
    "AGPL-3.0-header": _GNU.format("program", ":", "Affero General", ",", "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": _APACHE_HEADER,
    "BSD-2-Clause": _BSD_HEAD + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD_HEAD + _BSD_CLAUSE_3 + _BSD_WARRANTY,
    "BSD-conditions": _BSD_HEAD,
    "BSD-opening": _BSD_OPENING,
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC0-1.0": "This work is released under CC0 1.0.",
    "CC0-1.0-dedication": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."),
    "CC0-1.0-notice": "This work is dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication.",
    "CC0-1.0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": _GNU_LINE.format("General", "2"),
    "GPL-2.0-header": _GNU.format("program", ";", "General", ";", "2"),
    "GPL-3.0": _GNU_LINE.format("General", "3"),
    "GPL-header": _GNU.format("program", ":", "General", ",", "3"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "ISC-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1": _GNU_LINE.format("Lesser General", "2.1"),
    "LGPL-2.1-header": _GNU.format("library", ";", "Lesser General", ";", "2.1"),
    "LGPL-3.0": _GNU_LINE.format("Lesser General", "3"),
    "LGPL-3.0-header": _GNU.format("library", ":", "Lesser General", ",", "3"),
    "MIT": "Released under the MIT License.",
    "MIT-permission": _MIT_PERMISSION,
    "MIT-text": _MIT_PERMISSION + _MIT_REST,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution."),
}
#: Words that a window must hold to be the licence: they tell versions and variants apart (fixed values).
DECIDING = {
    "AGPL-3.0": ("gnu affero general", "version 3"), "AGPL-3.0-header": ("gnu affero general", "version 3"),
    "Apache-2.0": ("apache license", "version 2 0"), "Apache-2.0-header": ("apache license", "version 2 0"),
    "BSD-3-Clause": ("endorse or promote",), "CC0-1.0": ("cc0 1 0",), "CC0-1.0-notice": ("cc0 1 0",),
    "GPL-2.0": ("gnu general", "version 2"), "GPL-2.0-header": ("gnu general", "version 2 of"),
    "GPL-3.0": ("gnu general", "version 3"), "GPL-header": ("gnu general", "version 3"),
    "LGPL-2.1": ("gnu lesser general", "version 2 1"), "LGPL-2.1-header": ("gnu lesser general", "version 2 1"),
    "LGPL-3.0": ("gnu lesser general", "version 3"), "LGPL-3.0-header": ("gnu lesser general", "version 3"),
    "MIT": ("mit license",), "MPL-2.0": ("mozilla public", "v 2 0"), "MPL-2.0-header": ("mozilla public", "v 2 0"),
}
#: The Creative Commons variants by the words of their names; each in two versions, as a line and as a notice.
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _code, _name in _CC.items():
    for _version, _scope in (("4.0", "International"), ("3.0", "Unported")):
        _key = f"CC-{_code}-{_version}"
        TEMPLATES[_key] = f"Licensed under CC {_code} {_version}."
        DECIDING[_key] = (f"cc {_code.lower()} {_version}",)
        TEMPLATES[_key + "-notice"] = f"This work is licensed under a Creative Commons {_name} {_version} {_scope} License."
        DECIDING[_key + "-notice"] = (f"commons {_name.lower()} {_version}",)

#: What separates words: ASCII but letters and digits.
_SEP = r"[\x00-/:-@\[-`{-\x7f]"


def normal_words(text: str) -> list[str]:
    """Lower-case runs of ASCII letters and digits and of any non-ASCII characters."""
    return [w for w in re.split(f"{_SEP}+", text.lower()) if w]


#: Words of little use as anchors; any choice of anchors finds the same windows.
_COMMON = frozenset("a and any at be by can for free from in is it may of on or that the this to under use with you your".split())


def window_need(m: int, min_dice: float) -> tuple[int, int]:
    """``(fewest shared bigrams, most bigrams)`` of a window that reaches ``min_dice`` with a template of ``m`` bigrams."""
    return math.ceil(m * min_dice / (2 - min_dice) - 1e-9), math.floor(m * (2 - min_dice) / min_dice + 1e-9)


def pair_counts(words: list[str]) -> dict[tuple[str, str], int]:
    out: dict = {}
    for pair in zip(words, words[1:]):
        out[pair] = out.get(pair, 0) + 1
    return out


def deciding_pairs(phrases: tuple) -> list[tuple[str, str]]:
    """Bigrams of the deciding words."""
    return sorted({pair for x in phrases for w in (normal_words(x),) for pair in zip(w, w[1:])})


def _commonness(pair: tuple[str, str]) -> tuple:
    return sum(w in _COMMON or len(w) == 1 for w in pair), -len(pair[0] + pair[1]), pair


def anchor_pairs(words: list[str], min_dice: float) -> list[tuple[str, str]]:
    """Rare bigrams of a template, so many that no window can do without all of them."""
    counts, m = pair_counts(words), len(words) - 1
    out, spare = [], m - window_need(m, min_dice)[0]
    for pair in sorted(counts, key=_commonness):
        if spare < 0:
            break
        out.append(pair)
        spare -= counts[pair]
    return out


def best_window(words: list[str], template: list[str], min_dice: float, decide: tuple = ()) -> float:
    """Highest Dice coefficient of any window of ``words`` with a template (for short texts, on the driver)."""
    m, want, top = len(template) - 1, pair_counts(template), 0.0
    most = window_need(m, min_dice)[1]
    for a in range(len(words) - 1):
        have: dict = {}
        shared, best, held = 0, 0.0, set()
        for n, pair in enumerate(zip(words[a:a + most], words[a + 1:a + most + 1]), 1):
            have[pair] = have.get(pair, 0) + 1
            shared += have[pair] <= want.get(pair, 0)
            if 2 * shared / (n + m) > best:
                best, held = 2 * shared / (n + m), set(have)
        if held >= set(deciding_pairs(decide)):
            top = max(top, best)
    return top


def template_rows(templates: dict, deciding: dict, min_dice: float) -> list[tuple]:
    """``(name, m, most, pair, times, decides, n_decide, anchor)`` of every bigram of every template.

    ``times``: how often the template holds it; ``decides``: its number among
    the deciding bigrams (0: none); ``anchor``: whether a text needs one such to
    be looked into for the template.
    """
    out = []
    for name in sorted(templates):
        words = normal_words(templates[name])
        if len(words) < 2:
            continue
        decide = deciding_pairs(deciding.get(name, ()))
        anchors = [min(decide, key=_commonness)] if decide else anchor_pairs(words, min_dice)
        for pair, times in sorted(pair_counts(words).items()):
            out.append((name, len(words) - 1, window_need(len(words) - 1, min_dice)[1], " ".join(pair), times,
                        decide.index(pair) + 1 if pair in decide else 0, len(decide), pair in anchors))
    return out


def _anchor_pattern(rows: list[tuple]) -> str:
    """Two words of an anchor with separators around them, as alternatives by first letter and first word."""
    tree: dict[str, dict[str, set]] = {}
    for *_, pair, _, _, _, anchor in rows:
        if anchor:
            first, second = pair.split(" ")
            tree.setdefault(first[0], {}).setdefault(first[1:], set()).add(second)
    words = lambda d: "|".join(f"{re.escape(x)}{_SEP}+(?:{'|'.join(map(re.escape, sorted(d[x])))})" for x in sorted(d))
    first = "|".join(f"{re.escape(c)}(?:{words(tree[c])})" for c in sorted(tree))
    return f"(?:^|{_SEP})(?:{first})(?={_SEP}|$)"


def _hits(rows: DataFrame, table: list[tuple]) -> DataFrame:
    """The places of the templates' bigrams: ``rid, name, m, most, pos, decides, n_decide, prev, last``.

    ``last`` is the place of the occurrence of the same bigram before, ``prev``
    that of the occurrence as many before as the template holds it: a window
    that starts there or earlier has enough of it without this one.
    """
    fields = "name string, m int, most int, pair string, times int, decides int, n_decide int, anchor boolean"
    names = [f.split()[0] for f in fields.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in table])
    known = rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")))
    pairs = F.transform(F.sequence(F.lit(0), F.size("ws") - 2), lambda i: F.concat_ws(" ", F.get("ws", i), F.get("ws", i + 1)))
    places = rows.where(F.size("ws") > 1).select("rid", F.posexplode(pairs).alias("pos", "pair"))
    hits = places.join(F.broadcast(known), "pair")  # the templates are constants
    own = Window.partitionBy("rid", "name")
    hits = hits.withColumn("usable", F.max("anchor").over(own)).where("usable")
    again = Window.partitionBy("rid", "name", "pair").orderBy("pos")
    prev = F.lit(None).cast("int")
    for k in sorted({r[4] for r in table}):
        prev = F.when(F.col("times") == k, F.lag("pos", k).over(again)).otherwise(prev)
    return hits.select("rid", "name", "m", "most", "pos", "decides", "n_decide", prev.alias("prev"),
                       F.lag("pos", 1).over(again).alias("last"))


def _best_windows(hits: DataFrame, min_dice: float) -> DataFrame:
    """``rid, name, m, most, start, end, minus`` of the best window from every hit that reaches ``min_dice``.

    ``start`` and ``end`` are the places of its first and last bigram, ``minus``
    the negative coefficient.  The best window ends with a hit; of equal ones
    the shorter is taken.  A start meets the hits up to its template's widest
    window in its own block of places and the next one.
    """
    block = F.floor(F.col("pos") / F.col("most"))
    starts = hits.select("rid", "name", "m", "most", "n_decide", F.col("pos").alias("start"), block.alias("block"))
    ends = hits.select("rid", "name", F.col("pos").alias("end"), "prev", "last", "decides",
                       F.explode(F.array(block, block - 1)).alias("block"))
    near = starts.join(ends, ["rid", "name", "block"]).where(
        (F.col("end") >= F.col("start")) & (F.col("end") < F.col("start") + F.col("most"))
        & (F.col("prev").isNull() | (F.col("prev") < F.col("start"))))
    upto = Window.partitionBy("rid", "name", "block", "start").orderBy("end")
    new = (F.col("decides") > 0) & (F.col("last").isNull() | (F.col("last") < F.col("start")))
    near = near.withColumn("held", F.sum(new.cast("int")).over(upto)).withColumn(
        "minus", -2.0 * F.row_number().over(upto) / (F.col("end") - F.col("start") + 1 + F.col("m")))
    best = near.groupBy("rid", "name", "block", "start", "m", "most", "n_decide").agg(
        F.min(F.struct("minus", "end", "held")).alias("best"))
    return best.where((F.col("best.minus") <= -min_dice) & (F.col("best.held") == F.col("n_decide"))).select(
        "rid", "name", "m", "most", "start", F.col("best.end").alias("end"), F.col("best.minus").alias("minus"))


def _unbeaten(windows: DataFrame, keys: list[str], width: Column) -> DataFrame:
    """Windows that share no word with a better one of equal ``keys``; ``width`` bounds the windows compared.

    Better is the higher coefficient, then the longer template, the first name, the earlier start.
    """
    block = F.floor(F.col("start") / width)
    w = windows.withColumn("key", F.struct("minus", (-F.col("m")).alias("longer"), "name", "start")).withColumn("block", block)
    other = w.select(*keys, F.explode(F.array(block - 1, block, block + 1)).alias("block"), F.col("key").alias("other_key"),
                     F.col("start").alias("other_start"), F.col("end").alias("other_end"))
    beaten = [w[c] == other[c] for c in [*keys, "block"]]
    beaten += [other["other_start"] <= w["end"] + 1, w["start"] <= other["other_end"] + 1, other["other_key"] < w["key"]]
    cond = beaten[0]
    for one in beaten[1:]:
        cond = cond & one
    return w.join(other, cond, "left_anti").drop("key", "block")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{_SEP}+"), "")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict | None = None,
                  min_dice: float = MIN_DICE, deciding: dict | None = None) -> DataFrame:
    """``doc_id, license, dice, matches, licenses`` for every row.

    A window of words reaches ``min_dice`` with a template only if it has at most
    ``(2 - d) / d`` times its bigrams and shares ``d / (2 - d)`` of them; from
    every hit the best such window is taken, if it holds the template's deciding
    words (versions, variants; ``deciding``, by name of template).  Of windows
    of a template that share words those stay that no better one touches, and
    then likewise of all templates' windows (ties: the longer template, the
    first name, the earlier start).  ``license`` and ``dice`` are those of the
    best window, ``matches`` is the number of windows and ``licenses`` their
    names.

    Null, empty and one-word texts match nothing: null licence, 0 matches, no
    names.  Rows that repeat an id or a text are rows of their own, columns of
    other names are ignored, an empty table gives no rows.  Long texts are
    scanned whole; the work grows with their words and hits.
    """
    if deciding is None:
        deciding = DECIDING if templates is None else {}
    table = template_rows(templates or TEMPLATES, deciding, min_dice)
    lower = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = staged(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                              F.when(lower.rlike(_anchor_pattern(table)), _words(lower)).alias("ws")), "licencewords")
    hits = staged(_hits(rows.where("ws IS NOT NULL").select("rid", "ws"), table), "licencehits")
    windows = staged(_best_windows(hits, min_dice), "licencewindows")
    windows = staged(_unbeaten(windows, ["rid", "name"], F.col("most")), "licencetops")
    windows = _unbeaten(windows, ["rid"], F.lit(max((r[2] for r in table), default=1)))
    by_doc = windows.groupBy("rid").agg(
        F.min(F.struct("minus", (-F.col("m")).alias("longer"), "name")).alias("top"), F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_set("name")).alias("names"))
    out = rows.select("rid", "doc_id").join(by_doc, "rid", "left")
    return out.select("doc_id", F.col("top.name").alias("license"), (-F.col("top.minus")).alias("dice"),
                      F.coalesce("n", F.lit(0)).cast("long").alias("matches"),
                      F.coalesce("names", F.array().cast("array<string>")).alias("licenses"))
