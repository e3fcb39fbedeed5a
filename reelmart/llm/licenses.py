"""Operator 10, licence scans with a generalised suffix automaton of licence tokens.

All templates and phrases go, as word sequences, into one generalised suffix automaton
(bounded by the template texts, built once per Python worker). Each document's words are
streamed through it, which gives the matching statistics: at every word, the longest run
of words ending there that stands in some template. Right-maximal runs of ``min_match``
words or more are chained per template (template positions going up, at most ``max_gap``
foreign words between runs). A run may stand at several places of a template: all of them
are kept per state and tried, and each run ends the chain that covers most of the template.
Chains that cover ``min_cover`` of it are candidates, and the disjoint candidates that cover
most together become spans with that template's label; a span inside one of another label
that covers more words gives way. A phrase place is a state whose suffix chain holds the
whole phrase, so overlapping and repeated places all count.

Templates are the paragraphs of whole licence texts and the notices that name a licence.
A chain looks back over the runs that end within ``max_gap`` words of its own, which the
templates' lengths bound, so the work on a text of any length is linear in it.

A word outside all templates, or a pair of neighbouring words that no template holds,
resets the automaton to its root or to one word, so only runs of known pairs are streamed;
numpy finds them. Words hit by their 64-bit hash are compared byte by byte first.

Defined cases: a null or empty text has no words, places or spans; of equally covering
chains the one that starts last counts, of equally covering sets of chains the one whose
spans end first; repeated rows give repeated results;
an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .arrowmap import map_texts
from .words import ALNUM, LOWER, prefix_hash, span_hash, spans, string_hash

# FIXED VALUES: phrases that always give their label.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# FIXED VALUES: licence texts by paragraph, and licence notices (public texts), by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software"),
    ("mit", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
            "to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall "
            "the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of "
            "contract, tort or otherwise, arising from, out of or in connection with the software or the use or other "
            "dealings in the software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
               "See the License for the specific language governing permissions and limitations under the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or "
            "(at your option) any later version"),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation; either version 2 of the License, or "
            "(at your option) any later version"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
            "for more details"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
             "(at your option) any later version"),
    ("lgpl", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
             "License for more details"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("bsd", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
            "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
            "particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any "
            "direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, "
            "procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however "
            "caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or "
            "otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "The software is provided \"as is\" and the author disclaims all warranties with regard to this software "
            "including all implied warranties of merchantability and fitness. In no event shall the author be liable for any "
            "special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data "
            "or profits, whether in an action of contract, negligence or other tortious action, arising out of or in "
            "connection with the use or performance of this software"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software"),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
             "to alter it and redistribute it freely, subject to the following restrictions"),
    ("zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original "
             "software. If you use this software in a product, an acknowledgment in the product documentation would be "
             "appreciated but is not required"),
    ("zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
             "software"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
              "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
              "distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
            "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("cc0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
            "to this software to the public domain worldwide. This software is distributed without any warranty"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution NoDerivatives 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
                  "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("unlicense", "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and "
                  "all copyright interest in the software to the public domain. We make this dedication for the benefit of "
                  "the public at large and to the detriment of our heirs and successors"),
)


def words_of(text: str) -> list[str]:
    """Lower-cased words as the scan takes them."""
    raw = LOWER[np.frombuffer(text.encode(), np.uint8)]
    start, end, _ = spans(raw, np.array([0, len(raw)]), ALNUM)
    data = raw.tobytes()
    return [data[s:e].decode() for s, e in zip(start.tolist(), end.tolist())]


class Automaton:
    """Generalised suffix automaton over word ids, with phrase and template places per state."""

    def __init__(self, phrases: tuple, templates: tuple):
        self.phrases, self.templates = phrases, templates
        self.vocab: dict[str, int] = {}
        texts = [words_of(t) for t, _ in phrases] + [words_of(t) for _, t in templates]
        ids = [[self.vocab.setdefault(w, len(self.vocab)) for w in t] for t in texts]
        self.sizes = [len(t) for t in ids]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[dict[int, set[int]]]
        self.ends = ends = [{}]  # text -> ends of all its occurrences
        for k, text in enumerate(ids):
            last = 0
            for i, c in enumerate(text):
                last = self._extend(last, c)
                ends[last].setdefault(k, set()).add(i + 1)
        for s in sorted(range(1, len(self.len)), key=lambda s: -self.len[s]):
            up = ends[self.link[s]]
            for k, e in ends[s].items():
                up.setdefault(k, set()).update(e)
        ends[0] = {}
        self.ends = [{k: sorted(e) for k, e in of.items()} for of in ends]
        # phrase -> states whose strings end with it
        hit: dict[int, int] = {}
        for k in range(len(phrases)):
            s = 0
            for c in ids[k]:
                s = self.next[s][c]
            hit.setdefault(s, 0)
            hit[s] |= 1 << k
        self.hits: list[tuple] = []
        for s in range(len(self.len)):
            found, u = [], s
            while u > 0:
                found += [(k, self.sizes[k]) for k in range(len(phrases)) if hit.get(u, 0) >> k & 1]
                u = self.link[u]
            self.hits.append(tuple(found))
        pairs = {(a, b) for t in ids for a, b in zip(t, t[1:])}
        self.words = list(self.vocab)
        hashes = np.array([string_hash(w) for w in self.words], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.hash_id = hashes[order], order
        self.pairs = np.array(sorted(a * len(self.words) + b for a, b in pairs), np.int64)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = self._state(length[last] + 1, {})
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[new] = self.link[q]
        self.link[q] = new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _state(self, length: int, nxt: dict) -> int:
        self.next.append(nxt)
        self.link.append(0)
        self.len.append(length)
        self.ends.append({})
        return len(self.len) - 1

    def statistics(self, run: list[int]) -> list[tuple[int, int]]:
        """(state, length) of the longest template substring ending at each word id of ``run``."""
        out, s, n = [], 0, 0
        for c in run:
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.len[s]
            if c in self.next[s]:
                s, n = self.next[s][c], n + 1
            else:
                s, n = 0, 0
            out.append((s, n))
        return out


@lru_cache(maxsize=8)
def automaton(phrases: tuple, templates: tuple) -> Automaton:
    return Automaton(phrases, templates)


def _chain(found: list, size: int, max_gap: int, min_cover: float) -> list:
    """Disjoint spans (doc start, doc end, covered words) of one template.

    ``found``: runs (doc start, doc end, template ends) by doc end. The chain kept for a run
    at a template end is the one that covers most, then the one that starts last.
    """
    best: list[list] = []  # a run -> (doc start, template start, template end, covered words) of its chains
    low = 0  # runs that end too early for any later one: starts of runs never go down
    candidates = []
    for i, (s, e, places) in enumerate(found):
        while found[low][1] + max_gap < s:
            low += 1
        own = []
        for te in places:
            ts, top = te - (e - s), (e - s, s)
            for j in range(low, i):
                if found[j][0] < s:
                    for first, pts, pte, covered in best[j]:
                        if pte < te and pts <= ts:
                            top = max(top, (covered + te - max(ts, pte), first))
            own.append((top[1], ts, te, top[0]))
        best.append(own)
        covered, first = max((c, f) for f, _, _, c in own)
        if covered >= min_cover * size:
            candidates.append((first, e, covered))
    # the disjoint candidates that cover most together
    ends = [c[1] for c in candidates]
    total, take = [0], []
    for n, (first, _, covered) in enumerate(candidates):
        before = bisect_right(ends, first, 0, n)
        with_it = total[before] + covered
        take.append(before if with_it > total[n] else -1)
        total.append(max(total[n], with_it))
    out, n = [], len(candidates)
    while n:
        if take[n - 1] >= 0:
            out.append(candidates[n - 1])
            n = take[n - 1]
        else:
            n -= 1
    return out[::-1]


def _outer(spans_: list) -> list:
    """(label, start, end, cover) of the (start, end, label, words, cover) that no span of another label with more words holds."""
    out, open_ = [], []
    for x in sorted(spans_, key=lambda x: (x[0], -x[1], -x[3], x[2])):
        open_ = [y for y in open_ if y[1] > x[0]]
        if not any(y[1] >= x[1] and y[2] != x[2] and y[3] > x[3] for y in open_):
            out.append((x[2], x[0], x[1], x[4]))
        open_.append(x)
    return out


def _scan(auto: Automaton, raw: np.ndarray, offsets: np.ndarray, min_match: int, max_gap: int, min_cover: float):
    n = len(offsets) - 1
    raw = LOWER[raw]
    start, end, doc = spans(raw, offsets, ALNUM)
    n_words = np.bincount(doc, minlength=n) if n else np.zeros(0, int)
    places: list[list] = [[] for _ in range(n)]
    found_spans: list[list] = [[] for _ in range(n)]
    if len(start) < 2 or not len(auto.pairs):
        return n_words, places, found_spans
    h = span_hash(prefix_hash(raw), start, end)
    at = np.minimum(np.searchsorted(auto.hashes, h), len(auto.hashes) - 1)
    word = np.where(auto.hashes[at] == h, auto.hash_id[at], -1)
    key = word[:-1] * len(auto.words) + word[1:]
    at = np.minimum(np.searchsorted(auto.pairs, key), len(auto.pairs) - 1)
    good = (auto.pairs[at] == key) & (word[:-1] >= 0) & (word[1:] >= 0) & (doc[:-1] == doc[1:])
    pos = np.flatnonzero(good)
    if not len(pos):
        return n_words, places, found_spans
    first_word = np.searchsorted(doc, np.arange(n))
    breaks = np.flatnonzero(np.diff(pos) > 1)
    begins, stops = pos[np.r_[0, breaks + 1]], pos[np.r_[breaks, len(pos) - 1]] + 2
    matches: dict[tuple[int, int], list] = {}
    n_phrases = len(auto.phrases)
    for b, z in zip(begins.tolist(), stops.tolist()):
        ids = word[b:z].tolist()
        ids = [w if raw[s:e].tobytes().decode("utf-8", "replace") == auto.words[w] else -1
               for w, s, e in zip(ids, start[b:z].tolist(), end[b:z].tolist())]
        d = int(doc[b])
        base = b - int(first_word[d])
        stats = auto.statistics(ids)
        for i, (s, length) in enumerate(stats):
            for k, size in auto.hits[s]:
                if length >= size:
                    places[d].append((auto.phrases[k][1], base + i + 1 - size))
            if length >= min_match and (i + 1 == len(stats) or stats[i + 1][1] != length + 1):
                for k, ends in auto.ends[s].items():
                    if k >= n_phrases:
                        matches.setdefault((d, k), []).append((base + i + 1 - length, base + i + 1, ends))
    for (d, k), found in matches.items():
        label, size = auto.templates[k - n_phrases][0], auto.sizes[k]
        found_spans[d] += [(s, e, label, c, c / size) for s, e, c in _chain(found, size, max_gap, min_cover)]
    return n_words, places, [_outer(f) for f in found_spans]


def scan_licenses(docs: DataFrame, phrases: tuple = PHRASES, templates: tuple = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text", min_match: int = 3, max_gap: int = 5, min_cover: float = 0.6) -> DataFrame:
    """(id, n_words, places, spans): phrase places (label, start) and covered template spans (label, start, end, cover)."""
    place = StructType([StructField("label", StringType()), StructField("start", LongType())])
    span = StructType([StructField("label", StringType()), StructField("start", LongType()),
                       StructField("end", LongType()), StructField("cover", DoubleType())])

    def fn(raw, offsets):
        n_words, places, found = _scan(automaton(phrases, templates), raw, offsets, min_match, max_gap, min_cover)
        return [n_words,
                [[{"label": a, "start": b} for a, b in p] for p in places],
                [[{"label": a, "start": b, "end": c, "cover": d} for a, b, c, d in sorted(p)] for p in found]]

    fields = [StructField("n_words", LongType()), StructField("places", ArrayType(place)), StructField("spans", ArrayType(span))]
    return map_texts(docs, id_col, text_col, fields, fn)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query. score: the best covered share of a template, or 0.5 if only a phrase stands there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    s = scan_licenses(docs)
    starts = F.col("places.start")
    base = F.sort_array(F.array_distinct(F.col("places.label")))
    every = F.sort_array(F.array_union(F.col("places.label"), F.col("spans.label")))
    phrase = F.when(F.size("places") > 0, 0.5).otherwise(0.0)
    return s.select(
        "doc_id", "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(phrase, F.coalesce(F.array_max(F.col("spans.cover")), F.lit(0.0))).alias("score"),
        F.size("spans").cast("long").alias("n_spans"))
