import random
import re
from itertools import combinations

import pytest

from reelmart.llm.licenses import PHRASES, TEMPLATES, Automaton, op10_license_scan, scan_licenses, words_of

from .cases import edge_rows


def _words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_places_against_brute_force(spark, documents, clashing):
    rows = edge_rows() + [(200, "MIT license mit LICENSE, the Apache-License; gnu general public license general public license é-mit license"),
                          (201, "mit licenseé xmit license mit  license\nmit\x00license")]
    got = {(r.doc_id, r.n_words): r for r in scan_licenses(clashing(documents(rows))).collect()}
    for i, t in rows:
        w = _words(t)
        want = sorted((label, k) for p, label in PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        r = got[i, len(w)]
        assert sorted((p.label, p.start) for p in r.places) == want
    assert any(r.places for r in got.values())


def test_matching_statistics_against_brute_force():
    auto = Automaton(PHRASES, TEMPLATES)
    texts = [words_of(t) for t, _ in PHRASES] + [words_of(t) for _, t in TEMPLATES]
    subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    doc = ("this work is licensed under the apache license version 2 0 released under the mit license to any person obtaining a copy "
           "of the license general public license as published").split()
    ids = [auto.vocab.get(w, -1) for w in doc]
    for i, (_, n) in enumerate(auto.statistics(ids)):
        assert n == max((m for m in range(i + 2) if tuple(doc[i + 1 - m:i + 1]) in subs or m == 0))


def test_template_spans_and_labels(spark, documents):
    mit = dict((t, k) for k, t in TEMPLATES)
    long_mit = next(t for t in mit if t.startswith("Permission is hereby"))
    broken = long_mit.replace("without limitation", "with no limitation").replace("merge, publish", "merge and publish")
    docs = documents([(1, "Some prose before. " + broken + " and after"), (2, "Licensed under CC BY-NC 4.0."), (3, "the software is of the copies"), (4, "")])
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert [s.label for s in got[1].spans] == ["mit"] and got[1].spans[0].cover > 0.7 and got[1].spans[0].start == 3
    assert [s.label for s in got[2].spans] == ["cc-by-nc"]
    assert not got[3].spans and not got[4].spans and got[4].n_words == 0


def test_query(spark, documents, tmp_dir):
    documents([(1, "Released under the MIT License."), (2, "plain"), (3, None), (4, "the apache license and the mit license")]).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: r for r in op10_license_scan(spark, tmp_dir).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].labels) == (5, 1, 3, 3, "mit", "mit")
    assert (got[3].n_words, got[3].n_base, got[3].first_word, got[3].base_labels, got[3].labels, got[3].score) == (0, 0, None, "", "", 0.0)
    assert got[4].base_labels == "apache,mit" and got[4].score >= 0.5 and got[2].score == 0.0
    documents([]).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    assert op10_license_scan(spark, tmp_dir).count() == 0


def _runs(doc, template, others, min_match):
    """Right-maximal runs of ``doc`` in any template, (start, end, ends in ``template``), by trying all."""
    grams = {tuple(t[i:j]) for t in others for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    longest = [max((n for n in range(1, i + 2) if tuple(doc[i + 1 - n:i + 1]) in grams), default=0) for i in range(len(doc))]
    out = []
    for i, n in enumerate(longest):
        if n >= min_match and (i + 1 == len(doc) or longest[i + 1] != n + 1):
            ends = [k + n for k in range(len(template) - n + 1) if template[k:k + n] == doc[i + 1 - n:i + 1]]
            if ends:
                out.append((i + 1 - n, i + 1, ends))
    return out


def _brute_spans(doc, template, others, min_match, max_gap, min_cover):
    """All chains of runs, then all disjoint sets of the best chain of each run."""
    runs = _runs(doc, template, others, min_match)
    best = {}

    def grow(i, te, covered, first):
        key = (covered, first)
        best[i] = max(best.get(i, key), key)
        s, e, _ = runs[i]
        for j in range(i + 1, len(runs)):
            s2, e2, ends = runs[j]
            for te2 in ends:
                ts, ts2 = te - (e - s), te2 - (e2 - s2)
                if s2 > s and s2 <= e + max_gap and te2 > te and ts2 >= ts:
                    grow(j, te2, covered + te2 - max(ts2, te), first)

    for i, (s, e, ends) in enumerate(runs):
        for te in ends:
            grow(i, te, e - s, s)
    cands = [(first, runs[i][1], covered) for i, (covered, first) in best.items() if covered >= min_cover * len(template)]
    sets = [c for n in range(len(cands) + 1) for c in combinations(cands, n)
            if all(a[1] <= b[0] or b[1] <= a[0] for a, b in combinations(c, 2))]
    return max(sum(x[2] for x in c) for c in sets), cands


def test_spans_against_brute_force(spark, documents):
    rng = random.Random(5)
    words = "alpha beta gamma delta eps".split()
    for trial in range(6):
        template = [rng.choice(words) for _ in range(10)]
        other = [rng.choice(words) for _ in range(6)]
        docs = []
        for i in range(25):
            d = []
            for _ in range(2):
                t = list(template)
                for _ in range(rng.randrange(3)):
                    t[rng.randrange(len(t))] = rng.choice(["foreign", *words])
                d += t + ["x"] * rng.randrange(3)
            docs.append(d)
        got = {r.doc_id: r.spans for r in scan_licenses(
            documents([(i, " ".join(d)) for i, d in enumerate(docs)], 1), (), (("a", " ".join(template)), ("a", " ".join(other))),
            min_match=2, max_gap=2, min_cover=0.5).collect()}
        for i, d in enumerate(docs):
            want = [_brute_spans(d, t, [template, other], 2, 2, 0.5) for t in (template, other)]
            assert sum(round(s.cover * len(t)) for t, s in [(template if (s.start, s.end, round(s.cover * 10)) in want[0][1] else other, s) for s in got[i]]) == want[0][0] + want[1][0]


def test_a_run_at_a_later_place_of_its_template(spark, documents):
    template = "alpha beta gamma one two three alpha beta gamma four five six"
    docs = documents([(1, "alpha beta gamma one two three foreign words alpha beta gamma four five six"), (2, template + " . " + template), (3, template + " " + template)])
    got = {r.doc_id: [(s.start, s.end, s.cover) for s in r.spans] for r in scan_licenses(docs, (), (("t", template),)).collect()}
    assert got == {1: [(0, 14, 1.0)], 2: [(0, 12, 1.0), (12, 24, 1.0)], 3: [(0, 12, 1.0), (12, 24, 1.0)]}


@pytest.mark.parametrize("label", sorted({t for t, _ in TEMPLATES}))
def test_every_template_gives_its_own_label(spark, documents, label):
    texts = [t for k, t in TEMPLATES if k == label]
    docs = documents([(i, "Some prose. " + t.upper() + " More prose.") for i, t in enumerate(texts)], 1)
    for r in scan_licenses(docs).collect():
        assert {s.label for s in r.spans} == {label} and max(s.cover for s in r.spans) == 1.0
