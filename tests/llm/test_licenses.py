"""Scans against brute force over places, and planted notices with words changed."""

import random
import re
from collections import Counter

import numpy as np
from foliomill.llm import licenses

MIT = licenses.TEXTS[1][1]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(text):
    w, out = plain_words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return sorted(out)


def test_words():
    for t in (None, "", "A-b 3ß\x7fc", "Ünï cöde don't İ", "x" * 10, "\x00a\x01b"):
        assert [w.decode() for w in licenses.words(t)] == plain_words(t)


def test_hashes_are_of_words_only():
    w = [f"w{i % 7}é".encode() for i in range(500)] + [b"a", b"ab", b"b"]
    h = licenses.rolling_hashes(w, 3)
    assert (licenses.rolling_hashes(w, 3, at_once=11) == h).all() and len(h) == len(w) - 2
    seen = {}
    for i, x in enumerate(h):
        assert seen.setdefault(tuple(w[i : i + 3]), x) == x
    assert len(set(seen.values())) == len(seen)
    assert len(licenses.rolling_hashes([b"a", b"b"], 3)) == 0


def test_base_places():
    for t in ("Under the MIT License under the mit license", "cc by nc by nc cc-by-nc", "", "apache license, version 2.0", "xunder the mit license"):
        own = licenses.words(t)
        got = licenses.base_places(b" ".join(own), {b" ".join(licenses.words(p)): x for p, x in licenses.PHRASES.items()}) if own else []
        assert got == plain_base(t)


FILLER = " ".join(f"filler{i}" for i in range(300))
DOCS = [
    (1, f"{FILLER} Released under the MIT License. {FILLER}"), (2, FILLER), (3, None), (4, ""),
    (5, f"{FILLER}\nThis work is licensed under the GNU General Public License, version 3."),
    (6, FILLER + " " + MIT.replace("free of charge", "for free").replace("publish, distribute, ", "") + " " + FILLER),
    (7, " ".join(x for i, x in enumerate(MIT.split()) if i % 2)), (None, "CC BY-NC 4.0 " * 3), (5, "general public license"),
    (8, "word " * 60000 + "Licensed under CC BY-NC 4.0 " + "word " * 60000), (1, f"{FILLER} Released under the MIT License. {FILLER}"),
]


def test_scan(spark):
    docs = spark.createDataFrame([(*d, 1, "q") for d in DOCS], "doc_id long, text string, template int, spans string").repartition(3)
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(DOCS)
    found = {}
    for i, t in DOCS:
        found.setdefault(i, []).append(t)
    for r in rows:
        assert any(
            r.n_words == len(plain_words(t)) and [(p.word, p.label) for p in r.places] == plain_base(t) for t in found[r.doc_id]
        )
        assert {p.label for p in r.places} <= set(r.labels) and 0 <= r.score <= 1
    by = {(r.doc_id, r.n_words): r for r in rows}
    assert by[5, 12 + 300].labels == ["gpl-3"] and by[5, 12 + 300].score == 1.0
    assert by[5, 3].labels == [] and by[2, 300].labels == []
    six = next(r for r in rows if r.doc_id == 6)
    assert six.labels == ["mit"] and not six.places and six.score > 0.9
    assert abs(six.spans[0].first - 300) <= 2
    assert next(r for r in rows if r.doc_id == 7).labels == []
    assert next(r for r in rows if r.doc_id == 8).labels == ["cc-by-nc"]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_every_whole_notice_is_found(spark):
    docs = spark.createDataFrame([(i, f"{FILLER} {t} {FILLER}") for i, (_, t) in enumerate(licenses.TEMPLATES)], "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        assert licenses.TEMPLATES[r.doc_id][0] in r.labels


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(p.word, p.label) for p in r.places] == plain_base(texts[r.doc_id])
        assert r.n_words == len(plain_words(texts[r.doc_id]))
        known = bool(re.search("licen[sc]e|CC BY", texts[r.doc_id], re.I))
        assert bool(r.labels) == known
    assert np.isfinite([r.score for r in rows]).all()


def test_licenses_of_a_family(spark):
    texts = {i: f"{FILLER}\n{text}. {FILLER}" for i, (_, text) in enumerate(licenses.TEMPLATES)}
    rows = licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    # a base phrase in a notice of CC BY-NC-ND stays
    base = [{x for _, x in plain_base(text)} for _, text in licenses.TEMPLATES]
    assert {r.doc_id: r.labels for r in rows} == {i: sorted({label} | base[i]) for i, (label, _) in enumerate(licenses.TEMPLATES)}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
    return row[-1]


def plain_nearest(text, want, within=None):
    """By trying every run of words (of lengths that so many changes can make)."""
    spread = len(want) if within is None else within
    runs = ((a, b) for a in range(len(text)) for b in range(a + max(1, len(want) - spread), min(len(text), a + len(want) + spread) + 1))
    e, last, first = min(((edits(text[a:b], want), b - 1, -a) for a, b in runs), default=(len(want), 0, 0))
    return e, -first, last


def test_nearest_span_equals_all_runs():
    draw = random.Random(1)
    for _ in range(300):
        want = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(draw.randint(1, 6))]
        text = [draw.choice([b"a", b"b", b"c", b"d", b"e"]) for _ in range(draw.randint(0, 12))]
        found, got = plain_nearest(text, want), licenses.nearest_span(text, want)
        assert got == found if found[0] < len(want) else got[0] >= len(want), (text, want)


def changed(own, n, draw):
    own = list(own)
    for i in range(n):
        at, how = draw.randrange(len(own)), draw.choice(["change", "change", "put", "leave"])
        own[at : at + (how != "put")] = [] if how == "leave" else [f"zz{i}"]
    return own


def test_changed_notices_equal_brute_force(spark):
    """Every template with 0 to 2 more changes than it allows: a span is found if, and where, brute force finds one."""
    draw, rows = random.Random(8), []
    wanted = [[w.decode() for w in licenses.words(t)] for _, t in licenses.TEMPLATES]
    for own in (w for t, w in enumerate(wanted) if t % 9 == 0 or len(w) > 12):  # made notices are alike
        for n in sorted({0, 1, 2, *range(max(0, len(own) // 5 - 1), len(own) // 5 + 3)}):
            for _ in range(3 if len(own) < 15 else 1):
                rows.append((len(rows), " ".join(["f1", "f2", "f3", *changed(own, n, draw), "g1", "g2", "g3"])))
    for i in range(5):  # each single word of the shortest
        rows.append((len(rows), " ".join(["f", *wanted[0][:i], "other", *wanted[0][i + 1 :], "g"])))
    names, expected = [x for x, _ in licenses.TEMPLATES], {}
    for i, text in rows:
        own, good = text.split(), []
        for t, want in enumerate(wanted):
            if sum((Counter(own) & Counter(want)).values()) < len(want) - len(want) // 5:
                continue  # each change leaves all other words
            e, a, b = plain_nearest(own, want, len(want) // 5)
            if e <= len(want) // 5 and {w.decode() for w in licenses.keys(names[t])} & set(want) <= set(own[a : b + 1]):
                if ({"gpl": {"lesser", "library", "affero"}, "lgpl": {"affero"}, "agpl": {"lesser", "library"}}.get(names[t].split("-")[0], set()) - set(want)) & set(own[a : b + 1]):
                    continue  # another license of the family
                good.append((t, a, b, 1 - e / len(want)))
        expected[i] = sorted((names[t], a, b, s) for t, a, b, s in licenses.undisputed(good, names))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for most_small in (100_000, 0):
        found = {r.doc_id: sorted(map(tuple, r.spans)) for r in licenses.scan(frame, most_small=most_small).collect()}
        assert found == expected
    assert sum(bool(x) for x in found.values()) > 60


def test_another_license_is_not_the_mit_license(spark):
    texts = [f"{FILLER} Released under the {x} License {FILLER}" for x in ("Apache", "Zlib", "")]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.labels for r in rows] == [[], [], []]


#: Notices of licenses that have no template, or that are denied: what they may be labelled.
WRONG = [
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", ["cc-by-nc-nd"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", ["cc-by-nc-sa"]),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", ["cc-by-nd"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["cc-by-sa"]),
    ("Licensed under CC BY-ND 4.0", ["cc-by-nd"]), ("Licensed under CC BY-SA 3.0", ["cc-by-sa"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3", ["lgpl-3"]),
    ("This work is licensed under the GNU Affero General Public License, version 3", ["agpl-3"]),
    ("This work is licensed under the GNU Library General Public License, version 2", []),
    ("This work is licensed under the GNU General Public License, version 2", ["gpl-2"]),
    ("This work is licensed under the GNU General Public License", []),
    ("Licensed under the Apache License, Version 1.1", ["apache-1.1"]), ("Licensed under the Mozilla Public License, version 1.1", ["mpl-1.1"]),
    ("It is not released under the Boost Software License, Version 1.0", []), ("It was never licensed under the ISC License", []),
    ("It is no longer licensed under the PostgreSQL License", []), ("Licensed under the New BSD License", ["bsd-3"]), ("Licensed under the Old BSD License", []),
    ("Unless otherwise noted it is licensed under the ISC License", ["isc"]), ("Licensed under the ISC License and the PHP License, version 3.01", ["isc"]),
]


def test_members_of_a_family_are_told_apart(spark):
    docs = [(i, f"{FILLER}\n{text}. {FILLER}") for i, (text, _) in enumerate(WRONG)]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: labels for i, (_, labels) in enumerate(WRONG)}


def test_words_put_into_a_notice_of_a_family(spark):
    """Each word that makes another license, put at each place inside a license's name: the notice's own label goes."""
    rows = []
    for label, text in licenses.TEMPLATES:
        others, _ = licenses.OTHERS.get(label.split("-")[0], ((), 0))
        own = [w.decode() for w in licenses.words(text)]
        for w in sorted(set(others) - set(own)) if len(own) < 25 else ():
            rows += [(label, f"{FILLER} {' '.join([*own[:i], w, *own[i:]])} {FILLER}") for i in range(own.index("under") + 2, len(own))]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string").repartition(4)
    wrong = [(rows[r.doc_id], r.labels) for r in licenses.scan(docs).collect() if rows[r.doc_id][0] in r.labels and not r.places]
    assert wrong == [] and len(rows) > 200


def test_denied_base_phrases_stay_with_a_lower_score(spark):
    texts = ["It is not released under the MIT License", "Released under the MIT License", "Not under the MIT license. Under the MIT license"]
    rows = sorted(licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [(r.labels, r.score) for r in rows] == [(["mit"], 0.5), (["mit"], 1.0), (["mit"], 1.0)]
