from __future__ import annotations

import random
import re

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm import licenses
from trackloom.llm.license_rules import BASE, rules


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(k, label) for phrase, label in BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


TEXTS = [
    "All rights reserved. ALL-RIGHTS reserved, all rights, reserved",
    "cc by cc by cc-by 4.0",
    "under the GNU General Public License version 3 or later",
    "Licensed under the Apache License, Version 2.0",
    "SPDX-License-Identifier: MIT",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "éall rights reserved all rightsé",
    "",
]


def test_base_places(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + k, r[1]) for k, r in enumerate(awkward_rows())]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows:
        r = got[doc]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_base(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    assert "gpl-3" in got[2]["labels"] and "apache-2.0" in got[3]["labels"] and "mit" in got[4]["labels"] and "mit" in got[5]["labels"]
    assert got[7]["labels"] == "" and got[7]["score"] == 0


def test_gates_lose_nothing():
    """With the gates open every rule finds the same."""
    scanner = licenses.Scanner()
    for text in TEXTS + ["you should have received a copy of the gnu general public license", "version 2.0 of the Mozilla Public License"]:
        line = b" " + b" ".join(licenses.words_of(text.encode())) + b" "
        live = sorted({k for _, ks in scanner.gates.iter(line.decode("latin-1")) for k in ks}) if line.strip() else []
        assert scanner.detections(line, live) == scanner.detections(line, list(range(len(scanner.rules))))
    assert len(rules()) > 300


def alternatives(parsed):
    """Strings that a parsed pattern matches, with every branch and every optional part."""
    out = [""]
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            some = [chr(arg)]
        elif kind == "IN":
            some = ["x"] if str(arg[0][0]) == "NEGATE" else [chr(a if str(o) == "LITERAL" else a[0]) for o, a in arg]
        elif kind == "NOT_LITERAL":
            some = ["x"]
        elif kind == "SUBPATTERN":
            some = alternatives(arg[3])
        elif kind == "BRANCH":
            some = [s for branch in arg[1] for s in alternatives(branch)]
        else:
            least, most, inner = arg
            assert kind in ("MAX_REPEAT", "MIN_REPEAT")
            once = alternatives(inner)
            some = [s * n for n in {least, min(least + 1, most)} for s in once]
        out = [a + b for a in out for b in dict.fromkeys(some)]
    return out


def test_every_alternative_passes_its_gate():
    for label, _, keyword, pattern in rules():
        for text in alternatives(re._parser.parse(pattern)):
            assert re.fullmatch(pattern, text) and any(key in f" {text} " for key in keyword.split("|")), (label, text)
    scanner = licenses.Scanner()
    texts = {
        b"Licence: MIT": "mit", b"Licence: BSD-3-Clause": "bsd-3", b"End User Licence Agreement": "eula", b"unauthorised copying": "proprietary",
        b"without prior written consent": "proprietary", b"for academic use only": "research-only", b"CeCILL free software licence agreement": "cecill",
    }
    for text, label in texts.items():
        assert label in scanner.scan(text)["labels"].split(","), text


def test_suppression_against_pairs():
    rng = random.Random(1)
    for _ in range(500):
        found = []
        for k in range(rng.randint(0, 12)):
            at = rng.randint(0, 20)
            found.append((at, at + rng.randint(1, 8), "x", rng.randint(0, 3), k))
        best = []
        for d in sorted(found, key=lambda d: (d[3], d[0] - d[1], d[4], d[0])):
            if not any(b[0] <= d[0] and d[1] <= b[1] for b in best):
                best.append(d)
        assert licenses.kept(found) == best


def test_edges(spark):
    assert licenses.scan_licenses(empty(spark)).count() == 0
    assert same_rows(licenses.scan_licenses(clashing(awkward(spark))), licenses.scan_licenses(awkward(spark)))


def test_detections_name_their_words(spark):
    """Every detection is a place of its rule, and none lies within one of better or equal rank."""
    rows = [(k, f"é, before it: {t} -- and after") for k, t in enumerate(TEXTS)]
    patterns: dict = {}
    for label, priority, _, pattern in rules():
        patterns.setdefault((label, priority), []).append(pattern)
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        words = licenses.words_of(rows[r["doc_id"]][1].encode())
        for d in r["detections"]:
            found = b" ".join(words[d["start"] : d["end"]])
            assert any(re.fullmatch(p.encode(), found) for p in patterns[d["label"], d["priority"]])
            assert d["label"] in r["labels"].split(",")
            assert not any(o != d and o["start"] <= d["start"] and d["end"] <= o["end"] and o["priority"] < d["priority"] for o in r["detections"])
    assert any(r["detections"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect())
