from __future__ import annotations

import hashlib
import math
import re
import time
from collections import defaultdict

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm import pii


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(text))) % 10 == 0


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
]


def base(text):
    return [(k, m.start(), m.end()) for k, pattern, good in PLAIN for m in re.finditer(pattern, text or "") if good(m[0])]


TEXTS = [
    None, "", "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 12.3.4", "4539 1488 0343 6467 x", "+1 (555) 123-4567 +1 ( ( +44",
    "é4111-1111-1111-1111é+49 30 1234567890", "9" * 5000, "..%@x.y", "1.2.3." + "4." * 2000, "x@y.z" * 400, "a@" + "b." * 3000 + "c",
    "write to 😀 ann@x.org or +44 20 7946 0958, card 5500-0000-0000-0004",
]


def test_base_spans(spark):
    rows = list(enumerate(TEXTS)) + [(100 + k, r[1]) for k, r in enumerate(awkward_rows())]
    got = {r["doc_id"]: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows:
        want = base(text)
        line = ",".join("%s:%d:%d" % s for s in want)
        assert got[doc]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [got[doc][f"n_{k}"] for k, _, _ in PLAIN] == [sum(s[0] == k for s in want) for k, _, _ in PLAIN]
        assert got[doc]["spans"].startswith(line)


def test_no_run_is_quadratic_or_recursive(spark):
    rows = [(1, "a" * 200_000 + "@"), (2, "1" * 200_000), (3, "1." * 4_000), (4, "+" * 200_000), (5, "+1" + "(" * 200_000), (6, "a.b-" * 50_000)]
    got = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    addresses = ",".join("%s:%d:%d" % s for s in base(rows[2][1]))
    assert got == {1: "", 2: "", 3: addresses, 4: "", 5: "", 6: ""} and addresses


def plain_terms(rows, support=2, generalise=0.9):
    """Counts in dictionaries: documents per value, term and pair."""
    near, values, words = {}, defaultdict(set), defaultdict(set)
    for doc, text in rows:
        spans = base(text)
        for w in re.findall(r"[^\W\d_]{4,}", (text or "").lower()):
            words[w].add(doc)
        for kind, start, end in spans:
            value = f"{kind}:{text[start:end].lower()}"
            values[value].add(doc)
            same = [s for s in spans if s[0] == kind]
            at = same.index((kind, start, end))
            # the piece between two matches of a kind ends at the neighbour, accepted or not; the texts below have no refused ones
            low = max(same[at - 1][2] if at else 0, start - pii.CONTEXT)
            high = min(same[at + 1][1] if at + 1 < len(same) else len(text), end + pii.CONTEXT)
            for m in re.finditer(r"[^\W\d_]{4,}", text):
                cut = (m.start() <= low and start - low == pii.CONTEXT) or (m.end() >= high and high - end == pii.CONTEXT)
                inside = (low <= m.start() and m.end() <= start) or (end <= m.start() and m.end() <= high)
                if inside and not cut and not any(s < m.end() and m.start() < e for _, s, e in spans):
                    near.setdefault((value, m[0].lower()), {}).setdefault(doc, set()).add((m.start(), m.end()))
    out, n = defaultdict(set), len(rows)
    for (value, term), docs in near.items():
        content = math.log2(n / len(values[value]))
        if len(docs) >= support and content > 0 and math.log2(len(docs) * n / (len(values[value]) * len(words[term]))) / content >= generalise:
            for doc, places in docs.items():
                out[doc] |= places
    return out


def test_terms_against_counts(spark):
    rows = [(k, f"filler number {k} about nothing") for k in range(40)]
    rows += [(100 + k, f"meet Zebulon Quince at ann@x.org about nothing {k}") for k in range(3)]
    rows += [(200 + k, f"about filler bob{k}@x.org nothing") for k in range(5)]
    rows += [(300, "Zebulon went home"), (301, "call +44 20 7946 0958 Quagmire"), (302, "call +44 20 7946 0958 Quagmire again")]
    want = plain_terms(rows)
    assert want[100] and not want[200]
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: {(t["start"], t["end"]) for t in r["found_terms"]} for r in got if r["found_terms"]} == {d: p for d, p in want.items() if p}


def test_terms_anywhere_in_the_document(spark):
    far = "filler " * 30
    rows = [(k, f"filler number {k} about nothing") for k in range(40)]
    rows += [(100 + k, f"Quince {far} year 2024 4539 1488 0343 6467 {far}\nregards, İnci Li, QUINCE éann@x.org ann {k}") for k in range(2)]
    rows += [(200, "Quince went home")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = {doc: t for doc, t in rows}
    got = {r["doc_id"]: [text[r["doc_id"]][t["start"] : t["end"]] for t in r["found_terms"]] for r in pii.find_personal_data(df, generalise=0.8, shortest=1).collect()}
    assert got[100] == got[101] == ["Quince", "year", "regards", "İnci", "Li", "QUINCE", "ann"]
    assert not any(terms for doc, terms in got.items() if doc not in (100, 101))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert " Li," not in clean[100] and clean[200] == text[200]


def test_sanitise(spark):
    rows = [(1, "é ann@x.org 😀 1.2.3.4 end"), (2, "nothing"), (3, None), (4, "+49 30 1234567890")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert got == {1: "é [email] 😀 [ip] end", 2: "nothing", 3: None, 4: "[phone]"}


def test_edges(spark):
    assert pii.report(empty(spark)).count() == 0
    assert same_rows(pii.report(clashing(awkward(spark))), pii.report(awkward(spark)))
    df = clashing(awkward(spark))
    assert pii.sanitise(df).columns == df.columns
    plan = pii.report(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_very_many_matches_in_one_text(spark):
    """Twenty-five thousand addresses, and numbers between them: found and replaced in one go."""
    parts = [f"é{k} u{k}@mail.example.org, +49 30 {k:08d}; " for k in range(25_000)]
    text = "".join(parts)
    df = spark.createDataFrame([(1, text), (2, "ann@x.org")], "doc_id long, text string")
    began = time.monotonic()
    got = {r["doc_id"]: r for r in pii.report(df).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert time.monotonic() - began < 120
    assert (got[1]["n_email"], got[1]["n_phone"]) == (25_000, 25_000)
    spans = base(text)
    assert got[1]["base_sha256"] == hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()
    assert clean[1] == "".join(f"é{k} [email], [phone]; " for k in range(25_000)) and clean[2] == "[email]"


def test_native(spark):
    for df in (pii.report(awkward(spark)), pii.sanitise(awkward(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
