from __future__ import annotations

import re
from itertools import permutations

import pytest

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm.audit import audit

LABELS = "doc_id long, quality int, toxic int"
NAMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def fails(text, first):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": not first,
    }


def plain(rows, labels):
    """Every document through every order, one filter after the other."""
    low = -(2**63)
    docs = [(low if d is None else d, t or "", p or "") for d, t, p in rows]
    least: dict = {}
    for d, t, _ in docs:
        least[t] = min(d, least.get(t, d))
    good, toxic = ({d for d, q, x in labels if (q, x)[k] == 1} for k in (0, 1))
    out, shapley = {}, {}
    for part in {p for _, _, p in docs}:
        own = [(d, fails(t, d == least[t])) for d, t, p in docs if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order):
                here = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                failed = sum(x[1][f] for x in own)
                alone = sum(x[1][f] and sum(x[1].values()) == 1 for x in own)
                lost = [sum(x[0] in s for x in here) for s in (good, toxic)]
                out[part, order, step + 1] = (len(left), len(here), failed - len(here), alone, *lost)
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in (*NAMES, "shapley")) for r in rows}
    assert len(found) == len(rows)
    return found


def documents():
    many = " ".join(f"w{k}" for k in range(120))
    few = " ".join(f"w{k % 20}" for k in range(120))
    texts = [many, few, many + " $", few + " #", many.upper(), "SHOUT", "", None, many, many, few, "short|", many.title() + " É"]
    return [(k % 37 - 3, texts[k % len(texts)], ["en", "fr", None, ""][k % 4]) for k in range(90)] + [(None, many, "en"), (None, "unlike", "de")]


def test_against_every_order(spark):
    rows = documents()
    labels = [(k, k % 2, (k // 2) % 2) for k in range(-5, 30, 2)] + [(4, 0, 1), (4, 1, None), (None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert got(audit(df, spark.createDataFrame(labels, LABELS))) == plain(rows, labels)


def test_edges(spark):
    labels = spark.createDataFrame([(4, 1, 0), (6, 1, 1)], LABELS)
    expected = plain([(r[0], r[1], r[2]) for r in awkward_rows()], [(4, 1, 0), (6, 1, 1)])
    assert got(audit(awkward(spark), labels)) == expected
    assert same_rows(audit(clashing(awkward(spark)), clashing(labels)), audit(awkward(spark), labels))
    assert audit(empty(spark), labels).count() == 0
    assert all(v[4] == v[5] == 0 for v in got(audit(awkward(spark), labels.limit(0))).values())


@pytest.mark.parametrize("copies", [400])
def test_copies_collapse_before_the_exchange(spark, copies):
    rows = [(k, "one text", "en") for k in range(copies)]
    found = got(audit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([], LABELS)))
    assert found["en", "EABCD", 1][:2] == (1, copies - 1) and found["en", "EABCD", 2][:3] == (0, 1, copies - 1)
