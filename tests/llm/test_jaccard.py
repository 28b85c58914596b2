from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm.components import components
from trackloom.llm.jaccard import keep_one, near_duplicates


def plain(rows, width, percent):
    sets = []
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append((doc, {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()))
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders: dict = {}
    for k, (_, own) in enumerate(sets):
        common = Counter(o for s in own for o in holders.get(s, ()))
        for s in own:
            holders.setdefault(s, []).append(k)
        for o, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[o][1]) - n):
                parent[root(o)] = root(k)
    least: dict = {}
    for k, (doc, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), (True, 0)), (doc is not None, doc or 0)) if root(k) in least else (doc is not None, doc or 0)
    return sorted(repr((doc, len(own), least[root(k)][1] if least[root(k)][0] else None)) for k, (doc, own) in enumerate(sets)), Counter(
        least[k][1] if least[k][0] else None for k in {root(k) for k in range(len(sets))}
    )


def got(df, width, percent, **options):
    """Rows, and how many stay by component id: one of each component, though several may share their least id."""
    rows = near_duplicates(df, width=width, percent=percent, **options).collect()
    stay = Counter(r["component_id"] for r in rows if r["stays"])
    return sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in rows), stay


def edited_copies(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 6, 12, 30, 60, 150]))] for _ in range(25)]
    rows = []
    for doc in range(n):
        text = list(rng.choice(base[:6] if rng.random() < 0.5 else base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(text) + 1)
            if rng.random() < 0.5:
                text[at:at] = [rng.choice(words)]
            elif text:
                text.pop(min(at, len(text) - 1))
        rows.append((doc, " ".join(text)))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "ONE  two"), (1005, "three four five"), (2, "w1 w2"), (2, "w1 w2"), (-5, rows[0][1])]


@pytest.mark.parametrize(("seed", "width", "percent", "options"), [(1, 4, 85, {}), (2, 5, 80, {}), (3, 4, 85, {"long": 8})])
def test_against_all_pairs(spark, seed, width, percent, options):
    rows = edited_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df, width, percent, **options) == plain(rows, width, percent)


def test_edges(spark):
    assert got(awkward(spark), 4, 85) == plain([(r[0], r[1]) for r in awkward_rows()], 4, 85)
    assert near_duplicates(empty(spark)).count() == 0
    assert same_rows(near_duplicates(clashing(awkward(spark))), near_duplicates(awkward(spark)))


def test_one_of_each_stays(spark):
    df = clashing(awkward(spark))
    kept = keep_one(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 5 in ids and 6 not in ids and {1, 2, 3, None} <= set(ids)


def test_rows_stay_whatever_their_ids(spark):
    text = {k: " ".join(f"{k}{j}" for j in range(30)) for k in "abcxy"}
    rows = [(None, text["a"]), (None, text["b"]), (None, text["b"] + " more"), (None, None), (None, None), (5, text["x"]), (5, text["y"]), (3, text["y"]), (7, text["c"]), (7, text["c"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(map(repr, map(tuple, keep_one(df).collect())))
    assert kept in [sorted(map(repr, [(None, text["a"]), b, (None, None), (None, None), (5, text["x"]), (3, text["y"]), (7, text["c"])])) for b in rows[1:3]]


def test_components_along_a_path(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (103, 102), (102, 101), (7, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 104)}
