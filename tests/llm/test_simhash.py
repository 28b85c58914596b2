from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm import golay
from trackloom.llm.components import components
from trackloom.llm.simhash import fingerprint, keys_of, links_of, near_duplicates


def plain_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[k : k + 3]).encode(), 42).intdigest() for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Of distinct numbers, by all pairs: the least that can be reached."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    ordered = sorted(prints)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def plain(rows):
    prints = [plain_print(t) for _, t in rows]
    label = plain_components(set(prints))
    least: dict = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            least[label[p]] = min(doc, least.get(label[p], doc))
    return sorted(repr((d, f"{p:016x}", least.get(label[p]))) for (d, _), p in zip(rows, prints, strict=True))


def got(df, **options):
    return sorted(repr((r["doc_id"], r["fingerprint"], r["component_id"])) for r in near_duplicates(df, **options).collect())


def edited(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    base = [[rng.choice(words) for _ in range(rng.choice([2, 20, 200, 400]))] for _ in range(12)]
    rows = []
    for doc in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((doc * 7 % n, " ".join(text)))
    return rows + [(1000, None), (1001, ""), (1002, "\t"), (None, rows[0][1]), (None, "all alone here with words of its own"), (3, "W1 w2"), (3, "w1  w2")]


def test_against_all_pairs(spark):
    rows = edited(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = plain(rows)
    assert got(df) == expected
    assert got(df, limit=2) == expected


def test_edges(spark):
    assert got(awkward(spark)) == plain([(r[0], r[1]) for r in awkward_rows()])
    assert near_duplicates(empty(spark)).count() == 0
    assert same_rows(near_duplicates(clashing(awkward(spark))), near_duplicates(awkward(spark)))


def test_long_texts_in_parts(monkeypatch):
    text = " ".join(str(k * k) for k in range(700))
    whole = fingerprint(text.encode())
    monkeypatch.setattr("trackloom.llm.simhash.PART", 64)
    assert fingerprint(text.encode()) == whole and whole % 2**64 == plain_print(text)


@pytest.mark.parametrize("limit", [2, 16])
def test_crowded_words(spark, limit):
    """Very many numbers around a few: keys fuller than any limit."""
    rng = random.Random(limit)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(150)} | {rng.getrandbits(64) for _ in range(200)}
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print long")
    links = links_of(df, limit)
    assert all((r["a"] ^ r["b"]).bit_count() <= 2 or ((r["a"] ^ r["b"]) % 2**64).bit_count() <= 2 for r in links.collect())
    found = {r["node"] % 2**64: r["label"] % 2**64 for r in components(links).collect()}
    expected = plain_components(prints)
    groups = lambda label: {frozenset(p for p in prints if label(p) == x) for x in {label(p) for p in prints}}
    assert groups(lambda p: found.get(p, p)) == groups(lambda p: expected[p])


def test_golay_code():
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000).astype(np.uint32)
    codewords = {i: (i << 11) | golay.remainder(i << 11) for i in range(1 << 12)}
    for w, i in zip(words[:200].tolist(), golay.decode(words[:200]).tolist(), strict=True):
        assert (w ^ codewords[i]).bit_count() <= 3
    which, index = golay.nearby(words[:50])
    for k, w in enumerate(words[:50].tolist()):
        assert set(index[which == k].tolist()) == {i for i, c in codewords.items() if (w ^ c).bit_count() <= 4}


def test_two_errors_share_a_key():
    rng = np.random.default_rng(2)
    prints = rng.integers(-(2**63), 2**63 - 1, 64)
    for first in range(64):
        for second in range(first, 64):
            p = prints[first : first + 1]
            q = (p.view(np.uint64) ^ (np.uint64(1) << np.uint64(first)) ^ (np.uint64(second > first) << np.uint64(second))).view(np.int64)
            assert set(keys_of(p)[1].tolist()) & set(keys_of(q)[1].tolist())
