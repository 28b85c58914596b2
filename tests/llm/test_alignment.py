from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm import alignment
from trackloom.llm.aligned import Aligner, byte_characters
from trackloom.llm.alignment import align, merged, packed, unpacked, with_best
from trackloom.llm.tokens import vocabulary

PIECES = [" ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "a", "foo", "Bar", "'s", "'", "12", "é", "日本", "▁", "<s>", "</s>",
          "<|endoftext|>", "<0x41>", "😀", "\x00", "...", "-", "ﬁ", "́", " "]


@pytest.fixture(scope="module")
def coder():
    return Aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def plain(coder, text):
    """(A's ids, B's ids, links, groups) of a whole text, token by token."""
    code = byte_characters()
    a = [(k, bytes(code[c] for c in coder.a.id_to_token(k))) for k in coder.a.encode(" " + (text or ""), add_special_tokens=False).ids]
    b = [(k, coder.piece_bytes(k)) for k in coder.b.encode(text or "")]
    raw = (" " + (text or "")).encode()
    if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return [], [], [], ""
    links, groups, i, j, at, bt, ga, gb = [], [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at <= bt:
            ga.append(a[i][0])
            at += len(a[i][1])
            i += 1
        else:
            gb.append(b[j][0])
            bt += len(b[j][1])
            j += 1
        if at == bt and ga and gb:
            links.append((ga[-1], gb[-1]))
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            ga, gb = [], []
    return [k for k, _ in a], [k for k, _ in b], links, ";".join(groups)


def expected(coder, rows):
    texts = [(doc, plain(coder, text)) for doc, text in rows]
    counts = Counter(x for _, (_, _, links, _) in texts for x in links)
    best: dict = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc, (a, b, links, groups) in texts:
        of_best = sum(counts[x] == best[x[1]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if links else ""
        out.append((doc, len(a), len(b), len(links), len(links), of_best, sum(counts[x] for x in links), digest))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r)) for r in align(df).collect())


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return [(k, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))) for k in range(n)]


def test_texts_in_chunks_equal_whole_texts(coder):
    texts = [t for _, t in odd_texts(3000)] + ["x" * 2000, "word " * 500, " a", "a ", " ", "  "]
    for text, found in zip(texts, coder.align(texts), strict=True):
        a, b, links, groups = plain(coder, text)
        if not links:
            assert found is None
            continue
        assert (found[0], found[1], found[3]) == (len(a), len(b), groups)
        assert found[2].tolist() == [y << 16 | x for x, y in links]


def test_against_plain_counting(spark, coder, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == expected(coder, rows)


def test_many_blocks(spark, coder, monkeypatch):
    """More runs than a task merges: two levels, and several groups of blocks."""
    monkeypatch.setattr(alignment, "DOCS", 5)
    monkeypatch.setattr(alignment, "FAN", 4)
    monkeypatch.setattr(alignment, "TOGETHER", 8)
    rows = odd_texts(300, 2) + [(k, "the same text, again and again") for k in range(300, 400)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == expected(coder, rows)


def test_edges(spark, coder):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert got(awkward(spark)) == expected(coder, rows)
    assert align(empty(spark)).count() == 0
    assert same_rows(align(clashing(awkward(spark))), align(awkward(spark)))
    nothing = spark.createDataFrame([(1, None), (None, ""), (2, "▁")], "doc_id long, text string")
    assert got(nothing) == expected(coder, [(1, None), (None, ""), (2, "▁")])


def test_merge_and_maxima():
    rng = np.random.default_rng(3)
    runs, total = [], Counter()
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 1 << 19, rng.integers(1, 4000)))
        counts = rng.integers(1, 9, len(pairs))
        total.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        runs.append([[pairs[k : k + 100], counts[k : k + 100]] for k in range(0, len(pairs), 100)])
    best: dict = defaultdict(int)
    for p, n in total.items():
        best[p >> 16] = max(best[p >> 16], n)
    out = [x for part in with_best(merged([iter(r) for r in runs])) for x in zip(*(c.tolist() for c in part), strict=True)]
    assert out == [(p, total[p], int(total[p] == best[p >> 16])) for p in sorted(total)]


def test_numbers_come_back():
    columns = [np.array([5, 0, 2**40]), np.zeros(0, dtype=np.int64) + 1, np.array([-3])]
    columns[1] = np.array([7])
    assert [x.tolist() for x in unpacked(packed(*columns))] == [c.tolist() for c in columns]
