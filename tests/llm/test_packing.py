from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import awkward, awkward_rows, clashing, empty
from trackloom.llm.packing import VOCABULARY, Schedule, Sources, pack, plan_queues, sequences
from trackloom.llm.tokens import WordTokenizer, vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(VOCABULARY))


def check(rows, docs, tokenizer):
    """Every piece holds the right ids, every id is in one piece, and sequences have no gap."""
    ids = {k: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4") for k, t in docs.items()}
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(ids)
    for doc, mine in pieces.items():
        at = 0
        for r in sorted(mine, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[doc])
            assert r["ids_crc32"] == zlib.crc32(ids[doc][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[doc])
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 4096 + offset == at and offset + length <= 4096
        at += length


def test_round_trip(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(pack(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, tokenizer)


def test_awkward_rows(spark, tokenizer):
    df = awkward(spark).where("doc_id is null or doc_id <> 6")
    check(pack(df).collect(), {r[0]: r[1] for r in awkward_rows() if r[0] != 6}, tokenizer)
    assert sum(r["length"] for r in pack(awkward(spark).where("doc_id = 6")).collect()) == 2 * (len(tokenizer.encode("same text, twice").ids) + 1)
    assert pack(empty(spark)).count() == 0
    assert pack(clashing(awkward(spark))).count() == pack(awkward(spark)).count()


def test_sequences_hold_the_ids(spark, tokenizer):
    rows = [(k, f"text number {k} " * 40 * k, "ab"[k % 2]) for k in range(20)]
    held = defaultdict(dict)
    for r in sequences(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), window=256).collect():
        held[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(held[r["doc_id"]][r["start"]]) == r["length"]
    for doc, text, _ in rows:
        assert [x for _, ids in sorted(held[doc].items()) for x in ids] == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_cached_tokens_equal_the_tokenizer(tokenizer):
    texts = ["", "It's  HERE, isn't it?", "<|endoftext|> <|ENDOFTEXT|>x", "a\x1cb\x85c d Å H̱", "don’t 123abc 4.5", "É é é İ", "x" * 300]
    coder = WordTokenizer(vocabulary(VOCABULARY))
    for _ in range(2):
        for text, got in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("weights", [None, [3.0, 1.0, 2.0], [1.0, 0.0, 5.0]])
def test_schedule_places_every_token_once(weights):
    queues = [5000, 70, 12345]
    schedule = Schedule(queues, weights, 256)
    places = [p for q, n in enumerate(queues) for s in range(0, n, 37) for a, m in schedule.pieces(q, s, min(37, n - s)) for p in range(a, a + m)]
    assert sorted(places) == list(range(sum(queues)))


def test_windows_hold_the_mixture():
    queues = [50_000, 30_000, 20_000]
    schedule = Schedule(queues, None, 1000)
    windows = defaultdict(Counter)
    for q, n in enumerate(queues):
        for a, m in schedule.pieces(q, 0, n):
            for p in range(a, a + m):
                windows[p // 1000][q] += 1
    for mix in windows.values():
        assert all(abs(mix[q] - n / 100) <= 2 for q, n in enumerate(queues))


def test_small_sources_share_a_queue():
    of, queues = plan_queues({"a": 1000, "b": 900, None: 3, "z": 2}, None)
    assert queues == [["a"], ["b"], ["z", None]] and of[None] == 2


@pytest.mark.parametrize(
    "totals",
    [
        {f"s{k:03}": 2000 + k for k in range(100)},
        {f"s{k:03}": 1000 for k in range(150)} | {None: 40, "x": 1},
        {"large": 150_000, "other": 90_000} | {f"s{k:03}": 400 + 3 * k for k in range(80)},
        {f"s{k:04}": 30 for k in range(3000)},
    ],
)
def test_windows_hold_the_mixture_of_small_sources(totals):
    window, whole = 1000, sum(totals.values())
    sources, places, mixes = Sources(totals, None, window), [], defaultdict(Counter)
    for source, n in totals.items():
        for at in range(0, n, 701):
            for a, m in sources.pieces(source, at, min(701, n - at)):
                places += range(a, a + m)
                for p in range(a, a + m):
                    mixes[p // window][source] += 1
    assert sorted(places) == list(range(whole))
    rounds = -(-whole // window)
    for w, mix in mixes.items():
        if (w + 1) * window <= whole:
            # within one quantum and a few tokens of its share
            assert all(abs(mix[s] - n / rounds) <= n / rounds + 3 for s, n in totals.items())
    for source, n in totals.items():
        assert sum(mix[source] > 0 for mix in mixes.values()) >= min(n, rounds) * 0.8
