from __future__ import annotations

import hashlib
import random

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm.repeats import digests, remove_repeats


def plain(rows, width=50):
    """Windows in a dictionary, bytes in a set."""
    rows = [(-(2**63) if doc is None else doc, (text or "").encode()) for doc, text in rows]
    least: dict[bytes, int] = {}
    for doc, text in rows:
        for p in range(len(text) - width + 1):
            w = text[p : p + width]
            least[w] = min(least.get(w, doc), doc)
    out = []
    for doc, text in rows:
        gone = set()
        for p in range(len(text) - width + 1):
            if least[text[p : p + width]] < doc:
                gone.update(range(p, p + width))
        spans = sum(p - 1 not in gone for p in gone)
        kept = bytes(c for p, c in enumerate(text) if p not in gone)
        out.append((None if doc == -(2**63) else doc, len(text), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_against_plain_python(spark):
    rng = random.Random(5)

    def letters(n):
        return "".join(rng.choice("ab é") for _ in range(n))

    shared = [letters(rng.randint(40, 200)) for _ in range(15)]
    rows = [
        (i, "".join(rng.choice([rng.choice(shared)[rng.randint(0, 30) :], letters(rng.randint(0, 40))]) for _ in range(rng.randint(0, 10))))
        for i in range(150)
    ]
    rows += [(5, "a" * 300), (7, "a" * 300), (8, None), (9, "b" * 49), (3, "b" * 50), (1000, "b" * 51), (None, "b" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(digests(remove_repeats(df))) == plain(rows)


def test_awkward_rows(spark):
    rows = [(r[0], r[1] if r[0] != 4 else "word " * 300) for r in awkward_rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(digests(remove_repeats(df))) == plain(rows)
    assert same_rows(remove_repeats(clashing(df)), remove_repeats(df))
    assert remove_repeats(empty(spark)).count() == 0
    assert remove_repeats(awkward(spark)).count() == len(awkward_rows())


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 4000")
    assert rows_of(digests(remove_repeats(docs))) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_kept_bytes_and_places(spark):
    shared = "a passage that two of them hold, long enough to be found again"
    rows = [(1, f"first {shared} é"), (2, f"é {shared}; then {shared}!"), (3, "nothing of it")]
    got = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows:
        raw, r = text.encode(), got[doc]
        cut = list(zip(r["starts"], r["ends"], strict=True))
        assert r["n_bytes"] == len(raw)
        assert bytes(r["kept"]) == b"".join(raw[a:b] for a, b in zip([0, *r["ends"]], [*r["starts"], len(raw)], strict=True))
        assert cut == ([] if doc != 2 else [(raw.find(shared.encode()) - 1, raw.find(shared.encode()) + len(shared)), (raw.rfind(shared.encode()) - 1, raw.rfind(shared.encode()) + len(shared))])
