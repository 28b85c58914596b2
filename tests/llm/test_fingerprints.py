from __future__ import annotations

import hashlib

import pytest

from tests.llm.helpers import awkward, awkward_rows, clashing, empty, same_rows
from trackloom.llm import fingerprints as fp


def test_against_plain_python(spark):
    rows = sorted(((r[0] if r[0] is not None else -(2**63), r[1] or "") for r in awkward_rows()))
    want = []
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        changed = fp.edited(text, following).encode()
        a, b, c = fp.digest(text.encode()), fp.digest(changed), fp.digest(following.encode())
        want.append((None if doc == -(2**63) else doc, len(text), hashlib.sha256(changed).hexdigest(), fp.encode(a), fp.encode(b), fp.likeness(a, b), fp.likeness(a, c)))
    got = [tuple(r) for r in fp.compare_with_edited(awkward(spark)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_edges(spark):
    assert fp.compare_with_edited(empty(spark)).count() == 0
    one = fp.compare_with_edited(awkward(spark).where("doc_id = 9")).first()
    assert one["near_next"] == 1.0
    assert same_rows(fp.compare_with_edited(clashing(awkward(spark))), fp.compare_with_edited(awkward(spark)))
    assert fp.fingerprint(awkward(spark)).count() == len(awkward_rows())


def test_digest_reads_back_and_differs_within_bounds():
    texts = [b"", b"a", b"abc" * 50, bytes(range(256)) * 8, b"z" * 100_000]
    codes = [fp.digest(t) for t in texts]
    for a in codes:
        back = fp.decode(fp.encode(a))
        assert back[0] == a[0] and (back[1] == a[1]).all()
        for b in codes:
            assert 0 <= fp.difference(a, b) == fp.difference(b, a) <= fp.MOST
        assert fp.likeness(a, a) == 1.0


def test_edited_text_is_nearer_than_the_next(spark, sf_dir):
    rows = fp.compare_with_edited(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) / len(rows) > 0.97
    assert sum(r["near_edited"] for r in rows) / len(rows) == pytest.approx(0.91, abs=0.05)
