from __future__ import annotations

import zlib
from collections import Counter

from tests.llm.helpers import awkward, awkward_rows, clashing, empty
from trackloom.llm import languages


def plain_ranking(text, length):
    words = "".join(c if c.isalpha() or ord(c) >= 128 else " " for c in text.lower()).split()
    line = (" " + " ".join(words) + " ").encode()
    counts = Counter()
    for k, c in enumerate(line):
        if 0 < k < len(line) - 1 and c != 32:
            counts[c] += 1
        if k + 1 < len(line):
            counts[c << 8 | line[k + 1]] += 1
        if k + 2 < len(line) and line[k + 1] != 32:
            counts[c << 16 | line[k + 1] << 8 | line[k + 2]] += 1
    return sorted(counts, key=lambda g: (-counts[g], g))[:length]


def test_profiles_and_distances():
    texts = {"en": "the cat and the hat on the mat", "fr": "le chat et le chapeau sur le tapis", "de": "die Katze und der Hut über der Matte"}
    for text in [*texts.values(), "a", "Ünïcode 12 3x"]:
        got = languages.ranking(*languages.counted(languages.grams(text.encode())), 400).tolist()
        assert got == plain_ranking(text, 400)
    profiles = {k: plain_ranking(t, 400) for k, t in texts.items()}
    model = languages.Classifier(profiles)
    own = plain_ranking("the hat", 400)
    distance = {k: sum(abs(p.index(g) - r) if g in p else 400 for r, g in enumerate(own)) for k, p in profiles.items()}
    lang, score = model.predict(b"the hat")
    assert lang == min(distance, key=distance.get) == "en"
    assert abs(score - (1 - distance["en"] / (400 * len(own)))) < 1e-6


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in languages.identify(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [d for d, r in got.items() if r["held_out"] and truth[d]]
    assert sum(got[d]["lang_pred"] == truth[d] for d in held) / len(held) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'xx', lang) as lang")
    a, b = ({r["doc_id"]: r["lang_pred"] for r in languages.identify(d).collect()} for d in (docs, changed))
    assert a == b


def test_edges(spark):
    rows = languages.identify(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows())
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 8}
    assert languages.identify(empty(spark)).count() == 0
    unlabelled = awkward(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in languages.identify(unlabelled).collect()} == {"und"}
    extra = clashing(awkward(spark))
    assert sorted(map(repr, languages.identify(extra).collect())) == sorted(map(repr, rows))
    kept = languages.keep_identified(extra)
    assert kept.columns == extra.columns and kept.count() == len(awkward_rows()) - 4


def test_sample_is_bounded_and_exact(spark):
    """The rows of smallest hash, one of each, however many copies there are."""
    rows = [(k, f"text {k}", "ab"[k % 2]) for k in range(500)] + [(7, "text 7", "b")] * 300 + [(901, None, "a"), (902, "no label", None)]
    df = spark.createDataFrame(rows, "id long, text string, lang string").repartition(5)
    hashes = {(r["lang"], r["text"]): r["h"] for r in df.selectExpr("lang", "text", "xxhash64(id) as h").collect()}
    got = sorted((r["lang"], r["text"]) for r in languages.training_rows(df, 40).collect())
    want = [sorted((x for x in hashes if x[0] == lang and x[1]), key=hashes.get)[:40] for lang in "ab"]
    assert got == sorted(want[0] + want[1])
    assert languages.training_rows(df, 10_000).count() == 500


def test_what_is_rejected(spark):
    rows = [(k, "the cat and the hat on the mat near the old barn", "en") for k in range(5)]
    rows += [(10, "это другой язык и другие буквы", None), (11, "the barn and the cat", None), (12, "123", None), (13, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in languages.keep_identified(df).collect()} == {0, 1, 2, 3, 4, 11}
    # nothing is learnt, so nothing is rejected
    unlabelled = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert languages.keep_identified(unlabelled).count() == len(rows)
