"""License scan: ordered signature rules, gated by keywords, overlaps resolved by priority.

A text's A-Z are lower-cased; its words are the runs of digits, a-z and characters beyond ASCII. Each rule of
`license_rules` runs over the words joined by single spaces, but only if the text holds a keyword of the rule; one
automaton looks for all keywords at once. A detection whose interval of words lies within that of a rule of
better or equal rank (priority, then length, then order of the rules) is suppressed, except base phrases.

Cases: a null text is the empty text; without words there are no places, no labels and the score 0. Places
of one phrase may overlap and all count. Rows that repeat get the same result each.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackloom.llm import license_rules
from trackloom.llm.common import as_bytes, batch, map_batches

#: How much a detection of each priority says that the text carries a license.
WEIGHT = {license_rules.TAG: 0.95, license_rules.NOTICE: 0.9, license_rules.SENTENCE: 0.7, license_rules.MENTION: 0.4}

#: To lower case; all ASCII but digits and letters to blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Scanner:
    """The compiled rules. Build one per task."""

    def __init__(self, rules: list[tuple[str, int, str, str]] | None = None):
        rules = license_rules.rules() if rules is None else rules
        self.base = {(" " + phrase + " ").encode(): label for phrase, label in license_rules.BASE}
        self.rules = [(label, priority, re.compile(f" (?=({pattern}) )".encode())) for label, priority, _, pattern in rules]
        self.gates = ahocorasick.Automaton()
        by_key: dict[str, list[int]] = {}
        for k, (_, _, keyword, _) in enumerate(rules):
            for key in keyword.split("|"):
                by_key.setdefault(key, []).append(k)
        for keyword, numbers in by_key.items():
            self.gates.add_word(keyword, numbers)
        self.gates.make_automaton()

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        live = {k for _, numbers in self.gates.iter(line.decode("latin-1")) for k in numbers}
        found = kept(self.detections(line, sorted(live))) if live else []
        base = self.base_places(line) if live else []
        labels = {d[2] for d in found} | {label for _, label in base}
        doubt = 1.0
        for label in sorted(labels):
            doubt *= 1.0 - max([WEIGHT[license_rules.NOTICE] if any(b == label for _, b in base) else 0.0, *(WEIGHT[d[3]] for d in found if d[2] == label)])
        starts = [s for s, _ in base]
        gaps = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32) if found else None
        # a detection starts behind a blank and ends before one
        spans = sorted((int(np.searchsorted(gaps, d[0] - 1)), int(np.searchsorted(gaps, d[1])), d[2], d[3]) for d in found)
        return {
            "detections": [dict(zip(("start", "end", "label", "priority"), span, strict=True)) for span in spans],
            "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted({label for _, label in base})), "labels": ",".join(sorted(labels)), "score": round(1.0 - doubt, 6),
        }

    def base_places(self, line: bytes) -> list[tuple[int, str]]:
        """(first word, label) of each place of a base phrase."""
        places = []
        for phrase, label in self.base.items():
            at = line.find(phrase)
            while at >= 0:
                places.append((at, label))
                at = line.find(phrase, at + 1)
        if not places:
            return []
        gaps = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
        return [(int(np.searchsorted(gaps, at)), label) for at, label in places]

    def detections(self, line: bytes, live: list[int]) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, priority, rule) in bytes of the line, of every live rule."""
        return [(m.start(1), m.end(1), self.rules[k][0], self.rules[k][1], k) for k in live for m in self.rules[k][2].finditer(line)]


def kept(found: list[tuple[int, int, str, int, int]]) -> list[tuple[int, int, str, int, int]]:
    """Without detections that lie within one of better or equal rank."""
    best: list[tuple[int, int, str, int, int]] = []
    starts: list[int] = []  # of the outermost kept intervals; their ends rise with them
    ends: list[int] = []
    for d in sorted(found, key=lambda d: (d[3], d[0] - d[1], d[4], d[0])):
        k = bisect.bisect_right(starts, d[0])
        if k and ends[k - 1] >= d[1]:
            continue
        best.append(d)
        first = bisect.bisect_left(starts, d[0])
        last = bisect.bisect_right(ends, d[1])
        starts[first : max(first, last)] = [d[0]]
        ends[first : max(first, last)] = [d[1]]
    return best


KINDS = {
    "id": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
    "detections": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("priority", pa.int32())])),
}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, places of base phrases, labels, score, and `detections`. No exchange.

    Detections are those that stand: the words from `start` to before `end`, the label, and the priority of its rule.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in batches:
            rows = [scanner.scan(t) for t in as_bytes(b.column(1))]
            columns = {name: ([r[name] for r in rows], kind) for name, kind in KINDS.items() if name != "id"}
            yield batch({"id": (b.column(0).to_pylist(), pa.int64())} | columns)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    schema += ", detections array<struct<start: long, end: long, label: string, priority: int>>"
    return map_batches(rows, run, schema).withColumnRenamed("id", id_col)
