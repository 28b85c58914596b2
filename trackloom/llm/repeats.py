"""Exact repeated passages by a depth-limited radix sort of suffixes.

Only the first `width` bytes of a suffix matter: its window. Windows are ordered by most-significant-digit passes, and a group
is passed on only while it may still hold windows of several documents; what ends up in one group is repeated.

* First digit: the window's anchor, its 24-byte string of least hash. Neighbouring windows share an anchor, so a run of some
  14 windows costs one key. With it goes the run's whole text, as a hash: runs that agree in both are settled together.
* Last digit: the window itself, only for runs whose anchor several documents share in different surroundings.

Digits travel as hashes of 96 bits (see `packed`), once per block of documents, with the least document; so a passage in a third
of all documents is one key per block, and no task sees a list of its occurrences. A window is repeated if its group's
least document is smaller than its own. Repeated windows of a document are then laid over its bytes.

Cases: a null text is the empty text; texts shorter than the width lose nothing. Rows that share an id do not repeat each
other. A null id counts as the smallest. Repeats inside one document stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import as_bytes
from trackloom.llm.packed import Keys, answer, ask, blocks_of, bucket_bits, starts_of

WIDTH = 50
#: Longer anchors are shared less often by chance, shorter ones are fewer.
ANCHOR = 24
#: Windows that are looked at together; longer texts are taken in parts.
PART = 1 << 22
SETTLED, REPEATED, OPEN = 0, 1, 2

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
BYTE = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> U(31)) * ODD[3]
    return x ^ x >> U(29)


def join(left: np.ndarray, right: np.ndarray, odd: np.uint64) -> np.ndarray:
    return (left ^ left >> U(32)) * odd + right


def hashes_of(text: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all anchors and of all windows of a text."""
    x = BYTE[np.frombuffer(text, dtype=np.uint8)]
    for k, step in enumerate((1, 2, 4, 8)):
        x = join(x[:-step], x[step:], ODD[k])
    more = ANCHOR - 16
    anchor = mix(join(x[: len(x) - more], x[more:], ODD[4]))
    wide = join(x[: len(x) - 16], x[16:], ODD[4])  # of 32 bytes
    n, tail = len(text) - width + 1, width - 32
    return anchor, join(wide[:n], wide[tail : tail + n], ODD[5])


def runs_of(text: bytes, width: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, last window, hash of the anchor, hash of the run's text."""
    anchors, window = hashes_of(text, width)
    n = len(window)
    best = anchors & ~U(PART * 4 - 1) | np.arange(len(anchors), dtype=np.uint64)
    size, span = 1, width - ANCHOR + 1
    while size * 2 <= span:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    best = np.minimum(best[:n], best[span - size : span - size + n])
    place = (best & U(PART * 4 - 1)).astype(np.int64)
    first = np.flatnonzero(starts_of(place))
    last = np.append(first[1:], n) - 1
    at = place[first]
    whole = mix(window[first] * ODD[0] + mix(window[last]) * ODD[1] + (last - first).astype(np.uint64) * ODD[2] + (at - first).astype(np.uint64))
    return first, last, anchors[at], whole


class Runs:
    """The runs of all documents of a block, by rising document."""

    def __init__(self, docs: pa.Table, width: int):
        keys = docs.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        self.ids = [docs.column("id")[int(k)].as_py() for k in order]
        texts = as_bytes(docs.column("text"))
        self.texts = [texts[k] for k in order]
        self.keys = keys[order]
        self.width = width
        #: (document, first window) of each part that is looked at by itself.
        self.parts = [(d, at) for d, t in enumerate(self.texts) for at in range(0, max(0, len(t) - width + 1), PART)]
        found = [runs_of(self.text_of(p), width) for p in range(len(self.parts))]
        none = (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),) * 2
        self.first, self.last, self.gram, self.whole = (np.concatenate(c) for c in zip(*found, strict=True)) if found else none
        self.part = np.repeat(np.arange(len(found)), [len(f[0]) for f in found]).astype(np.int64)
        self.doc = np.array([d for d, _ in self.parts], dtype=np.int64)[self.part]
        self.starts = np.array([at for _, at in self.parts], dtype=np.int64)

    def text_of(self, part: int) -> bytes:
        d, at = self.parts[part]
        return self.texts[d][at : at + PART + self.width - 1]

    def keys_of_runs(self) -> Keys:
        # an anchor is the least of many hashes: mixed anew, or nearly all would lie in the first buckets
        return Keys(mix(self.gram), self.whole, self.keys[self.doc])

    def keys_of_windows(self, runs: np.ndarray) -> tuple[Keys, np.ndarray, np.ndarray]:
        """Of the windows in the given runs; with each window's run and place in its part."""
        sizes = self.last[runs] - self.first[runs] + 1
        run = np.repeat(runs, sizes)
        place = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.first[run]
        hashes = np.zeros(len(run), dtype=np.uint64)
        parts = self.part[run]  # rising, as the runs are
        edges = np.flatnonzero(starts_of(parts)).tolist()
        for at, end in zip(edges, [*edges[1:], len(run)], strict=True):
            hashes[at:end] = hashes_of(self.text_of(parts[at]), self.width)[1][place[at:end]]
        return Keys(mix(hashes), mix(hashes * ODD[1] + self.gram[run]), self.keys[self.doc[run]]), run, place


def open_runs(runs: Runs, keys: Keys, codes: np.ndarray) -> np.ndarray:
    """Runs whose windows are to be compared one by one: those of the least document of an open key."""
    least = runs.keys[runs.doc] == keys.owner[keys.of]
    return np.flatnonzero((codes[keys.of] == OPEN) & least)


def judge_runs(hi: np.ndarray, lo: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A later document with the same run repeats it. The first is open if other documents share the anchor only."""
    by_anchor, by_run = starts_of(hi), starts_of(hi, lo)
    least = owner[np.flatnonzero(by_run)][np.cumsum(by_run) - 1]
    anchors = np.flatnonzero(by_anchor)
    most = np.maximum.reduceat(owner, anchors) if len(owner) else owner
    fewest = np.minimum.reduceat(owner, anchors) if len(owner) else owner
    several = np.add.reduceat(by_run.astype(np.int64), anchors) > 1 if len(owner) else anchors
    shared = (several & (most > fewest))[np.cumsum(by_anchor) - 1]
    return np.where(owner > least, REPEATED, np.where(shared, OPEN, SETTLED)).astype(np.uint8)


def judge_windows(hi: np.ndarray, lo: np.ndarray, owner: np.ndarray) -> np.ndarray:
    new = starts_of(hi, lo)
    return (owner > owner[np.flatnonzero(new)][np.cumsum(new) - 1]).astype(np.uint8)


def laid_over(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """(rest, starts and ends of removed runs) when the stretches between starts and ends are taken out."""
    if not len(starts):
        return text, [], []
    edges = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    gone = np.cumsum(edges[:-1]) > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
    return np.frombuffer(text, dtype=np.uint8)[~gone].tobytes(), turns[::2].tolist(), turns[1::2].tolist()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, n_bytes, kept, starts, ends): each byte in a window that also starts in a smaller document goes.

    `kept` are the bytes that stay, `starts` and `ends` the places of the maximal removed runs, ends exclusive. The width lies between 32 and 64 bytes. One exchange of the texts serves all three passes.
    """
    if not 32 <= width <= 64:
        raise ValueError("the width lies between 32 and 64 bytes")
    blocks, count = blocks_of(docs, id_col, text_col)
    bits = bucket_bits(count)

    def first_digit(block: int, table: pa.Table, _: None) -> pa.Table:
        return Runs(table, width).keys_of_runs().questions(block, bits)

    def last_digit(block: int, table: pa.Table, got: pa.Table) -> pa.Table:
        runs = Runs(table, width)
        keys = runs.keys_of_runs()
        chosen = open_runs(runs, keys, keys.answers(got, 1, bits))
        return runs.keys_of_windows(chosen)[0].questions(block, bits)

    def remove(block: int, table: pa.Table, got: pa.Table) -> pa.Table:
        runs = Runs(table, width)
        keys = runs.keys_of_runs()
        codes = keys.answers(got, 1, bits)
        chosen = open_runs(runs, keys, codes)
        single, run, place = runs.keys_of_windows(chosen)
        later = runs.keys[runs.doc] > keys.owner[keys.of]
        whole = np.flatnonzero(later | (codes[keys.of] == REPEATED))
        dup = (single.answers(got, 2, bits)[single.of] == 1) | (runs.keys[runs.doc[run]] > single.owner[single.of])
        # a repeated run is one stretch, as is a repeated window
        run = np.concatenate([run[dup], whole])
        first, last = np.concatenate([place[dup], runs.first[whole]]), np.concatenate([place[dup], runs.last[whole]])
        doc, base = runs.doc[run], runs.starts[runs.part[run]]
        order = np.argsort(doc, kind="stable")
        first, last = (first + base)[order], (last + base + width)[order]
        edges = np.searchsorted(doc[order], np.arange(len(runs.texts) + 1))
        out = [laid_over(t, first[edges[d] : edges[d + 1]], last[edges[d] : edges[d + 1]]) for d, t in enumerate(runs.texts)]
        kept, starts, ends = zip(*out, strict=True) if out else ((), (), ())
        places = pa.list_(pa.int64())
        return pa.table(
            {
                "id": pa.array(runs.ids, pa.int64()),
                "n_bytes": pa.array([len(t) for t in runs.texts], pa.int64()),
                "kept": pa.array(kept, pa.binary()),
                "starts": pa.array(starts, places),
                "ends": pa.array(ends, places),
            }
        )

    anchors = answer(ask(blocks, first_digit), 1, judge_runs)
    windows = answer(ask(blocks, last_digit, anchors), 2, judge_windows)
    result = ask(blocks, remove, anchors.unionByName(windows), "id long, n_bytes long, kept binary, starts array<long>, ends array<long>")
    return result.withColumnRenamed("id", id_col)


def digests(cleaned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of what `remove_repeats` gives."""
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed")
    return cleaned.select(id_col, "n_bytes", removed, F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
