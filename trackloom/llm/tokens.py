"""Token ids of whole texts, with a cache of what stands between blanks."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cached pieces per worker; the cache starts anew beyond it.
CACHE = 300_000

#: Pieces of a chunk of printable ASCII without quotes and "<|": the tokenizer cuts at the same places.
ASCII_PIECES = re.compile(r"[a-z]+|[0-9]|[^a-z0-9\s]+")

#: Pieces that are given to the tokenizer at once.
TOGETHER = 32


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of a tokenizer that drops white space and cuts at it: each chunk between blanks stands for itself.

    Texts repeat their words, so each distinct chunk is tokenized once per worker.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Ids as narrow as the vocabulary allows.
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = np.dtype(self.kind).itemsize
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. The chunks of all texts are told apart first, so each is looked up once."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        chunks, index = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        held = self.ids_of(chunks)
        lengths = np.array([len(x) for x in held], dtype=np.int64) // self.width
        pool, starts = np.frombuffer(b"".join(held), dtype=self.kind), np.cumsum(lengths) - lengths
        counts = lengths[index]
        ends = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(counts)])
        ids = pool[np.repeat(starts[index] - ends[:-1], counts) + np.arange(ends[-1])]
        edges = ends[split.offsets.to_numpy()].tolist()
        return [ids[at:end] for at, end in zip(edges, edges[1:], strict=False)]

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known, self.pieces = {}, {}
        found = [self.known.get(c) for c in chunks]
        fresh = [c for c, x in zip(chunks, found, strict=True) if x is None]
        if not fresh:
            return found
        self.learn(fresh)
        return [self.known[c] for c in chunks]

    def learn(self, chunks: list[bytes]) -> None:
        plans, words, others = [], set(), set()
        for chunk in chunks:
            text = chunk.decode()
            if text.isascii() and text.isprintable() and "'" not in text and "<|" not in text:
                text = text.lower()
                parts = (text,) if text.isalpha() else ASCII_PIECES.findall(text)
                words.update(parts)
            else:
                parts = (text,)
                others.add(text)
            plans.append(parts)
        # such a word is one word to the tokenizer, so blanks may part them; other chunks are given as lists
        self.learn_pieces([w for w in words if w not in self.pieces], True)
        self.learn_pieces([w for w in others if w not in self.pieces], False)
        pieces = self.pieces
        for chunk, parts in zip(chunks, plans, strict=True):
            self.known[chunk] = pieces[parts[0]] if len(parts) == 1 else b"".join([pieces[p] for p in parts])

    def learn_pieces(self, pieces: list[str], joined: bool) -> None:
        groups = [pieces[at : at + TOGETHER] for at in range(0, len(pieces), TOGETHER)]
        texts = [" ".join(g) for g in groups] if joined else groups
        for group, found in zip(groups, self.tokenizer.encode_batch(texts, is_pretokenized=not joined, add_special_tokens=False), strict=True):
            raw = np.array(found.ids, dtype=self.kind).tobytes()
            edges = (np.searchsorted(np.array(found.word_ids), np.arange(len(group) + 1)) * self.width).tolist()
            for piece, at, end in zip(group, edges, edges[1:], strict=False):
                self.pieces[piece] = raw[at:end]


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process: Spark reuses its workers, and with them the cache."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
