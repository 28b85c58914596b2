"""Two tokenizers over one text: where their tokens end together."""

from __future__ import annotations

import os
import re

import numpy as np

#: Chunks that a worker remembers, and the longest that it does.
CACHE, LONGEST = 300_000, 256
#: Chunks that are tokenized as one text.
TOGETHER = 64
#: A blank behind other white space, or at the end.
IRREGULAR = re.compile(r"\s(?: |\Z)")
#: What byte-level vocabularies write for a byte: itself where it is printable, else a character from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_characters() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(0x100 + k): b for k, b in enumerate(others)}


def chunks_of(text: str) -> list[str]:
    """Parts of blank + text, each without the blank it starts with.

    Cuts lie before a blank that follows no white space and does not end the text. Neither tokenizer has a token across such a place, and
    both go on behind it as they would at the start.
    """
    parts = text.split(" ")
    if not IRREGULAR.search(" " + text):
        return parts
    out, held = [], [parts[0]]
    for part in parts[1:]:
        if not held[-1] or held[-1][-1].isspace():
            held.append(part)
        else:
            out.append(" ".join(held))
            held = [part]
    last = " ".join(held)
    if not last and out:
        out[-1] += " "
    else:
        out.append(last)
    return out


class Aligner:
    """Groups and links of texts under two vocabularies, A byte-level and B of pieces.

    What is known of a chunk: tokens of A, tokens of B, a number of 32 bits for each group's link (B's id above A's), and the groups as
    text; None if the tokens of a vocabulary do not give the chunk's bytes.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        code = byte_characters()
        size_a, size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        if max(size_a, size_b) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.bytes_a = [bytes(code.get(c, 0) for c in self.a.id_to_token(k)) for k in range(size_a)]
        self.bytes_b = [self.piece_bytes(k) for k in range(size_b)]
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.known: dict[str, tuple[int, int, bytes, str] | None] = {}

    def piece_bytes(self, piece: int) -> bytes:
        name = self.b.id_to_piece(piece)
        return bytes([int(name[1:-1], 16)]) if self.b.is_byte(piece) else name.replace("▁", " ").encode()

    def align(self, texts: list[str]) -> list[tuple[int, int, np.ndarray, str] | None]:
        """(tokens of A, tokens of B, links, groups) of each text; None for a text without tokens."""
        if len(self.known) > CACHE:
            self.known = {}
        split = [chunks_of(t) if t else None for t in texts]
        known = self.known
        fresh = {c for chunks in split if chunks for c in chunks if c not in known}
        self.learn(list(fresh))
        out = []
        for chunks in split:
            found = [known[c] for c in chunks] if chunks else [None]
            if None in found:
                out.append(None)
                continue
            a, b, links, groups = zip(*found, strict=True)
            out.append((sum(a), sum(b), np.frombuffer(b"".join(links), dtype="<u4"), ";".join(groups)))
        for c in fresh:
            if len(c) > LONGEST:
                del known[c]
        return out

    def learn(self, chunks: list[str]) -> None:
        """Regular chunks many at a time, as one text: it is cut where they are."""
        regular = [c for c in chunks if c and not c[-1].isspace() and "▁" not in c and len(c) <= LONGEST]
        groups = [regular[at : at + TOGETHER] for at in range(0, len(regular), TOGETHER)]
        self.learn_groups(groups)
        self.learn_groups([[c] for c in chunks if c not in self.known])

    def learn_groups(self, groups: list[list[str]]) -> None:
        texts = [" ".join(g) for g in groups]
        encoded = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        for group, text, a, b in zip(groups, texts, encoded, self.b.encode(texts, num_threads=1), strict=True):
            found = self.cut(group, (" " + text).encode(), a.ids, b)
            if found is not None:
                self.known.update(zip(group, found, strict=True))
            elif len(group) == 1:
                self.known[group[0]] = None

    def cut(self, group: list[str], raw: bytes, a: list[int], b: list[int]) -> list[tuple] | None:
        """What is known of each chunk of a group; None if tokens do not give the bytes, or run across chunks."""
        if b"".join([self.bytes_a[k] for k in a]) != raw or b"".join([self.bytes_b[k] for k in b]) != raw:
            return None
        ids_a, ids_b = np.array(a), np.array(b)
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        ends = np.cumsum([len(c.encode()) + 1 for c in group])
        last = np.searchsorted(common, ends)
        if not np.array_equal(common[last], ends):
            return None
        at_a, at_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        links = (ids_b[at_b] << 16 | ids_a[at_a]).astype("<u4").tobytes()
        of_a, of_b, stops = [0, *(at_a + 1).tolist()], [0, *(at_b + 1).tolist()], [0, *(last + 1).tolist()]
        names_a, names_b = list(map(str, a)), list(map(str, b))
        told = [f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}" for i, j, k, m in zip(of_a, of_a[1:], of_b, of_b[1:], strict=False)]
        return [
            (of_a[e] - of_a[s], of_b[e] - of_b[s], links[4 * s : 4 * e], ";".join(told[s:e])) for s, e in zip(stops, stops[1:], strict=False)
        ]


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process, with what it knows."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]
