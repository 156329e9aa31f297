"""Token ids of many texts at once, equal to the public byte-level BPE.

A chunk of texts is split into the tokenizer's pre-tokens with numpy; each
distinct pre-token is encoded once per worker by the tokenizer itself (all new
ones of a chunk in one call) and the ids are spread back over the texts. The
vocabulary file is a parameter; texts are ordinary text throughout, special
tokens' names included.
"""

from __future__ import annotations

import base64
import sys
import unicodedata

import numpy as np

from prefweave.llm.textarrays import span_hashes

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
CACHE_SIZE = 1 << 20           # pre-tokens a worker keeps; the cache then starts anew

# Unicode white space, and the endings split off after an apostrophe.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_classes: np.ndarray | None = None


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def classes() -> np.ndarray:
    """Class of every code point, built once per process."""
    global _classes
    if _classes is None:
        first = np.fromiter((ord(unicodedata.category(chr(c))[0]) for c in range(sys.maxunicode + 1)), np.uint8,
                            sys.maxunicode + 1)
        table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
        table[first == ord("L")] = LETTER
        table[first == ord("N")] = NUMBER
        table[WHITE_SPACE] = SPACE
        _classes = table
    return _classes


def pre_tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(byte start, byte end, is white space, row offsets) of the pre-tokens."""
    n_rows = len(offs) - 1
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, bool), np.zeros(n_rows + 1, np.int64)
    at = np.flatnonzero((buf & 0xC0) != 0x80)                  # byte of each character
    code = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    n = len(code)
    row = np.searchsorted(at, offs)                            # first character of each row, and n
    opens = np.zeros(n + 1, dtype=bool)
    opens[row] = True
    kind = classes()[code]
    run = opens[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    run[0] = True
    blank = np.zeros(n, dtype=bool)                            # an ordinary space just before, in the same row
    blank[1:] = (code[:-1] == 32) & ~opens[1:n]
    start = run & ((kind == SPACE) | ~blank)
    # The last of several spaces stands apart if something follows it in the row.
    first = np.flatnonzero(run)
    end = np.append(first[1:], n)
    apart = (kind[first] == SPACE) & (end - first >= 2) & ~opens[end]
    start[end[apart] - 1] = True
    # 's, 't, 're, ...: the apostrophe takes its ending along.
    for i in np.flatnonzero((code == 39) & start):
        for ending in ENDINGS:
            stop = i + 1 + len(ending)
            if stop <= n and not opens[i + 1:stop].any() and all(code[i + 1 + j] == ord(c) for j, c in enumerate(ending)):
                start[i + 1:stop] = False
                if stop < n:
                    start[stop] |= not (code[stop - 1] == 32)
                break
    first = np.flatnonzero(start)
    begin = at[first]
    return (begin, np.append(begin[1:], len(buf)), kind[first] == SPACE, np.searchsorted(first, row))


class Encoder:
    """Ids of chunks of texts; one per worker process and vocabulary."""

    _shared: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, vocabulary: str) -> "Encoder":
        if vocabulary not in cls._shared:
            cls._shared[vocabulary] = cls(vocabulary)
        return cls._shared[vocabulary]

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.newline = ranks[b"\n"]
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _add(self, keys: np.ndarray, tokens: list[bytes], white: np.ndarray) -> None:
        """Encode new pre-tokens: words in one call, parted by newlines."""
        sizes = np.zeros(len(tokens), np.int64)
        ids = [np.zeros(0, np.uint32)] * len(tokens)
        solid = np.flatnonzero(~white)
        if len(solid):
            text = b"\n".join(tokens[i] for i in solid).decode("utf-8")
            got = np.asarray(self.bpe.encode_to_numpy(text), dtype=np.uint32)
            for i, part in zip(solid, np.split(got, np.flatnonzero(got == self.newline))):
                ids[i] = part if i == solid[0] else part[1:]
        for i in np.flatnonzero(white):
            ids[i] = np.asarray(self.bpe.encode_ordinary(tokens[i].decode("utf-8")), dtype=np.uint32)
        sizes[:] = [len(v) for v in ids]
        first = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, *ids])
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.first = np.insert(self.first, where, first)
        self.size = np.insert(self.size, where, sizes)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the whole chunk, row offsets into them)."""
        begin, end, white, rows = pre_tokens(buf, offs)
        if len(begin) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        keys, which, back = np.unique(span_hashes(buf, begin, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > CACHE_SIZE:
            self._reset()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = which[~known]
            self._add(keys[~known], [buf[a:b].tobytes() for a, b in zip(begin[new], end[new])], white[new])
            at = np.searchsorted(self.keys, keys)
        size = self.size[at][back]
        stop = np.cumsum(size)
        out = np.arange(int(stop[-1])) + np.repeat(self.first[at][back] - (stop - size), size)
        return self.ids[out], np.concatenate([[0], stop])[rows]
