"""Token ids of whole texts with a public tokenizer, as Arrow batches.

Byte-level BPE never joins across a space that stands between two visible characters, nor across such a line break. A text
without other white space and without an added token is therefore cut there, and each distinct piece is encoded once per worker
process; all other texts go to the tokenizer whole. Both ways give the tokenizer's own ids (tested on random texts).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = 2
#: Pieces that a worker remembers before it drops those it met once.
CACHE_PIECES = 800_000
_BREAK = 198  # id of a single line break
_HEAD = "\0"  # marks a piece that no space precedes
# White space of Unicode other than space and line break, and the marker itself; looked for one by one, which is faster than a class.
_ODD = "\0\t\x0b\x0c\r\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_DOUBLE = ("  ", "\n\n", " \n", "\n ")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Index(dict):
    """Numbers pieces as they are first looked up, and lists them until they are encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


class Encoder:
    """Encodes batches of texts to one flat id array with row lengths; keeps distinct pieces in a table."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's own threads only get in the way
        self.tokenizer = Tokenizer.from_file(path)
        #: Texts of the tokenizer's added tokens; a text that holds one goes to the tokenizer whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most = cache_pieces
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.ids = np.empty(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.ends = np.zeros(1 << 12, np.int64)
        self.ends_used = 1
        self.uses = np.zeros(0, np.int64)

    def _trim(self) -> None:
        """Keep the pieces that were met again, at most half of the room: words met once are rarely met twice."""
        n = len(self.index)
        keep = self.uses[:n] >= 2
        if keep.sum() > self.most // 2:
            keep = np.zeros(n, bool)
            keep[np.argpartition(self.uses[:n], -(self.most // 2))[-(self.most // 2):]] = True
        pieces, uses, chosen = list(self.index), self.uses, np.flatnonzero(keep)
        flat, lengths = self._gather(chosen)
        self._forget()
        for i in chosen.tolist():
            self.index[pieces[i]] = len(self.index)
        self._add(flat, lengths)
        self.uses = uses[chosen] // 2

    def _gather(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chosen pieces in a row, and how many each has."""
        first = self.ends[chosen]
        lengths = self.ends[chosen + 1] - first
        until = np.cumsum(lengths)
        return self.ids[np.repeat(first - (until - lengths), lengths) + np.arange(int(lengths.sum()))], lengths

    def _add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        used = self.ends[self.ends_used - 1]
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.ends_used + len(lengths) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[used:used + len(flat)] = flat
        self.ends[self.ends_used:self.ends_used + len(lengths)] = used + np.cumsum(lengths)
        self.ends_used += len(lengths)

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces in their order, many in one string with line breaks between them."""
        for k in range(0, len(pieces), 20_000):
            texts = [p[1:] if p[0] == _HEAD else p if p == "\n" else f" {p}" for p in pieces[k:k + 20_000]]
            plain = [t for t in texts if t != "\n"]
            joined = ["\n".join([*plain[j:j + 500], ""]) for j in range(0, len(plain), 500)]
            flat = np.concatenate([np.asarray(row, self.ids.dtype) for row in [[], *self.encode_whole(joined)]])
            breaks = flat == _BREAK
            lengths, flat = np.diff(np.flatnonzero(breaks), prepend=-1) - 1, flat[~breaks]
            if len(plain) < len(texts):  # the line break is a piece too, once
                at = texts.index("\n")
                flat, lengths = np.insert(flat, lengths[:at].sum(), _BREAK), np.insert(lengths, at, 1)
            self._add(flat, lengths)

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text followed by the end id, and the number of ids of each."""
        plain = [
            i for i, t in enumerate(texts)
            if t and t[0] not in " \n" and t[-1] not in " \n" and not any(c in t for c in _ODD)
            and not any(d in t for d in _DOUBLE) and not any(a in t for a in self.added)
        ]
        parts = [(_HEAD + texts[i].replace("\n", f" \n {_HEAD}")).split(" ") for i in plain]
        if len(self.index) > self.most:
            self._trim()
        chosen = np.fromiter(
            map(self.index.__getitem__, chain.from_iterable(parts)), np.int64, count=sum(map(len, parts))
        )
        if self.index.new:
            self._learn(self.index.new)
            self.index.new = []
        seen = np.bincount(chosen, minlength=len(self.index))
        seen[:len(self.uses)] += self.uses
        self.uses = seen
        counts = np.zeros(len(texts), np.int64)
        flat, length = self._gather(chosen)
        until = np.cumsum(length)
        edges = np.concatenate([[0], until])[np.cumsum([0, *map(len, parts)])]
        rows: dict[int, np.ndarray] = {i: flat[edges[k]:edges[k + 1]] for k, i in enumerate(plain)}
        odd = [i for i in range(len(texts)) if i not in rows]
        rows.update(zip(odd, self.encode_whole([texts[i] for i in odd]), strict=True))
        out = []
        for i in range(len(texts)):
            counts[i] = len(rows[i]) + 1
            out += [np.asarray(rows[i], np.uint32), np.asarray([END], np.uint32)]
        return (np.concatenate(out) if out else np.empty(0, np.uint32)), counts


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file: Spark reuses workers, but unpickles the task function each time."""
    kept = sys.modules.setdefault("_hostpulse_encoders", ModuleType("_hostpulse_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = Encoder(path)
    return kept.__dict__[path]


def small_batches(batch: pa.RecordBatch, column: str = "text", most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` bytes of text, one row at least, that keep the working memory of a step small."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
