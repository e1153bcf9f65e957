"""Token ids of whole texts, with a memory for words that come again.

The two vocabularies cut a text before each space that follows a character other
than white space; no token crosses such a cut, so ids of the parts in a row are
the ids of the text. A part met before is not encoded again.
"""

from __future__ import annotations

import os
import re

import numpy as np

# Parts kept in memory by one worker, and the longest part kept.
MEMORY = 700_000
_LONG = 64
_CHUNK = 4_000
_MARK = "\x00"
_SPACE_RUN = re.compile(r"[\s\x1c-\x1f\x85] ")
_CUT = re.compile(r"(?<=\S) ")


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file on this machine; a name with a slash is a path already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Index(dict):
    """Numbers of parts in the order they were met; those not looked at yet are in ``fresh``."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.fresh.append(part)
        return number


class Encoder:
    """Ids by the ``tokenizers`` library, as it gives them: the names of special tokens in a text are those tokens.

    No such name holds a space, so it never lies across a cut.
    """

    def __init__(self, name: str, memory: int = MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        # Byte-level vocabularies without a normaliser keep every byte of a text.
        self.keeps_bytes = self.tokenizer.normalizer is None and isinstance(
            self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel
        )
        self.memory = memory
        if self.keeps_bytes:
            size = self.tokenizer.get_vocab_size(with_added_tokens=True)
            self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        else:
            mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
            self.mark = mark[0] if len(mark) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _parts(self, text: str) -> list[str]:
        if not self.keeps_bytes:
            return text.replace("\n", " ").split(" ")
        if _MARK in text or _SPACE_RUN.search(text):
            cuts = [m.start() for m in _CUT.finditer(text)]
            return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        return text.replace(" ", "\x00 ").split(_MARK)

    def _whole(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all parts from one call, and how many each has; None if they can't be told apart."""
        if self.keeps_bytes:
            whole = "".join(parts)
            ids = np.array(self._whole([whole])[0], np.uint32)
            sizes = map(len, parts) if whole.isascii() else (len(p.encode("utf-8", "surrogatepass")) for p in parts)
            stops = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(np.fromiter(sizes, np.int64, len(parts)))) + 1
        else:
            if self.mark is None:
                return None
            ids = np.array(self._whole([f" {_MARK} ".join(parts) + f" {_MARK}"])[0], np.uint32)
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) != len(parts):
                return None
            ids, stops = np.delete(ids, marks), marks - np.arange(len(marks))
        return ids, np.diff(stops, prepend=0)

    def _learn(self, parts: list[str]) -> None:
        """Ids of parts that have the next numbers."""
        first = " " if self.keeps_bytes else ""
        plain = [0 < len(p) <= _LONG and p.startswith(first) and _MARK not in p and not p[-1].isspace() for p in parts]
        places, ids, sizes = [], [], []

        def keep(some: list[int], own: tuple[np.ndarray, np.ndarray] | None) -> None:
            if own is None:
                each = self._whole([parts[i] for i in some])
                own = np.array([x for e in each for x in e], np.uint32), np.array([len(e) for e in each], np.int64)
            places.append(np.array(some, np.int64))
            ids.append(own[0])
            sizes.append(own[1])

        joint = [i for i, x in enumerate(plain) if x]
        for at in range(0, len(joint), _CHUNK):
            some = joint[at : at + _CHUNK]
            keep(some, self._together([parts[i] for i in some]))
        keep([i for i, x in enumerate(plain) if not x], None)
        places, sizes = np.concatenate(places), np.concatenate(sizes)
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        order = np.argsort(places)
        self.starts = np.concatenate((self.starts, starts[order]))
        self.sizes = np.concatenate((self.sizes, sizes[order]))
        self.flat = np.concatenate((self.flat, *ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        index, order, per_text = self.index, [], []
        for t in texts:
            parts = self._parts(t) if t else []
            per_text.append(len(parts))
            order.extend(map(index.__getitem__, parts))
        if index.fresh:
            self._learn(index.fresh)
            index.fresh = []
        at = np.array(order, np.int64)
        own = self.sizes[at]
        total = np.cumsum(own)
        ids = self.flat[np.repeat(self.starts[at] - (total - own), own) + np.arange(own.sum())]
        before = np.concatenate(([0], total))
        edges = np.concatenate(([0], np.cumsum(per_text))).astype(np.int64)
        counts = before[edges[1:]] - before[edges[:-1]]
        if len(index) > self.memory:
            self._forget()
        return ids, counts


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = (name, os.getpid())
    if key not in _encoders:
        _encoders[key] = Encoder(name)
    return _encoders[key]
