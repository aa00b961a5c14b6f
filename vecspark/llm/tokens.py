"""Token ids of whole texts by the ``tokenizers`` library.

The tokenizer of ``word_bpe_49k.json`` normalises (NFC, lower case, white
space), splits by a pattern none of whose pieces spans white space, and
encodes every piece by itself.  So a text's ids are those of its pieces in
order, and each distinct piece needs the library once per worker: texts are
cut into pieces here and looked up, and only unknown pieces are encoded,
many in one call; the word-end mark of a piece's last id tells them apart.
Pieces are cut here only where every character is ASCII or a Latin-1
letter, for which normalisation is plain lower-casing; any other stretch
between spaces goes to the library whole.  Ids are exactly the library's.
"""

from __future__ import annotations

import re

import numpy as np

MOST_CACHED = 600_000  # pieces, about 130 MB
JOINED = 200

# The tokenizer's own pieces, for lower-case ASCII and Latin-1 letters.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_OTHER = re.compile(r"[^\n\r\t -~À-ÖØ-öø-ÿ]")
_SPACE = re.compile(r"[ \n\r\t]+")


class PieceTokenizer:
    """``encode(texts)`` gives an id array (unsigned 16 or 32 bit) per text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}
        vocabulary = self.library.get_vocab()
        #: ids that end a piece, by the vocabulary's word-end mark
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def pieces(self, text: str) -> list[str]:
        """Strings whose ids, one after the other, are those of ``text``."""
        if "<|" not in text and not _OTHER.search(text):
            return _PIECES.findall(text.lower())
        out = []
        for part in _SPACE.split(text):
            if "<|" in part or _OTHER.search(part):
                out.append(part)
            else:
                out.extend(_PIECES.findall(part.lower()))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces(t) for t in texts]
        if len(self.cache) > MOST_CACHED:
            self.cache.clear()
        cache = self.cache
        self._learn([p for p in set().union(*cut) if p not in cache])
        get = cache.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), dtype=self.dtype) for pieces in cut]


    def _learn(self, unknown: list[str]) -> None:
        """Encode pieces, ``JOINED`` in one string; their word-end ids tell them apart."""
        plain = [p for p in unknown if "<|" not in p and not _OTHER.search(p)]
        alone = [p for p in unknown if "<|" in p or _OTHER.search(p)]
        groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        for i in range(0, len(groups), 100):
            part = groups[i:i + 100]
            for pieces, e in zip(part, self.library.encode_batch_fast([" ".join(g) for g in part],
                                                                      add_special_tokens=False), strict=True):
                ids = np.array(e.ids, dtype=self.dtype)
                cut = [0, *((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()]
                if len(cut) != len(pieces) + 1 or cut[-1] != ids.nbytes:
                    alone.extend(pieces)
                    continue
                raw = ids.tobytes()
                self.cache.update(zip(pieces, [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], strict=True))
        for i in range(0, len(alone), 5000):
            part = alone[i:i + 5000]
            for p, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.cache[p] = np.array(e.ids, dtype=self.dtype).tobytes()


_made: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """The worker's tokenizer of this path, made once."""
    if path not in _made:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _made[path] = PieceTokenizer(path)
    return _made[path]


def token_parts(column, path: str, limit: int = 1 << 21):
    """``(first, id arrays)`` of slices of a string column; null as empty."""
    from vecspark.llm.common import parts_of, texts_of

    raw, own = texts_of(column), tokenizer(path)
    for a, b in parts_of(raw, limit):
        yield a, own.encode([x.decode("utf-8", "replace") for x in raw[a:b]])
