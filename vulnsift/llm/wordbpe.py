"""Token ids of whole texts by a word-level BPE file of the ``tokenizers`` library.

The library spends most of its time on words it has met before, so a worker
keeps the ids of the pieces it has seen. The file's rules fold case, drop white
space and never join a letter with punctuation, so the ids of a text are those
of its pieces one after another.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from vulnsift.llm.common import held
from vulnsift.llm.pieces import Ragged, WordTable, per_text, split


def byte_letters() -> dict[int, int]:
    """The printable letter by which a byte-level file writes each byte: itself
    if printable in Latin-1, else the next free code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder of one vocabulary file with a bounded memory of pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.special_bytes = [s.encode() for s in self.special]
        self.max_id = max(self.tok.get_vocab(with_added_tokens=True).values())
        self.dtype = np.dtype("<u2") if self.max_id < 1 << 16 else np.dtype("<u4")
        self.ids = Ragged(self.dtype)
        self.table = WordTable(self._learn, self.ids.clear)

    def direct(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn(self, pieces: list[bytes]) -> None:
        tokenize, direct, letters = self.tok.model.tokenize, self.direct, byte_letters()
        flat: list[int] = []
        lengths = []
        for piece in pieces:
            if piece.isalpha():  # ASCII letters: a pre-token as it stands once in lower case
                ids = [t.id for t in tokenize(piece.lower().decode())]
            elif (word := piece.decode()).isalpha() and max(word) <= "\xff":  # Latin letters, all precomposed
                ids = [t.id for t in tokenize(word.lower().encode().decode("latin-1").translate(letters))]
            else:
                ids = direct(word)
            flat += ids
            lengths.append(len(ids))
        self.ids.extend(np.asarray(flat, self.dtype), np.asarray(lengths, np.int64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of each text in them; null counts as empty."""
        p = split(texts, fold=True, punct_edges=True)
        flat, lengths = self.ids.take(self.table.rows_of(p)) if len(p.starts) else (np.zeros(0, self.dtype), np.zeros(0, np.int64))
        offsets = per_text(lengths, p.offsets)
        raw = p.buf.tobytes() if any(s in p.buf.tobytes() for s in self.special_bytes) else b""
        if not raw:
            return flat, offsets
        parts = []  # a text with the string of a special token goes to the library whole
        for i in range(len(offsets) - 1):
            text = raw[p.text_offsets[i] : p.text_offsets[i + 1]]
            whole = any(s in text for s in self.special_bytes)
            parts.append(np.asarray(self.direct(text.decode()), self.dtype) if whole else flat[offsets[i] : offsets[i + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def encoder(path: str) -> WordBpe:
    """The worker's encoder for a vocabulary file."""
    return held("word-bpe", path, lambda: WordBpe(path))
