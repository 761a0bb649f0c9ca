"""Whole texts to token ids, one bounded Arrow batch at a time.

The tokenizer splits a text into pieces (runs of letters, single digits, runs of other
signs, contractions) and encodes each piece by itself. Pieces repeat a lot, so a batch
is split by Arrow, each distinct piece is encoded once by the tokenizer's BPE model, and
the ids are gathered back. This holds for texts of ASCII and extended Latin letters;
a text with any other sign is encoded by ``Tokenizer.encode_batch`` as it is. Both ways
give the same ids (tested).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orrery.llm.common import per_worker

#: Pieces whose ids a worker remembers; it starts afresh beyond that.
REMEMBERED_PIECES = 250_000
#: Bytes of text that are worked on at once; a longer text is one piece of work.
CHUNK_BYTES = 8 << 20

# Signs that the vocabulary's own splitting pattern treats alike here.
_OTHER = "[^\\t\\n\\r -~À-ÖØ-öø-ɏ]|<\\|"
_SIGNS = "('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[!-/:-@\\[-`{-~]+)"
_PIECE = re.compile("[!-~À-ÖØ-öø-ɏ]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PieceIds:
    """Ids of pieces, remembered between batches of one worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = _byte_letters()
        self.spelled = str.maketrans({chr(c): "".join(letters[b] for b in chr(c).encode()) for c in range(33, 0x250)})
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1 << 16, np.int64)
        self.count = 0

    def _piece(self, piece: str) -> list[int]:
        lower = piece.lower()
        if _PIECE.fullmatch(lower):
            return [t.id for t in self.model.tokenize(lower.translate(self.spelled))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Where the ids of each piece lie; those of new pieces are appended."""
        if self.count > REMEMBERED_PIECES:
            self._forget()
        get = self.place.get
        out = [get(p, -1) for p in pieces]
        end, new, ends = int(self.ends[self.count]), [], []
        for i, at in enumerate(out):
            if at < 0:
                out[i] = self.place[pieces[i]] = self.count + len(ends)
                new += self._piece(pieces[i]) if pieces[i] else []
                ends.append(end + len(new))
        if ends:
            need, top = end + len(new), self.count + len(ends) + 1
            if need > len(self.flat):
                self.flat = np.concatenate([self.flat[:end], np.empty(2 * need - end, np.int32)])
            if top > len(self.ends):
                self.ends = np.concatenate([self.ends[: self.count + 1], np.zeros(2 * top, np.int64)])
            self.flat[end:need], self.ends[self.count + 1 : top] = new, ends
            self.count += len(ends)
        return np.array(out, np.int64)

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts), _SIGNS, " \\1 ")
        lists = pc.ascii_split_whitespace(spaced)
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        pieces = lists.flatten().dictionary_encode()
        places = self._places(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        starts = self.ends[places]
        lengths = self.ends[places + 1] - starts
        total = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(starts - total[:-1], lengths)
        at += np.arange(len(at))
        return self.flat[at], np.diff(total[first])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        other = pc.match_substring_regex(texts, _OTHER).to_numpy(zero_copy_only=False)
        if not other.any():
            return self._split(texts)
        ids, counts = self._split(texts.filter(pa.array(~other)))
        whole = self.tokenizer.encode_batch(texts.filter(pa.array(other)).to_pylist(), add_special_tokens=False)
        out = np.empty(len(texts), object)
        ends = np.cumsum(counts)
        for i, (start, end) in zip(np.flatnonzero(~other), zip(ends - counts, ends)):
            out[i] = ids[start:end]
        for i, encoding in zip(np.flatnonzero(other), whole):
            out[i] = np.array(encoding.ids, np.int32)
        return np.concatenate(list(out)), np.array([len(x) for x in out], np.int64)


def piece_ids(path: str) -> PieceIds:
    return per_worker(("piece ids", path), lambda: PieceIds(path))


def chunks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``CHUNK_BYTES`` at most."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + CHUNK_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's ids followed by ``end_id``."""
    ends = np.cumsum(counts)
    return np.insert(ids, ends, end_id), counts + 1
