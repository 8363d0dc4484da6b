"""Encoding of whole texts with a tokenizers-library file, inside Spark tasks.

Most of a text's space-separated pieces repeat, so the distinct pieces of a
batch are found at once (Arrow's dictionary encoding), each Python worker keeps
the ids of pieces it has met (bounded in entries), and only new ones go to
the tokenizer, plain ones cut to pre-tokens already (``pre_tokens``).  That gives the same ids as encoding the whole text, because
for a byte-level pre-tokenizer with the usual pattern a space before a
non-space always begins a new pre-token and merges never cross pre-tokens.
Any other tokenizer file is applied to whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from ledgerloom.llm.common import worker_object

BYTE_BPE = "byte_bpe_50k.json"
#: Pieces that one worker remembers (about 250 bytes each), and the longest that it remembers.
CACHED_PIECES, CACHED_LENGTH = 400_000, 64
#: New pieces that go to the tokenizer as one text.
JOINED = 100
_UNEVEN = re.compile(r" (?:\s|\Z)")
_BOUNDARY = re.compile(r" (?=\S)")


def default_tokenizer() -> str:
    return public_tokenizers.path(BYTE_BPE)


def split_pieces(text: str) -> list[str]:
    """Cuts before every space that a non-space follows and drops that space:
    the first piece is as it stands, each other had a space before it."""
    return _BOUNDARY.split(text) if _UNEVEN.search(text) else text.split(" ")


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


def _numbered(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of ``numbered_pieces``, the numbers of all texts' pieces in one
    array, and for each text where its own begin and end there."""
    uneven = [i for i, t in enumerate(texts) if _UNEVEN.search(t)]
    plain = set(uneven)
    even = pc.split_pattern(pa.array([t for i, t in enumerate(texts) if i not in plain], pa.large_string()), " ")
    lists = [split_pieces(texts[i]) for i in uneven]
    pieces = pa.concat_arrays([even.flatten(), pa.array([p for own in lists for p in own], pa.large_string())]).dictionary_encode()
    distinct, flat = _strings(pieces.dictionary), pieces.indices.to_numpy().copy()
    order = np.array([i for i in range(len(texts)) if i not in plain] + uneven, np.int64)
    counts = np.concatenate([pc.list_value_length(even).to_numpy(), np.array([*map(len, lists)], np.int64)])
    begins, ends = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
    ends[order] = np.cumsum(counts)
    begins[order] = ends[order] - counts
    firsts = _strings(pieces.dictionary.take(pa.array(flat[begins])))
    flat[begins] = len(distinct) + np.arange(len(texts))
    return distinct + firsts, flat, begins, ends


def numbered_pieces(texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct pieces of some texts, and per text the numbers of its pieces in order.
    Pieces come without the space in front; the last ``len(texts)`` of the list are the
    texts' first pieces, which had none."""
    pieces, flat, begins, ends = _numbered(texts)
    return pieces, [flat[a:b] for a, b in zip(begins.tolist(), ends.tolist())]


def _byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte of a piece that ``pre_tokens`` can cut: letters
    (ASCII, and U+00C0 to U+027F as two bytes), ASCII digits, other printable
    ASCII but the apostrophe, white space; _OTHER for all other bytes."""
    classes = np.full(256, _OTHER, np.uint8)
    for i in range(33, 127):
        classes[i] = _LETTER if chr(i).isalpha() else _DIGIT if chr(i).isdigit() else _SIGN
    classes[ord("'")] = _OTHER  # 's, 't ... are pre-tokens of their own
    classes[[9, 10, 13]] = _BLANK
    classes[0x80:0xC0] = classes[0xC3:0xCA] = _LETTER
    return classes


def _byte_characters() -> np.ndarray:
    """The character that a byte-level vocabulary has for each byte."""
    shown = [i for i in range(256) if 33 <= i <= 126 or 161 <= i <= 172 or i >= 174]
    out = np.empty(256, "<u2")
    out[shown] = shown
    hidden = sorted(set(range(256)) - set(shown))
    out[hidden] = np.arange(256, 256 + len(hidden))
    return out


_OTHER, _LETTER, _DIGIT, _SIGN, _BLANK = range(5)
_CLASSES, _CHARACTERS = _byte_classes(), _byte_characters()


def pre_tokens(pieces: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Cuts pieces, each with a space put in front, into the pre-tokens of the
    usual byte-level pattern, many at once.  Returns which pieces are plain
    enough for that, the characters of these as texts of JOINED pieces with a
    line feed (no byte's character) between pre-tokens, and where each ends in bytes."""
    held = "\0 ".join(["", *pieces])
    if held.count("\0") != len(pieces):  # pieces with a zero byte
        plain = np.array(["\0" not in p for p in pieces])
        some, texts, ends = pre_tokens([p for p in pieces if "\0" not in p])
        plain[plain] = some
        return plain, texts, ends
    data = np.frombuffer(held.encode(), np.uint8)
    starts = np.flatnonzero(data == 0)
    kind = _CLASSES[data]
    # U+00D7 and U+00F7 are no letters; a lead byte is never the last byte
    kind[:-1][(data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))] = _OTHER
    own = np.ones(len(data), bool)  # bytes of the pieces themselves
    own[starts], own[starts + 1] = False, False
    plain = np.ones(len(pieces), bool)
    plain[np.searchsorted(starts, np.flatnonzero(own & (kind == _OTHER)), "right") - 1] = False
    if len(pieces):  # behind the space must come what a pre-token takes a space with
        after = np.append(kind, _OTHER)[starts + 2]
        plain &= (after != _OTHER) & (after != _BLANK)
    if not plain.all():
        _, texts, ends = pre_tokens([pieces[i] for i in np.flatnonzero(plain).tolist()])
        return plain, texts, ends
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] != kind[:-1]) & own[1:] & own[:-1]
    # the last blank of a run goes alone before what is none
    cut[1:-1] |= (kind[1:-1] == _BLANK) & (kind[2:] != _BLANK) & own[2:] & own[:-2]
    at = np.flatnonzero(cut)
    shown = _CHARACTERS[data]
    shown[starts] = 10
    shown = np.insert(shown, at, 10)
    begins = [*(starts + np.searchsorted(at, starts))[::JOINED].tolist(), len(shown)]
    texts = [shown[a + 1 : b].tobytes().decode("utf-16-le") for a, b in zip(begins, begins[1:])]
    return plain, texts, np.append(starts[1:], len(data))[: len(pieces)] - np.arange(1, len(pieces) + 1)


class PieceEncoder:
    """texts -> ids as little-endian unsigned 32-bit bytes, one bytes object per text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task a core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        added = [t for t in spec["added_tokens"] if not t["special"]]
        self.by_piece = (
            spec["normalizer"] is None and not added and before.get("type") == "ByteLevel"
            and before.get("use_regex") and not before.get("add_prefix_space")
        )
        vocab = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token)  # in a byte-level vocabulary each character stands for a byte
        self.known: dict[str, bytes] = {}
        self.by_pre_token = Tokenizer(self.tokenizer.model)
        self.by_pre_token.pre_tokenizer = CharDelimiterSplit("\n")

    def _plain(self, texts: list[str], tokenizer) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, ids: bytes, piece_ends: np.ndarray) -> list[bytes]:
        """Ids of each piece: the byte lengths of the tokens tell where it ends."""
        token_ends = np.cumsum(self.token_bytes[np.frombuffer(ids, "<u4")])
        cuts = [0, *(4 * (np.searchsorted(token_ends, piece_ends) + 1)).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _spaced(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece behind a space.  Many pieces are encoded as one
        text; those that ``pre_tokens`` can cut need no pattern in the tokenizer."""
        plain, texts, ends = pre_tokens(pieces)
        out = np.empty(len(pieces), object)
        out[plain] = self._cut(b"".join(self._plain(texts, self.by_pre_token)), ends)
        rest = [pieces[i] for i in np.flatnonzero(~plain).tolist()]
        groups = [rest[i : i + JOINED] for i in range(0, len(rest), JOINED)]
        ids = b"".join(self._plain([" " + " ".join(g) for g in groups], self.tokenizer))
        out[~plain] = self._cut(ids, np.cumsum([1 + len(p.encode()) for p in rest], dtype=np.int64))
        return out.tolist()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self._plain(texts, self.tokenizer)
        pieces, flat, begins, ends = _numbered(texts)
        distinct = pieces[: len(pieces) - len(texts)]
        known, room = self.known, CACHED_PIECES - len(self.known)
        ids = list(map(known.get, distinct))
        missing = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(missing, self._spaced([distinct[i] for i in missing])):
            ids[i] = x
        for i in missing:  # pieces met early are mostly the frequent ones: they stay
            if room <= 0:
                break
            if len(distinct[i]) <= CACHED_LENGTH:
                known[distinct[i]] = ids[i]
                room -= 1
        ids += self._plain(pieces[len(distinct) :], self.tokenizer)
        placed = pa.array(ids, pa.large_binary()).take(pa.array(flat))
        _, bounds, data = placed.buffers()
        bounds, data = np.frombuffer(bounds, np.int64), memoryview(data or b"")
        return [data[a:b].tobytes() for a, b in zip(bounds[begins].tolist(), bounds[ends].tolist())]


def encoder(path: str) -> PieceEncoder:
    return worker_object(("tokenizers", path), lambda: PieceEncoder(path), large=True)
