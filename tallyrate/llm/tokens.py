"""Exact encoding of texts piece by piece, over the public tokenizer files.

A space that is followed by anything but white space starts a new pre-token in the tokenizers
used here: byte-level ones join exactly that space to the word behind it, and those that drop
white space end a word there. Text cut before such spaces can be encoded piece by piece. Special
tokens hold no space, so a cut never falls into one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

# Bytes of pieces and their encodings that a generation of a worker's cache holds: about
# ENTRY for each and the piece's own. Longer pieces than LONGEST are encoded each time.
HELD, ENTRY, LONGEST = 32 << 20, 200, 400
# Characters, and pieces of odd content, that go to the tokenizer in one call.
JOINED, APART = 1 << 17, 1000
# More than the white space of any of the libraries: a cut left out does no harm.
_LOOSE = re.compile("[\\s\\x1c-\\x1f\\u180e\\u200b\\ufeff]")
_LOOSE_CUT = re.compile(" (?=[\\s\\x1c-\\x1f\\u180e\\u200b\\ufeff]|$)")


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(text: str) -> list[str]:
    """The text cut before safe spaces. All but the first piece have lost that one space."""
    parts = text.split(" ")
    if not _LOOSE_CUT.search(text):
        return parts
    out = parts[:1]
    for part in parts[1:]:
        if part and not _LOOSE.match(part):
            out.append(part)
        else:
            out[-1] += " " + part
    return out


def starts_loose(piece: str) -> bool:
    return _LOOSE.match(piece) is not None


@lru_cache(maxsize=4)
def load(path: str):
    """A tokenizer with truncation and padding off, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=4)
def separator(path: str) -> tuple[str, int] | None:
    """A special token, and its id, that may stand between pieces encoded in one call: it takes no
    white space beside it, and text on either side is encoded as if it stood alone."""
    for number, token in load(path).get_added_tokens_decoder().items():
        if token.special and not (token.lstrip or token.rstrip or token.single_word or token.normalized):
            return token.content, number
    return None


class PieceCache:
    """What `value` makes of the ids of each piece. Two generations of at most `HELD` bytes are
    kept: when the younger is full it becomes the elder, from which used pieces move up again."""

    def __init__(self, path: str, value: Callable[[np.ndarray], object]):
        self.tokenizer, self.value, self.separator = load(path), value, separator(path)
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.held = 0

    def of_first(self, piece: str):
        return self.value(np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<i4"))

    def of_spaced(self, found: list[str]) -> list:
        """Values of pieces that have a space in front."""
        young = self.young
        values = [young.get(piece) for piece in found]
        if None in values:
            wanted = {p for p, v in zip(found, values) if v is None}
            new = {p: self.old[p] for p in wanted if p in self.old}
            new.update(self._encoded([p for p in wanted if p not in new]))
            values = [new[p] if v is None else v for p, v in zip(found, values)]
            self._keep(new)
        return values

    def _keep(self, new: dict[str, object]) -> None:
        for piece, value in new.items():
            if len(piece) <= LONGEST:
                if self.held > HELD:
                    self.old, self.young, self.held = self.young, {}, 0
                self.young[piece] = value
                self.held += ENTRY + 2 * len(piece)

    def _encoded(self, missing: list[str]) -> Iterator[tuple[str, object]]:
        """Pieces that cannot be mistaken for a part of the separator go to the tokenizer many at a
        time, with it between them."""
        mark, number = self.separator or ("", -1)
        joined = [p for p in missing if mark and mark[0] not in p and mark[-1] not in p]
        apart = [p for p in missing if not mark or mark[0] in p or mark[-1] in p]
        ends = np.cumsum([len(p) + 1 for p in joined])
        at = 0
        while at < len(joined):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + JOINED, "right")))
            text = mark.join([" " + p for p in joined[at:stop]])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<i4")
            cuts = np.append(np.flatnonzero(ids == number), len(ids)).tolist()
            begins = [0, *(cut + 1 for cut in cuts[:-1])]
            yield from ((p, self.value(ids[a:b])) for p, a, b in zip(joined[at:stop], begins, cuts, strict=True))
            at = stop
        for at in range(0, len(apart), APART):
            part = apart[at:at + APART]
            encoded = self.tokenizer.encode_batch_fast([" " + p for p in part], add_special_tokens=False)
            yield from ((p, self.value(np.array(e.ids, "<i4"))) for p, e in zip(part, encoded))


def id_bytes(ids: np.ndarray) -> bytes:
    return ids.tobytes()


@lru_cache(maxsize=4)
def id_cache(path: str) -> PieceCache:
    return PieceCache(path, id_bytes)


@lru_cache(maxsize=4)
def length_cache(path: str) -> PieceCache:
    return PieceCache(path, len)


@lru_cache(maxsize=4)
def token_strings(path: str) -> list[str]:
    found = load(path)
    return [found.id_to_token(i) or "" for i in range(found.get_vocab_size(with_added_tokens=True))]


def decode(path: str, ids: list[int]) -> str:
    """As the library does, special tokens included. Without a decoder tokens are joined by
    spaces, which a table does faster."""
    found = load(path)
    if found.decoder is None:
        strings = token_strings(path)
        return " ".join([strings[i] for i in ids])
    return found.decode(ids, skip_special_tokens=False)
