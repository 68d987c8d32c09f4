"""Token ids of whole texts with the ``tokenizers`` library, one library call per distinct word part.

Both vocabularies split a text before merging, and a single space or newline between two visible characters
is always such a split.  A text with no other white space is cut there; the packed ids of each distinct piece
are kept in a bounded table.  A new piece that is a word, or a word and one punctuation mark, is looked up
by those parts, and only unknown parts go through the file's own merges.  Everything else (other white
space, unprintable characters, letters beyond Latin, digits, symbols) is encoded by the unchanged tokenizer.
Ids are packed as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import gc
import os
import re
from contextlib import suppress
from struct import pack

from .common import kept

ID_BYTES = 4
#: Pieces whose ids a worker keeps, of some 200 bytes each.  Frequent ones come early; when the table is full, later ones are kept
#: for their batch only, and the table starts again when most of a batch is not in it.
MAX_PIECES = 800_000
#: Parts in one call of the library, which is slower on single parts.
TOGETHER = 200
#: Marks that a vocabulary splits from the letters before them, as one run.  No apostrophe: it may begin a contraction.
MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
#: Letters below this point are the same letters to every Unicode version and stable under normalisation.
LATIN_END = "ɐ"
#: Such letters that stay letters when their case is dropped.
LETTERS = "".join(c for c in map(chr, range(ord(LATIN_END))) if c.isalpha() and c.lower().isalpha())
#: Of a piece and the NUL after it: the newline before it, letters, marks, and what is neither.
PIECE = re.compile(f"(\n?)([{LETTERS}]*)([{re.escape(MARKS)}]*)([^\0]*)\0")


def _byte_characters() -> dict[int, str]:
    """What byte-level vocabularies write for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class _Table(dict):
    """Remembers the keys it was asked for in vain."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> None:
        self.new.append(key)
        return None


class PieceEncoder:
    """Encodes texts with one tokenizer file."""

    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # The same merges without the splitting, which single words do not need.
        self.merges = Tokenizer.from_file(path)
        self.merges.encode_special_tokens = True
        self.byte_characters = _byte_characters()
        # Parts hold no newline, so its character parts them.
        self.border = self.byte_characters[10]
        self.merges.pre_tokenizer, self.merges.normalizer = Split(self.border, "isolated"), None
        self.border_id = self.merges.encode(self.border, add_special_tokens=False).ids[0]
        # A space belongs to the word after it (byte-level BPE), or only separates and case is dropped.
        self.space_joins = self._whole(" a") != self._whole("a")
        self.pieces = _Table()
        self.parts: dict[str, bytes] = {}
        self.max_pieces = max_pieces

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def _split(self, text: str) -> list[str] | None:
        """The pieces of a plain text: words, with a newline before those that start a line; else None."""
        flat = text.replace("\n", " ")
        if not flat or "  " in flat or flat[0] == " " or flat[-1] == " " or not flat.isprintable():
            return None
        if self.space_joins:
            return ("\n" + text.replace("\n", " \n")).split(" ")
        return flat.split(" ")

    def _written(self, parts: str) -> str:
        """Parts, one a line, in the vocabulary's characters."""
        if parts.isascii():
            return parts.replace(" ", self.byte_characters[32]).replace("\n", self.border)
        return parts.encode().decode("latin-1").translate(self.byte_characters)

    def _learn_parts(self, parts: list[str]) -> None:
        import numpy as np

        parts.sort(key=str.isascii)  # those that are quickly written out together
        groups = [parts[at : at + TOGETHER] for at in range(0, len(parts), TOGETHER)]
        for at in range(0, len(groups), 50):  # bounds the library's own objects
            some = groups[at : at + 50]
            texts = [self._written("\n".join(group)) for group in some]
            for group, found in zip(some, self.merges.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(found.ids, "<u4")
                borders = (np.flatnonzero(ids == self.border_id) * ID_BYTES).tolist()
                packed = ids.tobytes()
                if len(borders) == len(group) - 1:
                    self.parts.update(zip(group, [packed[s:e] for s, e in zip([0, *[x + ID_BYTES for x in borders]], [*borders, len(packed)])]))
                else:  # not as expected: the unchanged tokenizer tells
                    self.parts.update((x, self._whole(x)) for x in group)

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """The ids of new pieces.  A word, or a word and a run of marks, is looked up by parts."""
        if len(self.parts) > self.max_pieces:
            self.parts.clear()
        known, space = self.parts, " " if self.space_joins else ""
        known[""] = b""
        newline = self._whole("\n") if self.space_joins else b""
        found: dict[str, bytes] = {}
        open_: list[tuple[str, bytes, str, str]] = []
        odd: list[str] = []
        wanted: set[str] = set()
        pieces = list(new)
        for piece, (line, letters, marks, rest) in zip(pieces, PIECE.findall("".join([p + "\0" for p in pieces])), strict=True):
            if rest or not (letters or marks):
                odd.append(piece)
                continue
            if not letters:
                letters, marks = marks, ""
            elif not space:
                letters = letters.lower()
            # A newline before a piece takes the place of its space.
            word, before = (letters, newline) if line else (space + letters, b"")
            x, y = known.get(word), known.get(marks)
            if x is None or y is None:
                wanted.add(word)
                wanted.add(marks)
                open_.append((piece, before, word, marks))
            else:
                found[piece] = before + x + y
        self._learn_parts([x for x in wanted if x not in known])
        for piece, before, word, marks in open_:
            found[piece] = before + known[word] + known[marks]
        texts = [(p[1:] if p[0] == "\n" else " " + p) if self.space_joins else p for p in odd]
        for p, x in zip(odd, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            found[p] = (newline if p[0] == "\n" else b"") + pack(f"<{len(x.ids)}I", *x.ids)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, in order."""
        # The many small objects made here hold no cycles, and the tables are long to look through for some.
        on = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if on:
                gc.enable()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        get, new = self.pieces.__getitem__, self.pieces.new
        # The newline that _split puts before a text is not part of it.
        skip = len(self._whole("\n")) if self.space_joins else 0
        out: list[bytes] = []
        open_: list[tuple[int, list[str], list]] = []
        asked = 0
        for k, text in enumerate(texts):
            pieces = self._split(text)
            if pieces is None:
                out.append(self._whole(text))
                continue
            before = len(new)
            found = list(map(get, pieces))
            asked += len(found)
            if len(new) > before:
                open_.append((k, pieces, found))
                out.append(b"")
            else:
                out.append(b"".join(found)[skip:])
        missed = len(new)
        fresh = self._learn(set(new))
        new.clear()
        for k, pieces, found in open_:
            at = -1
            with suppress(ValueError):
                while True:
                    at = found.index(None, at + 1)
                    found[at] = fresh[pieces[at]]
            out[k] = b"".join(found)[skip:]
        if len(self.pieces) < self.max_pieces:
            self.pieces.update(fresh)
        elif missed > asked // 2:
            self.pieces.clear()
        return out


def encoder(path: str, max_pieces: int = MAX_PIECES) -> PieceEncoder:
    """The worker's encoder for a tokenizer file; workers live longer than tasks."""
    made = kept("encoders", dict)
    if path not in made:
        made[path] = PieceEncoder(path, max_pieces)
    return made[path]


def default_path(name: str) -> str:
    """The file of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)
