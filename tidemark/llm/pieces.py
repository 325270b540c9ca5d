"""Cut texts into the pieces that a vocabulary's merges stay within.

The patterns are the vocabularies' own, with their Unicode classes written out
for `PLAIN` characters (ASCII and the Latin letters up to U+024F), over which
all versions of Unicode agree. Any other text is cut by the library itself.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tidemark.llm.common import word_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_PLAIN_BYTES = bytes([9, 10, 13, *range(32, 127), *range(161, 256)])
_NOT_PLAIN = re.compile("[^\t\n\r -~¡-ɏ–—‘-”…€]")

BYTE_PIECES = re.compile(
    rf"{_ENDINGS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)
WORD_PIECES = re.compile(rf"{_ENDINGS}|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")

#: Words that the library is asked for in one text.
IN_A_ROW = 200
#: Pieces a worker remembers by hash, and those of them in a dictionary; and pieces
#: remembered by name, about 200 bytes each. When full, a memory starts anew.
REMEMBERED, RECENT, NAMED = 2_000_000, 60_000, 250_000


def is_plain(text: str) -> bool:
    if text.isascii():
        return not text.encode("ascii").translate(None, _PLAIN_BYTES)
    try:
        return not text.encode("latin-1").translate(None, _PLAIN_BYTES)
    except UnicodeEncodeError:
        return _NOT_PLAIN.search(text) is None


def look_up(cut: list[list], known: dict, ask) -> list[list]:
    """`known[piece]` for every piece; `ask` is called once with those not yet known."""
    found = [list(map(known.get, pieces)) for pieces in cut]
    new: set = set()
    for pieces, values in zip(cut, found, strict=True):
        if None in values:
            new.update(p for p, v in zip(pieces, values, strict=True) if v is None)
    if new:
        if len(known) + len(new) > NAMED:
            known.clear()
        asked = list(new)
        answers = dict(zip(asked, ask(asked), strict=True))
        known.update(answers)
        for pieces, values in zip(cut, found, strict=True):
            if None in values:
                values[:] = [
                    answers[p] if v is None else v for p, v in zip(pieces, values, strict=True)
                ]
    return found


WHITE, LETTER, NUMBER, OTHER = range(4)
_CLASS = np.array(
    [
        LETTER if re.match(f"[{_LETTER}]", c) else NUMBER if re.match(f"[{_NUMBER}]", c)
        else WHITE if c in "\t\n\r " else OTHER
        for c in map(chr, range(256))
    ],
    dtype=np.uint8,
)


def simple_bytes(text: str) -> bytes | None:
    """A plain text without apostrophes (which start pieces of their own kind) as Latin-1."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if b"'" in data or data.translate(None, _PLAIN_BYTES) else data


def _runs(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and classes of runs of one class, none of which leaves its text."""
    kind = _CLASS[data]
    opens = np.r_[True, kind[1:] != kind[:-1]]
    opens[begins[begins < len(data)]] = True
    starts = np.flatnonzero(opens)
    return starts, np.r_[starts[1:], len(data)], kind[starts]


def byte_pieces(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of `BYTE_PIECES` start and end in Latin-1 texts that begin at `begins`.

    A space before a word belongs to it. Of white space before a word the last
    character, if it is no such space, is a piece, and what is before it another.
    """
    starts, ends, kind = _runs(data, begins)
    white = kind == WHITE
    first = np.zeros(len(data) + 1, dtype=bool)
    first[begins] = True
    inside = ~first[starts]
    led = ~white & inside & (data[starts - 1] == 32)
    followed = white & np.r_[~white[1:] & inside[1:], False]
    last = ends - 1
    parts = [
        (starts[~white] - led[~white], ends[~white]),
        (starts[white & ~followed], ends[white & ~followed]),
        (starts[followed & (last > starts)], last[followed & (last > starts)]),
    ]
    alone = followed & (data[last] != 32)
    parts.append((last[alone], ends[alone]))
    low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(low, kind="stable")
    return low[order], high[order]


def word_pieces(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for `WORD_PIECES`: runs, but digits one by one; white space is no piece."""
    starts, ends, kind = _runs(data, begins)
    runs = (kind == LETTER) | (kind == OTHER)
    digits = np.flatnonzero(_CLASS[data] == NUMBER)
    low = np.concatenate([starts[runs], digits])
    order = np.argsort(low, kind="stable")
    return low[order], np.concatenate([ends[runs], digits + 1])[order]


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of `flat` behind one another."""
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    return flat[np.arange(total) + np.repeat(starts - (stops - sizes), sizes)]


class Memory:
    """Ids of pieces by their hash, in sorted arrays of about 20 bytes a piece; those
    met lately are in a dictionary, which joins the arrays when it has grown."""

    def __init__(self):
        self.hashes = np.empty(0, dtype=np.uint64)
        self.starts = self.sizes = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype="<u2")
        self.recent: dict[int, bytes] = {}

    def look_up(self, hashes: np.ndarray, ask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and sizes in a table of ids, and the table. `ask` gives the ids of the
        hashes at the places it gets."""
        sizes = np.zeros(len(hashes), dtype=np.int64)
        starts = np.zeros(len(hashes), dtype=np.int64)
        at = np.searchsorted(self.hashes, hashes)
        hit = np.zeros(len(hashes), dtype=bool)
        if len(self.hashes):
            hit = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes
        sizes[hit] = self.sizes[at[hit]]
        old = gathered(self.flat, self.starts[at[hit]], sizes[hit])
        starts[hit] = np.cumsum(sizes[hit]) - sizes[hit]
        rest = np.flatnonzero(~hit)
        keys = hashes[rest].tolist()
        found = list(map(self.recent.get, keys))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            for i, ids in zip(new, ask(rest[new]), strict=True):
                found[i] = self.recent[keys[i]] = ids
        sizes[rest] = [len(x) // 2 for x in found]
        starts[rest] = len(old) + np.cumsum(sizes[rest]) - sizes[rest]
        table = np.concatenate([old, np.frombuffer(b"".join(found), dtype="<u2")])
        if len(self.recent) > RECENT:
            self._join()
        return starts, sizes, table

    def _join(self) -> None:
        if len(self.hashes) > REMEMBERED:
            self.__init__()
            return
        added = np.array([len(x) // 2 for x in self.recent.values()], dtype=np.int64)
        hashes = np.concatenate([self.hashes, np.array(list(self.recent), dtype=np.uint64)])
        starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(added) - added])
        sizes = np.concatenate([self.sizes, added])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.sizes = hashes[order], starts[order], sizes[order]
        joined = np.frombuffer(b"".join(self.recent.values()), dtype="<u2")
        self.flat = np.concatenate([self.flat, joined])
        self.recent = {}


class LibraryEncoder:
    """Ids of whole texts as the tokenizers library gives them, asking it once per piece.

    The library merges each piece by itself, so a text's ids are those of its
    pieces in a row. Most texts are cut by numpy, all of a slice at once, and
    their pieces are told apart by 64-bit hashes; plain texts with apostrophes or
    letters beyond Latin-1 are cut by the pattern; those with special strings or
    characters that are not plain go to the library whole.
    """

    def __init__(self, path: str):
        self.library = self.load(path)
        vocabulary = self.library.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            # byte-level vocabularies write one letter for each byte
            self.token_bytes[i] = len(token)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.memory = Memory()

    def load(self, path: str):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, two bytes each, low byte first."""
        out: list[bytes] = [b""] * len(texts)
        simple, pieced, whole = [], [], []
        for i, text in enumerate(texts):
            if not is_plain(text) or any(s in text for s in self.special):
                whole.append(i)
            elif (data := simple_bytes(self.normal(text))) is not None:
                simple.append((i, data))
            else:
                pieced.append((i, self.cut(text)))
        for (i, _), ids in zip(simple, self._simple([d for _, d in simple]), strict=True):
            out[i] = ids
        found = look_up([x for _, x in pieced], self.known, self.ask_pieces)
        for (i, _), ids in zip(pieced, found, strict=True):
            out[i] = b"".join(ids)
        for i, ids in zip(whole, self._ask([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return out

    def _simple(self, texts: list[bytes]) -> list[bytes]:
        """Ids of Latin-1 texts: distinct pieces are looked up, their ids put in place."""
        joined = b"".join(texts)
        if not joined:
            return [b""] * len(texts)
        data = np.frombuffer(joined, dtype=np.uint8)
        ends_of = np.cumsum([len(t) for t in texts])
        begins = np.r_[0, ends_of[:-1]]
        low, high = self.bounds(data, begins)
        hashes = word_hashes(data, low, high)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)

        def ask(new: np.ndarray) -> list[bytes]:
            spans = zip(low[first[new]].tolist(), high[first[new]].tolist(), strict=True)
            return self.ask_pieces([joined[a:b].decode("latin-1") for a, b in spans])

        starts, sizes, table = self.memory.look_up(distinct, ask)
        packed = gathered(table, starts[which], sizes[which]).tobytes()
        # pieces of a text end where the text does
        stops = np.r_[0, np.cumsum(sizes[which])]
        bounds = 2 * stops[np.searchsorted(high, ends_of, side="right")]
        return [packed[a:b] for a, b in zip(np.r_[0, bounds[:-1]].tolist(), bounds.tolist())]

    def normal(self, text: str) -> str:
        """The text whose pieces are looked up."""
        return text

    def bounds(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return byte_pieces(data, begins)

    def cut(self, text: str) -> list[str]:
        return BYTE_PIECES.findall(text)

    def ask_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of new pieces. Words after a space are asked for many in a row, which
        the library cuts at the spaces again; tokens' lengths tell where each ends."""
        known: dict[str, bytes] = {}
        words = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        rows = ["".join(words[i : i + IN_A_ROW]) for i in range(0, len(words), IN_A_ROW)]
        if rows:
            found = self.library.encode_batch_fast(rows, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype="<u2") for e in found])
            ends = np.searchsorted(
                np.cumsum(self.token_bytes[ids]), np.cumsum([len(w.encode()) for w in words])
            )
            packed, ends = ids.tobytes(), (2 * (ends + 1)).tolist()
            known = {w: packed[a:b] for w, a, b in zip(words, [0, *ends], ends)}
        others = [p for p in pieces if p not in known]
        known.update(zip(others, self._ask(others), strict=True))
        return [known[p] for p in pieces]

    def _ask(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u2").tobytes() for e in found]


_encoders: dict[tuple[type, str], LibraryEncoder] = {}


def encoder(kind: type[LibraryEncoder], path: str) -> LibraryEncoder:
    """The worker's encoder of a kind for a file, loaded once."""
    if (kind, path) not in _encoders:
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]
