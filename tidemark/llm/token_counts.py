"""Operator 4. Token counts by rank-synchronous merging of ragged arrays.

All distinct pieces of a slice lie behind one another in flat arrays. In each
round every piece finds its lowest pair rank and merges all places of that pair
at once, from the left where they overlap; then the flat arrays close up. Pieces
without a pair of known rank leave. What is left of a piece are its tokens.

A merge only makes pairs of a higher rank than its own, as a vocabulary's merge
list builds every symbol before it uses it, so merging a rank's places together
gives the library's result.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices
from tidemark.llm.pieces import WORD_PIECES, is_plain, look_up

NO_RANK = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in kept}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


class MergeTable:
    """Merge ranks of a word vocabulary with an end-of-word suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, added = content["model"], content["added_tokens"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.byte_of = {letter: b for b, letter in enumerate(letters)}
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.final = np.array([vocab[x + suffix] for x in letters], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (
            np.array([vocab[x] for x in side], dtype=np.int64)
            for side in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs])
        )
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added) or "(?!)")
        self.known: dict[bytes | str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that are left of each piece once no pair has a rank."""
        return self.merge(pieces)[0]

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """Those symbols themselves, two bytes each, low byte first."""
        total, done = self.merge(pieces)
        owner = np.concatenate([o for o, _ in done]) if done else np.empty(0, dtype=np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else owner
        packed = symbols[np.argsort(owner, kind="stable")].astype("<u2").tobytes()
        ends = (2 * np.cumsum(total)).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, list]:
        """How many symbols are left of each piece, and `(piece, symbol)` arrays of them."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        total = lengths.copy()
        done: list[tuple[np.ndarray, np.ndarray]] = []
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        filled = lengths > 0
        symbols[ends[filled] - 1] = self.final[data[ends[filled] - 1]]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        ranks = np.full(len(symbols), NO_RANK)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        while len(symbols):
            opens = np.r_[True, owner[1:] != owner[:-1]]
            first = np.flatnonzero(opens)
            group = np.cumsum(opens) - 1
            lowest = np.minimum.reduceat(ranks, first)
            over = lowest == NO_RANK
            if over.any():
                gone = over[group]
                total[owner[first[over]]] = np.diff(np.r_[first, len(owner)])[over]
                done.append((owner[gone], symbols[gone]))
                kept = ~gone
                symbols, owner, ranks, group = symbols[kept], owner[kept], ranks[kept], group[kept]
                if not len(symbols):
                    break
            hits = np.flatnonzero(ranks == lowest[group])
            # overlapping places (x x x) merge from the left: every other one of a run
            if len(hits) > 1 and (np.diff(hits) == 1).any():
                breaks = np.r_[True, (np.diff(hits) != 1) | (owner[hits[1:]] != owner[hits[:-1]])]
                run_start = np.flatnonzero(breaks)
                in_run = np.arange(len(hits)) - run_start[np.cumsum(breaks) - 1]
                hits = hits[in_run % 2 == 0]
            symbols[hits] = self.made[ranks[hits]]
            alive = np.ones(len(symbols), dtype=bool)
            alive[hits + 1] = False
            changed = np.zeros(len(symbols), dtype=bool)
            changed[hits] = True
            symbols, owner, ranks, changed = (x[alive] for x in (symbols, owner, ranks, changed))
            # a changed symbol has a new pair with either neighbour
            changed[:-1] |= changed[1:]
            at = np.flatnonzero(changed)
            inner = at[:-1] if len(at) and at[-1] == len(symbols) - 1 else at
            ranks[at] = NO_RANK
            inner = inner[owner[inner] == owner[inner + 1]]
            ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        return total, done

    def cut(self, text: str) -> tuple[list[bytes | str], int]:
        """Pieces of a text, and how many special strings it holds."""
        specials = self.special.findall(text)
        parts = self.special.split(text) if specials else [text]
        pieces: list[bytes | str] = []
        for part in parts:
            if is_plain(part):
                pieces.extend(WORD_PIECES.findall(part.lower()))
            else:
                normal = self.library.normalizer.normalize_str(part)
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    pieces.append(bytes(map(self.byte_of.__getitem__, piece)))
        return pieces, len(specials)

    def count_texts(self, texts: list[str]) -> list[int]:
        cut = [self.cut(t) for t in texts]
        found = look_up([pieces for pieces, _ in cut], self.known, self._ask)
        return [sum(counts) + n for counts, (_, n) in zip(found, cut, strict=True)]

    def _ask(self, pieces: list[bytes | str]) -> list[int]:
        return self.count([p.encode() if isinstance(p, str) else p for p in pieces]).tolist()


_tables: dict[str, MergeTable] = {}


def merge_table(path: str) -> MergeTable:
    if path not in _tables:
        _tables[path] = MergeTable(path)
    return _tables[path]


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` without their text, and `n_bytes`, `n_tokens` of each text.

    A null text counts as empty: no bytes, no tokens. Rows are counted one by
    one, so repeated rows and columns of any other name do no harm; a column
    named like a result is replaced. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    narrow = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = narrow.select(*kept).schema.add("n_bytes", "long").add("n_tokens", "long")

    def counted(batches):
        table = merge_table(path)
        for piece, texts in text_slices(batches, "__text"):
            columns = [piece.column(n) for n in range(len(kept))]
            n_bytes = pa.array([len(t.encode()) for t in texts], pa.int64())
            n_tokens = pa.array(table.count_texts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, n_bytes, n_tokens], names=[*kept, "n_bytes", "n_tokens"]
            )

    return narrow.mapInArrow(counted, schema)
