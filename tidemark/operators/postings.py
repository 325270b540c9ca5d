"""Blocks of an inverted index, searched with exact pruning.

A block holds up to `BLOCK_ROWS` items and `CELLS` words, or one longer item. For each of its terms it keeps the
postings (item, count) by item, cut into stretches of `STRETCH`, and the largest
count of each stretch and of the whole term. A term of weight w adds at most w
times that count to the score of an item in the stretch.

A question's terms are read by falling upper score. As soon as the terms still to
come cannot lift an item that no term has met so far above the k-th best one, only
items met so far are followed, and of those only the ones that the largest counts
of their own stretches, summed over the terms to come, could still lift that high.
The rest of the postings is not read. Scores of what is left are complete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemark.operators.blocks import BLOCK_ROWS

STRETCH = 128

#: Words of a block at most, which makes it some 8 MB.
CELLS = 1 << 20

# Scores are compared after rounding, so that ties fall to the lower id
# whatever order the terms were added in. Bounds leave room for it.
SCORE_DIGITS = 6
ROUNDED = 2 * 10.0**-SCORE_DIGITS


def ragged_slices(batches, most: int, lists: int) -> Iterator:
    """Arrow batches in slices of up to `most` rows and `CELLS` list members, by the
    sizes of column `lists`; a longer row is a slice of its own."""
    for batch in batches:
        sizes = np.diff(batch.column(lists).offsets.to_numpy())
        ends, low = np.cumsum(sizes), 0
        while low < len(sizes):
            before = int(ends[low - 1]) if low else 0
            fits = int(np.searchsorted(ends, before + CELLS, side="right")) - low
            rows = max(1, min(most, fits))
            yield batch.slice(low, rows), sizes[low : low + rows]
            low += rows


def index_parts(batches) -> Iterator[tuple[int, bytes]]:
    """Packed blocks of rows (doc_id, item_id, hashed words with repeats)."""
    for part, sizes in ragged_slices(batches, BLOCK_ROWS, 2):
        docs, ids = (part.column(i).to_numpy().astype("<i8") for i in range(2))
        words = part.column(2).flatten().to_numpy()
        owner = np.repeat(np.arange(len(docs)), sizes)
        order = np.argsort(words, kind="stable")
        words, owner = words[order], owner[order]
        first = np.ones(len(words), dtype=bool)
        first[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        places = np.flatnonzero(first)
        counts = np.diff(np.r_[places, len(words)])
        words, owner = words[places], owner[places]
        opens = np.ones(len(words), dtype=bool)
        opens[1:] = words[1:] != words[:-1]
        starts = np.flatnonzero(opens)
        stretches = -(-np.diff(np.r_[starts, len(words)]) // STRETCH)
        ends = np.cumsum(stretches)
        inner = np.arange(int(stretches.sum())) - np.repeat(ends - stretches, stretches)
        cuts = np.repeat(starts, stretches) + STRETCH * inner
        most = np.maximum.reduceat(counts, cuts) if len(cuts) else cuts
        head = np.array([len(docs), len(starts), len(words), len(cuts)], dtype="<i8")
        keys = [docs, ids, words[starts]]
        places = [starts, ends, cuts, most, owner, counts]
        packed = [a.astype("<i8").tobytes() for a in keys] + [a.astype("<i4").tobytes() for a in places]
        yield 0, head.tobytes() + b"".join(packed)


class Postings:
    """A packed block as arrays."""

    def __init__(self, data: bytes):
        n, terms, postings, stretches = np.frombuffer(data, "<i8", 4).tolist()
        at = 32

        def take(size, kind="<i4"):
            nonlocal at
            found = np.frombuffer(data, kind, size, at)
            at += found.nbytes
            return found

        self.docs, self.ids, self.terms = take(n, "<i8"), take(n, "<i8"), take(terms, "<i8")
        self.starts, self.ends = take(terms), take(terms)
        self.cuts, self.most = take(stretches), take(stretches)
        self.owner, self.counts = take(postings), take(postings)
        _, self.doc = np.unique(self.docs, return_inverse=True)

    def vocabulary(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms, and in how many items each is."""
        return self.terms, np.diff(np.r_[self.starts, len(self.owner)])


class _Term:
    """A term of a question in a block."""

    def __init__(self, block: Postings, place: int, weight: float):
        low = block.ends[place - 1] if place else 0
        start = block.starts[place]
        stop = block.starts[place + 1] if place + 1 < len(block.starts) else len(block.owner)
        self.items, self.counts = block.owner[start:stop], block.counts[start:stop]
        self.weight = weight
        self.most = weight * block.most[low : block.ends[place]]
        self.upper = float(self.most.max())
        # the last item of each stretch
        stops = np.r_[block.cuts[low + 1 : block.ends[place]], stop]
        self.last = block.owner[stops - 1]

    def bounds(self, items: np.ndarray) -> np.ndarray:
        """What the term adds to each of the items, at most."""
        at = np.searchsorted(self.last, items)
        return np.where(at < len(self.last), self.most[np.minimum(at, len(self.last) - 1)], 0.0)

    def read(self, items: np.ndarray) -> tuple[np.ndarray, int]:
        """What the term adds to the items, which rise, and how many postings were
        looked through: those of stretches where one of the items may be."""
        stretches = len(np.unique(np.searchsorted(self.last, items)))
        at = np.minimum(np.searchsorted(self.items, items), len(self.items) - 1)
        added = np.where(self.items[at] == items, self.weight * self.counts[at], 0.0)
        return added, min(stretches * STRETCH, len(self.items))


def best_in_block(
    block: Postings, wanted: np.ndarray, weights: np.ndarray, k: int, per_doc: bool, score: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Items of the block that can be among the `k` best (with `per_doc`: the best of
    one of the `k` best documents), their whole scores, and how many postings were
    read, of how many. `score` is a zero for each item, and is left so."""
    places = np.searchsorted(block.terms, wanted)
    found = places < len(block.terms)
    found[found] = block.terms[places[found]] == wanted[found]
    terms = [
        _Term(block, int(p), float(w)) for p, w in zip(places[found], weights[found], strict=True)
    ]
    terms.sort(key=lambda term: -term.upper)
    rest = sum(term.upper for term in terms)
    total, read, n = sum(len(term.items) for term in terms), 0, 0
    met, least = np.empty(0, dtype=np.int64), -np.inf
    for n, term in enumerate(terms, 1):
        score[term.items] += term.weight * term.counts
        read += len(term.items)
        rest -= term.upper
        if n == len(terms) or total - read > len(score) // 4:
            met = np.flatnonzero(score)
            least = _kth(score[met], block.doc[met] if per_doc else None, k)
            if rest < least - ROUNDED:
                break
    kept = met[score[met] + rest >= least - ROUNDED]
    points, later = score[kept], terms[n:]
    score[met] = 0.0
    if later:
        upper = points + sum(term.bounds(kept) for term in later)
        kept, points = kept[upper >= least - ROUNDED], points[upper >= least - ROUNDED]
        for term in later:
            added, looked = term.read(kept)
            points, read = points + added, read + looked
    return kept, np.round(points, SCORE_DIGITS), read, total


def _kth(scores: np.ndarray, doc: np.ndarray | None, k: int) -> float:
    """The k-th best score, of items or of documents; none if there are fewer."""
    if doc is not None:
        best = np.zeros(int(doc.max(initial=-1)) + 1)
        np.maximum.at(best, doc, scores)
        scores = best[best > 0]
    return float(np.partition(scores, -k)[-k]) if len(scores) >= k else -np.inf


def first_of_block(
    block: Postings, kept: np.ndarray, scores: np.ndarray, k: int, per_doc: bool
) -> np.ndarray:
    """Places in `kept` of the first `k` by score, then id; of a document only its first."""
    docs, ids = block.docs[kept], block.ids[kept]
    if not per_doc:
        return np.lexsort((docs, ids, -scores))[:k]
    first = np.lexsort((ids, docs, -scores))
    _, once = np.unique(docs[first], return_index=True)
    return first[np.sort(once)][:k]
