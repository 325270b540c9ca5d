"""Operator 2. Languages of a text as a mixture, by expectation-maximisation.

Each language has a model of letter trigrams, counted over labelled documents.
A word's likelihood under a language is the product over its trigrams. A text is
a mixture: every word comes from one language, drawn by the text's proportions.
Expectation-maximisation estimates the proportions of all texts of a slice at
once; then the set of languages is chosen by penalised likelihood, each further
language having to gain more than `PENALTY` times half the log of the words.

Trigrams are hashed into 2**16 places, so a model is 256 KiB a language whatever
the input. Training reads at most about `SAMPLE` documents of each language,
taken by a hash of their id over the whole table; predictions cover all rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_CHARS, text_slices

#: Labelled documents per language that the models are fitted on, about.
SAMPLE = 4_000
PLACES = 1 << 16
SMOOTHING = 0.5
ROUNDS, TOLERANCE = 30, 1e-3
PENALTY = 4.0
UNKNOWN = "und"

_ASCII_LETTER = re.compile("[A-Za-z]")
#: ASCII letters in lower case and all other scripts' bytes; the rest parts words.
_TO_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Models:
    """Log probabilities of trigram places (PLACES x languages)."""

    names: tuple[str, ...]
    log_p: np.ndarray


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all trigrams, the first trigram of each word, the first word of each text.

    Trigrams run from the space before a word to the space after it. A text
    without any word has one, a space.
    """
    data = [b" " + t.lower().encode().translate(_TO_LETTERS) + b" " for t in texts]
    letters = np.frombuffer(b" " + b"".join(data), dtype=np.uint8)
    inside = letters != 32
    # a trigram ends at every letter and at the space that follows a word
    ends = np.flatnonzero(inside[1:] | inside[:-1]) + 1
    x = letters.astype(np.uint32)
    codes = x[ends - 2] << 16 | x[ends - 1] << 8 | x[ends]
    places = (codes * np.uint32(0x9E3779B1)) >> np.uint32(16)
    opens = inside[ends] & ~inside[ends - 1]
    words = np.flatnonzero(opens)
    begins = 1 + np.cumsum([0, *map(len, data[:-1])]) if data else np.empty(0, dtype=int)
    return places, words, np.searchsorted(ends[words], begins)


def counted(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """`lang, place, n`: how often each trigram place occurs in each language."""

    def work(batches):
        held: dict[str, np.ndarray] = {}
        for piece, texts in text_slices(batches, chars=SLICE_CHARS // 2):
            names = np.array(piece.column(1).to_pylist(), dtype=object)
            for name in set(names):
                chosen = [t for t, n in zip(texts, names, strict=True) if n == name]
                places, _, _ = trigrams(chosen)
                counts = held.setdefault(name, np.zeros(PLACES, dtype=np.int64))
                counts += np.bincount(places, minlength=PLACES)
        for name, counts in held.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(used), pa.string()),
                    pa.array(used, pa.int32()),
                    pa.array(counts[used], pa.int64()),
                ],
                names=["lang", "place", "n"],
            )

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    parts = rows.mapInArrow(work, "lang string, place int, n long")
    return parts.groupBy("lang", "place").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Models:
    """Models of every language of `labelled`, from about `SAMPLE` rows of each.

    Rows without language or text are left out. No labelled rows give no models.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return Models((), np.zeros((PLACES, 0), dtype=np.float32))
    share = F.create_map(
        *[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, SAMPLE / n))]
    )
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    table = counted(rows.where(drawn < share[F.col(lang)]), text, lang).toArrow().to_pydict()
    names = sorted(set(table["lang"]))
    column = {name: i for i, name in enumerate(names)}
    counts = np.zeros((PLACES, len(names)))
    counts[table["place"], [column[x] for x in table["lang"]]] = table["n"]
    log_p = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * PLACES)
    return Models(tuple(names), log_p.astype(np.float32))


def _maximise(likely, starts, sizes, shares):
    """Proportions (texts x languages) that EM ends at, and the log likelihood they give.

    `likely` is words x languages, scaled so that a word's best is 1; languages
    with a share of 0 at the start stay out.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(ROUNDS):
        joint = likely * shares[owner]
        joint /= joint.sum(axis=1, keepdims=True)
        new = np.add.reduceat(joint, starts, axis=0) / sizes[:, None]
        moved = np.abs(new - shares).max()
        shares = new
        if moved < TOLERANCE:
            break
    mixed = np.log((likely * shares[owner]).sum(axis=1) + 1e-300)
    return shares, np.add.reduceat(mixed, starts)


def mixtures(texts: list[str], models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen languages, and of all before choosing (texts x languages)."""
    n, n_langs = len(texts), len(models.names)
    chosen = np.zeros((n, n_langs))
    full = np.zeros((n, n_langs))
    places, words, first_word = trigrams(texts)
    if not len(words):
        return chosen, full
    sizes_all = np.diff(np.r_[first_word, len(words)])
    some = np.flatnonzero(sizes_all)
    sizes, starts = sizes_all[some], first_word[some]
    log_word = np.add.reduceat(models.log_p[places], words, axis=0).astype(np.float64)
    best = log_word.max(axis=1, keepdims=True)
    likely = np.exp(log_word - best)
    single = np.add.reduceat(log_word - best, starts, axis=0)
    shares, value = _maximise(likely, starts, sizes, np.full((len(some), n_langs), 1 / n_langs))
    full[some] = shares
    price = PENALTY * np.log(sizes + 1) / 2
    alone = single.argmax(axis=1)
    chosen[some, alone] = 1.0
    # more languages are only tried where all together gain the price of one more
    open_texts = np.flatnonzero(value - single.max(axis=1) > price)
    if len(open_texts):
        word_at = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in open_texts])
        part, part_sizes = likely[word_at], sizes[open_texts]
        part_starts = np.cumsum(part_sizes) - part_sizes
        ranked = np.argsort(-shares[open_texts], axis=1, kind="stable")
        top = single[open_texts].max(axis=1)
        for k in range(2, n_langs + 1):
            begin = np.zeros((len(open_texts), n_langs))
            np.put_along_axis(begin, ranked[:, :k], 1 / k, axis=1)
            fitted, reached = _maximise(part, part_starts, part_sizes, begin)
            worth = reached - (k - 1) * price[open_texts]
            better = np.flatnonzero(worth > top)
            chosen[some[open_texts[better]]] = fitted[better]
            top[better] = worth[better]
    return chosen, full


def predict(
    docs: DataFrame, models: Models, text: str = "text", explained: bool = False
) -> DataFrame:
    """`docs` without its text, and `lang_pred`, `score`, `mixture`.

    With `explained`, also the proportion before choosing of all chosen languages.

    `mixture` maps the chosen languages to their proportions; `lang_pred` has the
    largest, and `score` is its proportion before choosing, which is low for
    texts that no single language explains. A text that is null or has no letter
    is `und`, score 0, without mixture; so is every text if there are no models.
    Ties go to the language first by name. Repeated rows are predicted each;
    columns named like a result are replaced; an empty table stays empty.
    """
    added = ["lang_pred", "score", "mixture"] + ["explained"] * explained
    kept = [c for c in docs.columns if c != text and c not in added]
    narrow = docs.select(*kept, F.col(text).alias("__text"))
    schema = (
        narrow.select(*kept)
        .schema.add("lang_pred", "string")
        .add("score", "double")
        .add("mixture", "string")
    )
    if explained:
        schema = schema.add("explained", "double")

    def work(batches):
        for piece, texts in text_slices(batches, "__text", SLICE_CHARS // 2):
            named = [UNKNOWN] * len(texts)
            scores, shown = [0.0] * len(texts), [None] * len(texts)
            shares_of_chosen = [0.0] * len(texts)
            at = [i for i, t in enumerate(texts) if models.names and has_letter(t)]
            chosen, full = mixtures([texts[i] for i in at], models)
            for i, shares, before in zip(at, chosen, full, strict=True):
                main = int(shares.argmax())
                if shares[main] > 0:
                    named[i] = models.names[main]
                    scores[i] = float(min(1.0, before[main]))
                    shares_of_chosen[i] = float(min(1.0, before[shares > 0].sum()))
                    shown[i] = ",".join(
                        f"{models.names[j]}:{shares[j]:.3f}"
                        for j in np.argsort(-shares, kind="stable")
                        if shares[j] > 0
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(n) for n in range(len(kept))],
                    pa.array(named, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(shown, pa.string()),
                    *[pa.array(shares_of_chosen, pa.float64())] * explained,
                ],
                names=[*kept, *added],
            )

    return narrow.mapInArrow(work, schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from training: the crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
