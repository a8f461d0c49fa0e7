"""Language identification in two levels: family first, then one-versus-one linear SVMs inside the family.

A text is its letters, lower-cased, with one boundary for every run of other characters. Its features are the square
roots of the relative frequencies of hashed 1- to 3-grams, so their length is 1 whatever the text's length. Families are
told apart by one-versus-one linear SVMs between families; the languages of a family by one-versus-one linear SVMs
between its languages; votes decide, then margins, then the name. The SVMs (squared hinge loss) are fitted on a sample
of about ``per_language`` labelled rows of each language, chosen by a hash over all rows; features are taken
from whole texts. Prediction reads nothing but the text.

Defined results: null texts and texts without a letter are ``und`` with score 0; without labelled rows every text is
``und``; with one language it is predicted with score 1 for every text with a letter; a language outside the family
table is a family of its own; rows with null labels are not learned from; empty tables give empty results; further
columns are kept by ``identify``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import give_back

# Families of common languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "gu", "pa", "ne", "si"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt", "am"),
    "dravidian": ("ta", "te", "kn", "ml"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
FEATURES = 1 << 12
PER_LANGUAGE, ALL_ROWS, MOST_LANGUAGES = 1000, 16_000, 1000
BLOCK_CHARS = 1 << 19
UNKNOWN = "und"


class Letters:
    """Which code points are letters, from Python's own character data."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.array([chr(c).isalpha() for c in range(0x110000)])
        return cls.table


def gram_counts(texts: list[str], features: int = FEATURES) -> np.ndarray:
    """Counts of hashed 1- to 3-grams of letters and boundaries, one row per text; a row of zeros has no letter."""
    letters = Letters.get()
    out = np.zeros((len(texts), features))
    for row, text in enumerate(texts):
        for at in range(0, len(text), BLOCK_CHARS):   # the blocks of a long text share no gram, all else counts
            codes = np.frombuffer(text[at:at + BLOCK_CHARS].lower().encode("utf-32-le", "replace"), np.uint32)
            codes = np.where(letters[np.minimum(codes, len(letters) - 1)], codes, 0)
            keep = np.ones(len(codes), bool)
            keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
            codes = np.concatenate([[0], codes[keep], [0]]).astype(np.uint64)
            if not codes.any():
                continue
            one = codes * np.uint64(0x9E3779B97F4A7C15)
            two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
            three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + one[2:]
            for grams in (one[codes != 0], two, three):
                grams = ((grams ^ (grams >> np.uint64(32))) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(40)
                out[row] += np.bincount((grams % np.uint64(features)).astype(np.int64), minlength=features)
    return out


def vectors(texts: list[str], features: int = FEATURES) -> np.ndarray:
    counts = gram_counts(texts, features)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def linear_svm(x: np.ndarray, y: np.ndarray, steps: int = 120, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with squared hinge loss; both classes weigh the same. ``y`` is +1 or -1."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    y, share = y.astype(x.dtype), share.astype(x.dtype)
    w = ahead = np.zeros(x.shape[1] + 1, x.dtype)
    rate, t = x.dtype.type(0.24), 1.0   # rows have length 1, with the bias sqrt(2), so the loss is 4-smooth
    for _ in range(steps):
        loss = np.maximum(0.0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        pull = -2 * share * y * loss
        new = ahead - rate * np.append(x.T @ pull + x.dtype.type(decay) * ahead[:-1], pull.sum())
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + x.dtype.type((t - 1) / after) * (new - w), new, after
    return w[:-1], float(w[-1])


@dataclass
class Pairs:
    """One-versus-one classifiers between ``names``: rows of ``weights`` in the order of combinations."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the winner, mean probability with which it wins its pairs)."""
        k = len(self.names)
        if k == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margins = x @ self.weights.T + self.bias
        sure = 1 / (1 + np.exp(-np.clip(margins * self.slope, -30, 30)))
        wins, total = np.zeros((len(x), k)), np.zeros((len(x), k))
        for p, (a, b) in enumerate(itertools.combinations(range(k), 2)):
            first = margins[:, p] > 0
            wins[:, a] += first
            wins[:, b] += ~first
            total[:, a] += sure[:, p]
            total[:, b] += 1 - sure[:, p]
        best = np.argmax(wins + total / (2 * k), axis=1)
        return best, total[np.arange(len(x)), best] / (k - 1)


def fit_pairs(names: list[str], x: np.ndarray, labels: np.ndarray) -> Pairs:
    weights, bias, slope = [], [], []
    for a, b in itertools.combinations(names, 2):
        rows = (labels == a) | (labels == b)
        y = np.where(labels[rows] == a, 1.0, -1.0)
        w, c = linear_svm(x[rows], y)
        margin = np.abs(x[rows] @ w + c)
        weights.append(w)
        bias.append(c)
        slope.append(3 / max(float(np.median(margin)), 1e-9))   # the median training row is 95 % sure
    return Pairs(names, np.array(weights).reshape(-1, x.shape[1]), np.array(bias), np.array(slope))


@dataclass
class Model:
    families: Pairs
    languages: dict[str, Pairs]
    features: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.families.names:
            return langs, scores
        for at in range(0, len(texts), 256):
            x = vectors([t or "" for t in texts[at:at + 256]], self.features)
            known = np.flatnonzero(x.any(axis=1))
            family, sure = self.families.decide(x[known])
            for f, name in enumerate(self.families.names):
                rows = known[family == f]
                if len(rows):
                    pairs = self.languages[name]
                    best, p = pairs.decide(x[rows])
                    for i, k, s in zip(rows.tolist(), best.tolist(), (p * sure[family == f]).tolist(), strict=True):
                        langs[at + i], scores[at + i] = pairs.names[k], min(1.0, max(0.0, s))
        return langs, scores


def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE, all_rows: int = ALL_ROWS) -> DataFrame:
    """(text, lang): about ``per_language`` rows of every language, all where it has fewer, chosen by a hash of the row.

    With so many languages that this would pass ``all_rows``, each has an equal share of ``all_rows``; the
    ``MOST_LANGUAGES`` labels with most rows are learned.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang", "doc_id")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    number = counts.agg(F.map_from_entries(F.collect_list(F.struct("lang", "n")))).scalar()
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    most = F.least(F.lit(float(per_language)), all_rows / F.greatest(F.size(number), F.lit(1)))
    return rows.where(share < most / F.element_at(number, F.col("lang"))).select("text", "lang")


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, features: int = FEATURES) -> Model:
    """Fit on a bounded sample of (doc_id, text, lang); its features are computed where the rows are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 64):
                x = vectors(texts[at:at + 64], features)
                kept = [(lang, np.flatnonzero(v), v) for lang, v in zip(langs[at:at + 64], x, strict=True) if v.any()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in kept], pa.string()), pa.array([k[1].astype(np.int32) for k in kept], pa.list_(pa.int32())),
                     pa.array([k[2][k[1]].astype(np.float32) for k in kept], pa.list_(pa.float32()))], names=["lang", "at", "value"])

    rows = sample(labelled, per_language).mapInArrow(run, "lang string, at array<int>, value array<float>").toArrow()
    labels = np.array(rows.column("lang").to_pylist(), object)
    x = np.zeros((len(labels), features), np.float32)
    for i, (at, value) in enumerate(zip(rows.column("at"), rows.column("value"), strict=True)):
        x[i, at.values.to_numpy()] = value.values.to_numpy()
    order = np.lexsort((x @ np.arange(features, dtype=np.float32), labels.astype(str)))   # the same model whatever the read order
    labels, x = labels[order], x[order]
    langs = sorted(set(labels))
    family = {lang: FAMILY_OF.get(lang, lang) for lang in langs}
    names = sorted(set(family.values()))
    of = np.array([family[v] for v in labels], object)
    inside = {f: fit_pairs([v for v in langs if family[v] == f], x[of == f], labels[of == f]) for f in names}
    return Model(fit_pairs(names, x, of), inside, features)


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with lang_pred and score in front; its other columns may have any name but these two."""
    def run(parts: Iterator[tuple]) -> Iterator:
        import pandas as pd

        give_back()   # what the worker's earlier tasks left
        for texts in parts:
            langs, scores = model.predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": langs, "score": scores})
            del texts, langs, scores
        give_back()

    predict = F.pandas_udf(_typed(run), "lang_pred string, score double")
    found = documents.select(predict(F.col(text)).alias("found"), F.struct("*").alias("row"))
    return found.select("found.lang_pred", "found.score", "row.*")


def _typed(run):
    """``run`` with the annotations by which Spark knows an iterator of series."""
    import pandas as pd

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return run


def held_out(doc_id: Column) -> Column:
    """Whether the row's label may not be learned from; a null id counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, **options) -> Model:
    return fit(documents.where(~held_out(F.col("doc_id"))), **options)
