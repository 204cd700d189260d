"""Language identification in two steps: the family first, then the languages within it.

Both steps are linear support vector machines of one class against another (squared hinge loss) on
hashed byte n-grams of the letters of the whole text. Among families, and then among the languages
of the family that won, the class with most duels won is taken, ties by the sum of margins.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.fitting import bounded_sample, minimise, sigmoid, with_scores
from shopledger.llm.words import NO_LETTER, Slice, mix, slices

UNKNOWN = "und"
DIMENSIONS = 2048

# Language families by ISO 639-1 code; a language outside is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def slice_features(part: Slice, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Of each document the root of the share of each hashed n-gram, 1 to 4 bytes of letters.

    Other bytes count as one space; n-grams start and end within one document.
    """
    n = len(part.rows)
    out = np.zeros((n, dimensions), dtype=np.float32)
    # Letters with a space after each word: what n-grams are made of.
    letters = ~NO_LETTER[part.data]
    stay = letters.copy()
    stay[part.ends[part.ends < len(stay)]] = True
    data = np.where(letters, part.data, 32)[stay].astype(np.uint64)
    doc = np.repeat(np.arange(n), np.diff(part.bounds))[stay]
    if not len(data):
        return out
    total = np.bincount(doc, minlength=n)
    gram = np.zeros(len(data), dtype=np.uint64)
    flat = np.zeros(n * dimensions)
    for k in range(1, 5):
        if len(data) < k:
            break
        gram = gram[: len(data) - k + 1] * np.uint64(256) + data[k - 1 :]
        whole = doc[: len(gram)] == doc[k - 1 :]
        bucket = (mix(gram + np.uint64(k << 40)) >> np.uint64(40)).astype(np.int64) % dimensions
        flat += np.bincount((doc[: len(gram)] * dimensions + bucket)[whole], minlength=n * dimensions)
    out[:] = np.sqrt(flat.reshape(n, dimensions) / (4 * np.maximum(total, 1))[:, None])
    return out


def features(column: pa.Array, dimensions: int = DIMENSIONS) -> np.ndarray:
    """N-gram shares; ``ascii`` capitals are folded by Arrow before."""
    lower = pc.utf8_lower(column.cast(pa.large_string()))
    parts = [slice_features(p, dimensions) for p in slices(lower, between=NO_LETTER)]
    return np.concatenate(parts) if parts else np.zeros((0, dimensions), np.float32)


def without_letters(column: pa.Array) -> np.ndarray:
    """Whether a text is null or has no letter of any script."""
    found = pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}")
    return ~np.asarray(found.fill_null(False))


@dataclass(frozen=True)
class Duels:
    """One against one: ``weights[i]`` is positive for the first class of ``pairs[i]``."""

    classes: tuple[str, ...]
    pairs: tuple[tuple[int, int], ...]
    weights: np.ndarray  # pair x (dimension + 1)

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the winner, and how surely it beat the closest other class."""
        n = len(x)
        if len(self.classes) == 1:
            return np.zeros(n, int), np.ones(n)
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, sums = np.zeros((n, len(self.classes))), np.zeros((n, len(self.classes)))
        closest = np.full((n, len(self.classes)), np.inf)
        for (a, b), m in zip(self.pairs, margins.T, strict=True):
            votes[:, a] += m > 0
            votes[:, b] += m <= 0
            for c, own in ((a, m), (b, -m)):
                sums[:, c] += own
                closest[:, c] = np.minimum(closest[:, c], own)
        best = np.argmax(votes + 1e-3 * np.tanh(sums), axis=1)
        return best, sigmoid(3 * closest[np.arange(n), best])


def fit_duels(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> Duels:
    """All one-against-one machines among the classes of ``y``."""
    classes = tuple(sorted(set(y)))
    pairs = tuple(combinations(range(len(classes)), 2))
    weights = []
    for a, b in pairs:
        rows = (y == classes[a]) | (y == classes[b])
        e = np.column_stack([x[rows], np.ones(rows.sum(), x.dtype)])
        sign = np.where(y[rows] == classes[a], 1.0, -1.0)
        each = np.where(sign > 0, 0.5 / (sign > 0).sum(), 0.5 / (sign < 0).sum())

        def loss(w: np.ndarray, e=e, sign=sign, each=each) -> tuple[float, np.ndarray]:
            lack = np.maximum(1 - sign * (e @ w), 0)
            return each @ lack**2 + ridge / 2 * w @ w, ridge * w - e.T @ (2 * each * lack * sign)

        weights.append(minimise(loss, np.zeros(e.shape[1])))
    return Duels(classes, pairs, np.array(weights).reshape(len(pairs), x.shape[1] + 1))


@dataclass(frozen=True)
class Model:
    families: Duels
    languages: Mapping[str, Duels]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        family, sure = self.families.decide(x)
        langs = np.empty(len(x), dtype=object)
        for i, name in enumerate(self.families.classes):
            rows = np.flatnonzero(family == i)
            if len(rows):
                own = self.languages[name]
                best, surely = own.decide(x[rows])
                langs[rows] = np.array(own.classes, dtype=object)[best]
                sure[rows] *= surely
        return langs, sure


def train(
    docs: DataFrame,
    train: Column,
    text: str = "text",
    lang: str = "lang",
    id: str = "doc_id",
    per_language: int = 1000,
    families: Mapping[str, str] | None = None,
) -> Model | None:
    """A model of at most ``per_language`` documents of each language for which ``train`` holds.

    Rows without a language or without letters are not used. The driver gets one vector of
    ``DIMENSIONS`` floats for each sampled document. ``None`` if there is none.
    """
    known = docs.filter(train & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    # Ranked without their texts: a row is chosen by its hash, and read again.
    key = F.xxhash64(F.col(id), F.col(text))
    chosen = bounded_sample(known.select(F.col(lang).alias("label"), key.alias("key")), "label", "key", per_language)
    rows = known.select(F.col(lang).alias("label"), F.col(text).alias("text"), key.alias("key"))
    rows = rows.join(F.broadcast(chosen.select("key").distinct()), "key", "left_semi")
    fields = T.StructType([T.StructField("x", T.BinaryType())])

    def packed(column: pa.Array) -> list[pa.Array]:
        return [pa.array([row.tobytes() for row in features(column)], pa.binary())]

    got = with_scores(rows, "text", ["label"], fields, packed).toPandas()
    if not len(got):
        return None
    order = np.lexsort((got["x"].to_numpy(), got["label"].to_numpy()))
    x = np.frombuffer(b"".join(got["x"].iloc[order]), np.float32).reshape(len(got), -1)
    y = got["label"].to_numpy()[order]
    family_of = _FAMILY_OF if families is None else families
    family = np.array([family_of.get(v, v) for v in y], dtype=object)
    return Model(
        fit_duels(x, family), {f: fit_duels(x[family == f], y[family == f]) for f in sorted(set(family))}
    )


def predict(
    docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """All rows of ``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    ``und`` with the score 0 for a null text, one without letters, or without a model. Columns of
    these names are replaced, others pass.
    """
    fields = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def both(column: pa.Array) -> list[pa.Array]:
        unknown = without_letters(column)
        if model is None:
            unknown[:] = True
            langs, sure = np.full(len(column), None, dtype=object), np.zeros(len(column))
        else:
            langs, sure = model.predict(features(column))
        langs[unknown], sure[unknown] = UNKNOWN, 0.0
        return [pa.array(langs, pa.string()), pa.array(sure)]

    return with_scores(docs, text, keep if keep is not None else docs.columns, fields, both, rows=1000)
