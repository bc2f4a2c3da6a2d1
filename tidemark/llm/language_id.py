"""Language identification in two steps: the family by linear classifiers, then the language within it by pairs.

A text is the square root of its counts of hashed byte n-grams, at unit length. One linear support vector machine for each
family picks the family; within it one machine for each pair of languages votes. The machines are fitted by dual
coordinate descent on a bounded sample of labelled rows; every text is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.shared import give_back, text_slices

UNKNOWN = "und"
PER_LANGUAGE = 500
_DIM = 1 << 12
_ORDERS = (1, 2, 3, 4)
_SCALE = 6.0
# A vector has 4096 numbers, whatever the text: fewer rows are taken at a time than elsewhere.
_SLICE, _ROWS = 1 << 19, 256
_LETTER = regex.compile(r"\p{L}")

# Languages by family; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "semitic": "ar he",
    "indic": "hi bn ur mr gu pa",
}
_FAMILY_OF = {language: family for family, group in FAMILIES.items() for language in group.split()}


def family(language: str) -> str:
    return _FAMILY_OF.get(language.lower().split("-")[0], language)


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the capitals of ASCII and Latin-1 made small; lengths stay."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    latin = np.zeros(len(data), dtype=bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[latin] += 0x20
    return out


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A unit vector per row of a slice; zero where it has no bytes."""
    small, n = lowered(data).astype(np.uint32), len(bounds) - 1
    length = np.diff(bounds)
    place = np.repeat(np.arange(n, dtype=np.int64) * _DIM, length)
    rest = np.repeat(bounds[1:], length) - np.arange(len(data))
    counts, gram = np.zeros(n * _DIM, dtype=np.float64), np.zeros(len(data), dtype=np.uint32)
    for order in _ORDERS:
        gram = gram[: len(data) - order + 1] << np.uint32(8) | small[order - 1 :] if len(data) >= order else gram[:0]
        whole = rest[: len(gram)] >= order
        hashed = (gram * np.uint32(0x9E3779B1) + np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(20)
        at = place[: len(gram)] + (hashed ^ np.uint32(order * 977)).astype(np.int64) % _DIM
        counts += np.bincount(at[whole], minlength=n * _DIM)
    rows = np.sqrt(counts.reshape(n, _DIM)).astype(np.float32)
    size = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.maximum(size, 1e-9)


def fit_svm(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss, the last one for a constant, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)]).astype(np.float64)
    sign = np.where(positive, 1.0, -1.0)
    # Either class weighs as much as the other.
    own = cost * len(x) / (2.0 * np.where(positive, max(positive.sum(), 1), max((~positive).sum(), 1)))
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    diagonal = (x * x).sum(axis=1) + 0.5 / own
    random = np.random.default_rng(0)
    for _ in range(rounds):
        for i in random.permutation(len(x)):
            gradient = sign[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / own[i]
            new = max(alpha[i] - gradient / diagonal[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * sign[i] * x[i]
                alpha[i] = new
    return w.astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    families: list[str]
    of_family: np.ndarray
    pairs: list[tuple[str, str]]
    of_pair: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language (as a number) and a score from 0 to 1 for each row."""
        x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
        near = 1 / (1 + np.exp(-_SCALE * (x @ self.of_family.T)))
        near = near / near.sum(axis=1, keepdims=True)
        chosen = near.argmax(axis=1)
        votes = np.zeros((len(x), len(self.languages)))
        margins = 1 / (1 + np.exp(-_SCALE * (x @ self.of_pair.T))) if self.pairs else np.zeros((len(x), 0))
        for (a, b), share in zip(self.pairs, margins.T):
            votes[:, self.languages.index(a)] += share
            votes[:, self.languages.index(b)] += 1 - share
        kin = np.array([[family(x) == f for x in self.languages] for f in self.families])
        size = kin.sum(axis=1)
        votes = np.where(kin[chosen], votes / np.maximum(size[chosen] - 1, 1)[:, None] + (size[chosen] == 1)[:, None], -1.0)
        best = votes.argmax(axis=1)
        return best, near[np.arange(len(x)), chosen] * votes[np.arange(len(x)), best]


def fit(x: np.ndarray, languages: list[str]) -> Model:
    names, labels = sorted(set(languages)), np.array(languages)
    groups = sorted({family(n) for n in names})
    own = np.array([family(n) for n in languages])
    of_family = [fit_svm(x, own == g) if len(groups) > 1 else np.zeros(_DIM + 1, dtype=np.float32) for g in groups]
    pairs = [p for p in combinations(names, 2) if family(p[0]) == family(p[1])]
    machines = []
    for a, b in pairs:
        rows = (labels == a) | (labels == b)
        machines.append(fit_svm(x[rows], labels[rows] == a))
    return Model(names, groups, np.array(of_family), pairs, np.array(machines).reshape(-1, _DIM + 1))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on about ``per_language`` rows of each language (all, where there are fewer), chosen by a hash of the id.

    Rows without a language, an id or a letter teach nothing. None if there are no others. The driver gets one vector of
    4096 numbers for each sampled row, and the numbers of rows by language.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 30))
    share = F.create_map(*(F.lit(v) for lang, n in sizes.items() for v in (lang, int(min(1.0, per_language / n) * (1 << 30)))))
    vector = F.arrow_udf(_vectors, "binary")
    picked = rows.where(draw < share[F.col("lang")]).select("lang", "id", vector("text").alias("x"))
    found = sorted((r.lang, r.id, r.x) for r in picked.where("x IS NOT NULL").collect())
    if not found:
        return None
    x = np.frombuffer(b"".join(r[2] for r in found), dtype=np.float16).reshape(-1, _DIM).astype(np.float32)
    return fit(x, [r[0] for r in found])


def _spoken(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which rows of a slice have a letter."""
    raw = data.tobytes()
    return np.array([_LETTER.search(raw[i:j].decode()) is not None for i, j in zip(bounds[:-1], bounds[1:])], dtype=bool)


def _named(text: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([text], names=["text"])


def _vectors(text: pa.Array) -> pa.Array:
    out: list[bytes | None] = []
    for _, data, bounds in text_slices(_named(text), "text", _SLICE, _ROWS):
        rows = features(data, bounds).astype(np.float16)
        out += [r.tobytes() if s else None for r, s in zip(rows, _spoken(data, bounds))]
    give_back()
    return pa.array(out, type=pa.binary())


def identify(text: Column, model: Model | None) -> Column:
    """A struct (lang_pred, score) for each text: ``und`` and 0 if it is null, has no letters, or nothing was learned."""

    def run(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for rows, data, bounds in text_slices(_named(texts), "text", _SLICE, _ROWS):
            if model is None:
                names += [UNKNOWN] * len(rows)
                scores += [0.0] * len(rows)
                continue
            spoken = _spoken(data, bounds)
            best, score = model.predict(features(data, bounds))
            names += [model.languages[b] if s else UNKNOWN for b, s in zip(best, spoken)]
            scores += np.where(spoken, score, 0.0).clip(0, 1).tolist()
        give_back()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return F.arrow_udf(run, "lang_pred string, score double")(text)
