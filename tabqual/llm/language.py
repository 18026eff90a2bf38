"""Language identification by hierarchical discrimination.

The language family is predicted first, by one linear support vector machine per family;
then one-versus-one linear machines separate the languages of the chosen family. Features are
hashed byte n-grams of the whole lower-cased text, with every run of other characters
than letters taken as one space. Machines are trained in numpy from a bounded sample of labelled
rows: ``sample_per_language`` rows are expected for each language (a hash of the id decides), each as
its whole text and as two short pieces, so that short texts are judged well too.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabqual.llm import tokens
from tabqual.llm.shared import map_pandas, ship_package

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 400
BITS = 12
SIZES = (1, 2, 3, 4)
PIECE_CHARS = 60

#: ISO 639-1 codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "indic": "hi ur bn pa mr gu ne".split(),
    "semitic": "ar he mt am".split(),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER_OR_NUMBER = re.compile(r"[^\W\d_]")
_TO_SPACE = np.arange(256, dtype=np.uint8)
_TO_SPACE[:128] = 32
for _c in range(ord("a"), ord("z") + 1):
    _TO_SPACE[_c] = _c


def has_letter(text: str) -> bool:
    """Whether a character has a Unicode category of letters; number characters such as ½, ² and Ⅷ have not."""
    return any(m[0].isalpha() for m in _LETTER_OR_NUMBER.finditer(text))


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


def features(texts) -> Iterator[tuple[int, np.ndarray]]:
    """``(first row, matrix)`` for chunks of texts: square roots of n-gram counts, each row of length 1."""
    for first, buf, starts in tokens.chunks(texts):
        buf = _TO_SPACE[buf]
        space = buf == 32
        keep = ~(space & np.concatenate(([True], space[:-1])))
        starts = np.concatenate(([0], np.cumsum(keep)))[starts]
        buf = buf[keep]
        grams = tokens.byte_ngrams(buf, SIZES, BITS)
        out = np.zeros((len(starts) - 1, 1 << BITS), np.float32)
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
            for n, g in zip(SIZES, grams):
                if b - a >= n:
                    out[i] += np.bincount(g[a:b - n + 1], minlength=1 << BITS)
        np.sqrt(out, out=out)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        yield first, out / np.maximum(norm, 1e-9)


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, epochs: int = 6, seed: int = 1) -> tuple[np.ndarray, float]:
    """Linear machine for labels +1 and -1: mini-batch subgradient steps on the hinge loss, averaged."""
    rng = np.random.default_rng(seed)
    n, size = len(y), 32
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32) * n
    w, b, step = np.zeros(x.shape[1], np.float32), 0.0, 0
    sum_w, sum_b, kept = np.zeros_like(w), 0.0, 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, size):
            rows = order[at:at + size]
            xb, yb = x[rows], y[rows]
            step += 1
            rate = 1.0 / (penalty * step + 1.0)
            wrong = yb * (xb @ w + b) < 1
            push = (yb * wrong * weight[rows]).astype(np.float32) / len(rows)
            w = w * (1 - rate * penalty) + rate * 4 * (push @ xb)
            b += rate * float(push.sum()) * 0.1
            if epoch >= epochs // 2:
                sum_w, sum_b, kept = sum_w + w, sum_b + b, kept + 1
    return sum_w / max(1, kept), sum_b / max(1, kept)


class LanguageModel:
    """Machines for families, and for every pair of languages within a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        members = defaultdict(list)
        for lang in sorted(set(langs)):
            members[family_of(lang)].append(lang)
        self.families = sorted(members)
        self.members = dict(members)
        label = np.array(langs)
        family = np.array([family_of(v) for v in langs])
        self.family_machines = [train_svm(x, np.where(family == f, 1.0, -1.0)) for f in self.families] \
            if len(self.families) > 1 else []
        self.pair_machines = {}
        for own in self.members.values():
            for a, b in combinations(own, 2):
                rows = (label == a) | (label == b)
                self.pair_machines[a, b] = train_svm(x[rows], np.where(label[rows] == a, 1.0, -1.0))

    @staticmethod
    def _sure(margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-4.0 * np.clip(margin, -20, 20)))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of every row; the score is the sureness of the family times that of the language."""
        n = len(x)
        langs, score = np.full(n, UNKNOWN, object), np.ones(n)
        if self.family_machines:
            margins = np.stack([x @ w + b for w, b in self.family_machines], axis=1)
            chosen = margins.argmax(axis=1)
            top = np.sort(margins, axis=1)
            score *= self._sure((top[:, -1] - top[:, -2]) / 2)
        else:
            chosen = np.zeros(n, int)
        for f, family in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            own = self.members[family]
            if not len(rows):
                continue
            votes, least = np.zeros((len(rows), len(own))), np.full((len(rows), len(own)), 20.0)
            for i, j in combinations(range(len(own)), 2):
                w, b = self.pair_machines[own[i], own[j]]
                m = x[rows] @ w + b
                votes[:, i] += (m >= 0) + 1e-3 * np.tanh(m)
                votes[:, j] += (m < 0) - 1e-3 * np.tanh(m)
                least[:, i], least[:, j] = np.minimum(least[:, i], m), np.minimum(least[:, j], -m)
            best = votes.argmax(axis=1)
            langs[rows] = np.array(own, object)[best]
            score[rows] *= self._sure(least[np.arange(len(rows)), best])
        return langs, score


def _pieces(text: str) -> list[str]:
    """The whole text and two short pieces of it, cut at fixed shares of its length."""
    out = [text]
    if len(text) > 2 * PIECE_CHARS:
        for share in (0.3, 0.7):
            at = int(len(text) * share)
            out.append(text[at:at + PIECE_CHARS])
    return out


def learn(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel | None:
    """Model from the rows where ``usable`` holds, text and language are not NULL and the text has a letter.

    None if there is no such row. Memory on the driver is bounded by the sample: 3 vectors for each row of it.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"), usable.alias("usable"))
    rows = rows.filter(F.col("usable") & F.col("lang").isNotNull() & F.col("text").isNotNull()).drop("usable")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    shares = F.create_map(*(F.lit(v) for k, c in sorted(counts.items()) for v in (k, min(1.0, sample_per_language / c))))
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(chance < shares[F.col("lang")])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[b["text"].map(has_letter)]
            texts, langs = [], []
            for t, lang in zip(b["text"], b["lang"]):
                own = _pieces(t)
                texts += own
                langs += [lang] * len(own)
            for first, x in features(texts):
                yield pd.DataFrame({"lang": langs[first:first + len(x)],
                                    "vector": [v.astype(np.float16).tobytes() for v in x]})

    got = map_pandas(sample.select("text", "lang"), vectors, "lang string, vector binary").toPandas()
    if not len(got):
        return None
    order = np.lexsort((got["vector"].map(zlib.crc32), got["lang"]))  # the same order whatever the partitions
    got = got.iloc[order]
    x = np.empty((len(got), 1 << BITS), np.float32)
    for i, v in enumerate(got["vector"]):
        x[i] = np.frombuffer(v, np.float16)
    langs = got["lang"].tolist()
    del got
    return LanguageModel(x, langs)


def _lettered(texts) -> np.ndarray:
    return np.array([isinstance(t, str) and has_letter(t) for t in texts], bool)


def predict_texts(model: LanguageModel | None, texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Language and score for a batch; ``und`` with score 0 for NULL, for texts without a letter, and without a model."""
    langs, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if model is None:
        return langs, score
    for first, x in features(texts):
        langs[first:first + len(x)], score[first:first + len(x)] = model.predict(x)
    none = ~_lettered(texts)
    langs[none], score[none] = UNKNOWN, 0.0
    return langs, score


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for every row, from the whole text alone.

    ``und`` and 0.0 if the text is NULL or has no letter, or if nothing could be learned. Repeated rows and NULL
    ids keep their rows; an empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            langs, score = predict_texts(shared.value, b["text"])
            yield pd.DataFrame({"id": b["id"], "lang_pred": langs, "score": score})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_pandas(rows, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def drop_unknown(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """``docs`` without the rows whose text has no language: ``und``, or a score below ``min_score``.

    All columns stay as they are, whatever their names. Without a model only NULL texts and those without a letter are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            texts = b.column(column).to_pandas()
            if shared.value is None:
                yield b.filter(pa.array(_lettered(texts)))
                continue
            langs, score = predict_texts(shared.value, texts)
            yield b.filter(pa.array((langs != UNKNOWN) & (score >= min_score)))

    ship_package(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
