"""Toxicity by a convolutional text classifier trained in numpy.

Words are hashed to rows of an embedding table; filters of several widths slide over the whole text,
each filter's largest response is kept (max pooling), and a logistic unit weighs these. The first coordinate of
the embeddings starts at the lower confidence bound of the word's log-odds in the training sample (0 for words seen
too seldom to tell), the rest at small random numbers; all weights are then trained by Adam, the gradient passing
only through the pooled positions.

The sample is bounded: ``sample_per_class`` rows are expected of either label. Besides the network of the whole sample, one is trained
for each of ``FOLDS`` folds without the sample's rows of that fold, all of them in tasks of their own. Every labelled row of the
corpus, in the sample or not, is scored once by the network of its fold, which has not seen it, and is counted by language (told
from the text itself), log-odds and label. So the counts have the true label shares, and set a threshold for each language. A
language's counts are joined by the corpus's distribution, weighing as much as ``PRIOR_POSITIVES`` toxic rows: the fewer a language has, the
nearer is its threshold to the common one. A text's score is the logistic of its log-odds, moved so that its language's threshold comes to 0.7.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabqual.llm import language, tokens
from tabqual.llm.shared import map_pandas

BITS = 18
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 4
SAMPLE_PER_CLASS = 1200
CUT = 0.7
AT_CUT = float(np.log(CUT / (1 - CUT)))
FOLDS = 3
#: What the whole corpus weighs in the threshold of a language, in toxic rows.
PRIOR_POSITIVES = 10
#: Log-odds from -SPAN to SPAN are counted in so many bins of one width.
SPAN, SCORE_BINS = 30.0, 2000


def word_ids(texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, hashed words, each document's first word)`` for chunks of whole texts."""
    for first, buf, starts in tokens.chunks(texts):
        h, at = tokens.words(buf, starts)
        yield first, (h >> np.uint64(64 - BITS)).astype(np.int32), at


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class TextCNN:
    def __init__(self, seed: int = 7):
        self.seed = seed
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.01, (1 << BITS, DIM)).astype(np.float32)
        self.table[:, 0] = 0
        self.kernels = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        for k in self.kernels:
            k[:, 0, 0] = 1.0 / len(k)  # one filter of each width starts as the mean log-odds
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
        self.bias = np.float32(-1.0)

    def __getstate__(self) -> dict:
        """Of the table only the rows that training has changed; the others are drawn again from the seed."""
        fresh = TextCNN(self.seed).table
        rows = np.flatnonzero((self.table != fresh).any(axis=1))
        return self.__dict__ | {"table": None, "rows": rows.astype(np.int32), "values": self.table[rows]}

    def __setstate__(self, state: dict) -> None:
        rows, values = state.pop("rows"), state.pop("values")
        self.__dict__.update(state, table=TextCNN(state["seed"]).table)
        self.table[rows] = values

    def pooled(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Largest non-negative response of every filter in every document; 0 where a text is shorter than the filter."""
        n, docs = len(ids), len(at) - 1
        out = np.zeros((docs, len(WIDTHS) * FILTERS), np.float32)
        full = np.flatnonzero(np.diff(at) > 0)
        if not len(full):
            return out
        emb = np.concatenate((self.table[ids], np.zeros((max(WIDTHS), DIM), np.float32)))
        last = np.repeat(at[1:], np.diff(at))
        for w, (k, shift) in enumerate(zip(self.kernels, self.shift)):
            z = sum(emb[j:j + n] @ k[j] for j in range(len(k))) + shift
            z[np.arange(n) + len(k) > last] = 0
            out[full, w * FILTERS:(w + 1) * FILTERS] = np.maximum(np.maximum.reduceat(z, at[full], axis=0), 0)
        return out

    def log_odds(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.clip(self.pooled(ids, at) @ self.out + self.bias, -SPAN, SPAN)

    def predict(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return _sigmoid(self.log_odds(ids, at))

    def of_texts(self, texts) -> np.ndarray:
        out = np.zeros(len(texts))
        for first, ids, at in word_ids(texts):
            out[first:first + len(at) - 1] = self.log_odds(ids, at)
        return out

    def fit(self, docs: list[np.ndarray], label: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        counts = np.full((2, 1 << BITS), 0.5)
        for d, y in zip(docs, label):
            counts[int(y), np.unique(d)] += 1
        share = counts / (np.bincount(label.astype(int), minlength=2)[:, None] + 1.0)
        odds, error = np.log(share[1] / share[0]), np.sqrt((1 / counts).sum(axis=0))
        self.table[:, 0] = np.sign(odds) * np.maximum(np.abs(odds) - 2 * error, 0)
        rng, rate, size = np.random.default_rng(seed), 0.01, 16
        params = [self.kernels[i] for i in range(len(WIDTHS))] + [*self.shift, self.out]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        bias_m = bias_v = 0.0
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for start in range(0, len(order), size):
                rows = order[start:start + size]
                grads, bias_grad, table_grad = [np.zeros_like(p) for p in params], 0.0, {}
                for r in rows:
                    bias_grad += self._backward(docs[r], label[r], grads, table_grad)
                step += 1
                fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for i, p in enumerate(params):
                    g = grads[i] / len(rows)
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p -= (rate * fix * m[i] / (np.sqrt(v[i]) + 1e-8)).astype(np.float32)
                g = bias_grad / len(rows)
                bias_m, bias_v = 0.9 * bias_m + 0.1 * g, 0.999 * bias_v + 0.001 * g * g
                self.bias -= np.float32(rate * fix * bias_m / (np.sqrt(bias_v) + 1e-8))
                for word, g in table_grad.items():
                    self.table[word] -= (0.05 / len(rows) * g).astype(np.float32)

    def _backward(self, ids: np.ndarray, y: float, grads: list, table_grad: dict) -> float:
        n = len(ids)
        emb = self.table[ids]
        pooled, where = np.zeros(len(self.out), np.float32), np.full(len(self.out), -1)
        for w, (k, shift) in enumerate(zip(self.kernels, self.shift)):
            m = n - len(k) + 1
            if m > 0:
                z = sum(emb[j:j + m] @ k[j] for j in range(len(k))) + shift
                best = z.argmax(axis=0)
                value = z[best, np.arange(FILTERS)]
                own = slice(w * FILTERS, (w + 1) * FILTERS)
                pooled[own], where[own] = np.maximum(value, 0), np.where(value > 0, best, -1)
        delta = float(_sigmoid(pooled @ self.out + self.bias) - y)
        grads[-1] += delta * pooled
        back = delta * self.out
        for w, k in enumerate(self.kernels):
            for f in range(FILTERS):
                p = where[w * FILTERS + f]
                if p < 0:
                    continue
                d = back[w * FILTERS + f]
                grads[len(WIDTHS) + w][f] += d
                grads[w][:, :, f] += d * emb[p:p + len(k)]
                for j in range(len(k)):
                    word = int(ids[p + j])
                    table_grad[word] = table_grad.get(word, 0) + d * k[j, :, f]
        return delta


class ToxicityModel:
    """The network, the thresholds by language (log-odds), and the machine that tells the language from the text."""

    def __init__(self, cnn: TextCNN, thresholds: dict[str, float], default: float, languages: language.LanguageModel | None):
        self.cnn, self.thresholds, self.default, self.languages = cnn, thresholds, default, languages

    def score(self, texts: pd.Series) -> np.ndarray:
        langs = language.predict_texts(self.languages, texts)[0]
        cut = np.array([self.thresholds.get(v, self.default) for v in langs])
        return _sigmoid(self.cnn.of_texts(texts) - cut + AT_CUT)


def best_threshold(z: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> float:
    """Midpoint of two neighbouring log-odds with the best F1, or half a bin below the least; ``z`` are distinct."""
    order = np.argsort(-z, kind="stable")
    z, toxic, other = z[order], toxic[order], other[order]
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(toxic + other) + toxic.sum())
    i = int(f1.argmax())
    return float((z[i] + z[i + 1]) / 2 if i + 1 < len(z) else z[i] - SPAN / SCORE_BINS)


def set_thresholds(model: ToxicityModel, counts: pd.DataFrame, prior: float = PRIOR_POSITIVES) -> None:
    """From ``counts (lang, bin, y, n)`` of labelled rows, each scored by a network that has not seen it.

    Without toxic rows the thresholds stay as they are.
    """
    table = counts.pivot_table(index="bin", columns=["lang", "y"], values="n", aggfunc="sum", fill_value=0).sort_index()
    z = (table.index.to_numpy() + 0.5) * (2 * SPAN / SCORE_BINS) - SPAN
    by_label = {y: table.xs(y, axis=1, level="y") if y in table.columns.get_level_values("y") else None for y in (0, 1)}
    if by_label[1] is None:
        return
    everywhere = {y: np.zeros(len(z)) if t is None else t.sum(axis=1).to_numpy() for y, t in by_label.items()}
    model.default = best_threshold(z, everywhere[1], everywhere[0])
    weight = prior / everywhere[1].sum()
    for lang in sorted(set(counts["lang"])):
        own = {y: t[lang].to_numpy() if t is not None and lang in t.columns else 0.0 for y, t in by_label.items()}
        model.thresholds[lang] = best_threshold(z, own[1] + weight * everywhere[1], own[0] + weight * everywhere[0])


def _fold(ids: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("fold"), ids.cast("string")), F.lit(FOLDS)).cast("int")


def _networks(sample: DataFrame) -> dict[int, bytes]:
    """Pickled networks of the rows ``(text, y, h, fold)`` outside each fold, and of all rows (``FOLDS``); each is trained in a task."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, ids, at in word_ids(b["text"]):
                own = b.iloc[first:first + len(at) - 1]
                yield pd.DataFrame({c: own[c].to_numpy() for c in ("y", "h", "fold")}
                                   | {"ids": [ids[x:y].tobytes() for x, y in zip(at[:-1], at[1:])]})

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(n=pdf["ids"].map(len)).sort_values(["h", "n", "ids"], kind="stable")  # the same order whatever the partitions
        net = TextCNN()
        if pdf["y"].nunique() == 2:
            net.fit([np.frombuffer(v, np.int32) for v in pdf["ids"]], pdf["y"].to_numpy(float))
        return pd.DataFrame({"net": pdf["net"].iloc[:1].to_numpy(), "fitted": [pickle.dumps(net)]})

    rows = map_pandas(sample, hashed, "y int, h bigint, fold int, ids binary")
    rows = rows.withColumn("net", F.explode(F.sequence(F.lit(0), F.lit(FOLDS)))).filter("net != fold")
    fitted = rows.groupBy("net").applyInPandas(train, "net int, fitted binary").toPandas()
    nets = {int(k): v for k, v in zip(fitted["net"], fitted["fitted"])}
    return {k: nets[k] if k in nets else pickle.dumps(TextCNN()) for k in range(FOLDS + 1)}


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          languages: language.LanguageModel | None = None, sample_per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Train from ``labels (id, label)`` of 0 or 1 and the texts of ``docs`` with these ids.

    A hash of the id decides which labels are in the sample, and another one their fold. The sample's size is bounded, so the texts are
    picked by a broadcast of it; for the thresholds, the log-odds of all texts are joined to the labels. So no text outside the
    sample is shuffled. Rows with a NULL id, text or label are not used; repeated ones count each time. With no row of one label, the
    network stays as it starts and scores low.
    """
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("y"), F.xxhash64(id_col).alias("h"))
    known = known.filter("y in (0, 1) and label_id is not null").distinct()
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    shares = [min(1.0, sample_per_class / max(1, counts.get(y, 0))) for y in (0, 1)]
    chance = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.filter(chance < F.when(F.col("y") == 1, shares[1]).otherwise(shares[0]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    sample = texts.join(F.broadcast(picked), F.col("id") == F.col("label_id"))
    nets = _networks(sample.select("text", "y", "h", _fold(F.col("id")).alias("fold")))
    model = ToxicityModel(pickle.loads(nets.pop(FOLDS)), {}, AT_CUT, languages)
    if len(counts) == 2:
        scored = bins(texts, nets, languages).join(known, F.col("id") == F.col("label_id"))
        set_thresholds(model, scored.groupBy("lang", "bin", "y").agg(F.count("*").alias("n")).toPandas())
    return model


def bins(texts: DataFrame, nets: dict[int, bytes], languages: language.LanguageModel | None) -> DataFrame:
    """``(id, lang, bin)`` of ``texts (id, text)``: language and binned log-odds, by the network of the id's fold."""
    kind = texts.schema["id"].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast((nets, languages))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed, tongues = shared.value
        own = {f: pickle.loads(v) for f, v in packed.items()}
        for b in batches:
            z, fold = np.zeros(len(b)), b["fold"].to_numpy()
            for f, net in own.items():
                z[fold == f] = net.of_texts(b["text"][fold == f].reset_index(drop=True))
            yield pd.DataFrame({"id": b["id"], "lang": language.predict_texts(tongues, b["text"])[0],
                                "bin": np.minimum((z + SPAN) / (2 * SPAN) * SCORE_BINS, SCORE_BINS - 1).astype(np.int32)})

    rows = texts.filter("id is not null").select("id", "text", _fold(F.col("id")).alias("fold"))
    return map_pandas(rows, run, f"id {kind}, lang string, bin int")


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, predicted)`` for every row, from the whole text alone.

    NULL and empty texts have the score of a text without words. Repeated rows and NULL ids keep their rows; an
    empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = shared.value.score(b["text"])
            yield pd.DataFrame({"id": b["id"], "score": s, "predicted": (s >= CUT).astype(np.int32)})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_pandas(rows, run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
