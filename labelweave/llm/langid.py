"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over them, each filter keeps its
maximum over a window, and a softmax layer tells the language of the window. The
network is trained in numpy on windows of a bounded sample of labelled texts. A
text is cut into windows of fixed length, all of it, and takes the language of the
largest mean probability, windows weighted by their bytes.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave.llm.common import fold, table, whole_text
from labelweave.session import materialise

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
# The sample: so many texts of a language at most, so many windows of a text.
TEXTS = 400
TEXT_WINDOWS = 6
EPOCHS, BATCH, RATE = 4, 64, 0.01
_CHUNK = 1024  # windows convolved at once


def windows_of(data):
    """All bytes of a text in rows of WINDOW, the last one filled with zeros."""
    rows = max(1, -(-len(data) // WINDOW))
    out = np.zeros(rows * WINDOW, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(rows, WINDOW)


def train_network(windows, labels, classes, seed=0):
    """Weights of the network, by Adam on the cross-entropy of the windows."""
    rng = np.random.default_rng(seed)
    w = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "o": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes)),
         "p": np.zeros(classes)}
    for k in WIDTHS:
        w[f"f{k}"] = rng.normal(0, (k * EMBEDDING) ** -0.5, (k * EMBEDDING, FILTERS))
        w[f"b{k}"] = np.zeros(FILTERS)
    w = {k: v.astype(np.float32) for k, v in w.items()}
    mean, square, step = {k: 0.0 for k in w}, {k: 0.0 for k in w}, 0
    weight = (len(labels) / (classes * np.maximum(1, np.bincount(labels, minlength=classes)))).astype(np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), BATCH):
            rows = order[start:start + BATCH]
            x, y, n = windows[rows], labels[rows], len(rows)
            embedded, pooled, kept = w["e"][x], [], []
            for k in WIDTHS:
                spots = WINDOW - k + 1
                patches = np.concatenate([embedded[:, j:j + spots] for j in range(k)], axis=2)
                values = patches @ w[f"f{k}"]
                best = values.argmax(1)
                at = np.arange(n)[:, None]
                pooled.append(np.maximum(np.take_along_axis(values, best[:, None], 1)[:, 0] + w[f"b{k}"], 0))
                kept.append((best, patches[at, best]))
            hidden = np.concatenate(pooled, 1)
            logits = hidden @ w["o"] + w["p"]
            probability = np.exp(logits - logits.max(1, keepdims=True))
            probability /= probability.sum(1, keepdims=True)
            slope = probability
            slope[np.arange(n), y] -= 1
            slope *= weight[y][:, None] / n
            g = {"o": hidden.T @ slope, "p": slope.sum(0), "e": np.zeros_like(w["e"])}
            back = (slope @ w["o"].T) * (hidden > 0)
            for i, k in enumerate(WIDTHS):
                b = back[:, i * FILTERS:(i + 1) * FILTERS]
                best, patches = kept[i]
                g[f"f{k}"] = np.einsum("nfd,nf->df", patches, b)
                g[f"b{k}"] = b.sum(0)
                through = b[:, :, None] * w[f"f{k}"].T[None]
                for j in range(k):
                    np.add.at(g["e"], x[np.arange(n)[:, None], best + j],
                              through[:, :, j * EMBEDDING:(j + 1) * EMBEDDING])
            step += 1
            for key in w:
                mean[key] = 0.9 * mean[key] + 0.1 * g[key]
                square[key] = 0.999 * square[key] + 0.001 * g[key] ** 2
                w[key] = w[key] - (RATE * (mean[key] / (1 - 0.9 ** step))
                                   / (np.sqrt(square[key] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return w


class Network:
    """The trained network as tables. A filter sees only bytes, so what it gives
    for one or two neighbouring bytes is looked up instead of multiplied."""

    def __init__(self, w):
        self.w, self.tables = w, {}
        for k in WIDTHS:
            taps = [w["e"] @ w[f"f{k}"][j * EMBEDDING:(j + 1) * EMBEDDING] for j in range(k)]
            self.tables[k] = [
                (j, (taps[j][:, None] + taps[j + 1][None, :]).reshape(-1, FILTERS) if j + 1 < k else taps[j])
                for j in range(0, k, 2)]

    def probabilities(self, windows):
        out = np.empty((len(windows), len(self.w["p"])), np.float32)
        for start in range(0, len(windows), _CHUNK):
            x = windows[start:start + _CHUNK].astype(np.int32)
            pairs = x[:, :-1] * 256 + x[:, 1:]
            pooled = []
            for k in WIDTHS:
                spots, total = WINDOW - k + 1, None
                for j, lookup in self.tables[k]:
                    part = lookup.take((pairs if len(lookup) > 256 else x)[:, j:j + spots], axis=0)
                    total = part if total is None else np.add(total, part, out=total)
                pooled.append(np.maximum(total.max(1) + self.w[f"b{k}"], 0))
            logits = np.concatenate(pooled, 1) @ self.w["o"] + self.w["p"]
            e = np.exp(logits - logits.max(1, keepdims=True))
            out[start:start + _CHUNK] = e / e.sum(1, keepdims=True)
        return out


def train(docs):
    """(languages, weights) from doc_id, text and lang outside the held-out fold.

    At most TEXTS texts of a language, those of the smallest hashes, give up to
    TEXT_WINDOWS windows each, evenly spread over the text.
    """
    known = docs.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull()
                       & F.regexp_like("text", F.lit(r"\p{L}")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (known.select("doc_id", "lang").withColumn("nth", F.row_number().over(order))
              .where(F.col("nth") <= TEXTS).select("doc_id", F.col("lang").alias("label")).distinct())
    texts = known.select("doc_id", "text").join(materialise(chosen, "sample"), "doc_id")

    def cut(batches):
        for batch in batches:
            rows = []
            for label, text in zip(batch["label"], batch["text"]):
                windows = windows_of(text.encode())
                at = np.unique(np.linspace(0, len(windows) - 1, TEXT_WINDOWS).astype(int))
                rows += [(label, windows[i].tobytes()) for i in at]
            yield pd.DataFrame(rows, columns=["label", "bytes"])

    sample = texts.select("label", "text").mapInPandas(cut, "label string, bytes binary").collect()
    sample = sorted((r["label"], bytes(r["bytes"])) for r in sample)
    languages = sorted({label for label, _ in sample})
    if not languages:
        return [], None
    windows = np.frombuffer(b"".join(b for _, b in sample), np.uint8).reshape(-1, WINDOW)
    labels = np.array([languages.index(label) for label, _ in sample])
    return languages, train_network(windows, labels, len(languages))


def predict(df, model, text="text"):
    """Adds lang_pred and score. Null texts and texts without a letter, and any
    text where nothing was learned, are ``und`` with score 0."""
    languages, weights = model

    def judge(network, held, names, scores):
        windows = np.concatenate([w for _, w in held])
        starts = np.cumsum([0] + [len(w) for _, w in held[:-1]])
        weight = (windows > 0).sum(1)[:, None] + 1e-6
        weighed = network.probabilities(windows) * weight
        mean = np.add.reduceat(weighed, starts) / np.add.reduceat(weight, starts)
        for (i, _), row in zip(held, mean):
            names[i], scores[i] = languages[int(row.argmax())], float(min(1.0, row.max()))

    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        network = Network(weights) if languages else None
        for texts in batches:
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            held, size = [], 0
            for i, t in enumerate(texts):
                if t is None or not languages:
                    continue
                held.append((i, windows_of(t.encode())))
                size += len(held[-1][1])
                if size >= 4 * _CHUNK:
                    judge(network, held, names, scores)
                    held, size = [], 0
            if held:
                judge(network, held, names, scores)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    udf = F.pandas_udf(guess, "lang_pred string, score double")
    lettered = F.when(F.regexp_like(whole_text(text), F.lit(r"\p{L}")), F.col(text))
    return (df.drop("lang_pred", "score").withColumn("__guess", udf(lettered))
            .withColumns({"lang_pred": F.col("__guess.lang_pred"), "score": F.col("__guess.score")}).drop("__guess"))


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
