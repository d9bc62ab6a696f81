"""Toxicity by a convolutional text classifier, trained in numpy.

Words (ASCII punctuation stripped, A-Z lower-cased) are hashed into an embedding table, each as itself and by its first four and six
bytes, so that inflected forms share a part; a word's embedding is the sum. Filters of several widths run over the word sequence, each keeps its maximum over the whole text, a logistic layer reads the maxima. The score is the calibrated probability of
label 1. Nothing but the text goes into it.

The model is fitted in one task from a bounded, documented sample, and the driver gets the model alone: at most ``max_rows`` labelled rows, half of them of either label where
there are enough, of at most ``max_words`` words each (whole rows, never prefixes); a fifth of the labelled rows, by a hash of the id, never enters it. Everything after
that sees all rows: every document is scored once, in chunks of words, and all usable labelled rows that were not fitted on are counted by
language, label and bin of the raw score. Platt scaling is fitted to the counts, each label weighted back to its true share. A language's threshold has the best F1, among calibrated scores of one half or more, on
its own counts plus ``PRIOR`` rows spread like the counts of all languages, so one rule serves languages with many rows, few or none.

Nulls and odd rows: a null or empty text is scored like any other (all maxima zero); rows without label, or with a label other than 0 and
1, are not learnt from; several labels of one id count as their maximum; with one class only, or none, every score is the share of label
1 (0 without labels); an unknown or null language uses the threshold of all languages together; repeated rows get equal scores; a very long text is read in
chunks; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import pickle
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import filled, sliced, staged

BUCKETS, DIM, FILTERS, WIDTHS, STEMS = 1 << 16, 8, 8, (1, 2, 3), (4, 6)
MAX_ROWS, MAX_WORDS, EPOCHS, LEAST_STEPS = 6000, 20_000, 3, 450
THRESHOLD = 0.7
PRIOR, BINS, REACH = 40.0, 64, 40  # bins of a raw score: 64 a unit, from -40 to 40
CHUNK, CACHED = 1 << 14, 1 << 17
_TABLE = bytes.maketrans((string.ascii_uppercase + string.punctuation).encode(), (string.ascii_lowercase + " " * len(string.punctuation)).encode())


def words_of(body: bytes) -> list[bytes]:
    return body.translate(_TABLE).split()


def word_units(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Per word the buckets of its units: itself, and its beginnings of ``STEMS`` bytes."""
    out = np.empty((len(words), 1 + len(STEMS)), np.int32)
    out[:, 0] = [xxhash.xxh32_intdigest(w) % buckets for w in words]
    for k, size in enumerate(STEMS, 1):
        out[:, k] = [xxhash.xxh32_intdigest(w[:size], size) % buckets for w in words]
    return out


@dataclass
class TextCnn:
    embed: np.ndarray  # buckets x dim
    filters: list[np.ndarray]  # per width: width x dim x filters
    weights: np.ndarray
    bias: float
    scale: float = 1.0  # calibration: score = sigmoid(scale * z + shift)
    shift: float = 0.0
    cut: float = THRESHOLD  # of all languages together

    def score(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * np.asarray(z, float) + self.shift, -60, 60)))


class Reader:
    """Runs a model over texts. What a word adds to each place of each filter is kept in a bounded table, so that a convolution is a sum of look-ups."""

    def __init__(self, model: TextCnn):
        self.model, self.known = model, {}
        self.filters = np.concatenate([f[k] for f in model.filters for k in range(len(f))], axis=1)
        self.table = np.empty((CACHED + CHUNK, self.filters.shape[1]), np.float32)

    def _rows(self, words: list[bytes]) -> np.ndarray:
        new = list(set(words).difference(self.known))
        if new:
            if len(self.known) + len(new) > len(self.table):
                self.known.clear()
                new = list(set(words))
            at = len(self.known)
            embed = self.model.embed[word_units(new, len(self.model.embed))].sum(axis=1)
            self.table[at : at + len(new)] = embed @ self.filters
            self.known.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def maxima(self, words: list[bytes]) -> np.ndarray:
        size, widest = self.model.filters[0].shape[2], max(map(len, self.model.filters))
        best = [np.zeros(size, np.float32) for _ in self.model.filters]  # the rectifier's zero
        for at in range(0, len(words), CHUNK):
            added = self.table[self._rows(words[at : at + CHUNK + widest - 1])]  # neighbouring chunks overlap by a filter
            column = 0
            for k, f in enumerate(self.model.filters):
                n = len(added) - len(f) + 1
                if n > 0:
                    total = added[:n, column : column + size].copy() if len(f) > 1 else added[:n, column : column + size]
                    for place in range(1, len(f)):
                        total += added[place : place + n, column + place * size : column + (place + 1) * size]
                    best[k] = np.maximum(best[k], total.max(axis=0))
                column += len(f) * size
        return np.concatenate(best)

    def logit(self, words: list[bytes]) -> float:
        return float(self.maxima(words) @ self.model.weights + self.model.bias)


def _initial(widths, buckets, dim, filters, seed) -> TextCnn:
    draw = np.random.default_rng(seed)
    embed = draw.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    kernels = [draw.normal(0, 1 / np.sqrt(w * dim), (w, dim, filters)).astype(np.float32) for w in widths]
    return TextCnn(embed, kernels, draw.normal(0, 0.3, filters * len(widths)).astype(np.float32), 0.0)


def _step(param: np.ndarray, memory: np.ndarray, grad: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
    """Adagrad, on the given rows only."""
    if rows is None:
        memory += grad * grad
        param -= rate * grad / np.sqrt(memory + 1e-8)
    else:
        memory[rows] += grad * grad
        param[rows] -= rate * grad / np.sqrt(memory[rows] + 1e-8)


def fit_cnn(texts: list[np.ndarray], labels: np.ndarray, widths=WIDTHS, buckets=BUCKETS, dim=DIM, filters=FILTERS, epochs=EPOCHS, rate=0.05, batch=32, seed=7) -> TextCnn:
    """``texts`` are arrays of word units. Logistic loss; gradients flow through the places of the maxima only."""
    model = _initial(widths, buckets, dim, filters, seed)
    memory = [np.zeros_like(model.embed), [np.zeros_like(f) for f in model.filters], np.zeros_like(model.weights), np.zeros(1)]
    order = np.random.default_rng(seed + 1)
    for _ in range(max(epochs, -(-LEAST_STEPS * batch // len(texts)))):
        for rows in np.array_split(order.permutation(len(texts)), max(1, len(texts) // batch)):
            touched, changes = [], []
            g_filters, g_weights, g_bias = [np.zeros_like(f) for f in model.filters], np.zeros_like(model.weights), 0.0
            for r in rows:
                ids = texts[r]
                words = model.embed[ids].sum(axis=1)
                maxima, places = np.zeros(len(model.weights), np.float32), []
                for k, f in enumerate(model.filters):
                    n = len(ids) - len(f) + 1
                    if n < 1:
                        places.append(None)
                        continue
                    total = words[:n] @ f[0]
                    for place in range(1, len(f)):
                        total += words[place : place + n] @ f[place]
                    top = total.argmax(axis=0)
                    places.append(top)
                    maxima[k * filters : (k + 1) * filters] = total[top, np.arange(filters)].clip(0)
                z = float(maxima @ model.weights + model.bias)
                error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[r]) / len(rows)
                g_weights += error * maxima
                g_bias += error
                back = error * model.weights * (maxima > 0)
                for k, (f, top) in enumerate(zip(model.filters, places)):
                    if top is None:
                        continue
                    g = back[k * filters : (k + 1) * filters]
                    for place in range(len(f)):
                        g_filters[k][place] += words[top + place].T * g
                        units = ids[top + place]
                        touched.append(units.ravel())
                        changes.append(np.repeat((f[place] * g).T, units.shape[1], axis=0))
            if touched:
                at, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                g_embed = np.zeros((len(at), dim), np.float32)
                np.add.at(g_embed, inverse, np.concatenate(changes))
                _step(model.embed, memory[0], g_embed, rate, at)
            for f, m, g in zip(model.filters, memory[1], g_filters):
                _step(f, m, g, rate)
            _step(model.weights, memory[2], g_weights, rate)
            memory[3] += g_bias**2
            model.bias -= float(rate * g_bias / np.sqrt(memory[3][0] + 1e-8))
    return model


def _calibrate(model: TextCnn, z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    """Platt scaling by Newton steps with a light ridge towards the raw score."""
    beta = np.array([1.0, 0.0])
    x = np.stack([z, np.ones_like(z)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -60, 60)))
        grad = x.T @ (weight * (p - y)) + 1e-2 * (beta - [1.0, 0.0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.linalg.solve(hess, grad)
    model.scale, model.shift = float(beta[0]), float(beta[1])


def best_cut(score: np.ndarray, hits: np.ndarray, misses: np.ndarray) -> float:
    """The calibrated score of best F1, in the middle between it and the next one below that holds rows; never where label 0 is the likelier one."""
    order = np.argsort(-score, kind="stable")
    score, hits, seen = score[order], np.cumsum(hits[order]), np.cumsum((hits + misses)[order])
    able = score >= 0.5
    if not able.any():
        return 0.5
    best = int(np.where(able, 2 * hits / np.maximum(seen + hits[-1], 1e-12), -1).argmax())
    return max(0.5, float((score[best] + score[min(best + 1, len(score) - 1)]) / 2))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def _split(max_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [b"\n".join(words_of(x.as_py())) for x in batch.column("body")]
            fits = pa.array([w.count(b"\n") < max_words for w in words], pa.bool_())
            yield batch.drop_columns(["body"]).append_column("words", pa.array(words, pa.binary())).filter(fits)

    return run


def usable_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): one label per id, of the ids that may be learnt from."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def draw(known: DataFrame, max_rows: int, seed: int = 11) -> tuple[DataFrame, dict[int, int]]:
    """(labelled ids with ``fitted``, number of ids of either label). The draw is by a hash of the id; a fifth of the ids cannot be drawn."""
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    few = min(sizes.values(), default=0)
    room = {k: min(n, max_rows // 2 if few >= max_rows // 2 or n == few else max_rows - few) for k, n in sizes.items()}
    unit = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for k, n in sizes.items():
        share = F.when(F.col("toxic") == k, F.lit(min(0.8, room[k] / n))).otherwise(share)
    return known.withColumn("fitted", unit < share), sizes


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pickled network of (doc_id, toxic, words), in the order of ids and words; nothing where one of the labels is missing."""
    table = {"doc_id": [], "toxic": [], "words": []}
    for batch in batches:
        for name, values in table.items():
            values.extend(batch.column(name).to_pylist())
    if len(set(table["toxic"])) < 2:
        return
    order = np.lexsort((table["words"], np.array(table["doc_id"], object)))
    model = fit_cnn([word_units(table["words"][i].split()) for i in order], np.array([table["toxic"][i] for i in order], float))
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})


def training_rows(docs: DataFrame, drawn: DataFrame, max_words: int) -> DataFrame:
    """(doc_id, toxic, words joined by line ends) of the bounded sample."""
    rows = docs.select("doc_id", F.encode(filled(F.col("text")), "UTF-8").alias("body"))
    # the draw holds about ``max_rows`` ids, so it may be broadcast
    picked = drawn.where("fitted").select(F.col("doc_id").alias("__id"), "toxic")
    rows = rows.join(F.broadcast(picked), rows["doc_id"] == picked["__id"]).select("doc_id", "toxic", "body")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_split(max_words), f"doc_id {kind}, toxic int, words binary")


def fitted(docs: DataFrame, drawn: DataFrame, sizes: dict[int, int], max_words: int = MAX_WORDS) -> TextCnn:
    """The network, not yet calibrated; a constant where one of the labels is missing from the sample."""
    found = training_rows(docs, drawn, max_words).repartition(1).mapInArrow(_learn, "model binary").collect()  # one row at most
    if not found:
        model = _initial(WIDTHS, 1, 1, FILTERS, 0)
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        model.weights[:] = 0
        model.scale, model.shift = 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return model
    return pickle.loads(found[0]["model"])


def calibrated(model: TextCnn, scored: DataFrame, drawn: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Calibrates the model on ``scored`` (doc_id, lang, z) and gives (lang, threshold) of the languages with labels. A count per language, label and bin is
    all that is gathered, and a language's choice is a task of its own."""
    raw = F.least(F.greatest(F.floor(F.col("z") * BINS), F.lit(-REACH * BINS)), F.lit(REACH * BINS)).cast("int").alias("bin")
    rows = scored.join(drawn.where("not fitted").select(F.col("doc_id").alias("__id"), "toxic"), F.col("doc_id") == F.col("__id"))
    counts = staged(rows.groupBy("lang", raw, "toxic").agg(F.count("*").alias("n")), "counts")
    total = counts.groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect()  # at most 2 * 80 * BINS rows
    n = {k: sum(r["n"] for r in total if r["toxic"] == k) for k in (0, 1)}
    weight = {k: sizes.get(k, 0) / n[k] if n[k] else 0.0 for k in (0, 1)}
    schema = "lang string, threshold double"
    if model.scale == 0.0 or not total:
        return counts.sparkSession.createDataFrame([], schema)
    bins = np.array(sorted({r["bin"] for r in total}))
    at = {b: k for k, b in enumerate(bins)}
    pooled = np.zeros((2, len(bins)))
    for r in total:
        pooled[r["toxic"], at[r["bin"]]] = r["n"] * weight[r["toxic"]]
    z = (np.concatenate([bins, bins]) + 0.5) / BINS
    spread = np.concatenate([pooled[0], pooled[1]])
    _calibrate(model, z, np.repeat([0.0, 1.0], len(bins)), spread * sum(n.values()) / spread.sum())
    score = model.score((bins + 0.5) / BINS)
    model.cut = best_cut(score, pooled[1], pooled[0])
    prior = pooled / pooled.sum() * PRIOR

    def choose(table):
        own = prior.copy()
        for b, k, m in zip(table["bin"], table["toxic"], table["n"]):
            own[k, at[b]] += m * weight[k]
        return table[["lang"]].iloc[:1].assign(threshold=best_cut(score, own[1], own[0]))

    return staged(counts.where("lang is not null").groupBy("lang").applyInPandas(choose, schema), "cuts")


def _scored(model: TextCnn, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for part in sliced(batch, text_col):
                bodies = part.column(text_col).cast(pa.binary())
                z = [reader.logit(words_of(x.as_py() or b"")) for x in bodies]
                yield part.append_column("__z", pa.array(z, pa.float64()))

    return run


def scores(docs: DataFrame, model: TextCnn, columns: list[str], text_col: str = "text") -> DataFrame:
    """The given columns of ``docs`` with the raw score ``__z``; every text is read whole and goes to Python once."""
    rows = docs.select(*[F.col(f"`{c}`") for c in columns])
    if text_col not in columns:
        rows = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(text_col).cast("string").alias("__text"))
        out = rows.mapInArrow(_without("__text", _scored(model, "__text")), T.StructType([f for f in rows.schema if f.name != "__text"]).add("__z", "double"))
        return out
    return rows.mapInArrow(_scored(model, text_col), T.StructType(list(rows.schema)).add("__z", "double"))


def _without(column: str, run):
    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.drop_columns([column])

    return narrow


def probability(model: TextCnn, z: Column) -> Column:
    raw = F.greatest(F.least(F.lit(model.scale) * z + F.lit(model.shift), F.lit(60.0)), F.lit(-60.0))
    return 1 / (1 + F.exp(-raw))


def _language(docs: DataFrame) -> Column:
    return F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def _with_cut(rows: DataFrame, model: TextCnn, cuts: DataFrame, lang: str) -> DataFrame:
    """Adds ``__cut``, the threshold of the row's language. The table has one small row per labelled language; Spark broadcasts it below its own limit."""
    side = cuts.select(F.col("lang").alias("__of"), F.col("threshold").alias("__own"))
    return rows.join(side, rows[lang] == side["__of"], "left").withColumn("__cut", F.coalesce("__own", F.lit(model.cut))).drop("__of", "__own")


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (score >= 0.7), threshold (of its language) and rejected."""
    known, sizes = draw(usable_labels(labels), max_rows)
    known = staged(known, "labels")
    model = fitted(docs, known, sizes, max_words)
    rows = scores(docs.select("doc_id", "text", _language(docs).alias("__lang")), model, ["doc_id", "__lang"])
    rows = staged(rows.withColumnRenamed("__z", "z"), "scores")
    cuts = calibrated(model, rows.select("doc_id", F.col("__lang").alias("lang"), "z"), known, sizes)
    score = probability(model, F.col("z"))
    return _with_cut(rows, model, cuts, "__lang").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
        F.col("__cut").alias("threshold"),
        (score >= F.col("__cut")).alias("rejected"),
    )


def keep_acceptable(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` without the rows whose score reaches their language's threshold, all columns kept. The scored rows are written once, as
    their decision needs the counts of all of them."""
    known, sizes = draw(usable_labels(labels), max_rows)
    known = staged(known, "labels")
    model = fitted(docs, known, sizes, max_words)
    rows = staged(scores(docs, model, docs.columns).withColumn("__lang", _language(docs)), "scored")
    cuts = calibrated(model, rows.select("doc_id", F.col("__lang").alias("lang"), F.col("__z").alias("z")), known, sizes)
    return _with_cut(rows, model, cuts, "__lang").where(probability(model, F.col("__z")) < F.col("__cut")).select(*[F.col(f"`{c}`") for c in docs.columns])
