"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (per-coordinate
steps, elastic-net penalty) and calibrated by one temperature.

Features: the lower-cased text with every run of non-letters as one blank;
1-, 2- and 3-grams hashed into ``DIM`` columns; (1 + log tf) * idf, scaled to
length one.  Document frequencies are counted over all labelled rows, in one
pass that leaves at most ``DIM`` numbers per task.  The weights are fitted on
a bounded sample: about ``per_lang`` documents of each language, those with
the smallest hashes of their ids; every fifth of them only calibrates.  The
sample's hashed counts (at most ``DIM`` pairs a document) go to the driver;
weights, idf and languages come back in the closure of the prediction, whose
size is ``DIM`` x languages whatever the corpus.

Strangers.  The classes share all probability among the learned languages, so
text of another one gets a high score, too.  ``typical`` therefore compares a
text with its predicted language alone: the mean log frequency of its n-grams
there, in standard errors from the held-out mean, over ``SLACK`` times the worst
of the held-out rows of that language.  Below -1 the text is further off than
anything held out by that factor, and some other language or no language.

Defined results: text that is null or has no letter is ``und`` with score 0;
without any labelled row everything is ``und``.  Repeated rows are predicted
alike; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import ddl_of

DIM = 1 << 15
SLACK = 2.25
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; built once per worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Columns and counts of the text's n-grams; empty without a letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.where(letter, c, 32)
    c = c[letter | np.concatenate([[True], letter[:-1]])].astype(np.uint32)    # one blank per run
    c = np.concatenate([[32], c, [32]]).astype(np.uint32) * np.uint32(0x9E3779B1)
    two = (c[:-1] ^ (c[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + c[2:]
    cols = np.concatenate([c, two * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1)]) >> np.uint32(17)
    n = np.bincount(cols, minlength=DIM)
    at = np.flatnonzero(n)
    return at, n[at]


@dataclass
class LanguageModel:
    langs: list[str]
    idf: np.ndarray            # DIM
    weights: np.ndarray        # DIM x languages
    temperature: float = 1.0
    frequency: np.ndarray | None = None        # DIM x languages, logarithms
    usual: np.ndarray | None = None            # languages x (mean, spread, between, worst)

    def typical(self, cols: np.ndarray, counts: np.ndarray, k: int) -> float:
        """How far the text is from language ``k``; -1 is the bound."""
        mean, spread, between, worst = self.usual[k]
        return float(_off(self.frequency[:, k], cols, counts, mean, spread, between) / (SLACK * worst))

    def logits(self, cols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = vectorise(cols, counts, self.idf)
        return v @ self.weights[cols]

    def predict(self, text: str | None) -> tuple[str, float, float | None]:
        """Language, its probability, and ``typical`` (null for ``und``)."""
        cols, counts = ngram_counts(text)
        if not len(cols) or not self.langs:
            return "und", 0.0, None
        p = softmax(self.logits(cols, counts) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k]), self.typical(cols, counts, k)


def _off(frequency: np.ndarray, cols: np.ndarray, counts: np.ndarray, mean: float, spread: float, between: float) -> float:
    """The mean log frequency of the n-grams, in standard errors from ``mean``:
    texts differ by ``between`` and by chance, the less the longer they are."""
    n = counts.sum()
    return (counts @ frequency[cols] / n - mean) / np.sqrt(between ** 2 + spread ** 2 / n)


def usual_language(fit: list, held: list, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Log frequencies of the n-grams per language from the fitted rows, and
    per language the mean, the spread of one n-gram, that between texts, and the
    worst of the held-out rows (the fitted ones where a language has none)."""
    total = np.full((DIM, n_langs), 0.5)
    for cols, counts, y in fit:
        total[cols, y] += counts
    frequency = np.log(total / total.sum(axis=0)).astype(np.float32)
    usual = np.tile([0.0, 1.0, 0.0, 1.0], (n_langs, 1))
    for k in range(n_langs):
        rows = [(c, n) for c, n, y in held if y == k] or [(c, n) for c, n, y in fit if y == k]
        if rows:
            n = np.array([m.sum() for _, m in rows], float)
            each = np.array([m @ frequency[c, k] for c, m in rows])
            mean = each.sum() / n.sum()
            square = sum(float(m @ frequency[c, k].astype(float) ** 2) for c, m in rows) / n.sum()
            spread = np.sqrt(max(square - mean * mean, 1e-6))
            between = np.sqrt(max(float(np.mean((each / n - mean) ** 2 - spread ** 2 / n)), 0.0))
            off = (each / n - mean) / np.sqrt(between ** 2 + spread ** 2 / n)
            usual[k] = mean, spread, between, max(float(-off.min()), 4.0)
    return frequency, usual


def vectorise(cols: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf[cols]
    return v / np.sqrt(v @ v)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, alpha: float, beta: float,
             l1: float, l2: float, epochs: int, dim: int = DIM) -> np.ndarray:
    """Weights (dim x n_langs) after ``epochs`` passes over (columns, values,
    class) rows, in their order."""
    z, n = np.zeros((dim, n_langs)), np.zeros((dim, n_langs))

    def weights(zz, nn):
        return np.where(np.abs(zz) <= l1, 0.0, (np.sign(zz) * l1 - zz) / ((beta + np.sqrt(nn)) / alpha + l2))

    for _ in range(epochs):
        for cols, v, y in rows:
            zc, nc = z[cols], n[cols]
            w = weights(zc, nc)
            p = softmax(v @ w)
            p[y] -= 1
            g = np.outer(v, p)
            sigma = (np.sqrt(nc + g * g) - np.sqrt(nc)) / alpha
            z[cols] = zc + g - sigma * w
            n[cols] = nc + g * g
    return weights(z, n)


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, from a fixed grid."""
    def loss(t):
        return -np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean()

    grid = np.geomspace(0.02, 50, 300)
    return float(min(grid, key=loss)) if len(y) else 1.0


def _document_frequencies(rows: DataFrame, text_col: str) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIM + 1, np.int64)
        for b in batches:
            for t in b.column(0):
                cols, _ = ngram_counts(t.as_py())
                df[cols] += 1
                df[DIM] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], ["col", "n"])

    got = (rows.select(text_col).mapInArrow(run, "col int, n bigint").groupBy("col").agg(F.sum("n").alias("n"))
           .toPandas())                                                   # DIM + 1 rows at most
    out = np.zeros(DIM + 1)
    out[got["col"].to_numpy(int)] = got["n"].to_numpy(float)
    return out


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = 1500, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.002,
          epochs: int = 3) -> LanguageModel:
    """A model from rows whose language is known (rows with a null language
    or text are not used)."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    df = _document_frequencies(rows, text_col)
    idf = np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1
    spot = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(11)), F.lit(1 << 30))
    # One number per language, as the model has one column for each; joined,
    # the texts would be shuffled by their few languages.
    sizes = {r["y"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = F.lit(0)
    for y, n in sorted(sizes.items()):
        bound = F.when(F.col(lang_col) == y, int(min(1.0, per_lang / n) * (1 << 30))).otherwise(bound)
    drawn = (rows.filter(spot < bound)
             .select(spot.alias("spot"), F.col(lang_col).alias("y"), F.col(text_col).alias("text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [ngram_counts(t) for t in b["text"]]
            yield pd.DataFrame({"spot": b["spot"], "y": b["y"], "cols": [c.astype(np.uint16).tobytes() for c, _ in got],
                                "n": [n.astype(np.uint32).tobytes() for _, n in got]})

    sample = drawn.select("spot", "y", "text").mapInPandas(run, "spot long, y string, cols binary, n binary").toPandas()
    sample = sample[sample["cols"].map(len) > 0].sort_values(["spot", "y", "cols"], kind="stable")
    langs = sorted(sample["y"].unique())
    vectors, counts = [], []
    for cols, n, y in zip(sample.pop("cols"), sample.pop("n"), sample["y"], strict=True):
        c, n = np.frombuffer(cols, np.uint16), np.frombuffer(n, np.uint32)
        v = vectorise(c, n.astype(float), idf)
        vectors.append((c, v.astype(np.float32), langs.index(y)))       # ten bytes a feature with its count
        counts.append((c, n, langs.index(y)))
    del sample
    frequency, usual = usual_language([v for i, v in enumerate(counts) if i % 5], counts[::5], len(langs))
    del counts
    fit, held = [v for i, v in enumerate(vectors) if i % 5], vectors[::5]
    w = fit_ftrl(fit, len(langs), alpha, beta, l1, l2, epochs)
    t = calibrate(np.array([v @ w[c] for c, v, _ in held]), np.array([y for *_, y in held], int)) if held else 1.0
    return LanguageModel(langs, idf.astype(np.float32), w.astype(np.float32), t, frequency, usual)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score", typical_out: str = "typical") -> DataFrame:
    """``docs`` with the predicted language, its calibrated probability and how
    typical the text is of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(t.as_py()) for t in b.column(b.schema.get_field_index(text_col))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array([g[i] for g in got], k) for i, k in enumerate((pa.string(), pa.float64(), pa.float64())))],
                [*b.schema.names, lang_out, score_out, typical_out])

    docs = docs.drop(lang_out, score_out, typical_out)
    return docs.mapInArrow(run, f"{ddl_of(docs.schema.fields)}, `{lang_out}` string, `{score_out}` double, `{typical_out}` double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no training may use: a third, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
