"""Language identification: blended-spectrum presence kernels, Nyström landmarks and one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortry.llm.common import table

#: n-grams of 1 to ORDERS characters, in so many hashed places.
ORDERS, PLACES = 3, 1 << 14
#: Labelled documents that the model is fitted on, by hash of their id; all if there are fewer.
FIT_DOCS = 3_000
LANDMARKS, RIDGE = 160, 1e-3
#: Texts whose presence vectors stand in one matrix.
BATCH = 256
UNKNOWN = "und"


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """For each code point of the BMP its lower-case letter, or a space if it is none."""
    return np.array([ord(low) if (c := chr(i)).isalpha() and len(low := c.lower()) == 1 else 32 for i in range(0x10000)], np.uint64)


def presence(text: str) -> np.ndarray:
    """The places of the n-grams of a text, repeated and in no order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = folding()[np.minimum(points, 0xFFFF)]
    # one space for each run of other characters, and one at each end
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 32) | (letters[:-1] != 32)
    letters = np.concatenate(([32], letters[keep], [32])).astype(np.uint64)
    found, gram = [], np.zeros(len(letters), np.uint64)
    for n in range(1, ORDERS + 1):
        if len(letters) < n:
            break
        gram = gram[: len(letters) - n + 1] * np.uint64(1_000_003) + letters[n - 1 :] + np.uint64(n)
        found.append((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PLACES.bit_length() + 1))
    return np.concatenate(found).astype(np.int64)


def marked(texts: list[str]) -> np.ndarray:
    """A row for each text, 1 at the places of its n-grams."""
    marks = np.zeros((len(texts), PLACES), np.float32)
    for i, text in enumerate(texts):
        marks[i, presence(text)] = 1
    return marks


@dataclass
class Model:
    """Languages, and for each the weights of all places: landmarks times dual coefficients. A text's scores are its
    presence vector times these, over the root of its size, plus the bias: the kernel against each landmark, weighted."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        names: list[str] = []
        scores: list[float] = []
        for at in range(0, len(texts), BATCH):
            marks = marked(texts[at : at + BATCH])
            margins = marks @ self.weights / np.sqrt(np.maximum(marks.sum(1), 1))[:, None] + self.bias
            best = margins.argmax(1)
            names += [self.languages[b] for b in best]
            scores += np.clip((margins[np.arange(len(best)), best] + 1) / 2, 0, 1).astype(float).tolist()
        return names, scores


def learnt(doc_id: Column) -> Column:
    """Whether a document may be learned from: its id's CRC-32 is not 2 modulo 4. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def fit(df: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", fit_docs: int = FIT_DOCS) -> Model:
    """A model from up to ``fit_docs`` rows with a letter, a language and an id that may be learned from.

    Executors turn texts into presence bits, 2 KB each; only these and the labels come to the driver. Without labelled
    rows the model knows no language and predicts UNKNOWN.
    """
    usable = df.where(learnt(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    ids = usable.select(F.col(doc_id).alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(fit_docs)

    @arrow_udf("binary")
    def bits(texts: pa.Array) -> pa.Array:
        return pa.array([np.packbits(marked([t.as_py()])[0].astype(bool)).tobytes() for t in texts], pa.binary())

    chosen = usable.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("lang")).join(F.broadcast(ids), "_id")
    once = chosen.select("_id", "lang", bits("_text").alias("bits")).orderBy("_id", "lang", "bits").limit(fit_docs)
    rows = once.collect()
    if not rows:
        return Model([], np.zeros((PLACES, 0), np.float32), np.zeros(0, np.float32))
    marks = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in rows]).astype(np.float32)
    names = [r["lang"] for r in rows]
    languages = sorted(set(names))
    size = np.sqrt(marks.sum(1))
    # landmarks in turn from each language
    places = {name: [i for i, n in enumerate(names) if n == name] for name in languages}
    order = sorted((k, name, i) for name in languages for k, i in enumerate(places[name]))
    chosen_rows = np.array([i for *_, i in order[:LANDMARKS]])
    kernel = lambda a, b: (marks[a] @ marks[b].T) / (size[a][:, None] * size[b][None, :])
    every = np.arange(len(rows))
    values, vectors = np.linalg.eigh(kernel(chosen_rows, chosen_rows).astype(np.float64))
    good = values > 1e-6 * values.max()
    project = vectors[:, good] / np.sqrt(values[good])
    features = kernel(every, chosen_rows) @ project
    features = np.hstack([features, np.ones((len(rows), 1))])
    targets = np.array([[1.0 if n == name else -1.0 for name in languages] for n in names])
    solved = np.linalg.solve(features.T @ features + RIDGE * len(rows) * np.eye(features.shape[1]), features.T @ targets)
    dual = project @ solved[:-1]
    weights = (marks[chosen_rows] / size[chosen_rows][:, None]).T @ dual
    return Model(languages, weights.astype(np.float32), solved[-1].astype(np.float32))


def identify(df: DataFrame, model: Model, *, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add ``out``, the language of ``text``, and ``score`` from 0 to 1.

    Null texts and texts without a letter are UNKNOWN with score 0. Only the text is read. Other columns stay; columns
    named as the outputs are replaced. Repeated rows each get their result; an empty table gives an empty one. No shuffle.
    """
    shipped = df.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("struct<name:string,score:double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shipped.value
        for batch in batches:
            names, scores = known.predict([t.as_py() for t in batch])
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["name", "score"])

    columns = [df[c] for c in df.columns if c not in (out, score)]
    known = F.coalesce(df[text].rlike(r"\p{L}"), F.lit(False)).alias("known")
    held = df.select(F.struct(*columns).alias("row"), known, predicted(F.coalesce(df[text], F.lit(""))).alias("p"))
    return held.select("row.*", F.when(F.col("known"), F.col("p.name")).otherwise(UNKNOWN).alias(out), F.when(F.col("known"), F.col("p.score")).otherwise(0.0).alias(score))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.drop("lang"), fit(docs))
    return found.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op7_language_id": op7_language_id}
