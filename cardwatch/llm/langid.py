"""Language by the nearest of several centroids per language.

A text becomes a normalised TF-IDF vector of its letter n-grams (two and three
bytes of the lower-cased text, hashed to ``SIZE`` places).  Each language has a
few centroids, found by spherical k-means over a bounded sample; a text gets
the language of the centroid with the largest cosine.  A text whose cosine is
below what nearly all of the centroid's own members have is marked as rejected:
it is far from all that was learned.

Defined results: ``und`` with score 0 if the text is null or has no letter, or
nothing was learned; rows without id or language teach nothing; repeated rows
are treated alike; extra columns are passed through, columns named like a
result are replaced.

Scale: document frequencies are counted over all training documents, with one
row per place and task in the shuffle; k-means sees about ``per_language``
texts of a language, chosen by a hash of the id against the language's count,
in one group per language; prediction is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import common

SIZE = 8192
#: Bytes of one text, and texts, handled at once.
CHUNK, GROUP = 1_000_000, 64
#: Sharpness of the score: a lead of this much cosine counts e to 1.
LEAD = 0.05

_LETTER = regex.compile(r"\p{L}").search
_LETTERS = bytes(c if 97 <= c < 123 or c >= 128 else 32 for c in range(256))


def counts(texts: list[str | None]) -> np.ndarray:
    """n-gram counts, one row per text; a text without letters has none."""
    out = np.zeros((len(texts), SIZE), dtype=np.float32)
    for i, text in enumerate(texts):
        if not text or not _LETTER(text):
            continue
        raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS) + b"  ", dtype=np.uint8)
        for k in range(0, len(raw) - 2, CHUNK):
            b = raw[k:k + CHUNK + 2].astype(np.uint32)
            two = b[:-2] * np.uint32(257) + b[1:-1]
            three = two * np.uint32(257) + b[2:]
            blank = (b[:-2] == 32) & (b[1:-1] == 32)
            codes = np.concatenate([two[~blank], three[~blank] + np.uint32(1 << 20)])
            places = (codes * np.uint32(2654435761)) >> np.uint32(32 - 13)
            out[i] += np.bincount(places, minlength=SIZE)
    return out


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1 (or 0)."""
    v = np.log1p(c) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart rows: centroids of length 1 and the cosine that 99 in 100 members reach."""
    chosen = [0]
    near = v @ v[0]
    for _ in range(1, min(k, len(v))):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, v @ v[chosen[-1]])
    centres = v[chosen].copy()
    for _ in range(rounds):
        own = (v @ centres.T).argmax(axis=1)
        moved = np.stack([v[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    cosine = v @ centres.T
    own = cosine.argmax(axis=1)
    reach = np.array([np.quantile(cosine[own == j, j], 0.01) if (own == j).any() else 1.0 for j in range(len(centres))])
    return centres, reach


@dataclass
class Model:
    """Weights of the places and the centroids."""

    idf: np.ndarray = field(default_factory=lambda: np.zeros(SIZE, dtype=np.float32))
    languages: list[str] = field(default_factory=list)
    centres: np.ndarray = field(default_factory=lambda: np.zeros((0, SIZE), dtype=np.float32))
    reach: np.ndarray = field(default_factory=lambda: np.zeros(0))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 800, centroids: int = 3) -> Model:
    """Document frequencies over all training documents; centroids from about ``per_language`` texts each."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull() & ~common.held_out("id"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(SIZE, dtype=np.int64), 0
        for batch in batches:
            for b in common.blocks(batch, "text"):
                texts = b.column("text").to_pylist()
                for k in range(0, len(texts), GROUP):
                    c = counts(texts[k:k + GROUP])
                    df += (c > 0).sum(axis=0)
                    n += int((c.sum(axis=1) > 0).sum())
        yield pa.RecordBatch.from_pydict({"place": np.arange(-1, SIZE), "n": np.concatenate([[n], df])})

    total = {r["place"]: r["n"] for r in rows.select("text").mapInArrow(frequencies, "place long, n long")
             .groupBy("place").agg(F.sum("n").alias("n")).collect()}
    n = total.get(-1, 0)
    if not n:
        return Model()
    idf = np.log((n + 1) / (np.array([total[k] for k in range(SIZE)]) + 1)).astype(np.float32) + 1

    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*[x for lang, size in sorted(sizes.items()) for x in (F.lit(lang), F.lit(min(1.0, per_language / size)))])
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def clusters(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        texts = part.sort_values("id")["text"].tolist()
        v = np.concatenate([vectors(counts(texts[k:k + GROUP]), idf) for k in range(0, len(texts), GROUP)])
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            return pd.DataFrame({"lang": [], "centre": [], "reach": []})
        centres, reach = cluster(v, centroids)
        return pd.DataFrame({"lang": key[0], "centre": [c.tolist() for c in centres], "reach": reach})

    got = (rows.filter(draw < share[F.col("lang")]).groupBy("lang")
           .applyInPandas(clusters, "lang string, centre array<float>, reach double").toPandas())
    if got.empty:
        return Model()
    got = got.sort_values(["lang", "reach"])
    return Model(idf, got["lang"].tolist(), np.stack([np.array(c, dtype=np.float32) for c in got["centre"]]), got["reach"].to_numpy())


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()),
          T.StructField("lang_rejected", T.BooleanType())]


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_rejected`` (too far from every centroid)."""
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        m = packed.value
        names = sorted(set(m.languages))
        owner = np.array([names.index(x) for x in m.languages], dtype=np.int64)

        def work(column: pa.Array) -> dict[str, pa.Array]:
            texts = column.to_pylist()
            langs, scores, far = [], [], []
            for k in range(0, len(texts), GROUP):
                c = counts(texts[k:k + GROUP])
                some = (c.sum(axis=1) > 0) & bool(names)
                cosine = vectors(c, m.idf) @ m.centres.T if names else np.zeros((len(c), 1))
                best = cosine.argmax(axis=1)
                top = cosine[np.arange(len(c)), best]
                by = np.full((len(c), max(len(names), 1)), -1.0)
                for j, o in enumerate(owner):
                    by[:, o] = np.maximum(by[:, o], cosine[:, j])
                odds = np.exp((by - by.max(axis=1, keepdims=True)) / LEAD)
                score = odds.max(axis=1) / odds.sum(axis=1)
                langs += [m.languages[b] if s else "und" for b, s in zip(best.tolist(), some.tolist())]
                scores += np.where(some, score, 0.0).tolist()
                far += (~some | (top < m.reach[best] * 0.8 if names else True)).tolist()
            return {"lang_pred": pa.array(langs, pa.string()), "lang_score": pa.array(scores, pa.float64()),
                    "lang_rejected": pa.array(far, pa.bool_())}

        return work

    return common.annotate(docs, text_col, make, FIELDS)


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document of ``documents``."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", common.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"))
