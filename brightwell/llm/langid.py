"""Language identification by nearest centroids.

A text is a vector of its letter n-grams (one to three letters, words padded by a
blank), hashed into ``SIZE`` places, damped by a logarithm, weighted by inverse
document frequency and scaled to length one. Each language has several
centroids, found by clustering its training texts by cosine. A text gets the
language of the nearest centroid; one that is farther from it than all but
``REJECT`` of that language's own training texts is marked as rejected.

The model is fitted on about ``PER_LANGUAGE`` documents of each language, chosen
by a hash of their rows; everything else covers all rows and whole texts. A text
that is null or has no letter is ``und`` with score 0. Repeated rows get equal
results. Without training rows every text is ``und``. An empty table gives no
rows. Predictions read the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.llm.common import crc_part, cut_lineage

SIZE = 8_192
#: Documents of each language that the model is fitted on, about; languages at most.
PER_LANGUAGE = 400
CENTROIDS = 3
#: Share of a language's training texts that may be farther away than the limit.
REJECT = 0.005
#: Code points of a text that are counted in one go.
CHUNK = 1 << 20

UNKNOWN = "und"


def letters(text: str) -> np.ndarray:
    """Code points of the small letters, each run of other signs as one blank."""
    signs = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    keep = _is_letter(signs)
    kept = np.where(keep, signs, 32)
    first = np.ones(len(kept), dtype=bool)
    first[1:] = keep[1:] | keep[:-1]
    return kept[first]


_TABLE = np.zeros(0x110000, dtype=bool)


def _is_letter(signs: np.ndarray) -> np.ndarray:
    if not _TABLE.any():
        _TABLE[:] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _TABLE[signs]


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text."""
    signs = letters(text)
    if not len(signs) or (signs == 32).all():
        return np.zeros(SIZE)
    signs = np.concatenate(([32], signs[int(signs[0] == 32):], [32])).astype(np.uint64)
    total = np.zeros(SIZE)
    for at in range(0, len(signs), CHUNK):
        part = signs[at:at + CHUNK + 2]
        own = min(CHUNK, len(signs) - at)
        grams = np.zeros(len(part), dtype=np.uint64)
        for width in (1, 2, 3):
            count = min(own, len(part) - width + 1)
            if count <= 0:
                break
            grams = grams[:count] * np.uint64(0x9E3779B97F4A7C15) + part[width - 1:width - 1 + count]
            mixed = (grams + np.uint64(width)) * np.uint64(0xD6E8FEB86659FD93)
            total += np.bincount((mixed >> np.uint64(64 - 13)).astype(np.int64), minlength=SIZE)
    return total


@dataclass
class Model:
    languages: list[str]   # of each centroid
    centroids: np.ndarray  # a row each, length one
    limits: np.ndarray     # least cosine that is not rejected, of each centroid's language
    idf: np.ndarray

    def predict(self, vectors: np.ndarray) -> tuple[list[str], np.ndarray, list[bool]]:
        """Language, cosine (0 to 1) and whether it is rejected, of each row of counts."""
        if not self.languages:
            return [UNKNOWN] * len(vectors), np.zeros(len(vectors)), [True] * len(vectors)
        cosine = np.clip(weighted(vectors, self.idf) @ self.centroids.T, 0.0, 1.0)
        best = cosine.argmax(axis=1)
        score = cosine[np.arange(len(vectors)), best]
        return [self.languages[b] for b in best], score, list(score < self.limits[best])


def weighted(vectors: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(vectors) * idf
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


def clustered(rows: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Centroids of length one by cosine: first the rows farthest from those taken,
    then alternating assignment and mean."""
    centres = [rows.mean(axis=0)]
    while len(centres) < min(k, len(rows)):
        near = np.max(rows @ np.array(centres).T, axis=1)
        centres.append(rows[near.argmin()])
    centroids = np.array(centres)
    for _ in range(rounds):
        owner = (rows @ centroids.T).argmax(axis=1)
        moved = np.array([rows[owner == i].mean(axis=0) if (owner == i).any() else centroids[i]
                          for i in range(len(centroids))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centroids):
            break
        centroids = moved
    return centroids


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, k: int = CENTROIDS) -> Model:
    """Fit on the documents that ``docs`` offers (doc_id, text, lang).

    ``per_language`` documents of each language are drawn, of however many languages.
    A language's centroids are made by one task from its own draw; the driver gets the
    centroids alone.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .collect()}
    if not sizes:
        return Model([], np.zeros((0, SIZE)), np.zeros(0), np.ones(SIZE))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [counts(t) for t in batch["text"]]
            at = [np.flatnonzero(r) for r in rows]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang": batch["lang"],
                                "at": [a.tolist() for a in at], "n": [r[a].tolist() for r, a in zip(rows, at)]})

    picked = known.where(drawn < F.element_at(share, F.col("lang"))).select("doc_id", "text", "lang")
    found = cut_lineage(picked.mapInPandas(run, "doc_id long, lang string, at array<int>, n array<double>"))
    held = np.zeros(SIZE)
    for r in found.select(F.explode("at").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect():
        held[r["at"]] = r["n"]
    idf = np.log((1 + found.count()) / (1 + held)) + 1

    def centres(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(size=group["n"].map(sum))
        group = group.sort_values(["doc_id", "size"])  # the fit then does not depend on which task came first
        vectors = np.zeros((len(group), SIZE))
        for i, (at, n) in enumerate(zip(group["at"], group["n"])):
            vectors[i, at] = n
        own = weighted(vectors, idf)
        made = clustered(own, k)
        limit = float(np.quantile((own @ made.T).max(axis=1), REJECT))
        return pd.DataFrame({"lang": group["lang"].iloc[0], "place": range(len(made)), "centre": made.tolist(), "limit": limit})
    made = found.groupBy("lang").applyInPandas(lambda g: centres(g), "lang string, place int, centre array<double>, limit double").collect()
    made.sort(key=lambda r: (r["lang"], r["place"]))
    return Model([r["lang"] for r in made], np.array([r["centre"] for r in made]).reshape(-1, SIZE), np.array([r["limit"] for r in made]), idf)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected for each row of (doc_id, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):  # bounds the dense vectors held
                part = batch.iloc[at:at + 256]
                vectors = np.array([counts(t or "") for t in part["text"]])
                lang, score, rejected = model.predict(vectors)
                blank = ~vectors.any(axis=1)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64").to_numpy(dtype=object),
                    "lang_pred": [UNKNOWN if b else name for b, name in zip(blank, lang)],
                    "score": np.where(blank, 0.0, score), "rejected": [bool(b or r) for b, r in zip(blank, rejected)]})
    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """Fit on three quarters of ``docs`` by id, then predict every row: doc_id,
    held_out, lang_pred, score, rejected."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(crc_part(F.col("doc_id")) != 2))
    return predict(rows, model).select("doc_id", (crc_part(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score", "rejected")
