"""Language identification with hyperdimensional profiles.

Each symbol of a small alphabet has a random vector of +1 and -1. A trigram is bound by multiplying its
letters' vectors, each permuted (rotated) by its place; a text is bundled by adding its trigrams'
vectors, and so is a language, from the trigram counts of all its training documents. A text is compared
with the prototypes by the cosine, after the part that all prototypes share is taken out of
both. Bundling is linear, so training needs counts only: they are summed per language in Spark, and the
driver sees one vector per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconlake.llm import workers

#: Length of the vectors, and texts that are bundled together.
DIMENSIONS = 1024
_TEXTS = 128
#: Trigrams whose vectors are looked up together.
_BLOCK = 2048
_SEED = 20240229
_SYMBOLS = 64  # no letter, a to z, and 37 for all other letters (those of Latin-1 have one each)
_PIECE = 1 << 20
UNDETERMINED = "und"


def _symbol_table() -> np.ndarray:
    points = np.arange(0x110000)
    letters = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    table = np.where(letters, 27 + (points - 0xDF) % 37, 0).astype(np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """One byte per character of the lower-cased text, runs of non-letters as one 0, a 0 at both ends."""
    if not _TABLE:
        _TABLE.append(_symbol_table())
    pieces = [np.zeros(1, np.uint8)]
    for at in range(0, len(text), _PIECE):
        raw = text[at : at + _PIECE].lower().encode("utf-32-le", "surrogatepass")
        pieces.append(_TABLE[0][np.frombuffer(raw, "<u4")])
    pieces.append(np.zeros(1, np.uint8))
    found = np.concatenate(pieces)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    return found[keep]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the trigrams around each letter; both empty if there is no letter."""
    found = symbols(text or "")
    codes, counts = [], []
    for at in range(0, max(len(found) - 2, 0), _PIECE):
        part = found[at : at + _PIECE + 2].astype(np.int32)
        code = (part[:-2] * _SYMBOLS + part[1:-1]) * _SYMBOLS + part[2:]
        some, n = np.unique(code[part[1:-1] != 0], return_counts=True)
        codes.append(some)
        counts.append(n)
    if not codes:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    merged, place = np.unique(np.concatenate(codes), return_inverse=True)
    return merged, np.bincount(place, np.concatenate(counts)).astype(np.int64)


_LETTERS: list[np.ndarray] = []


def _drop_tables() -> None:
    _TABLE.clear()
    _LETTERS.clear()


workers.keeps("language", _drop_tables)


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """The bound vectors of trigrams: first letter rotated twice, second once, third not at all."""
    if not _LETTERS:
        plain = np.random.default_rng(_SEED).choice(np.array([-1, 1], np.int8), (_SYMBOLS, DIMENSIONS))
        _LETTERS.extend([np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1), plain])
    first, second, third = _LETTERS
    low = _SYMBOLS - 1
    return first[codes >> 12] * second[(codes >> 6) & low] * third[codes & low]


def bundle(texts: list[str | None]) -> np.ndarray:
    """One row per text: the sum of its trigrams' vectors (all zero without letters).

    Trigrams are taken in blocks of _BLOCK, so that memory does not grow with how many there are.
    """
    parts = [trigrams(t) for t in texts]
    codes = np.concatenate([c for c, _ in parts])
    row = np.repeat(np.arange(len(texts)), [len(c) for c, _ in parts])
    order = np.argsort(codes, kind="stable")
    codes, row, n = codes[order], row[order], np.concatenate([n for _, n in parts])[order]
    seen, first = np.unique(codes, return_index=True)
    total = np.zeros((len(texts), DIMENSIONS), np.float32)
    for at in range(0, len(seen), _BLOCK):
        begin, end = first[at], first[at + _BLOCK] if at + _BLOCK < len(seen) else len(codes)
        block = seen[at : at + _BLOCK]
        counts = np.zeros((len(texts), len(block)), np.float32)
        counts[row[begin:end], np.searchsorted(block, codes[begin:end])] = n[begin:end]
        total += counts @ trigram_vectors(block).astype(np.float32)
    return total


@dataclass(frozen=True)
class Profiles:
    """Languages and their prototypes, without what all have in common (``shared``, of length 1), and with it
    (``whole``)."""

    languages: tuple[str, ...]
    prototypes: np.ndarray
    shared: np.ndarray
    whole: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The nearest language and its score (1 + cosine) / 2; ``und`` and 0 without letters."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """As ``predict``, and the cosine with that language before the common part is taken out."""
        vectors = bundle(texts)
        empty = ~vectors.any(axis=1)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = vectors / np.maximum(lengths, 1e-9)
        own = vectors - (vectors @ self.shared)[:, None] * self.shared
        own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
        cosines = own @ self.prototypes.T
        best = cosines.argmax(axis=1)
        scores = np.clip((1 + cosines[np.arange(len(best)), best].astype(float)) / 2, 0, 1)
        named = [UNDETERMINED if e else self.languages[b] for b, e in zip(best, empty)]
        nearness = np.einsum("ij,ij->i", vectors, self.whole[best]).astype(float)
        return named, np.where(empty, 0.0, scores), np.where(empty, 0.0, nearness)


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that is never learned from; a NULL id is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, text: str = "text", language: str = "lang", id_column: str = "doc_id") -> Profiles:
    """Prototypes from all documents that are not held out and have a language and a letter.

    Languages are in code point order, so ties go to the first. Without any such document there are no
    languages and every prediction is ``und``.
    """
    workers.importable(docs.sparkSession)
    workers.small_batches(docs.sparkSession)
    known = docs.where(~held_out(F.col(f"`{id_column}`")) & F.col(f"`{language}`").isNotNull()).select(
        F.col(f"`{language}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.in_use("language")
        for batch in batches:
            by_language: dict[str, list] = {}
            for lang, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                by_language.setdefault(lang, []).append(trigrams(whole.as_py()))
            for lang, parts in by_language.items():
                codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                n = np.bincount(place, np.concatenate([n for _, n in parts]), len(codes))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(codes), pa.string()),
                        "code": pa.array(codes, pa.int32()),
                        "n": pa.array(n.astype(np.int64), pa.int64()),
                    }
                )

    def prototype(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("code")
        total = np.zeros(DIMENSIONS)
        for at in range(0, len(rows), 4096):
            part = rows.iloc[at : at + 4096]
            total += part["n"].to_numpy(float) @ trigram_vectors(part["code"].to_numpy())
        return pd.DataFrame({"lang": [key[0]], "vector": [total.tolist()]})

    counts = known.mapInArrow(counted, "lang string, code int, n long").groupBy("lang", "code").agg(
        F.sum("n").alias("n")
    )
    # a language has at most 64 ** 3 codes
    found = counts.groupBy("lang").applyInPandas(prototype, "lang string, vector array<double>").collect()
    return profiles({r["lang"]: np.array(r["vector"]) for r in found})


def profiles(bundles: dict[str, np.ndarray]) -> Profiles:
    languages = tuple(sorted(bundles))
    if not languages:
        none = np.zeros((0, DIMENSIONS), np.float32)
        return Profiles((), none, np.zeros(DIMENSIONS, np.float32), none)
    stacked = np.stack([bundles[name] / np.linalg.norm(bundles[name]) for name in languages])
    shared = stacked.mean(axis=0)
    shared /= np.linalg.norm(shared)
    if len(languages) == 1:
        shared = np.zeros(DIMENSIONS)
    own = stacked - (stacked @ shared)[:, None] * shared
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    return Profiles(languages, own.astype(np.float32), shared.astype(np.float32), stacked.astype(np.float32))


def least_nearness(
    docs: DataFrame, found: Profiles, quantile: float, text: str = "text", language: str = "lang", id_column: str = "doc_id"
) -> dict[str, float]:
    """Per predicted language, the cosine (rounded down to 0.01) that all but a ``quantile`` of the documents
    learned from reach; a language that none of them is taken for has no entry."""
    known = docs.where(~held_out(F.col(f"`{id_column}`")) & F.col(f"`{language}`").isNotNull())
    judged = known.select(predictor(docs, found)(F.col(f"`{text}`")).alias("p")).where(F.col("p.lang_pred") != UNDETERMINED)
    counts = judged.groupBy("p.lang_pred", F.floor(F.col("p.nearness") * 100).alias("bin")).count()
    by_language: dict[str, list[tuple[int, int]]] = {}
    # at most 201 rows per language
    for row in counts.collect():
        by_language.setdefault(row["lang_pred"], []).append((row["bin"], row["count"]))
    least = {}
    for name, bins in by_language.items():
        below, allowed = 0, quantile * sum(n for _, n in bins)
        for edge, n in sorted(bins):
            below += n
            if below > allowed:
                least[name] = edge / 100
                break
    return least


def predictor(docs: DataFrame, found: Profiles):
    """A function from a text column to a struct of lang_pred, score and nearness."""
    workers.importable(docs.sparkSession)
    workers.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(found)

    @F.pandas_udf("lang_pred string, score double, nearness double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        workers.in_use("language")
        for texts in batches:
            names, scores, nearness = [], [], []
            for at in range(0, len(texts), _TEXTS):
                some, s, near = shared.value.judge(texts.iloc[at : at + _TEXTS].tolist())
                names += some
                scores += s.tolist()
                nearness += near.tolist()
            yield pd.DataFrame({"lang_pred": names, "score": scores, "nearness": nearness})

    # evaluated once per row: a filter on the result is not pushed below it as a second evaluation
    return predict.asNondeterministic()


def identify(
    docs: DataFrame, found: Profiles, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from its whole text alone.

    A NULL text, or one without a letter, is ``und`` with score 0; repeated rows get equal results; an
    empty table gives none.
    """
    doc_id = F.col(f"`{id_column}`")
    named = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(f"`{text}`").alias("t"))
    return named.withColumn("p", predictor(docs, found)("t")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def identified(
    docs: DataFrame, found: Profiles, least_score: float, text: str = "text", least: dict[str, float] | None = None
) -> DataFrame:
    """The columns of the documents, without those that are ``und`` or score below ``least_score``, and those
    whose cosine with their language is below what ``least`` asks of it."""
    # the text is in each row once, also while Python judges it
    rows = docs.select(F.struct("*").alias("row"))
    judged = rows.withColumn("p", predictor(docs, found)(F.col("row").getField(text)))
    sure = (F.col("p.lang_pred") != UNDETERMINED) & (F.col("p.score") >= least_score)
    if least:
        asked = F.lit(None).cast("double")
        for name in sorted(least):
            asked = F.when(F.col("p.lang_pred") == name, F.lit(least[name])).otherwise(asked)
        sure &= F.col("p.nearness") >= F.coalesce(asked, F.lit(-1.0))
    return judged.where(sure).select("row.*")
