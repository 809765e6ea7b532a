"""Language identification by rank-order profiles.

A profile is the list of the ``PROFILE`` most frequent character n-grams (n = 1 to 3) of lower-cased
text, words padded with one blank, most frequent first, ties by code. A document's own profile is
compared with each language's by the out-of-place distance: the sum of the rank differences, with
``PROFILE`` for an n-gram that the language's profile lacks. The nearest language wins, ties by name.

Training counts n-grams per language in the tasks (numpy), sums them by Spark and keeps the top of
each language; only ``languages x PROFILE`` rows reach the driver. Prediction is one pass over the
text without a shuffle.

A null text or one without letters is ``und`` with score 0, as is every text if there is nothing
to learn from. Rows with a null language or a null text teach nothing. The score is one minus the distance's share
of its maximum. Repeated rows get equal answers. Only the named columns are read.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logblocks.llm.common import fold
from logblocks.shipping import ship

PROFILE = 300
CHUNK = 1 << 18  # characters whose n-grams are counted together in training
BLANK = 1  # stands for every run of characters that are not letters


@functools.cache
def _letters() -> np.ndarray:
    """Code point to lower-cased letter, everything else to BLANK."""
    out = np.full(0x110000, BLANK, np.uint32)
    for code in range(0x110000):
        if (char := chr(code)).isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def letters(text: str) -> np.ndarray:
    """The text's letters, every other run as one BLANK, a BLANK at both ends."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    codes = np.concatenate([[BLANK], codes, [BLANK]]).astype(np.uint64)
    blank = codes == BLANK
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def grams(codes: np.ndarray) -> np.ndarray:
    """The 1-, 2- and 3-grams, 21 bits a character."""
    two = codes[:-1] | (codes[1:] << np.uint64(21))
    three = two[:-1] | (codes[2:] << np.uint64(42))
    return np.concatenate([codes[codes != BLANK], two, three])


def ranked(codes: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """A text's profile: its most frequent n-grams, ties by code."""
    values, counts = np.unique(grams(codes), return_counts=True)
    if len(values) > size:  # only the counts that can be in the profile are sorted
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        values, counts = values[keep], counts[keep]
    return values[np.argsort(-counts, kind="stable")[:size]]


def _count(batches):
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        open_parts: dict[str, list] = {}
        sizes: dict[str, int] = {}

        def flush(lang):
            values, counts = np.unique(np.concatenate(open_parts.pop(lang)), return_counts=True)
            sizes.pop(lang)
            return pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(values), "gram": values.view(np.int64), "n": counts.astype(np.int64)}
            )

        for lang, text in zip(langs, texts):
            codes = letters(text)
            if len(codes) > 1:
                open_parts.setdefault(lang, []).append(grams(codes))
                sizes[lang] = sizes.get(lang, 0) + len(codes)
                if sizes[lang] >= CHUNK:
                    yield flush(lang)
        for lang in list(open_parts):
            yield flush(lang)


class Profiles:
    """All languages' profiles as one table: n-gram to its rank in each language."""

    def __init__(self, names: list[str], profiles: list[np.ndarray], size: int):
        self.names, self.size = names, size
        self.grams = np.unique(np.concatenate(profiles)) if profiles else np.zeros(0, np.uint64)
        self.ranks = np.full((len(self.grams), len(names)), -1, np.int32)
        for k, profile in enumerate(profiles):
            self.ranks[np.searchsorted(self.grams, profile), k] = np.arange(len(profile))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = letters(text or "")
        if len(codes) < 2 or not self.names:
            return "und", 0.0
        own = ranked(codes, self.size)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        ranks = self.ranks[at]
        apart = np.where(known[:, None] & (ranks >= 0), np.abs(ranks - np.arange(len(own))[:, None]), self.size)
        distance = apart.sum(axis=0)
        best = int(np.argmin(distance))
        return self.names[best], float(1 - distance[best] / (len(own) * self.size))


def train(rows: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from ``(lang, text)`` rows."""
    ship(rows.sparkSession)
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counted = known.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= size)
    found: dict[str, list] = {}
    for row in top.orderBy("lang", "place").select("lang", "gram").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["gram"])
    names = sorted(found)
    return Profiles(names, [np.array(found[n], np.int64).view(np.uint64) for n in names], size)


def predictor(profiles: Profiles):
    """A Pandas UDF: text to struct(lang_pred, score)."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def language_id(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; fold 0 of the ids is held out."""
    held_out = fold(F.col("doc_id"), folds) == 0
    profiles = train(docs.where(~held_out))
    guess = predictor(profiles)(F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), guess.alias("g")).select(
        "doc_id", "held_out", "g.lang_pred", "g.score"
    )
