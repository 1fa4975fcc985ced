"""Language identification by rank-order profiles.

A profile is a language's ``profile_size`` most frequent letter n-grams (1 to 3 letters,
words framed by blanks), most frequent first. A document's own most frequent n-grams are
ranked the same way and compared by the out-of-place distance: the sum over its n-grams
of how far their rank is from the profile's, absent ones costing the full profile size.
The nearest profile wins, ties to the smaller language name.

Counting is numpy on code points (n-grams are packed into 63-bit integers), document by
document, in Arrow batches; profiles come from one pre-aggregated count over all
training documents. What reaches the driver is ``profile_size`` rows a language.

Defined results: null text or text without a letter is ``und`` with score 0; a table
without training rows yields ``und`` throughout; texts are read whole, in spans of ``SPAN``
characters (some 8 bytes a character beside that); n-grams of equal frequency rank by their
code, equally near languages by name; repeated rows are predicted each alike; an empty table
gives an empty result; extra columns are kept, but ``lang_pred``, ``score`` and ``distance``
of the input give way to the results of ``identify`` (``keep_identified`` returns every
column as it was).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rewardmill.llm.common import free_name, give_back, ship, slices

_BLANK = 32
#: Characters of a text whose n-grams are counted at once.
SPAN = 1 << 18
_FOLD: dict[str, np.ndarray] = {}


def _fold_table() -> np.ndarray:
    """Code point -> lower-case code point of a letter, or blank; for the first 2^16."""
    if "t" not in _FOLD:
        t = np.full(1 << 16, _BLANK, dtype=np.int32)
        for c in range(1 << 16):
            if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
                low = chr(c).lower()
                t[c] = ord(low) if len(low) == 1 else c
        _FOLD["t"] = t
    return _FOLD["t"]


def letters(text: str) -> np.ndarray:
    """Lower-case letters with one blank for every other character, framed by blanks."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    high = codes >= 1 << 16
    out = np.empty(len(codes) + 2, dtype=np.int32)
    out[0] = out[-1] = _BLANK
    if high.any():
        body = _fold_table()[np.where(high, 0, codes)]
        body[high] = [c if chr(c).isalpha() else _BLANK for c in codes[high].tolist()]
        out[1:-1] = body
    else:
        out[1:-1] = _fold_table()[codes]
    return out


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of 1 to 3 characters (packed) and how often each occurs."""
    c = letters(text)
    gap = c == _BLANK
    if gap.all():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams, n = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(c), SPAN):  # n-grams that begin in this span
        part = c[at : at + SPAN + 2].astype(np.int64)
        gap = part == _BLANK
        two = part[:-1] << 21 | part[1:]
        three = (two[:-1] << 21 | part[2:])[~(gap[1:-1] | gap[:-2] & gap[2:])]
        one, two = part[:SPAN][~gap[:SPAN]], two[:SPAN][~(gap[:-1] & gap[1:])[:SPAN]]
        found, count = np.unique(np.concatenate([one, two, three]), return_counts=True)
        grams, n = _added(grams, n, found, count) if at else (found, count)
    return grams, n


def _added(grams, n, more, count) -> tuple[np.ndarray, np.ndarray]:
    """Sums of two counts."""
    found, where = np.unique(np.concatenate([grams, more]), return_inverse=True)
    return found, np.bincount(where, np.concatenate([n, count]), len(found)).astype(np.int64)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, ties by the n-gram's own value."""
    if len(grams) > 4 * size:  # only those that can be among the first
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= floor], counts[counts >= floor]
    return grams[np.lexsort((grams, -counts))][:size]


def train_profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", profile_size: int = 400
) -> DataFrame:
    """(lang, gram, rank) of every non-null language over all given documents."""
    ship(docs.sparkSession)

    def count(batches):
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                grams, n = np.empty(0, np.int64), np.empty(0, np.int64)
                for some in slices(part, 200):
                    pairs = [(grams, n), *(ngram_counts(t) for t in some["text"])]
                    found, where = np.unique(np.concatenate([g for g, _ in pairs]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([c for _, c in pairs]), len(found)).astype(np.int64)
                    grams = found
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})
        give_back()

    counted = (
        docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .dropna()
        .mapInPandas(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counted.withColumn("rank", F.row_number().over(order) - 1)
        .filter(F.col("rank") < profile_size)
        .select("lang", "gram", "rank")
    )


def distances(text: str, grams: np.ndarray, ranks: np.ndarray, size: int) -> np.ndarray | None:
    """Out-of-place distance to every profile as a share of the largest possible; None without letters.

    ``grams`` (sorted) by ``ranks`` (a row each, a column a language, ``size`` if absent).
    """
    own, counts = ngram_counts(text)
    if not len(own):
        return None
    top = ranked(own, counts, size)
    at = np.minimum(np.searchsorted(grams, top), len(grams) - 1)
    hit = grams[at] == top
    off = np.where(
        (ranks[at] < size) & hit[:, None], np.abs(ranks[at] - np.arange(len(top))[:, None]), size
    )
    return off.sum(axis=0) / (size * len(top))


def predict(
    docs: DataFrame, profiles: DataFrame, profile_size: int = 400, text_col: str = "text"
) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and distance (0 to 1, of the nearest profile).

    The score is how much nearer the nearest profile is than the second: 1 - nearest / second
    distance (against the largest distance where there is one profile only). Columns of these
    names in ``docs`` give way.
    """
    made = {"lang_pred", "score", "distance"}
    guess = free_name(docs.columns, "_guess")
    seen = _guessed(docs, profiles, profile_size, text_col, guess)
    return seen.drop(*(c for c in docs.columns if c.lower() in made)).select("*", f"{guess}.*").drop(guess)


def _guessed(docs: DataFrame, profiles: DataFrame, profile_size: int, text_col: str, name: str) -> DataFrame:
    """``docs`` with a struct ``name`` of lang_pred, score and distance."""
    spark = docs.sparkSession
    ship(spark)
    rows = profiles.collect()  # languages x profile_size rows: bounded
    langs = sorted({r["lang"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), dtype=np.int64)
    ranks = np.full((len(grams), len(langs)), profile_size, dtype=np.int64)
    for r in rows:
        ranks[np.searchsorted(grams, r["gram"]), langs.index(r["lang"])] = r["rank"]

    @F.pandas_udf("lang_pred string, score double, distance double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            d = distances(t, grams, ranks, profile_size) if isinstance(t, str) and langs else None
            if d is None:
                out.append(("und", 0.0, 1.0))
                continue
            best = int(d.argmin())
            second = float(np.partition(d, 1)[1]) if len(d) > 1 else 1.0
            score = 1 - d[best] / second if second > 0 else 0.0
            out.append((langs[best], float(min(1.0, max(0.0, score))), float(d[best])))
        return pd.DataFrame(out, columns=["lang_pred", "score", "distance"])

    return docs.withColumn(name, guess(F.col(text_col)))


def identify(
    docs: DataFrame, train_on: Column, profile_size: int = 400, text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Learn profiles from the rows where ``train_on`` holds, predict every row."""
    profiles = train_profiles(docs.filter(train_on), text_col, lang_col, profile_size)
    return predict(docs, profiles, profile_size, text_col)


def keep_identified(
    docs: DataFrame, train_on: Column, accepted: list[str] | None = None, profile_size: int = 400,
    max_distance: float = 0.97,
) -> DataFrame:
    """The documents whose language is recognised, in their own columns.

    Rejected: no letters at all, further than ``max_distance`` from every profile, or
    outside ``accepted`` where that is given.
    """
    name = free_name(docs.columns, "_guess")
    seen = _guessed(docs, train_profiles(docs.filter(train_on), profile_size=profile_size), profile_size, "text", name)
    guess = F.col(name)
    good = (guess["lang_pred"] != "und") & (guess["distance"] <= max_distance)
    if accepted is not None:
        good = good & guess["lang_pred"].isin(accepted)
    return seen.filter(good).drop(name)
