"""Language identification by rank-order n-gram profiles (out-of-place distance)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, settle, stored

#: Ranked n-grams of a document or language that are compared.
PROFILE = 300
#: Distinct n-grams that a training task holds before it hands them on.
HELD = 1_000_000
UNKNOWN = "und"
#: A document scoring under ``MARGIN`` of the ``LOW`` quantile of a language's own documents is not in it.
LOW, MARGIN = 0.05, 0.6
#: The same for a language of which no own score is known.
MIN_SCORE = 0.05


def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None, alpha: np.ndarray) -> np.ndarray:
    """Codes of all 1- to 3-grams within the words of the whole text.

    Lower case; runs of other characters than letters are one blank, which
    counts at the ends of a 2- or 3-gram only. A code holds 21 bits a character.
    """
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    keep = alpha[chars]
    chars = np.where(keep, chars + 1, 1)
    keep[1:] |= keep[:-1].copy()
    chars = np.concatenate(([1], chars[keep], [1]))
    if len(chars) < 3:
        return np.empty(0, np.int64)
    if chars[-2] == 1:
        chars = chars[:-1]
    if chars[1] == 1:
        chars = chars[1:]
    inner = chars != 1
    one = chars[inner]
    two = (chars[:-1] << 21 | chars[1:])[inner[:-1] | inner[1:]]
    three = (chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:])[inner[1:-1]]
    return np.concatenate((one, two, three))


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    found, n = np.unique(codes, return_counts=True)
    if len(found) > size:
        least = np.partition(n, len(n) - size)[len(n) - size]
        found, n = found[n >= least], n[n >= least]
    return found[np.argsort(-n, kind="stable")][:size]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """Profiles ``lang``, ``code``, ``rank`` (from 0): the ``size`` most frequent
    n-grams over all whole texts of each language (ties by code).

    Rows with a null language or text teach nothing.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        alpha = letters()
        held: dict[str, list] = {}

        def merged(parts):
            codes = np.concatenate([p[0] for p in parts])
            order = np.argsort(codes, kind="stable")
            codes, n = codes[order], np.concatenate([p[1] for p in parts])[order]
            at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            return codes[at], np.add.reduceat(n, at)

        def out(lang, codes, n):
            return pd.DataFrame({"lang": lang, "code": codes, "n": n})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                codes = grams(text, alpha)
                if len(codes):
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(codes, return_counts=True))
                    if sum(len(p[0]) for p in parts[1:]) > HELD:
                        parts[:] = [merged(parts)]
                        if len(parts[0][0]) > HELD:
                            yield out(lang, *parts.pop())
        for lang, parts in held.items():
            if parts:
                yield out(lang, *merged(parts))

    seen = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang is not null and text is not null")
    counts = seen.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    # the filter on the place itself lets each task keep its own first ones before the shuffle
    return counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "code", (F.col("place") - 1).alias("rank"))


def predict(docs: DataFrame, profiles: DataFrame, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    Each of the document's ``size`` most frequent n-grams is out of place by the
    difference of its ranks in the document and in the language (``size`` if the
    language lacks it); the language of the smallest sum wins, ties by name.
    ``score`` is 1 less that sum over its largest possible value. Defined cases:
    null text, text without a letter or no profiles: ``und`` with score 0; very
    long texts count whole; repeated rows agree; extra columns are kept, one
    called ``lang_pred`` or ``score`` is replaced. The profiles are a
    few hundred rows per language and come to the driver.
    """
    by_lang: dict[str, list] = {}
    for r in profiles.collect():
        by_lang.setdefault(r["lang"], []).append((r["code"], r["rank"]))
    model = []
    for lang in sorted(by_lang):
        pairs = np.array(sorted(by_lang[lang]), np.int64)
        model.append((lang, pairs[:, 0], pairs[:, 1]))

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        alpha = letters()

        def one(text):
            own = ranked(grams(text, alpha), size)
            if not len(own) or not model:
                return UNKNOWN, 0.0
            place, best = np.arange(len(own)), None
            for lang, codes, ranks in model:
                at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                far = np.where(codes[at] == own, np.abs(ranks[at] - place), size).sum()
                if best is None or far < best[0]:
                    best = far, lang
            return best[1], 1.0 - best[0] / (size * len(own))

        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])

    found, = fresh(docs, "found")
    kept = [F.col(c) for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.withColumn(found, judge(F.col(text_col))).select(
        *kept, F.col(f"{found}.lang_pred").alias("lang_pred"), F.col(f"{found}.score").alias("score"))


def floors(docs: DataFrame, profiles: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE,
           low: float = LOW, margin: float = MARGIN) -> dict[str, float]:
    """``floors_of`` the ``docs``, which are scored for it (once: the scores are written down)."""
    judged = predict(docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), profiles, "text", size)
    return floors_of(settle(judged.drop("text")), low, margin)


def floors_of(judged: DataFrame, low: float = LOW, margin: float = MARGIN) -> dict[str, float]:
    """The least score of each language: ``margin`` of the ``low`` quantile of the
    scores of all ``judged`` rows (``lang``, ``lang_pred``, ``score``) of the language that are found in it.

    Scores are counted by thousandths (rounded down), which come to the driver. Defined cases: rows of a
    null language, and languages none of whose rows are found in them, give no least score; repeated rows
    count each; an empty table gives none.
    """
    counts = judged.where("lang = lang_pred").groupBy("lang", F.floor(F.col("score") * 1000).alias("at")).count()
    by_lang: dict[str, list] = {}
    for r in counts.collect():
        by_lang.setdefault(r["lang"], []).append((r["at"], r["count"]))
    out = {}
    for lang, steps in by_lang.items():
        left = low * sum(n for _, n in steps)
        for at, n in sorted(steps):
            left -= n
            if left <= 0:
                out[lang] = margin * at / 1000
                break
    return out


def known_language(docs: DataFrame, profiles: DataFrame, text_col: str = "text", size: int = PROFILE,
                   min_score: float = MIN_SCORE, least: dict[str, float] | None = None, lang_col: str | None = None) -> DataFrame:
    """Rows of ``docs`` whose text has a letter and scores in its best language what
    ``least`` asks for, or ``min_score`` if that lacks the language; the others are rejected.
    With ``lang_col``, ``least`` is ``floors_of`` the rows themselves.

    Every row is scored once: the scored rows are written to the shared folder, where
    the floors and the verdicts read them. Defined cases: null, empty and letterless texts are rejected; a null language
    says nothing of the floors, the row is judged by its text; equal rows stay or go together; an empty
    table stays empty; columns of any name are kept.
    """
    row, = fresh(docs, "row")
    own = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    held = docs.select(F.struct(*docs.columns).alias(row), F.col(text_col).alias("text"), own.alias("lang"))
    judged = stored(predict(held, profiles, "text", size).drop("text"), "scored")
    if least is None and lang_col:
        least = floors_of(judged)
    needed = F.lit(min_score)
    for lang, score in sorted((least or {}).items()):
        needed = F.when(F.col("lang_pred") == lang, score).otherwise(needed)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= needed)).select(f"{row}.*")
