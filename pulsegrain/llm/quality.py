"""Quality rules by weak supervision.

Each rule looks at one ratio of a text and votes good, bad or abstains. The votes of all
texts are counted by pattern, expectation-maximisation over the pattern counts estimates
how often each rule is right for good and for bad texts, and the posterior probability of
being good decides. No label is used. A few hard limits (base_failed) come first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.shared import written
from pulsegrain.llm.textarrays import (
    gram_hashes, running, span_hashes, texts_of, words_of)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_letters", "n_stops")
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_START = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LETTER = _IS_UPPER.copy()
_IS_LETTER[97:123] = True
_IS_STOP = np.zeros(256, bool)
_IS_STOP[list(b"!?|")] = True


@dataclass(frozen=True)
class Rule:
    """Votes bad if the ratio is over bad_above or under bad_below, good if within the good
    range, else abstains. SQL text over FEATURES."""

    name: str
    ratio: str
    good_to: float
    bad_above: float
    good_from: float = 0.0
    bad_below: float = -1.0

    def vote(self) -> str:
        return (f"CASE WHEN {self.ratio} > {self.bad_above} OR {self.ratio} < {self.bad_below} "
                f"THEN -1 WHEN {self.ratio} BETWEEN {self.good_from} AND {self.good_to} THEN 1 "
                f"ELSE 0 END")


RULES = (
    Rule("symbols", "n_symbols / n_words", 0.02, 0.1),
    Rule("word_length", "word_chars / n_words", 8.0, 12.0, 3.5, 2.5),
    Rule("repeats", "n_repeat_words / n_words", 0.1, 0.3),
    Rule("same_lines", "n_dup_lines / n_lines", 0.1, 0.3),
    Rule("capitals", "n_upper / greatest(n_letters, 1)", 0.15, 0.5),
    Rule("marks", "n_stops / n_words", 0.05, 0.3),
    Rule("letters", "n_letters / word_chars", 1.0, 1.0, 0.75, 0.6),
)


def _count(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(grams: np.ndarray, n_words: int, n: int) -> int:
    """Words that lie in an n-word window seen twice or more."""
    order = np.argsort(grams, kind="stable")
    same = np.zeros(len(grams) + 1, bool)
    ranked = grams[order]
    same[1:-1] = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    hit = np.zeros(n_words, bool)
    at = order[same[1:] | same[:-1]]
    for j in range(n):
        hit[at + j] = True
    return int(hit.sum())


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """FEATURES of each text of an Arrow column."""
    out = {k: [] for k in FEATURES}
    for texts in texts_of(column):
        words, offsets, data = words_of(texts), texts.offsets, texts.data
        total = running(data)
        hashes = span_hashes(total, words.starts, words.ends)
        n = np.diff(words.bounds)
        grams = gram_hashes(hashes, 3)
        repeat = np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(n >= 3):
            a, b = words.bounds[i], words.bounds[i + 1]
            repeat[i] = _repeated(grams[a:b - 2], b - a, 3)
        # Lines: the first byte of a line is the start of the text or follows a \n.
        breaks = np.flatnonzero(data == 10)
        filled = offsets[:-1] < offsets[1:]
        starts = np.union1d(offsets[:-1][filled], breaks + 1)
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))
        ends = ends - ((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10))
        first = np.searchsorted(words.starts, starts)
        has_word = first < np.searchsorted(words.starts, ends)
        starts, ends = starts[has_word], ends[has_word]
        line_text = np.searchsorted(offsets[1:], starts, "right")
        lines = span_hashes(total, starts, ends)
        order = np.lexsort((lines, line_text))
        again = np.zeros(len(order), bool)
        again[1:] = (lines[order][1:] == lines[order][:-1]) & (
            line_text[order][1:] == line_text[order][:-1])
        solid = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_IS_START[data], out=solid[1:])
        chars = np.zeros(len(words.starts) + 1, np.int64)
        np.cumsum(solid[words.ends] - solid[words.starts], out=chars[1:])
        out["n_words"].append(n)
        out["word_chars"].append(chars[words.bounds[1:]] - chars[words.bounds[:-1]])
        out["n_symbols"].append(_count(_IS_SYMBOL[data], offsets))
        out["n_dup_lines"].append(np.bincount(line_text[order][again], minlength=len(texts)))
        out["n_repeat_words"].append(repeat)
        out["n_lines"].append(np.bincount(line_text, minlength=len(texts)))
        out["n_upper"].append(_count(_IS_UPPER[data], offsets))
        out["n_letters"].append(_count(_IS_LETTER[data] | (data >= 0xC2), offsets))
        out["n_stops"].append(_count(_IS_STOP[data], offsets))
    return {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64)
            for k, v in out.items()}


def text_features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns keep, as kept0, kept1 and so on, and FEATURES of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] +
                [pa.array(found[k]) for k in FEATURES], schema.names)

    inner = docs.select(*[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)],
                        F.col(f"`{text}`").alias("text"))
    schema = inner.drop("text").schema
    for k in FEATURES:
        schema = schema.add(k, "long")
    return inner.mapInArrow(run, schema)


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200,
             smooth: float = 1.0) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """EM over vote patterns: share of good texts, and for each rule and vote its probability
    for good and for bad texts. Starts from the majority of the votes; with no text at all the
    votes count as they stand."""
    n_rules = len(patterns[0][0]) if patterns else len(RULES)
    # One bad vote outweighs good ones at the start: each rule looks for another fault.
    good = [0.1 if -1 in votes else 0.9 if 1 in votes else 0.5 for votes, _ in patterns]
    share, tables = 0.5, [{v: (1 / 3, 1 / 3) for v in (-1, 0, 1)} for _ in range(n_rules)]
    for _ in range(rounds):
        total_good = sum(g * c for g, (_, c) in zip(good, patterns, strict=True)) + smooth
        total_bad = sum((1 - g) * c for g, (_, c) in zip(good, patterns, strict=True)) + smooth
        share = total_good / (total_good + total_bad)
        tables = []
        for r in range(n_rules):
            table = {}
            for v in (-1, 0, 1):
                a = sum(g * c for g, (p, c) in zip(good, patterns, strict=True) if p[r] == v)
                b = sum((1 - g) * c for g, (p, c) in zip(good, patterns, strict=True) if p[r] == v)
                table[v] = ((a + smooth / 3) / total_good, (b + smooth / 3) / total_bad)
            tables.append(table)
        before, good = good, [posterior(p, share, tables) for p, _ in patterns]
        if max((abs(a - b) for a, b in zip(before, good, strict=True)), default=0) < 1e-6:
            break
    return share, tables


def posterior(votes: tuple[int, ...], share: float,
              tables: list[dict[int, tuple[float, float]]]) -> float:
    odds = math.log(share / (1 - share)) + sum(
        math.log(t[v][0] / t[v][1]) for v, t in zip(votes, tables, strict=True))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


@dataclass(frozen=True)
class Model:
    share: float
    tables: list[dict[int, tuple[float, float]]]


BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
VOTES = [f"vote_{r.name}" for r in RULES]


def _votes(features: DataFrame) -> DataFrame:
    return features.withColumn("base_failed", F.expr(BASE_FAILED)).select(
        "*", *[F.expr(f"CASE WHEN base_failed THEN 0 ELSE {r.vote()} END").alias(n)
               for r, n in zip(RULES, VOTES, strict=True)])


def fit(features: DataFrame) -> Model:
    """Estimate over all texts that pass the base.

    Only the pattern counts, at most 3 ** len(RULES) rows, reach the driver.
    """
    rows = _votes(features).where("NOT base_failed").groupBy(*VOTES).count().collect()
    return Model(*estimate(sorted((tuple(row[n] for n in VOTES), row["count"]) for row in rows)))


def judge(features: DataFrame, model: Model) -> DataFrame:
    """Add base_failed, p_good and kept to rows with FEATURES."""
    odds = F.lit(math.log(model.share / (1 - model.share)))
    for n, t in zip(VOTES, model.tables, strict=True):
        weight = {v: math.log(t[v][0] / t[v][1]) for v in t}
        odds = odds + (F.when(F.col(n) == 1, weight[1]).when(F.col(n) == -1, weight[-1])
                       .otherwise(weight[0]))
    p_good = F.when(F.col("base_failed"), F.lit(0.0)).otherwise(1 / (1 + F.exp(-odds)))
    return (_votes(features).withColumn("p_good", p_good)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM))
            .drop(*VOTES))


def quality_verdicts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns keep, FEATURES, base_failed, p_good, kept of each row of docs.

    Null and empty texts have no words and fail the base; repeated rows are judged alike and
    each stays a row; other columns of docs are ignored whatever their names. An empty table
    gives no rows.
    """
    features = written(text_features(docs, keep, text), "quality")
    return judge(features, fit(features)).withColumnsRenamed(
        {f"kept{i}": c for i, c in enumerate(keep)})


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that are kept, with all their columns.

    Texts are measured twice, once for the estimate and once beside the whole rows, which
    saves a shuffle or a copy of all texts.
    """
    model = fit(text_features(docs, [], text))
    judged = judge(text_features(docs, docs.columns, text), model).where("kept")
    return judged.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(docs.columns)])
