"""Toxicity score: a weighted lexicon matched by an Aho-Corasick automaton.

Texts are folded first (case, homoglyphs, digit and sign substitutions,
punctuation to blanks). Terms are stems anchored at a word's start. Hits that
lie inside an exception phrase do not count. The weighted hits, per hundred
words and in total, give the score through a logistic curve. Stems, weights,
phrases and curve are learned from a bounded sample of labelled rows: a pair of
neighbouring words, one of which has a stem, is an exception if it is found in
enough clean rows and in no smaller share of them than of the toxic ones; the
stems are then weighed by what is left outside the phrases. A few fixed phrases
are added.

Defined results: null or empty text scores as a text without hits; a null id is
in no evaluation fold; repeated rows are scored each; an empty table gives an
empty result; without labelled rows of both classes only ``seed_terms`` count.
Only the id and the text column are read, so further columns never clash.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import held_out, put, training_rows

MIN_STEM, MAX_STEM = 3, 10
# fixed phrases in which a term is harmless
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "clown car", "sore loser rule", "pond scum")
# characters that look like a Latin letter
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v",
    "ι": "i", "κ": "k", "ı": "i", "ⅼ": "l", "ɡ": "g",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _fold_table() -> dict[int, str]:
    t = {c: " " for c in range(128) if not chr(c).isalnum()}
    t |= {ord(k): v for k, v in SUBSTITUTES.items()}
    t |= {c: chr(c + 32) for c in range(65, 91)}
    t |= {0xFF21 + k: chr(97 + k) for k in range(26)} | {0xFF41 + k: chr(97 + k) for k in range(26)}  # full width
    t |= {ord(k): v for k, v in HOMOGLYPHS.items()} | {ord(k.upper()): v for k, v in HOMOGLYPHS.items() if len(k.upper()) == 1 and ord(k.upper()) > 127}
    t |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # invisible
    return t


FOLD = _fold_table()


def fold(text: str | None) -> str:
    """Folded text with one blank before it; words are separated by blanks."""
    return " " + (text or "").translate(FOLD).lower()


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.0, 1.0)
    _auto: list = field(default_factory=list, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_auto": []}

    def automaton(self):
        if not self._auto:
            a = ahocorasick.Automaton()
            for t, w in self.weights.items():
                a.add_word(" " + t, (len(t), w))
            for p in self.exceptions:
                q = fold(p)
                if q.strip():
                    a.add_word(q, (len(q) - 1, None))
            if len(a):
                a.make_automaton()
            self._auto.append(a)
        return self._auto[0]

    def hits(self, t: str) -> dict[int, tuple[float, int]]:
        """Place -> (weight, length) of the heaviest stem of each word of a folded text, outside the exceptions."""
        a = self.automaton()
        if not len(a):
            return {}
        hits: dict[int, tuple[float, int]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, w) in a.iter(t):
            at = end - size + 1
            if w is None:
                spared.append((at, end))
            elif at not in hits or w > hits[at][0]:
                hits[at] = w, size
        if spared:
            # both in order of their place: one pass; ``upto`` is the end of the phrases that begin before a hit
            spared.sort()
            left, k, upto = {}, 0, -1
            for at in sorted(hits):
                while k < len(spared) and spared[k][0] <= at:
                    upto = max(upto, spared[k][1])
                    k += 1
                if at > upto:
                    left[at] = hits[at]
            hits = left
        return hits

    def evidence(self, text: str | None) -> tuple[float, int, int]:
        """(weight of the hits, number of hits, number of words). A word counts once, by its heaviest stem."""
        t = fold(text)
        hits = self.hits(t)
        return sum(w for w, _ in hits.values()), len(hits), len(t.split())

    def judge(self, text: str | None) -> tuple[float, int, int, float]:
        """(weight of the hits, number of hits, number of words, score)."""
        w, n, words = self.evidence(text)
        b, u, v = self.curve
        f, g = features(w, words)
        return w, n, words, 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, b + u * f + v * g))))


def features(weight: float, words: int) -> tuple[float, float]:
    """Total and length-normalised evidence, on a log scale; very short texts count as 20 words."""
    return math.log1p(max(0.0, weight)), math.log1p(max(0.0, 100.0 * weight / max(words, 20)))


def _counts(terms_of):
    """Tasks' counts (term, pos, neg) of the toxic and of the clean rows that hold a term; the empty term counts all rows."""

    def run(batches):
        pos, neg, n = Counter(), Counter(), [0, 0]
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (pos if y > 0 else neg).update(terms_of(text))
                n[y > 0] += 1
        # terms that no toxic text of this task has still count against the term
        terms = list(pos.keys() | neg.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([*terms, ""]), pa.array([*(pos[t] for t in terms), n[1]], pa.int64()), pa.array([*(neg[t] for t in terms), n[0]], pa.int64())],
            names=["term", "pos", "neg"])

    return run


def _prefixes(word: str) -> list[str]:
    return [word[:k] for k in range(MIN_STEM, min(len(word), MAX_STEM) + 1)]


def _stems(text: str | None) -> set[str]:
    return {p for w in set(fold(text).split()) for p in _prefixes(w)}


def _pairs_at(stems: frozenset[str]):
    """Text -> its pairs of words with one blank between them, one of which begins with one of ``stems``."""

    def run(text: str | None) -> set[str]:
        words = fold(text).split(" ")
        bad = {w for w in set(words) if any(p in stems for p in _prefixes(w))}
        return {f"{v} {w}" for v, w in zip(words, words[1:]) if v and w and (v in bad or w in bad)}

    return run


def _left_stems(lexicon: Lexicon):
    """Text -> the stems that it has outside the exceptions."""

    def run(text: str | None) -> set[str]:
        t = fold(text)
        return {t[at:at + size] for at, (_, size) in lexicon.hits(t).items()}

    return run


def fit_lexicon(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = 12_000, max_terms: int = 4_000, max_exceptions: int = 1_000,
                min_docs: int = 4, seed_terms: dict[str, float] | None = None, exceptions: tuple[str, ...] = EXCEPTIONS,
                id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """Learn stems, exceptions and curve from at most ``max_train`` labelled rows; at most ``max_terms`` stems and
    ``max_exceptions`` phrases, beside ``exceptions``, reach the driver. The rows are written once and read from there."""
    spark = docs.sparkSession
    train = put(training_rows(docs, labels, label, max_train, id_col, text_col).select(F.col("text").cast("string").alias("text"), "label"),
                scratch_path(spark, "toxicity-rows"), "text string, label double")

    def counted(terms_of) -> DataFrame:
        return train.mapInArrow(_counts(terms_of), "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    counts = counted(_stems)
    total = counts.where("term = ''").collect()
    seeds = dict(seed_terms or {})
    n1, n0 = (total[0]["pos"], total[0]["neg"]) if total else (0, 0)
    if not n1 or not n0:
        return Lexicon(seeds, exceptions)
    odds = F.log((F.col("pos") + 0.1) / n1) - F.log((F.col("neg") + 0.1) / n0)
    rows = (counts.where((F.col("pos") >= min_docs) & (F.col("term") != "")).withColumn("w", odds).where("w >= 3")
            .orderBy(F.desc(F.col("pos") * F.col("w")), "term").limit(max_terms).collect())
    chosen: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r["term"]), r["term"])):
        s = r["term"]
        if not any(s[:k] in chosen for k in range(MIN_STEM, len(s))):  # a shorter stem already covers it
            chosen[s] = float(r["w"])
    harmless = (counted(_pairs_at(frozenset(chosen))).where((F.col("neg") >= min_docs) & (F.col("term") != "") & (F.col("neg") * n1 >= F.col("pos") * n0))
                .orderBy(F.desc("neg"), "term").limit(max_exceptions).collect())
    phrases = tuple(dict.fromkeys([*exceptions, *(r["term"] for r in harmless)]))
    if harmless:
        left = counted(_left_stems(Lexicon(chosen, phrases))).where((F.col("pos") >= min_docs) & (F.col("term") != "")).withColumn("w", odds)
        chosen = {r["term"]: float(r["w"]) for r in left.orderBy("term").collect()}  # some of ``chosen``
    lex = Lexicon({**seeds, **chosen}, phrases)

    def evidence(batches):
        for b in batches:
            x = [features(e[0], e[2]) for e in map(lex.evidence, b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in x], pa.float64()), pa.array([q for _, q in x], pa.float64()), b.column(1)], names=["a", "b", "y"])

    got = train.mapInArrow(evidence, "a double, b double, y double").collect()
    return Lexicon(lex.weights, lex.exceptions, _logistic(np.array([[1.0, r["a"], r["b"]] for r in got]), np.array([float(r["y"] > 0) for r in got])))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> tuple[float, float, float]:
    """Ridge logistic regression by damped Newton steps; row order does not matter beyond rounding."""
    beta = np.zeros(x.shape[1])
    pen = np.diag([0.01, ridge, ridge])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + pen, x.T @ (y - p) - pen @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-10:
            break
    return tuple(round(float(v), 9) for v in beta)


def toxicity_scores(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, weight of the hits, number of hits and words, score in 0..1."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = [lexicon.judge(t) for t in b.column(1).to_pylist()]
            w, n, k, s = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w, pa.float64()), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(s, pa.float64())],
                                             names=["doc_id", "hit_weight", "n_hits", "n_words", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, hit_weight double, n_hits long, n_words long, score double")


def op9(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity_scores(docs, fit_lexicon(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "n_hits", "hit_weight")
