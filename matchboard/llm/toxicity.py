"""Toxicity of texts from a learned lexicon, with misspellings and context.

Training learns a lexicon: words whose labelled documents are nearly all toxic. Documents that share their
smallest word-pair hash count once, so that a much copied text cannot make its own words look typical.

Matching intersects Levenshtein automata with the trie of the lexicon: a state is the set of (trie node, edits
used) that the letters read so far can have reached, and the transitions are worked out once per set and
letter. A word that ends in an accepting state is a term or a misspelling of one. Misspellings that occur in
clean labelled documents are known words and do not count.

Context windows weigh each hit: between quotation marks or next to reporting words (both within a few words) it
is quoted speech and enters separately from direct use, and direct hits are strengthened by further hits
around them. A logistic model over these sums gives the score.

Null texts count as empty; empty texts get the score of a text without hits. Rows without a label, with
conflicting labels (the higher counts) or a null id never break training; with no toxic label every score is 0.
Repeated rows are scored alike. Columns other than id, text and label are never read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.llm.common import stored, text_of

WORD = re.compile(r"\w+|[\"“”„«»]")
QUOTES = frozenset('"“”„«»')
REPORTING = frozenset("said says wrote writes quote quoted quotes called according sagte schrieb dit écrit dijo escribió".split())
WINDOW = 8  # words on either side that tell quotation from abuse
FUZZY_LENGTH = 5  # shorter terms are matched exactly
KEEP_WORDS = 200_000  # words whose match a task remembers
TRAIN_ROWS = 20_000  # labelled rows that are fitted to, at most
MIN_SUPPORT = 3
MIN_SHARE = 0.01  # of the toxic training documents
MIN_PRECISION = 0.9


class Matcher:
    """The lexicon's trie and the lazily built automaton of all words within the edit distance."""

    def __init__(self, terms, max_edits: int = 1):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.max_edits = max_edits
        for term in sorted(terms):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][letter]
            self.term[node] = term
        self.longest = [0] * len(self.children)  # the longest term below each node: short terms allow no edit
        for node in range(len(self.children) - 1, -1, -1):
            below = [self.longest[c] for c in self.children[node].values()]
            own = len(self.term[node]) if self.term[node] else 0
            self.longest[node] = max([own, *below])
        self.alphabet = {letter for node in self.children for letter in node}
        self.states: list[tuple[tuple[int, int], ...]] = []
        self.number: dict[tuple[tuple[int, int], ...], int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})
        self.known: dict[str, tuple[str, int] | None] = {}

    def _state(self, reached: dict[int, int]) -> int:
        """The state of nodes with their fewest edits, letters left out of the word included."""
        queue = list(reached.items())
        while queue:
            node, edits = queue.pop()
            if edits < self.max_edits and reached.get(node) == edits:
                for child in self.children[node].values():
                    if self.longest[child] >= FUZZY_LENGTH and reached.get(child, self.max_edits + 1) > edits + 1:
                        reached[child] = edits + 1
                        queue.append((child, edits + 1))
        key = tuple(sorted(reached.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return self.number[key]

    def _move(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, edits in self.states[state]:
            child = self.children[node].get(letter)
            if child is not None and reached.get(child, self.max_edits + 1) > edits:
                reached[child] = edits
            if edits < self.max_edits:
                others = [node, *self.children[node].values()]  # a letter too many, another letter
                for other in others:
                    if self.longest[other] >= FUZZY_LENGTH and reached.get(other, self.max_edits + 1) > edits + 1:
                        reached[other] = edits + 1
        return self._state(reached) if reached else -1

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term (the first in order on ties) and its distance."""
        if word in self.known:
            return self.known[word]
        state = self.start
        for letter in word:
            letter = letter if letter in self.alphabet else ""
            after = self.moves[state].get(letter)
            if after is None:
                after = self.moves[state][letter] = self._move(state, letter)
            state = after
            if state < 0:
                break
        found = None
        if state >= 0:
            ends = [(edits, self.term[node]) for node, edits in self.states[state] if self.term[node]]
            ends = [(e, t) for e, t in ends if e == 0 or len(t) >= FUZZY_LENGTH]
            found = min(ends)[::-1] if ends else None
        if len(self.known) >= KEEP_WORDS:
            self.known.clear()
        self.known[word] = found
        return found


@dataclass
class Lexicon:
    """Terms with their weights, and words within the edit distance of a term that are known to be clean."""

    weights: dict[str, float]
    clean: frozenset[str] = frozenset()
    max_edits: int = 1
    matcher: Matcher | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "clean": self.clean, "max_edits": self.max_edits, "matcher": None}

    def hits(self, text: str) -> tuple[list[tuple[str, str, int, bool, float]], int]:
        """(word, term, distance, quoted, weight) of each hit, and the number of words."""
        if self.matcher is None:
            self.matcher = Matcher(self.weights, self.max_edits)
        words = WORD.findall(text.lower())
        find = self.matcher.match
        at = [(i, m) for i, w in enumerate(words) if (m := find(w)) and (m[1] == 0 or w not in self.clean)]
        found, low, high = [], 0, 0  # hits low to high are at most WINDOW words away
        for i, (term, edits) in at:
            while at[low][0] < i - WINDOW:
                low += 1
            while high < len(at) and at[high][0] <= i + WINDOW:
                high += 1
            before, after = words[max(0, i - WINDOW) : i], words[i + 1 : i + 1 + WINDOW]
            inside = any(w in QUOTES for w in before) and any(w in QUOTES for w in after)
            reported = any(w in REPORTING for w in before[-3:] + after[:3])
            company = min(high - low - 1, 4)
            found.append((words[i], term, edits, inside or reported, self.weights[term] * (1 + 0.25 * company)))
        return found, len(words)


FEATURES = 5


def features(hits, n_words: int, clean=frozenset()) -> list[float]:
    direct = sum(w for _, _, e, q, w in hits if not e and not q)
    quoted = sum(w for _, _, e, q, w in hits if not e and q)
    fuzzy = sum(w for form, _, e, _, w in hits if e and form not in clean)
    strongest = max((w for _, _, e, _, w in hits if not e), default=0.0)
    return [math.log1p(direct), math.log1p(quoted), math.log1p(fuzzy), strongest / 10, math.log1p(100 * (direct + quoted) / max(20, n_words))]


# What the weights are drawn to where there is little to learn from: quoted and misspelled terms count for less.
PRIOR = (1.0, 0.3, 0.5, 0.0, 0.0, 0.0)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights and intercept by Newton steps."""
    a, prior = np.column_stack([x, np.ones(len(x))]), np.array(PRIOR)
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (p - y) + penalty @ (w - prior))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None  # None: nothing toxic to learn from

    def score(self, text: str) -> float:
        if self.weights is None:
            return 0.0
        x = features(*self.lexicon.hits(text))
        return float(1 / (1 + math.exp(-min(30.0, max(-30.0, float(np.dot(self.weights[:-1], x) + self.weights[-1]))))))


def _words_of(text: str) -> tuple[int, list[str]]:
    words = re.findall(r"\w+", text.lower())
    pairs = (f"{a} {b}" for a, b in zip(words, words[1:]))
    least = min((xxhash.xxh64_intdigest(p) for p in pairs), default=xxhash.xxh64_intdigest(text))
    return least >> 1, sorted(set(words))


def train(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, max_edits: int = 1, label_col: str = "toxic",
    id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    """A model from at most ``train_rows`` labelled documents, chosen by a hash of their ids.

    ``labels`` must hold only rows that may be learned from.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg((F.max(label_col) > 0).alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(train_rows)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    sample = stored(rows.join(F.broadcast(chosen), "id"), "toxicity-sample")  # train_rows ids at most are broadcast

    @F.pandas_udf("struct<family long, words array<string>>")
    def parts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_words_of(t) for t in texts], columns=["family", "words"])

    words = sample.select("toxic", parts("text").alias("p")).select("toxic", "p.family", F.explode("p.words").alias("word"))
    families = sample.select("toxic", parts("text").alias("p")).select("toxic", "p.family").distinct()
    n_toxic, n_clean = families.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).head()
    if not n_toxic:
        return Model(Lexicon({}), None)
    support = max(MIN_SUPPORT, math.ceil(MIN_SHARE * n_toxic))
    per_word = words.distinct().groupBy("word").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c"))
    # every term is in a share of the toxic documents, so the list stays short however large the corpus
    strong = per_word.where((F.col("t") >= support) & (F.col("t") >= MIN_PRECISION * (F.col("t") + F.col("c")))).collect()
    odds = lambda r: math.log((r.t + 0.5) / (n_toxic + 1)) - math.log((r.c + 0.5) / (n_clean + 1))
    lexicon = Lexicon({r.word: max(0.1, odds(r)) for r in strong}, frozenset(), max_edits)

    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).cast("int")

    @F.pandas_udf("array<string>")
    def near_terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({h[0] for h in lexicon.hits(t)[0] if h[2]}) for t in texts])

    # words of clean documents within the edits of a term: as many at most as the terms have such neighbours
    known = sample.where(~F.col("toxic")).select(half.alias("half"), F.explode(near_terms("text")).alias("word")).distinct().collect()
    clean = [frozenset(r.word for r in known if r.half == h) for h in (0, 1)]

    @F.pandas_udf("array<double>")
    def feature(texts: pd.Series, halves: pd.Series) -> pd.Series:
        # each half is fitted with the clean words of the other, so known words do not look better than they are
        return pd.Series([features(*lexicon.hits(t), clean[1 - h]) for t, h in zip(texts, halves)])

    # a few numbers per training document, train_rows documents at most
    rows = sample.select("id", "toxic", F.xxhash64("text").alias("h"), feature("text", half).alias("x"))
    seen = rows.orderBy(F.xxhash64("id"), "id", "h").limit(train_rows).collect()
    x = np.array([r.x for r in seen]).reshape(-1, FEATURES)
    weights = fit_logistic(x, np.array([float(r.toxic) for r in seen]))
    return Model(Lexicon(lexicon.weights, clean[0] | clean[1], max_edits), weights)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept out of training."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def scored(docs: DataFrame, model: Model, name: str = "score", text_col: str = "text") -> DataFrame:
    """All rows and columns, and the score; a column of that name is replaced."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t or "") for t in texts], dtype="float64")

    return docs.withColumn(name, score(F.col(f"`{text_col}`").cast("string")))
