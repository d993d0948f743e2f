"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import read_table, worker_cache
from tessera.llm.linear import held_out

#: Rows of each language that its automaton is built from, and symbols of them: bounds of the model.
SAMPLE_ROWS, SAMPLE_SYMBOLS = 64, 32_000
#: Rows with longer texts are taken for the sample only if a language has too few others.
SAMPLE_CHARS = 4000
#: Symbols: any non-letter, letters without a symbol of their own, what pads a block, then the commonest letters.
GAP, OTHER, PAD, FIRST, SYMBOLS = 0, 1, 2, 3, 64
#: A text is parsed in blocks of so many symbols, side by side; a phrase ends where its block ends.
BLOCK = 256
#: Characters that are parsed at once.
BATCH_CHARS = 1 << 20
LETTER = re.compile(r"[^\W\d_]")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(symbols: list[int]) -> tuple[list[dict[int, int]], int]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for s in symbols:
        new = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p >= 0 and s not in nxt[p]:
            nxt[p][s] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(s) == q:
                    nxt[p][s] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return nxt, len(nxt)


class CrossParser:
    """Suffix automata of each language's sample, as tables that restart a phrase by themselves.

    An entry is (row of the state that follows) * 2 + (1 if a phrase ended
    before this symbol): where the automaton can't go on, the longest match is
    a phrase, and the next one starts with the symbol at hand.
    """

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        seen = Counter(c for t in samples.values() for c in t.lower() if LETTER.match(c))
        letters = [ord(c) for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:SYMBOLS - FIRST]]
        self.own = {c: FIRST + i for i, c in enumerate(letters)}
        self.table = np.full(0x110000 if letters else 1, GAP, np.uint8)
        if letters:
            self.table[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
            for c, s in self.own.items():
                self.table[c] = s
        self.cost, self.step = [], []
        for lang in self.langs:
            symbols = self.encode(samples[lang].lower())[:SAMPLE_SYMBOLS].tolist()
            nxt, n = suffix_automaton(symbols)
            go = np.full((n + 1, SYMBOLS), -1, np.int64)
            for s, row in enumerate(nxt):
                for c, t in row.items():
                    go[s, c] = t * SYMBOLS * 2
            alone = n * SYMBOLS * 2  # after a symbol that the sample lacks, which is a phrase by itself
            begin = np.where(go[0] >= 0, go[0], alone)
            go = np.where(go >= 0, go, begin + 1)
            go[0] = begin
            go[:, PAD] = np.arange(n + 1) * SYMBOLS * 2
            self.step.append(go.astype(np.int32).ravel())
            self.cost.append(log2(max(2, len(symbols))))

    def encode(self, lowered: str) -> np.ndarray:
        """Symbols of a text; runs of non-letters are one gap."""
        s = self.table[code_points(lowered)]
        return s[~((s == GAP) & np.concatenate([[False], s[:-1] == GAP]))] if len(s) else s

    def bits(self, texts: list[str]) -> np.ndarray:
        """For each text and language, bits a symbol: its phrases at the price of a pointer into the sample."""
        coded = [self.encode(t.lower()) for t in texts]
        blocks = [-(-len(c) // BLOCK) for c in coded]
        first = np.cumsum([0, *blocks])
        lanes = np.full(first[-1] * BLOCK, PAD, np.uint8)
        for c, a in zip(coded, first):
            lanes[a * BLOCK:a * BLOCK + len(c)] = c
        columns = np.ascontiguousarray(lanes.reshape(-1, BLOCK).T).astype(np.int32)
        out = np.zeros((len(texts), len(self.langs)))
        size = np.array([max(1, len(c)) for c in coded])
        for k, step in enumerate(self.step):
            state, phrases = np.zeros(columns.shape[1], np.int32), np.ones(columns.shape[1], np.int32)
            for column in columns:
                state += column
                state = step[state]
                phrases += state & 1
                state >>= 1
            total = np.concatenate([[0], np.cumsum(phrases)])
            out[:, k] = (total[first[1:]] - total[first[:-1]]) * self.cost[k] / size
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language with the fewest bits, and by what share it beats the next; ties go to the first by name."""
        out, at, room = [("und", 0.0)] * len(texts), [], 0
        for i, t in enumerate([*texts, None]):
            if i < len(texts) and t and self.langs and LETTER.search(t):
                at.append(i)
                room += len(t)
            if at and (room >= BATCH_CHARS or i == len(texts)):
                for j, b in zip(at, self.bits([texts[j] for j in at])):
                    best, rest = int(b.argmin()), np.sort(b)
                    out[j] = self.langs[best], float(1 - rest[0] / rest[1]) if len(rest) > 1 else 1.0
                at, room = [], 0
        return out


def training_sample(docs: DataFrame) -> dict[str, str]:
    """Text of up to SAMPLE_ROWS rows of each language, those with the smallest id hashes.

    Rows without text or language and held-out documents don't count.  The
    rank is limited before the shuffle, so that a language's rows never meet.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit("lang"))
    rows = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id")))
    rank = Window.partitionBy("lang").orderBy(F.length("text") > SAMPLE_CHARS, order, "doc_id", "text")
    few = rows.select("lang", "text", F.row_number().over(rank).alias("n")).where(F.col("n") <= SAMPLE_ROWS)
    texts: dict[str, list[str]] = {}
    for r in sorted(few.collect(), key=lambda r: (r["lang"], r["n"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    return {lang: "\n".join(t)[:4 * SAMPLE_SYMBOLS] for lang, t in texts.items()}


def detect(docs: DataFrame, samples: dict[str, str], text_col: str = "text"):
    """Struct column (lang, score) of every text.

    Each text is parsed greedily against each language's automaton into the
    longest phrases that its sample holds, in blocks of 256 symbols, over its
    whole length; the language with the fewest phrases at the price of a
    pointer into its sample wins.  ``score`` is the share by which it beats the
    next (0 for a tie, 1 if there is no other).  NULL, empty and letterless
    texts, and all texts when there is nothing to learn from, are ``und`` with 0.
    """
    key = ("languages", hashlib.sha256(repr(sorted(samples.items())).encode()).digest())

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        cache = worker_cache()
        if key not in cache:
            cache[key] = CrossParser(samples)
        return pd.DataFrame(cache[key].predict(list(texts)), columns=["lang", "score"])
    return run(docs[text_col])


def op9_language(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), detect(docs, training_sample(docs)).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
