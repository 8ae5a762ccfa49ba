"""Spelling variants of a vocabulary by bidirectional FM-index search schemes.

Two words are near if one inserted, deleted or replaced code point turns one into the
other. The error lies in the first or in the second half of the word, so two searches
find all near words: match the first half exactly and extend to the right over the
second one with one error, or match the second half exactly and extend to the left
over the first one. Both run on suffix-rank intervals of a bidirectional FM-index over
the delimited vocabulary, for all words of a block at once.

Words meet by their halves: a word is searched in the block of its own first and of
its own last half, and indexed under every prefix and suffix that can be a near word's
half. Blocks hold about ``BLOCK_CHARS`` code points; a half that alone has more is
split into several blocks, its searches into parts, and every part visits every block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import ascii_lower, stage

#: A run of letters.
RUN = "[A-Za-zÀ-ÿ]+"
BLOCK_CHARS = 1 << 18
#: Interval states whose children are made at once.
STATES = 1 << 14
PAIR = "word string, n bigint, near string, near_n bigint"


class _Ranks:
    """How many of the first i symbols are below c, from bit words."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        n_words = len(symbols) // 64 + 1
        padded = np.full(n_words * 64, sigma, dtype=np.uint8 if sigma < 255 else np.int64)
        padded[:len(symbols)] = symbols
        # to sigma + 1, so that the symbol sigma stands for letters that no indexed word has
        self.bits = np.empty((sigma + 2, n_words), dtype=np.uint64)
        self.sums = np.zeros((sigma + 2, n_words), dtype=np.int32)
        for c in range(sigma + 2):
            self.bits[c] = np.packbits(padded < c, bitorder="little").view("<u8")
            np.cumsum(np.bitwise_count(self.bits[c][:-1]), out=self.sums[c, 1:])

    def below(self, c, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[c, word] + np.bitwise_count(self.bits[c, word] & mask)


class BidirectionalIndex:
    """FM-index of distinct words, each taken as the circular text "$word", in both
    directions. A state (low, reverse low, size) of a pattern holds its interval
    among the sorted rotations and that of the reversed pattern among the rotations
    read backwards; the pattern grows on either side."""

    LEFT, RIGHT = 0, 1

    def __init__(self, words: list[str]) -> None:
        lengths = np.array([len(w) + 1 for w in words])
        ends = np.cumsum(lengths)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.alphabet = np.unique(points)
        n, sigma = int(ends[-1]), len(self.alphabet) + 1
        first = ends - lengths
        text = np.zeros(n, dtype=np.int64)
        inner = np.ones(n, dtype=bool)
        inner[first] = False
        text[inner] = np.searchsorted(self.alphabet, points) + 1
        after = np.arange(1, n + 1)
        after[ends - 1] = first
        before = np.empty(n, dtype=np.int64)
        before[after] = np.arange(n)
        order, back = self._sorted(text, after), self._sorted(text, before)
        self.n, self.sigma, self.order = n, sigma, order
        self.starts = np.searchsorted(np.sort(text), np.arange(sigma + 2))
        self.ranks = _Ranks(text[before[order]], sigma), _Ranks(text[after[back]], sigma)
        self.word_at = np.repeat(np.arange(len(words)), lengths)

    @staticmethod
    def _sorted(text: np.ndarray, step: np.ndarray) -> np.ndarray:
        """The rotations in order: ranks of 1, 2, 4, ... symbols until all differ."""
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        while (top := int(rank.max()) + 1) < len(text):
            rank = np.unique(rank * top + rank[step], return_inverse=True)[1].astype(np.int64)
            step = step[step]
        return np.argsort(rank)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words, one after the other, and where each begins."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points
        return np.where(known, at + 1, self.sigma), np.concatenate([[0], np.cumsum([len(w) for w in words])])

    def grow(self, side: int, state: np.ndarray, c) -> np.ndarray:
        """States (3 rows) with the symbol ``c`` added on ``side``; size 0: none."""
        own, other = (0, 1) if side == self.LEFT else (1, 0)
        ranks, low, high = self.ranks[own], state[own], state[own] + state[2]
        below_low, below_high = ranks.below(c, low), ranks.below(c, high)
        upto_low, upto_high = ranks.below(c + 1, low), ranks.below(c + 1, high)
        out = np.empty((3, *np.broadcast(c, low).shape), dtype=np.int64)
        out[own] = self.starts[c] + upto_low - below_low
        out[other] = state[other] + below_high - below_low
        out[2] = upto_high - upto_low - (below_high - below_low)
        return out

    def children(self, side: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(parent, symbol, state) of every state one letter longer that occurs."""
        parents, symbols, states = [], [], []
        letters = np.arange(1, self.sigma)[:, None]
        for at in range(0, state.shape[1], STATES):
            grown = self.grow(side, state[:, None, at:at + STATES], letters)
            c, p = np.nonzero(grown[2])
            parents.append(p + at)
            symbols.append(c + 1)
            states.append(grown[:, c, p])
        if not parents:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((3, 0), np.int64)
        return np.concatenate(parents), np.concatenate(symbols), np.concatenate(states, axis=1)


def _search(index: BidirectionalIndex, words: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, indexed word) with one error. ``side`` RIGHT: the first half matches
    exactly, the second one is extended to the right with the error; LEFT: mirrored."""
    flat, begin = index.codes(words)
    length = np.diff(begin)
    half = length // 2
    right = side == index.RIGHT
    # what matches exactly, from the error's half outwards, then what is extended over; "$" closes both
    n_exact, n_rest = (half, length - half) if right else (length - half, half)

    def symbol(q: np.ndarray, j: np.ndarray, rest: bool) -> np.ndarray:
        """The j-th symbol of the exact or the other half, counted from the cut."""
        forward = rest == right
        n = (n_rest if rest else n_exact)[q]
        at = begin[q] + np.where(forward, half[q] + j, half[q] - 1 - j)
        return np.where(j < n, flat[np.clip(at, 0, len(flat) - 1)], 0)

    q = np.arange(len(words))
    state = np.zeros((3, len(words)), dtype=np.int64)
    state[2] = index.n
    done_q, done_state = [], []
    j = 0
    while len(q):
        state = index.grow(1 - side, state, symbol(q, np.full(len(q), j), False))
        live = state[2] > 0
        over = live & (j == n_exact[q])
        done_q.append(q[over])
        done_state.append(state[:, over])
        q, state = q[live & ~over], state[:, live & ~over]
        j += 1
    q, state = np.concatenate(done_q or [q]), np.concatenate(done_state or [state], axis=1)

    found_q, found_row = [], []
    wrong_q, wrong_j, wrong = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((3, 0), np.int64)
    j = 0
    while len(q) or len(wrong_q):
        if len(q):
            here = symbol(q, np.full(len(q), j), True)
            parent, letter, grown = index.children(side, state)
            other = letter != here[parent]
            parent, grown = parent[other], grown[:, other]
            replace, drop = here[parent] > 0, here > 0
            wrong_q = np.concatenate([wrong_q, q[parent], q[parent][replace], q[drop]])
            wrong_j = np.concatenate([wrong_j, np.full(len(parent), j), np.full(int(replace.sum()), j + 1), np.full(int(drop.sum()), j + 1)])
            wrong = np.concatenate([wrong, grown, grown[:, replace], state[:, drop]], axis=1)
            state = index.grow(side, state, here)
            live = (state[2] > 0) & (here > 0)
            q, state = q[live], state[:, live]
            j += 1
        wrong = index.grow(side, wrong, symbol(wrong_q, wrong_j, True))
        live = wrong[2] > 0
        over = live & (wrong_j == n_rest[wrong_q])
        found_q.append(wrong_q[over])
        found_row.append(wrong[0, over])
        wrong_j = wrong_j + 1
        live &= ~over
        wrong_q, wrong_j, wrong = wrong_q[live], wrong_j[live], wrong[:, live]
    q, row = np.concatenate(found_q or [wrong_q]), np.concatenate(found_row or [wrong_q])
    return q, index.word_at[index.order[row]]


def _near_in_block(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    rows = rows.drop_duplicates("word")
    out = [pd.DataFrame({"word": [], "n": [], "near": [], "near_n": []})]
    if len(rows) and len(asked):
        index = BidirectionalIndex(rows["word"].tolist())
        for side in (index.RIGHT, index.LEFT):
            some = asked[asked["side"] == side]
            if len(some):
                q, found = _search(index, some["word"].tolist(), side)
                out.append(pd.DataFrame({"word": some["word"].to_numpy()[q], "n": some["n"].to_numpy()[q],
                                         "near": rows["word"].to_numpy()[found], "near_n": rows["n"].to_numpy()[found]}))
    return pd.concat(out[1:] or out).drop_duplicates()


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words (string, n, distinct, at
    least two code points) that differ by exactly one inserted, deleted or replaced
    code point."""
    size = F.char_length("word")
    right, left = BidirectionalIndex.RIGHT, BidirectionalIndex.LEFT

    def keys(side: int, lengths: list) -> list:
        cut = (lambda k: F.substring("word", F.lit(1), k)) if side == right else (lambda k: F.substring("word", -k, k))
        return [F.struct(F.lit(side).alias("side"), cut(k).alias("half")) for k in lengths]

    whole = lambda x: F.floor(x).cast("int")
    own = F.array(*keys(right, [whole(size / 2)]), *keys(left, [whole((size + 1) / 2)]))
    any_half = F.array_distinct(F.array(*keys(right, [whole((size + d) / 2) for d in (-1, 0, 1)]),
                                        *keys(left, [whole((size + d) / 2) for d in (0, 1, 2)])))
    rows = stage(vocabulary.select("word", "n", F.explode(any_half).alias("k")).select("word", "n", "k.side", "k.half"), "spelling-index")
    asked = vocabulary.select("word", "n", F.explode(own).alias("k")).select("word", "n", "k.side", "k.half")
    chars = F.sum(F.char_length("word") + 1).alias("chars")
    n_blocks = -(-(rows.agg(chars).first()["chars"] or 0) // BLOCK_CHARS) or 1
    # one row for every half that fills a block alone: at most n_blocks
    hot = F.broadcast(rows.groupBy("side", "half").agg(chars).where(F.col("chars") > BLOCK_CHARS).select(
        "side", "half", F.ceil(F.col("chars") / BLOCK_CHARS).cast("int").alias("parts")))
    block = F.pmod(F.xxhash64("side", "half"), F.lit(n_blocks)).cast("string")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)).alias("_every")
    name = lambda row, query: F.when(F.col("parts").isNull(), block).otherwise(
        F.concat_ws("|", "side", "half", row.cast("string"), query.cast("string")))
    rows = rows.join(hot, ["side", "half"], "left").select("*", every).withColumn("block", name(part, F.col("_every")))
    asked = asked.join(hot, ["side", "half"], "left").select("*", every).withColumn("block", name(F.col("_every"), part))
    found = rows.select("block", "word", "n").groupBy("block").cogroup(
        asked.select("block", "word", "n", "side").groupBy("block")).applyInPandas(
        lambda a, b: _near_in_block(a, b), PAIR)
    return found.distinct()


def spelling_groups(vocabulary: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``vocabulary`` (word, n;
    words distinct). ``form`` is the near word of largest n (ties: smallest in
    code-point order) if that is at least ``ratio`` times the word's own n, else null;
    ``root`` the last word that forms lead to. n grows by ``ratio`` with each step, so
    chains are short; they are halved every round."""
    vocabulary = stage(vocabulary.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    forms = vocabulary.join(near, "word", "left").withColumn(
        "best", F.when(-F.col("best.m") >= F.lit(ratio) * F.col("n"), F.col("best")))
    forms = stage(forms.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.col("best.near").alias("form"), (-F.col("best.m")).alias("form_n")), "spelling-forms")
    ahead = stage(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        hop = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stage(ahead.join(hop, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "spelling-roots")
        ahead = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return forms.join(ahead, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def corpus_words(docs: DataFrame, *, least_chars: int = 6, least_count: int = 5, noise: int | None = 199,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z lower-cased, of at least
    ``least_chars`` code points that occur ``least_count`` times. With ``noise``, a
    run whose h = crc32("<id>:<run>") is divisible by it loses its code point
    h % length. A null text has no runs, a null id is an empty string there; repeated
    rows count as often as they occur."""
    run = F.explode(F.regexp_extract_all(ascii_lower(text_col), F.lit(RUN), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run).where(
        F.char_length("run") >= least_chars)
    word = F.col("run")
    if noise:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(h, F.char_length("run").cast("long")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(h % noise == 0, cut).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.char_length("word") >= least_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))
