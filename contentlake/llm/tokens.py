"""Token counts by a byte-level BPE vocabulary compiled to a finite-state machine.

The count of a byte-pair encoding is a rational function of the text, so it
needs no merge loop. Three facts are used: every prefix of an encoding is the
encoding of its string; a token sequence is an encoding exactly if each pair of
neighbours is; hence the last token of every prefix is unique. The transducer
reads a byte at a time. Its state holds, for each suffix of the input that
begins some token, the token that ends where the suffix begins and the count up
to there; the step to a next state emits the change of the count (a longer token
may replace several, so it can be negative). States are made when they are first
reached and kept in a table; equal situations are the same state, however long
the text.

Splitting at words is a local automaton over character classes: whether a token
may cross a place depends on at most two characters before and three after it.
At such a place the count transducer starts anew.

A batch is one byte stream cut into chunks of equal length which advance in
lockstep. A chunk's map from entry state to exit state and count is constant
once the stream starts anew inside it, so all chunks run at once from their first
restart; their open heads are then run from the exit states of the chunks before
(the scan over the maps), again all at once, until none is left.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 384  # bytes that a lane reads
BATCH_CHARS = 3_000_000  # text that is in arrays at once
MAX_STATES = 160_000  # then the table is made anew (it only saves work)
GROW = 32_768  # rows by which the table grows
ROOT, OPEN = 0, 1  # start of a word; entry state not known yet
LETTER, NUMBER, SPACE, BLANK, OTHER, EDGE = 1, 2, 3, 4, 5, 0  # BLANK: U+0020


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable
    Latin-1 for itself, the other bytes in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Of a tokenizer file: ``tokens`` (id -> bytes), ``merge`` ((left, right) ->
    rank), ``made`` (token -> rank, left, right) and the ``special`` strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or spec["normalizer"] or pre != {**pre, "type": "ByteLevel", "use_regex": True, "add_prefix_space": False}:
        raise ValueError("only byte-level BPE with the built-in word pattern is compiled")
    symbol = byte_symbols()
    special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    tokens = {i: bytes(symbol[c] for c in t) for t, i in model["vocab"].items() if t not in special}
    ids = {t: i for i, t in tokens.items()}
    merge, made = {}, {}
    for rank, pair in enumerate(model["merges"]):
        a, b = (bytes(symbol[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
        merge[ids[a], ids[b]] = rank
        made.setdefault(ids[a + b], (rank, ids[a], ids[b]))
    return {"tokens": tokens, "merge": merge, "made": made, "special": special}


class Transducer:
    """Count transducer of a vocabulary, with the table of the states met so far."""

    def __init__(self, vocabulary: dict) -> None:
        self.merge, self.made, self.pairs = vocabulary["merge"], vocabulary["made"], {}
        # trie of the tokens: node -> {byte: node}, and the token that ends there
        self.child, self.token = [{}], [None]
        for i, t in vocabulary["tokens"].items():
            node = 0
            for b in t:
                node = self.child[node].setdefault(b, len(self.child))
                if node == len(self.token):
                    self.child.append({})
                    self.token.append(None)
            self.token[node] = i
        self.reset()

    def reset(self) -> None:
        # a state: ((trie node, last token, count relative to now), ...), longest suffix first
        self.states = [((0, None, 0),), ()]
        self.ids = {s: i for i, s in enumerate(self.states)}
        # bytes get a column when they are first met; an entry is state * 32 + 16 + change of the count
        self.column, self.byte_of, self.width = np.full(256, -1, np.int32), [], 128
        self.table = np.full((GROW, self.width), -1, np.int32)
        self.table[OPEN] = OPEN * 32 + 16

    def columns(self, data: np.ndarray) -> np.ndarray:
        """The table's column of every byte."""
        for b in np.unique(data[self.column[data] < 0]).tolist():
            if len(self.byte_of) == self.width:
                self.table = np.hstack([self.table, np.full_like(self.table, -1)])
                self.width *= 2
                self.table[OPEN] = OPEN * 32 + 16
            self.column[b] = len(self.byte_of)
            self.byte_of.append(b)
        return self.column[data]

    def fits(self, left: int | None, right: int) -> bool:
        """Is (left, right) the encoding of its string? It isn't if, undoing the
        merges next to the border in the order they came, some merge would have
        joined the two sides first."""
        if left is None:
            return True
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self._fits(left, right)
        return known

    def _fits(self, a: int, b: int) -> bool:
        merge, made = self.merge, self.made
        limit, last = 1 << 60, None
        while True:
            rank = merge.get((a, b))
            # at an equal place the left side's merge comes first
            if rank is not None and (rank < limit or rank == limit and last == "right"):
                return False
            ra, rb = made.get(a, (-1,))[0], made.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a, last = ra, made[a][2], "left"
            else:
                limit, b, last = rb, made[b][1], "right"

    def fill(self, state: int, column: int) -> None:
        """Makes the transition of a state at a byte."""
        b, found, suffixes = self.byte_of[column], None, []
        for node, last, count in self.states[state]:
            to = self.child[node].get(b)
            if to is None:
                continue
            suffixes.append((to, last, count))
            token = self.token[to]
            if found is None and token is not None and self.fits(last, token):
                found = (token, count + 1)
        token, count = found
        if not -16 <= count < 16:
            raise OverflowError("a byte changes the token count by more than the table holds")
        new = tuple((n, t, c - count) for n, t, c in suffixes if self.child[n]) + ((0, token, 0),)
        i = self.ids.get(new)
        if i is None:
            i = self.ids[new] = len(self.states)
            self.states.append(new)
            if i >= len(self.table):
                self.table = np.concatenate([self.table, np.full((GROW, self.width), -1, np.int32)])
        self.table[state, column] = i * 32 + 16 + count

    def move(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """One step of all lanes: the table's entries."""
        index = state * self.width + column
        to = self.table.reshape(-1)[index]
        if to.min(initial=0) < 0:
            for i in np.unique(index[to < 0]).tolist():
                self.fill(*divmod(i, self.width))
            to = self.table.reshape(-1)[index]
        return to

    def deltas(self, data: np.ndarray, restart: np.ndarray) -> np.ndarray:
        """The change of the token count at every byte of a stream whose words
        begin where ``restart`` is set (it is at 0)."""
        n = len(data)
        lanes = -(-n // CHUNK)
        pad = lanes * CHUNK - n
        grid = np.ascontiguousarray(self.columns(np.pad(data, (0, pad), mode="edge")).reshape(lanes, CHUNK).T)
        begin = np.pad(restart, (0, pad), constant_values=True).reshape(lanes, CHUNK).T
        carry = np.ascontiguousarray(~begin).astype(np.int32)  # 0 sends a lane to ROOT
        out = np.zeros((CHUNK, lanes), np.int8)
        state = np.full(lanes, OPEN, np.int32)
        for t in range(CHUNK):
            to = self.move(state * carry[t], grid[t])
            state = to >> 5
            out[t] = (to & 31) - 16
        head = np.where(begin.any(axis=0), begin.argmax(axis=0), CHUNK)
        todo = np.flatnonzero(head > 0)  # lane 0 has none
        while len(todo):
            ready = todo[state[todo - 1] != OPEN]
            lane, now, t = ready, state[ready - 1], 0
            while len(lane):
                to = self.move(now, grid[t, lane])
                now = to >> 5
                out[t, lane] = (to & 31) - 16
                t += 1
                over = head[lane] <= t
                whole = over & (head[lane] == CHUNK)
                state[lane[whole]] = now[whole]
                lane, now = lane[~over], now[~over]
            todo = np.setdiff1d(todo, ready, assume_unique=True)
        return out.T.reshape(-1)[:n]


def char_classes() -> np.ndarray:
    """Class of every code point as the word pattern sees it."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, every):
            a, b = (i if i < 0xD800 else i + 0x800 for i in m.span())
            if a < 0xD800 < b:  # the run goes on past the surrogates
                out[a:0xD800], out[0xE000:b] = kind, kind
            else:
                out[a:b] = kind
    out[0x20] = BLANK
    return out


def word_starts(cp: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where words begin; ``kind`` is EDGE before, between and after the texts."""
    n = len(kind)
    space = (kind == SPACE) | (kind == BLANK)
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[0], before[1:] = EDGE, kind[:-1]
    after[-1], after[:-1] = EDGE, kind[1:]
    space_before = (before == SPACE) | (before == BLANK)
    solid_after = (after == LETTER) | (after == NUMBER) | (after == OTHER)
    # white space: the last of a run stands alone or leads the next word
    start = np.where(space, ~space_before | solid_after, (before != kind) & (before != BLANK))
    # 's 't 'm 'd 're 've 'll (fixed values) behind no blank and no other sign
    at = np.flatnonzero(start & (cp == 0x27) & (after == LETTER))
    if len(at):
        one = cp[at + 1]
        two = np.where(at + 2 < n, cp[np.minimum(at + 2, n - 1)], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for pair in ("re", "ve", "ll"):
            size = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 3, size)
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        end = at + size
        end = end[end < n]
        start[end[(kind[end] == LETTER)]] = True
    return start & (kind != EDGE)


def count_batch(machine: Transducer, classes: np.ndarray, texts: list[str], splitter) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of every text."""
    pieces, owner, tokens = [], [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        parts = splitter.split(t) if splitter is not None else [t]
        tokens[i] = len(parts) - 1  # special strings are a token each
        pieces += parts
        owner += [i] * len(parts)
    size = np.zeros(len(texts), np.int64)
    joined = "\0".join(["", *pieces, ""])
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kind = classes[cp]
    edge = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    kind[edge] = EDGE
    start = word_starts(cp, kind)
    width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    offset = np.cumsum(width) - width
    data = np.frombuffer(joined.encode("utf-8"), np.uint8)
    restart = np.zeros(len(data), bool)
    restart[offset[start]] = True
    restart[offset[edge]] = True
    delta = machine.deltas(data, restart).astype(np.int64)
    delta[offset[edge]] = 0
    # texts lie between the edges
    sums = np.add.reduceat(delta, offset[edge])[:-1]
    lengths = np.diff(offset[edge]) - 1
    np.add.at(tokens, owner, sums)
    np.add.at(size, owner, lengths)
    if splitter is not None:
        for i, t in enumerate(texts):
            for m in splitter.finditer(t):
                size[i] += len(m.group().encode())
    return size, tokens


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row: UTF-8 bytes and tokens of the whole
    text, as the vocabulary's library gives them without added tokens; special
    strings inside a text are one token each.

    Null text is empty: 0 and 0. Null and repeated ids stay separate rows; an
    empty table gives no rows; other columns are not read. The vocabulary is read
    on the driver (its size bounds what is sent to the tasks).
    """
    sent = docs.sparkSession.sparkContext.broadcast(
        {"vocabulary": read_vocabulary(vocabulary_path), "classes": char_classes(), "machine": None})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = sent.value  # stays with the worker process, and so does the table made so far
        machine = shared["machine"] = shared["machine"] or Transducer(shared["vocabulary"])
        special, classes = shared["vocabulary"]["special"], shared["classes"]
        splitter = regex.compile("|".join(map(regex.escape, special))) if special else None
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (chars < BATCH_CHARS or end == at):
                    chars += len(texts[end])
                    end += 1
                n_bytes, n_tokens = count_batch(machine, classes, texts[at:end], splitter)
                yield pd.DataFrame({"id": batch["id"].iloc[at:end], "n_bytes": n_bytes, "n_tokens": n_tokens})
                if len(machine.states) > MAX_STATES:
                    machine.reset()
                at = end

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
