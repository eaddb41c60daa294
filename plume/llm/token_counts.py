"""Word-piece counts by a linear longest-match automaton.

A vocabulary file (path is a parameter) gives pieces over bytes; ``</w>`` at the
end of a piece marks the end of a word.  Greedy longest-match splits a word
into pieces from the left, always taking the longest that fits.  The automaton
does that in one step per byte: a trie of the pieces, where each node has a
failure link (the node reached after the pieces that must be cut off are cut
off) and the number of pieces cut off on the way.  Both are spelled out into a
full transition table, level by level, so a step is one table look-up and
pieces are never built.  A batch's words advance together, byte by byte.

Words are runs of anything but ASCII white space, A-Z lower-cased.  The
vocabulary must hold every single byte, inside and at the end of a word, so
every word can be split (checked on load).  The table is built once per Python
worker from the broadcast vocabulary, whose size is checked.

Defined results: NULL, empty or blank text has 0 words and 0 pieces.  Texts of
any length are read whole; every row gives a row; extra columns are not read.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textbytes import column_bytes, row_slices, words

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
MAX_VOCABULARY = 200_000     #: entries; the broadcast list and the tables stay small
END = 256                    #: the symbol for the end of a word


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes that byte-level vocabularies use, by their published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[int, ...]]:
    """Pieces as tuples of symbols: bytes, and END where the piece ends a word."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    if len(vocab) > MAX_VOCABULARY:
        raise ValueError(f"{path} has {len(vocab)} entries; at most {MAX_VOCABULARY} are supported")
    alphabet, out = byte_alphabet(), []
    for token in vocab:
        body = token.removesuffix("</w>")
        if body and all(c in alphabet for c in body):
            out.append(tuple(alphabet[c] for c in body) + ((END,) if body != token else ()))
    single = {p for p in out if len(p) == 1 or (len(p) == 2 and p[1] == END)}
    if len(single) < 512:
        raise ValueError(f"{path} lacks single bytes: not every word could be split")
    return sorted(out)


class Automaton:
    """``step[state, symbol]`` and the number of pieces cut off on the way, ``cut[state, symbol]``."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        child: list[dict[int, int]] = [{}]
        depth, parent, symbol, whole = [0], [0], [0], [False]
        for piece in pieces:
            at = 0
            for c in piece:
                nxt = child[at].get(c)
                if nxt is None:
                    nxt = len(child)
                    child[at][c] = nxt
                    child.append({})
                    depth.append(depth[at] + 1)
                    parent.append(at)
                    symbol.append(c)
                    whole.append(False)
                at = nxt
            whole[at] = True
        n = len(child)
        depth, parent, symbol = np.array(depth), np.array(parent), np.array(symbol)
        whole = np.array(whole)
        goto = np.full((n, END + 1), -1, np.int32)
        goto[parent[1:], symbol[1:]] = np.arange(1, n)
        #: after a state's text no longer fits: the state of what is left, and pieces cut off
        fail, lost = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.step, self.cut = goto.copy(), np.zeros((n, END + 1), np.uint8)
        # at the root a symbol without a child cannot occur but END alone, which costs nothing
        self.step[0][goto[0] < 0] = 0
        for d in range(1, int(depth.max()) + 1):
            here = np.flatnonzero(depth == d)
            done = here[whole[here]]
            fail[done], lost[done] = 0, 1
            part = here[~whole[here]]
            if len(part):
                # the parent's text no longer fits plus one symbol: a step from the parent's failure state
                up = parent[part]
                fail[part] = self.step[fail[up], symbol[part]]
                lost[part] = lost[up] + self.cut[fail[up], symbol[part]]
            missing = goto[here] < 0
            onward, more = self.step[fail[here]], self.cut[fail[here]].astype(np.int32) + lost[here][:, None]
            self.step[here] = np.where(missing, onward, goto[here])
            cut = np.where(missing, more, 0)
            if cut.max(initial=0) > 255:
                raise ValueError("a piece of the vocabulary splits into more than 255 others")
            self.cut[here] = cut
        #: pieces that a state's text itself splits into (a word's end leaves a whole piece or nothing)
        rest, left = lost.copy(), fail.copy()
        while left.any():
            rest += lost[left]
            left = fail[left]
        self.rest = rest

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end], all words one byte at a time."""
        order = np.argsort(start - end, kind="stable")  # longest first
        at, length = start[order], (end - start)[order]
        state, total = np.zeros(len(at), np.int32), np.zeros(len(at), np.int64)
        live = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        for k, n in enumerate(live):
            c = data[at[:n] + k]
            total[:n] += self.cut[state[:n], c]
            state[:n] = self.step[state[:n], c]
        total += self.cut[state, END]
        state = self.step[state, END]
        total += self.rest[state]
        out = np.empty(len(at), np.int64)
        out[order] = total
        return out


def lower_bytes(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper * np.uint8(32))


def token_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens per row."""
    sent = docs.sparkSession.sparkContext.broadcast({"pieces": read_vocabulary(path)})

    def run(batches):
        held = sent.value  # one object per Python worker, so the table is built once in each
        if "automaton" not in held:
            held["automaton"] = Automaton(held["pieces"])
        auto = held["automaton"]
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            n_words, n_tokens = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for lo, hi in row_slices(offsets):
                part = lower_bytes(data[offsets[lo]:offsets[hi]])
                start, end, row = words(part, offsets[lo:hi + 1] - offsets[lo])
                if len(start):
                    n_words[lo:hi] = np.bincount(row, minlength=hi - lo)
                    n_tokens[lo:hi] = np.bincount(row, auto.count(part, start, end), hi - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_tokens)], names=["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long")
