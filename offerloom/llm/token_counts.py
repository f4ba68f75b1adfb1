"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie over UTF-8 bytes with failure links: when no edge fits, the automaton pops the longest piece
that it has seen and goes on from the state of what remains. How many pieces a failure pops is precomputed, so the
number of tokens of a word follows from one pass over its bytes and no piece is ever built. All words of a batch are
run side by side, one byte per step.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Mark of a word's begin in the vocabulary.
MARK = "▁".encode()
#: Words longer than this are run one by one, so that few long words do not stretch a batch.
SIDE_BY_SIDE = 64
STEP_BYTES = 1 << 22


@dataclass(frozen=True)
class Automaton:
    """row: first cell of a state's edges in ``edges`` (256 cells, -1: no edge); fail, popped: where a failure goes
    and how many tokens it counts. State 0 is the root."""
    row: np.ndarray
    edges: np.ndarray
    fail: np.ndarray
    popped: np.ndarray

    def counts(self, data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of the words data[begin:end]; every byte value is a piece, so a word never fails as a whole."""
        out = np.zeros(len(begin), np.int64)
        raw = np.frombuffer(data, np.uint8)
        size = end - begin
        short = np.flatnonzero(size <= SIDE_BY_SIDE)
        short = short[np.argsort(-size[short], kind="stable")]
        state = np.zeros(len(short), np.int64)
        start = self.walk(MARK)
        state[:], out[short] = start
        lengths = size[short]
        for step in range(int(lengths[0]) if len(short) else 0):
            live = int(np.searchsorted(-lengths, -step, side="left"))  # words longer than step come first
            byte = raw[begin[short[:live]] + step].astype(np.int64)
            now = state[:live]
            after = self.edges[self.row[now] + byte]
            stuck = np.flatnonzero(after < 0)
            while len(stuck):
                at = now[stuck]
                out[short[stuck]] += self.popped[at]
                now[stuck] = at = self.fail[at]
                after[stuck] = self.edges[self.row[at] + byte[stuck]]
                stuck = stuck[after[stuck] < 0]
            state[:live] = after
        left = np.flatnonzero(state > 0)
        while len(left):
            out[short[left]] += self.popped[state[left]]
            state[left] = self.fail[state[left]]
            left = left[state[left] > 0]
        for i in np.flatnonzero(size > SIDE_BY_SIDE):
            out[i] = self.tokens(data[begin[i]:end[i]])
        return out

    def walk(self, word: bytes, state: int = 0, count: int = 0) -> tuple[int, int]:
        edges, row, fail, popped = self.edges, self.row, self.fail, self.popped
        for c in word:
            while edges[row[state] + c] < 0:
                count += popped[state]
                state = fail[state]
            state = edges[row[state] + c]
        return int(state), int(count)

    def tokens(self, word: bytes) -> int:
        state, count = self.walk(word, *self.walk(MARK))
        while state:
            count += self.popped[state]
            state = self.fail[state]
        return int(count)


def build(pieces: list[bytes]) -> Automaton:
    """The automaton of a vocabulary; single bytes that are no piece are added, as the fall-back for the rest."""
    children: list[dict[int, int]] = [{}]
    piece = [False]
    for p in {*pieces, *(bytes([c]) for c in range(256))} - {b""}:
        state = 0
        for c in p:
            if c not in children[state]:
                children[state][c] = len(children)
                children.append({})
                piece.append(False)
            state = children[state][c]
        piece[state] = True
    n = len(children)
    fail, popped = np.zeros(n, np.int64), np.zeros(n, np.int64)
    todo = deque([0])
    while todo:
        u = todo.popleft()
        for c, v in children[u].items():
            if piece[v]:
                fail[v], popped[v] = 0, 1
            else:
                z, count = fail[u], popped[u]
                while c not in children[z]:
                    z, count = fail[z], count + popped[z]
                fail[v], popped[v] = children[z][c], count
            todo.append(v)
    inner = [i for i in range(n) if children[i]]
    row = np.zeros(n, np.int64)  # leaves share the row without edges
    edges = np.full((len(inner) + 1) * 256, -1, np.int32)
    for k, i in enumerate(inner, 1):
        row[i] = k * 256
        for c, v in children[i].items():
            edges[k * 256 + c] = v
    return Automaton(row, edges, fail, popped)


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a sentencepiece model as bytes; its control pieces and byte fall-backs are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i).encode() for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words and n_tokens of every whole text, for any vocabulary file on the driver.

    A word is a run without white space (space and characters 9 to 13). It is matched greedily from its begin, with
    the begin mark in front; a byte that no piece covers is a token of its own. Null and blank texts have none;
    repeated rows are counted each; an empty table gives no rows. Other columns are not read. What is broadcast is
    the automaton, whose size follows from the vocabulary alone.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(build(read_pieces(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton.value
        gap = np.zeros(256, bool)
        gap[[32, 9, 10, 11, 12, 13]] = True
        for batch in batches:
            texts = batch.column(1).to_pylist()
            words, tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size < STEP_BYTES):
                    size += len(texts[high] or b"") + 1
                    high += 1
                data = b" ".join([b"", *((t or b"") for t in texts[low:high]), b""])
                blank = gap[np.frombuffer(data, np.uint8)]
                begin = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
                end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
                bounds = np.cumsum([0, *(len(t or b"") + 1 for t in texts[low:high])])
                cut = np.searchsorted(begin, bounds)
                total = np.concatenate([[0], np.cumsum(machine.counts(data, begin, end))])
                words[low:high] = np.diff(cut)
                tokens[low:high] = np.diff(total[cut])
                low = high
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(tokens)], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
