"""Token counts with a unigram model over a trie of pre-tokens.

A pre-token is a run of characters other than blanks, led by the word mark. Its segmentation is the one with
the highest sum of piece scores; a character that no piece holds falls back to its bytes. The forward score
of a prefix does not depend on what follows, so distinct pre-tokens are inserted in a trie and the score (and
number of pieces) of each node is computed once, from its ancestors; a pre-token's count is stored where it
ends. The pieces that end at a node come from an automaton over the vocabulary. Tasks hold one trie for all
their documents, of bounded size: it is begun anew at MAX_NODES, the terminal counts at MAX_WORDS, and
pre-tokens beyond MAX_KEPT characters are scored without being inserted. None of these changes a result.

Pieces come from a public vocabulary (its path is a parameter) and score by their rank, -log(rank + 2); the
vocabulary is fixed in size and checked against MAX_PIECES before it is broadcast.

Defined results: null, empty and blank texts have no words and no tokens; ties prefer fewer pieces, then the
longer last piece; repeated rows count alike; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.text import slices

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MAX_PIECES = 1_000_000
MAX_NODES = 600_000
MAX_WORDS = 500_000
MAX_KEPT = 256
MARK = "▁"


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Scores of the pieces of a public vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if len(model) > MAX_PIECES:
        raise ValueError(f"{path} holds {len(model)} pieces, more than {MAX_PIECES}")
    special = [i for i in range(len(model)) if model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i)]
    kept = sorted(set(range(len(model))) - set(special))
    return {model.IdToPiece(i): -math.log(rank + 2) for rank, i in enumerate(kept)}


class Pieces:
    """The vocabulary as an automaton: which pieces end at a place, found from the place before."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.byte = min(scores.values(), default=0.0) - 1.0  # the score of one byte
        self.next: list[dict[str, int]] = [{}]
        ends: list[tuple[int, float] | None] = [None]
        for piece, score in scores.items():
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(None)
                node = self.next[node][c]
            ends[node] = (len(piece), score)
        self.fall = [0] * len(self.next)
        self.found: list[tuple[tuple[int, float], ...]] = [()] * len(self.next)  # (length, score), longest first
        queue = list(self.next[0].values())
        for node in queue:
            self.found[node] = ((ends[node],) if ends[node] else ()) + self.found[self.fall[node]]
            for c, child in self.next[node].items():
                self.fall[child] = self.step(self.fall[node], c)
                queue.append(child)

    def step(self, state: int, c: str) -> int:
        """The longest end of the text so far that some piece begins with."""
        following = self.next
        while c not in following[state]:
            if not state:
                return 0
            state = self.fall[state]
        return following[state][c]


class Trie:
    """Forward scores of prefixes; `counts` maps pre-tokens to their numbers of pieces."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.counts = Counts(self)
        self.reset()

    def reset(self) -> None:
        self.children: dict[int, int] = {}
        self.score, self.count, self.state = [0.0], [0], [0]

    def _best(self, c: str, state: int, path: list[int], score: list[float], count: list[int]) -> tuple[float, int]:
        """Best score and number of pieces after c, given those of all places on the path so far."""
        size = 1 if c < "\x80" else len(c.encode())
        before = path[-1]
        best, pieces = score[before] + size * self.pieces.byte, count[before] + size
        for length, value in self.pieces.found[state]:
            at = path[-length]
            total = score[at] + value
            if total > best or (total == best and count[at] < pieces):
                best, pieces = total, count[at] + 1
        return best, pieces

    def insert(self, word: str) -> int:
        """Number of pieces of a pre-token."""
        if len(word) > MAX_KEPT:
            return self._walk(word)
        if len(self.score) > MAX_NODES:
            self.reset()
        children, node, path = self.children, 0, [0]
        for c in word:
            key = node << 21 | ord(c)
            child = children.get(key)
            if child is None:
                state = self.pieces.step(self.state[node], c)
                best, pieces = self._best(c, state, path, self.score, self.count)
                child = children[key] = len(self.score)
                self.score.append(best)
                self.count.append(pieces)
                self.state.append(state)
            node = child
            path.append(node)
        return self.count[node]

    def _walk(self, word: str) -> int:
        """The same without keeping anything."""
        state, path, score, count = 0, [0], [0.0], [0]
        for c in word:
            state = self.pieces.step(state, c)
            best, pieces = self._best(c, state, path, score, count)
            path.append(len(score))
            score.append(best)
            count.append(pieces)
        return count[-1]


class Counts(dict):
    """Terminal counts by the bytes of a pre-token, without its mark."""

    def __init__(self, trie: Trie) -> None:
        super().__init__()
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        n = self.trie.insert(MARK + word.decode())
        if len(word) <= MAX_KEPT:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = n
        return n


def _count(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        look = trie.counts.__getitem__
        for batch in batches:
            words, tokens = [], []
            for part in slices(batch.column(1)):
                for i in range(len(part)):
                    some = part.text(i).split()  # of bytes: exactly the ASCII blanks
                    words.append(len(some))
                    tokens.append(sum(map(look, some)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return run


def report(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per document: doc_id, n_words, n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(load_pieces(path)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_count(shared), f"doc_id {kind}, n_words long, n_tokens long")
