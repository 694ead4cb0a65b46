"""Token counts by trie-shared unigram scoring.

A text's pre-tokens are its words, each with the word mark before it. A pre-token's tokens are those of its best
segmentation into vocabulary pieces, by the sum of their unigram scores. Distinct pre-tokens go into a trie whose nodes
hold the forward score and token count of the best segmentation of their prefix: a prefix that many
pre-tokens share is scored once, and the count at a pre-token's last node is its own.

The vocabulary file gives pieces in order of use but no probabilities, and a tokenizer is never trained here, so a piece
at rank r scores -ln(r + 1), Zipf's law: the counts are those of this unigram model and of no published tokenizer. A character in no piece falls back to its UTF-8 bytes, a token each, at ``FALLBACK`` each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
FALLBACK = -20.0
MAX_NODES = 1_000_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def load_pieces(path: str) -> dict[str, float]:
    """Scores of the ordinary pieces of a SentencePiece vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {piece: -math.log(rank + 1) for rank, piece in enumerate(ordinary, start=1)}


class Trie:
    """Forward scores of prefixes; starts anew when it has grown to ``max_nodes``, which bounds its memory.

    Each node knows the longest suffix of its prefix that begins some piece. That suffix gives, from a memo, the pieces that
    end at the node, so scoring a node reads only scores along its own path.
    """

    def __init__(self, pieces: dict[str, float], max_nodes: int = MAX_NODES) -> None:
        self.pieces, self.max_nodes = pieces, max_nodes
        self.begins = {p[:i] for p in pieces for i in range(len(p) + 1)}
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}  # (node, character) as one number
        self.nodes: list[tuple[float, int, str]] = [(0.0, 0, "")]  # score, tokens, suffix
        self.memo: dict[str, tuple[str, list[tuple[int, float]]]] = {}
        self.known = _Known(self)

    def _ending(self, text: str) -> tuple[str, list[tuple[int, float]]]:
        """The longest suffix that begins a piece, and (length, score) of the pieces that end ``text``."""
        suffix = text
        while suffix not in self.begins:
            suffix = suffix[1:]
        self.memo[text] = found = suffix, [(len(suffix) - i, self.pieces[suffix[i:]]) for i in range(len(suffix)) if suffix[i:] in self.pieces]
        return found

    def total(self, words: list[str]) -> int:
        """Tokens of some pre-tokens."""
        if len(self.nodes) > self.max_nodes:
            self.clear()
        return sum(map(self.known.__getitem__, words))

    def add(self, word: str) -> int:
        """Insert one pre-token; its tokens."""
        child, nodes, memo = self.child, self.nodes, self.memo
        node, at = 0, nodes[0]
        path = [at]
        for c in MARK + word:
            key = node << 21 | ord(c)
            node = child.get(key, 0)
            if not node:
                score, count, suffix = at
                text = suffix + c
                own, ending = memo.get(text) or self._ending(text)
                size = 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
                best, tokens = score + FALLBACK * size, count + size
                for length, piece in ending:
                    score, count, _ = path[-length]
                    score += piece
                    if score > best or (score == best and count + 1 < tokens):
                        best, tokens = score, count + 1
                node = child[key] = len(nodes)
                nodes.append((best, tokens, own))
            at = nodes[node]
            path.append(at)
        return at[1]


class _Known(dict):
    """Terminal counts by pre-token; one not seen yet goes into the trie."""

    def __init__(self, trie: Trie) -> None:
        self.trie = trie

    def __missing__(self, word: str) -> int:
        self[word] = found = self.trie.add(word)
        return found


_tries: dict[int, Trie] = {}  # a worker's trie goes on from task to task


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", max_nodes: int = MAX_NODES) -> DataFrame:
    """(doc_id, n_words, n_tokens), one row for each row of ``docs``; null and wordless texts have none of either.

    The vocabulary is read on the driver from ``vocabulary`` and sent to the tasks. A worker keeps one trie over its
    tasks, so nothing is shuffled. A word of any length is scored whole. Only the named columns are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _tries.get(max_nodes)
        if trie is None or trie.pieces is not sent.value:
            trie = _tries[max_nodes] = Trie(sent.value, max_nodes)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).to_pylist():
                found = WORD.findall(text or "")
                words.append(len(found))
                tokens.append(trie.total(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_words", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, f"{id_col} {kind}, n_words long, n_tokens long")
