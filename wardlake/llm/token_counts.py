"""Token counts under a unigram vocabulary, by dynamic programming over a trie of the distinct pre-tokens.

A pre-token is a word between white space with the vocabulary's word mark before it. Its best segmentation has the
largest sum of piece scores. The best score of a prefix does not depend on what follows, so words that begin
alike share the work: a node of the trie is a prefix and holds its forward score and the number of
tokens that give it, computed once; a word's own count is stored where it ends. A document's count is the sum over
its words. Each task has its own trie, of bounded size: when it or the table of counts is full, it starts
anew, which changes no result.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import text_of

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: What a character that no piece covers costs below the least score, as unigram vocabularies have it.
UNKNOWN_PENALTY = 10.0
TRIE_NODES = 300_000
TABLE_ENTRIES = 400_000
#: Prefixes longer than this are computed, not stored.
TRIE_DEPTH = 48


class Node:
    __slots__ = ("score", "count", "next")

    def __init__(self, score: float, count: int):
        self.score, self.count, self.next = score, count, None


class UnigramTrie:
    """Counts tokens of words under pieces with scores.

    ``pieces`` maps a piece to its score; of segmentations with equal scores the one with fewest tokens counts.
    A character outside all pieces counts as its UTF-8 bytes if ``byte_fallback``, else as one token.
    """

    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True, nodes: int = TRIE_NODES,
                 entries: int = TABLE_ENTRIES):
        self.byte_fallback = byte_fallback
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in pieces if len(p) == 1}
        self.backward: dict = {}  # the pieces from their last character to their first; "" holds the score
        for p, score in pieces.items():
            at = self.backward
            for c in reversed(p):
                at = at.setdefault(c, {})
            at[""] = score
        self.limit, self.entries = nodes, entries
        self.root, self.size = Node(0.0, 0), 1
        self.counts: dict[str, int] = {}

    def _forward(self, text: str, end: int, path: list[Node]) -> Node:
        """The node of ``text[:end]``: best score, fewest tokens. ``path`` ends with the node of the prefix before."""
        best, n = float("-inf"), 0
        at, k = self.backward, 0
        while k < end:
            k += 1
            at = at.get(text[end - k])
            if at is None:
                break
            s = at.get("")
            if s is not None:
                node = path[-k]
                s += node.score
                if s > best or s == best and node.count + 1 < n:
                    best, n = s, node.count + 1
        c = text[end - 1]
        if c not in self.single:
            s = path[-1].score + self.unknown
            m = path[-1].count + (len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else 1)
            if s > best or s == best and m < n:
                best, n = s, m
        return Node(best, n)

    def insert(self, word: str) -> int:
        """The word's token count; its prefixes are left in the trie."""
        if self.size > self.limit:
            self.root, self.size = Node(0.0, 0), 1
        node = self.root
        path = [node]
        for end, c in enumerate(word, 1):
            if end > TRIE_DEPTH:
                node = self._forward(word, end, path)
                if len(path) > 4 * self.longest + 64:  # only the last prefixes are looked at
                    del path[:-self.longest - 1]
            else:
                below = node.next
                if below is None:
                    below = node.next = {}
                child = below.get(c)
                if child is None:
                    child = below[c] = self._forward(word, end, path)
                    self.size += 1
                node = child
            path.append(node)
        return node.count

    def count(self, words: list[str]) -> int:
        """Tokens of a text given as its words, without their marks."""
        table = self.counts
        for w in set(words).difference(table):
            if len(w) > TRIE_DEPTH:
                continue
            if len(table) >= self.entries:
                table = self.counts = {}
                return self.count(words) if len(set(words)) < self.entries else sum(self.insert(MARK + x) for x in words)
            table[w] = self.insert(MARK + w)
        get = table.get
        total = 0
        for w in words:
            n = get(w)
            total += self.insert(MARK + w) if n is None else n
        return total


def zipf_scores(scores: dict[str, float]) -> dict[str, float]:
    """Log probabilities from ranks by Zipf's law: the piece of rank r has a chance in proportion to 1 / r."""
    order = sorted(scores, key=lambda p: (-scores[p], p))
    total = math.log(sum(1 / r for r in range(1, len(order) + 1)))
    return {p: -math.log(r) - total for r, p in enumerate(order, 1)}


def load_pieces(path: str) -> tuple[dict[str, float], bool]:
    """The ordinary pieces of a vocabulary file with log probabilities, and whether it falls back to bytes.

    A file whose scores are all whole numbers holds ranks, as pair encodings do; the ranks become log
    probabilities by ``zipf_scores``. Other scores are log probabilities already.
    """
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    ordinary = {sp.id_to_piece(k): sp.get_score(k) for k in range(n)
                if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))}
    if all(x == int(x) for x in ordinary.values()):
        ordinary = zipf_scores(ordinary)
    return ordinary, any(sp.is_byte(k) for k in range(n))


_TRIES: dict[str, UnigramTrie] = {}


def trie(path: str) -> UnigramTrie:
    if path not in _TRIES:
        _TRIES[path] = UnigramTrie(*load_pieces(path))
    return _TRIES[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = trie(path)
        gc.disable()  # tries and tables hold no cycles; walking them again and again would take longer than the work
        for b in batches:
            words, tokens = [], []
            for text in b.column("text").to_pylist():
                ws = text.split()
                words.append(len(ws))
                tokens.append(t.count(ws))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["doc_id", "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens for every row of ``docs``, without a shuffle.

    A null or empty text has no words and no tokens. Rows that repeat an id are counted each; an empty table
    gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_counted(path or vocabulary_path()), f"doc_id {kind}, n_words long, n_tokens long")
