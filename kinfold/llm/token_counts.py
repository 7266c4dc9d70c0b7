"""Unigram token counts by dynamic programming over a trie (operator 9).

A text is cut into pre-tokens, each a run of spaces and what follows up to the next space. The distinct pre-tokens are inserted in a
trie; every node holds the forward scores of its prefix (best log probability and token count), which are computed once
when the node is made and so once per shared prefix. The terminal count of a pre-token is stored and looked up for every further occurrence.

The vocabulary file ranks its pieces and has no probabilities. The pieces get those of Zipf's law over the ranks, so they are one distribution, a path of
fewer pieces wins over a chain of letters, and nothing is trained.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Trie nodes and stored pre-tokens of a task; beyond it both start anew, which costs time only.
STORE = 1_000_000
#: Log probability of a byte of a character that no piece covers, below that of the rarest piece.
BYTE_PENALTY = 10.0

_CUT = re.compile(f"{SPACE}+[^{SPACE}]*")


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Log probability by normal piece of a sentencepiece model: the piece of rank r (1, 2, ... by falling score) has 1 / r of the
    whole, which is the sum over all ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    plain.sort(key=lambda i: (-model.get_score(i), i))
    whole = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
    return {model.id_to_piece(i): -math.log(r) - whole for r, i in enumerate(plain, 1)}


def pretokens(text: str) -> list[str]:
    """The text with a space before it, its spaces as marks, cut before each run of marks."""
    marked = SPACE + text.replace(" ", SPACE)
    if SPACE * 2 in marked:
        return _CUT.findall(marked)
    return [SPACE + x for x in marked[1:].split(SPACE)]


class Trie:
    """Prefixes of pre-tokens: the children by (node, character), and the forward scores of every node.

    The best path has the highest log probability; a tie goes to fewer tokens. A character that no piece covers costs its UTF-8 bytes as tokens.
    """

    def __init__(self, pieces: dict[str, float]):
        self.floor = min(pieces.values(), default=0.0) - BYTE_PENALTY
        self.backward: dict = {}  # the pieces as a trie of their last characters; "" has the log probability of one that begins here
        for p, own in pieces.items():
            at = self.backward
            for c in reversed(p):
                at = at.setdefault(c, {})
            at[""] = own
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}  # by node and code point, in one number
        self.score, self.tokens = array("d", [0.0]), array("q", [0])  # of the prefix that ends at each node

    def insert(self, word: str) -> int:
        """Tokens of `word`; only the nodes that no word before it has made are scored."""
        child, score, tokens = self.child, self.score, self.tokens
        path, node = [0], 0
        for end, c in enumerate(word):
            key = node << 21 | ord(c)
            known = child.get(key)
            if known is None:
                at = self.backward.get(c)
                own = at and at.get("")
                if own is not None:
                    best, few = score[node] + own, tokens[node] + 1
                else:
                    size = len(c.encode("utf-8", "surrogatepass"))
                    best, few = score[node] + size * self.floor, tokens[node] + size
                start = end
                while at and start:
                    start -= 1
                    at = at.get(word[start])
                    if at and "" in at:
                        before = path[start]
                        now = score[before] + at[""]
                        if now > best or now == best and tokens[before] < few:
                            best, few = now, tokens[before] + 1
                known = child[key] = len(score)
                score.append(best)
                tokens.append(few)
            node = known
            path.append(node)
        return tokens[node]


class Counter:
    """Token counts of texts; the terminal counts of all pre-tokens met so far are stored."""

    def __init__(self, pieces: dict[str, float]):
        self.trie = Trie(pieces)
        self.store: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        """The sum over the pre-tokens; none for null and empty."""
        if not text:
            return 0
        words = pretokens(text)
        counts = list(map(self.store.get, words))
        if None in counts:
            for i, n in enumerate(counts):
                if n is None:
                    counts[i] = self._new(words[i])
        return sum(counts)

    def _new(self, word: str) -> int:
        n = self.store.get(word)
        if n is None:
            if len(self.trie.score) > STORE:
                self.trie.clear()
                self.store.clear()
            n = self.store[word] = self.trie.insert(word)
        return n


def token_counts(docs: DataFrame, pieces: dict[str, float]) -> DataFrame:
    """(doc_id, n_tokens) of every row of `docs` (doc_id, text); the pieces are broadcast, their number is the vocabulary's.

    A null or empty text has none. Repeated rows are counted each, a null doc_id is returned as it is, extra columns are ignored. Ties
    between paths go to fewer tokens. No text is cut short: a pre-token of any length is one path of the trie.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(shared.value)
        for df in batches:
            yield pd.DataFrame({"doc_id": df["doc_id"], "n_tokens": [counter.count(t) for t in df["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(count, f"doc_id {kind}, n_tokens bigint")


def query(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), load_pieces(vocabulary))
