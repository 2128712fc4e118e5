"""Unigram token counts by dynamic programming over a trie of distinct pre-tokens."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, units

#: Characters of a pre-token whose trie nodes wait for the next one; what lies deeper is made and left at once.
DEPTH = 4096

#: The mark that stands for a space before a pre-token.
MARK = "▁"

#: Penalty of an unknown character below the lowest score of the vocabulary.
UNKNOWN_PENALTY = 10.0


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The normal pieces and their scores of a sentencepiece vocabulary file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]


class PrefixTrie:
    """Pre-tokens as a trie whose nodes hold the best segmentation of the path to them.

    The forward score of a prefix depends on that prefix only, so it is computed
    once, when its node is made, and shared by every pre-token that begins so.
    Pre-tokens are inserted in order, which makes every node once and lets a
    branch go when the next pre-token leaves it: what is held is the path to the
    pre-token at hand, at most DEPTH nodes of it, whatever the number and length
    of the pre-tokens.  The end of each pre-token, its terminal, gives its count.

    A node is the best score, the tokens of the best segmentation and whether
    that ends in an unknown character.  Of equal scores the longest last piece
    wins.  A run of unknown characters is one token.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.scores: dict[str, float] = {}
        for piece, score in pieces:
            self.scores.setdefault(piece, score)
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        #: The score of every piece, and None for what only ends one.
        self.endings: dict[str, float | None] = {p[k:]: None for p in self.scores for k in range(1, len(p))}
        self.endings.update(self.scores)
        self.clear()

    def clear(self) -> None:
        self.word, self.best, self.tokens, self.open = "", [0.0], [0], [False]

    def insert(self, word: str) -> int:
        """The tokens of word, for which the nodes below its common beginning with the word before are made."""
        last, shared = self.word, 0
        for a, b in zip(word, last):  # noqa: B905
            if a != b:
                break
            shared += 1
        best, tokens, unknown = self.best, self.tokens, self.open
        del best[shared + 1 :], tokens[shared + 1 :], unknown[shared + 1 :]
        endings, gone, wide = self.endings, 0, self.longest + DEPTH
        for end in range(shared + 1, len(word) + 1):
            top = None
            for start in range(end - 1, -1, -1):
                piece = word[start:end]
                if piece not in endings:
                    break
                score = endings[piece]
                if score is not None:
                    total = best[start - gone] + score
                    if top is None or total >= top:
                        top, count = total, tokens[start - gone] + 1
            lost = False
            if word[end - 1] not in self.scores:
                total = best[-1] + self.unknown
                if top is None or total > top:
                    top, count, lost = total, tokens[-1] + (not unknown[-1]), True
            best.append(top)
            tokens.append(count)
            unknown.append(lost)
            if len(best) > 2 * wide:
                del best[:-wide], tokens[:-wide], unknown[:-wide]
                gone = end + 1 - wide
        found = tokens[-1]
        if gone:
            self.clear()
        else:
            self.word = word[:DEPTH]
            del best[DEPTH + 1 :], tokens[DEPTH + 1 :], unknown[DEPTH + 1 :]
        return found

    def counts(self, words: list[str]) -> np.ndarray:
        """The tokens of each of the distinct pre-tokens, every one with the mark before it; an empty one has none."""
        out = np.zeros(len(words), np.int64)
        for k in sorted(range(len(words)), key=words.__getitem__):
            if words[k]:
                out[k] = self.insert(MARK + words[k])
        return out


def counted(trie: PrefixTrie, texts: pa.Array) -> np.ndarray:
    """The tokens of each whole text: its pre-tokens, as white space parts them, have the counts of their terminals."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten().dictionary_encode()
    sums = np.concatenate([[0], np.cumsum(trie.counts(words.dictionary.to_pylist())[words.indices.to_numpy()])])
    ends = np.cumsum(lists.value_lengths().to_numpy())
    return np.diff(sums[np.concatenate([[0], ends])])


def token_counts(documents: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and n_tokens: the pieces of the best unigram segmentation of every whole text.

    The vocabulary file's pieces and scores make the unigram model (nothing is
    trained): a segmentation's score is the sum of its pieces' scores as the
    file has them.  In a vocabulary of merges these are places in the order of
    the merges, not log probabilities.

    Text is split at white space.  The distinct pre-tokens of some megabytes of
    text at a time go through the trie, and texts add up their terminals'
    counts, so nothing is shuffled.  A pre-token of any length is segmented
    whole, in memory that doesn't grow with it.

    Null, empty and blank texts have no tokens; repeated rows are counted each;
    a null id stays null; an empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    held = documents.sparkSession.sparkContext.broadcast(read_pieces(path))  # of the size of the vocabulary

    def scan(batches):
        trie = PrefixTrie(held.value)
        for unit in units(batches, "text"):
            unit = unit.combine_chunks()
            trie.clear()
            yield from pa.table([unit.column("doc_id"), pa.array(counted(trie, unit.column("text").chunk(0)), pa.int64())], names=["doc_id", "n_tokens"]).to_batches()

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(scan, "doc_id long, n_tokens long")


def op6_trie_token_counts(spark, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document, by the pieces of a public vocabulary."""
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
