"""Token counts of a unigram vocabulary: dynamic programming over a trie of the distinct pre-tokens.

A pre-token is a word between white space, with the mark of a word start before it. Its segmentation is the one whose
pieces have the highest sum of scores (the scores of the vocabulary file); among equals, the one of fewest pieces. Scores of a
byte-pair model are merge ranks, not log probabilities: with them, counts are no unigram model's, nor the library's. The forward
score of a prefix depends on its letters alone, so words that share a prefix share its scores: the distinct words of a slice of texts are
visited in order, which walks their trie depth first, and each node is scored once. Terminal counts are remembered.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame, types as T

from logsonde.llm.common import map_texts

WORD_START = "▁"

#: Words remembered by one worker; the memory is emptied when full: this bounds its size, not its results.
REMEMBERED_WORDS = 1 << 19


class Unigram:
    """Counts of pieces of the best segmentation. `scores` maps pieces to scores; a letter in no piece is its UTF-8 bytes."""

    def __init__(self, scores: dict[str, float]):
        self.ends: dict = {}  # the pieces, read from their last letter; None holds a score
        for piece, score in scores.items():
            node = self.ends
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[None] = score
        self.byte = min(scores.values(), default=0.0) - 1
        self.memory: dict[str, int] = {}

    def count(self, words: Iterable[str]) -> None:
        """Remembers the number of pieces of each word."""
        best = [(0.0, 0)]  # of each prefix of the word at hand: score, minus the number of pieces
        last = ""
        ends, byte, memory = self.ends, self.byte, self.memory
        for word in sorted(words):
            spelled = WORD_START + word
            shared = 0
            for a, b in zip(spelled, last):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :]
            for j in range(shared, len(spelled)):
                n = len(spelled[j].encode("utf-8", "surrogatepass"))
                score, pieces = best[j]
                top = (score + byte * n, pieces - n)
                node, i = ends, j
                while i >= 0:
                    node = node.get(spelled[i])
                    if node is None:
                        break
                    own = node.get(None)
                    if own is not None:
                        score, pieces = best[i]
                        here = (score + own, pieces - 1)
                        if here > top:
                            top = here
                    i -= 1
                best.append(top)
            memory[word] = -best[-1][1]
            last = spelled

    def totals(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Words and pieces of each text; null has none."""
        split = [t.split() if t else [] for t in texts]
        if len(self.memory) > REMEMBERED_WORDS:
            self.memory.clear()
        self.count(set().union(*split).difference(self.memory))
        get = self.memory.__getitem__
        return [len(ws) for ws in split], [sum(map(get, ws)) for ws in split]


def vocabulary_scores(path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece model, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    return Unigram(vocabulary_scores(path))


COUNTED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of `docs` (doc_id, text), by the unigram scores of a sentencepiece model.

    A null or empty text has none; rows that repeat and null ids stay; an empty table gives no rows; other columns are not read.
    Texts are counted whole, whatever their length; no shuffle.
    """

    def task():
        counter = unigram(model)
        return lambda texts: list(counter.totals(texts))

    return map_texts(docs.select("doc_id", "text"), task, COUNTED, ["doc_id"])
