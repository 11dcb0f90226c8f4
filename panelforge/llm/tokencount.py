"""Greedy word-piece lengths of texts by a linear longest-match automaton.

The vocabulary becomes a trie.  Every node carries a failure link and the number of
pieces popped when it is taken, both computed once in breadth-first order, so a word's
length is read off in one pass over its characters without building pieces or going back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import share, tidy

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_START = "▁"
#: Words whose lengths a task remembers; the memory is emptied when full.
REMEMBERED = 1 << 18
SLICE_CHARS = 1 << 20


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """The ordinary pieces of a SentencePiece model file; control, unknown and byte pieces are left out."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class LongestMatch:
    """Trie with failure links and popped-piece counts over ``WORD_START`` + word."""

    def __init__(self, pieces: list[str]):
        step: dict[tuple[int, str], int] = {}
        final, parent, letter, depth = [False], [0], [""], [0]
        for piece in pieces:
            at = 0
            for c in piece:
                to = step.get((at, c))
                if to is None:
                    to = len(final)
                    step[at, c] = to
                    final.append(False)
                    parent.append(at)
                    letter.append(c)
                    depth.append(depth[at] + 1)
                at = to
            final[at] = at > 0
        fail, pops = [-1] * len(final), [0] * len(final)
        for v in sorted(range(1, len(final)), key=depth.__getitem__):
            if final[v]:
                fail[v], pops[v] = 0, 1
                continue
            z, count = fail[parent[v]], pops[parent[v]]
            while z >= 0 and (z, letter[v]) not in step:
                z, count = fail[z], count + pops[z]
            if z >= 0:
                fail[v], pops[v] = step[z, letter[v]], count
        self.step, self.fail, self.pops = step, fail, pops

    def length(self, word: str) -> int:
        """Pieces of the word, or -1 if greedy matching gets stuck."""
        step, fail, pops = self.step, self.fail, self.pops
        at, count = 0, 0
        for c in WORD_START + word:
            to = step.get((at, c))
            while to is None:
                if fail[at] < 0:
                    return -1
                count += pops[at]
                at = fail[at]
                to = step.get((at, c))
            at = to
        while at:
            if fail[at] < 0:
                return -1
            count += pops[at]
            at = fail[at]
        return count


class _Lengths(dict):
    """Word -> pieces + unknown words * 2^40, remembered up to a bound."""

    def __init__(self, automaton: LongestMatch, bound: int):
        super().__init__()
        self.automaton, self.bound = automaton, bound

    def __missing__(self, word: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        n = self.automaton.length(word)
        n = n if n >= 0 else 1 + (1 << 40)
        if len(word) <= 64:
            self[word] = n
        return n


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """The text in slices of about ``size`` characters, cut at white space."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def count_tokens(docs: DataFrame, pieces: list[str]) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every row.

    Words are runs without white space; each is matched as ``WORD_START`` + word, always
    taking the longest piece.  A word that greedy matching cannot finish counts as one
    unknown token.  Null, empty and blank texts count 0; null and repeated doc_ids and
    other columns make no difference.  The automaton is broadcast; its size is the vocabulary's.
    """
    shared = share(docs.sparkSession, LongestMatch(pieces))

    def run(batches):
        lengths = _Lengths(shared(), REMEMBERED)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column("text"):
                n = total = 0
                for part in slices(text.as_py() or ""):
                    own = part.split()
                    n += len(own)
                    total += sum(map(lengths.__getitem__, own))
                words.append(n)
                tokens.append(total & ((1 << 40) - 1))
                unknown.append(total >> 40)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_words long, n_tokens long, n_unknown long")
