"""Sentences, words and runs of words by Arrow's own functions, in tasks over batches of whole texts.

They give what ``text.sentences``, ``text.tokens`` and ``text.ngrams`` give, at about half their CPU time where every word
of a corpus becomes a row. Texts are taken in pieces of some PIECE_BYTES, so that a worker's memory is bounded; a null text
has no sentences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import MARK

#: Bytes of text that are taken apart at once, and rows of a batch that is given back.
PIECE_BYTES, BATCH_ROWS = 8 << 20, 65_536
_ENDS, _APART = "([.!?])[ \t\n\x0b\f\r]+", "[^a-z]+"


def pieces(batches, text: str) -> Iterator[pa.RecordBatch]:
    """Batches of some PIECE_BYTES of text, or of one row."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(b):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, "right")))
            yield b.slice(at, to - at)
            at = to


def laid_flat(text: pa.Array):
    """Words of texts: their (text's row, sentence's number in the text, sentence's number of all, word), in order, and the rows and numbers of all sentences."""
    sents = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(text), _ENDS, "\\1" + MARK), MARK)
    row = pc.list_parent_indices(sents).to_numpy(zero_copy_only=False)
    first = np.searchsorted(row, row)
    number = (np.arange(len(row)) - first).astype(np.int32)
    lists = pc.split_pattern_regex(sents.flatten(), _APART)
    words, sent = lists.flatten(), pc.list_parent_indices(lists)
    is_word = pc.not_equal(words, "")
    return words.filter(is_word), sent.filter(is_word).to_numpy(zero_copy_only=False), row, number


def runs(words: pa.Array, sent: np.ndarray, longest: int, joint: str = " ") -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Runs of 1 to ``longest`` words of a sentence, with the place of their first word."""
    at, grams = np.arange(len(words)), words
    yield grams, at
    for k in range(1, longest):
        on = (at + k < len(words)) & (sent[np.minimum(at + k, max(len(words) - 1, 0))] == sent[at]) if len(at) else np.zeros(0, bool)
        grams, at = grams.filter(pa.array(on)), at[on]
        grams = pc.binary_join_element_wise(grams, words.take(pa.array(at + k)), joint)
        yield grams, at


def sentence_grams(docs: DataFrame, text: str, *keys: str, longest: int) -> DataFrame:
    """(*keys, sent_idx, term): every word and run of up to ``longest`` words of each sentence, as often as it stands there."""
    rows = docs.select(*keys, text)
    schema = rows.select(*keys, F.lit(0).alias("sent_idx"), F.lit("").alias("term")).schema

    def run(batches):
        for b in pieces(batches, text):
            words, sent, row, number = laid_flat(b.column(text))
            for grams, at in runs(words, sent, longest):
                for k in range(0, len(at), BATCH_ROWS):
                    s = sent[at[k : k + BATCH_ROWS]]
                    own = pa.array(row[s])
                    yield pa.record_batch([b.column(c).take(own) for c in keys] + [pa.array(number[s]), grams.slice(k, BATCH_ROWS)], names=[*keys, "sent_idx", "term"])

    return rows.mapInArrow(run, schema)


def document_counts(docs: DataFrame, text: str, longest: int) -> DataFrame:
    """(term, n): rows of ``docs`` that have the word or run of up to ``longest`` words of a sentence; counted within a task's pieces first."""

    def run(batches):
        for b in pieces(batches, text):
            words, sent, row, _ = laid_flat(b.column(text))
            for grams, at in runs(words, sent, longest):
                coded = grams.dictionary_encode()
                size = max(1, len(coded.dictionary))
                each = pa.table({"k": row[sent[at]] * size + coded.indices.to_numpy()}).group_by("k").aggregate([])
                counts = np.bincount(each["k"].to_numpy() % size, minlength=len(coded.dictionary))
                yield from pa.table({"term": coded.dictionary, "n": counts}).to_batches(BATCH_ROWS)

    return docs.select(text).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
