"""Token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each character; dynamic
programming carries the best score and its number of pieces. Rules of ties are the tokenizer's: of
paths with equal scores to a place, the one whose last piece begins earliest stays; a character that
no piece of one character matches costs 10 less than the lowest score and counts one piece per UTF-8
byte. A text is cut before every space (shown as U+2581), and one stands before its first word, as
the Metaspace rule has it, so units are independent; each distinct unit of a step is solved once.

Scores are summed as doubles per unit and then over a text. No unigram model is at hand, so the query
takes pieces and scores of a public BPE vocabulary as unigram scores.

Defined results: null and empty texts have no pieces and score 0; repeated rows count alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common, words

MARK, UNKNOWN_PENALTY, STEP_BYTES = "▁", 10.0, 2 << 20


def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece model, in order of ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class ViterbiCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.pool = words.SlicePool(np.float64)

    def unit(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best path through text."""
        n = len(text)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        at, found = 0, False  # at: characters settled so far
        single = False

        def settle(end: int) -> None:
            """Without a piece of one character, the unknown character competes last."""
            nonlocal found, single
            if not single:
                other = best[end - 1] + self.unknown
                if not found or other > best[end]:
                    best[end], count[end] = other, count[end - 1] + len(text[end - 1].encode())
            found = single = False

        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            while at < end - 1:
                at += 1
                settle(at)
            begin = end - length
            total = best[begin] + score
            if not found or total > best[end]:  # longer pieces come first, so ties stay with the earlier start
                best[end], count[end], found = total, count[begin] + 1, True
            single = single or length == 1
        while at < n:
            at += 1
            settle(at)
        return count[n], best[n]

    def texts(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and score of each text."""
        n_pieces, scores = np.zeros(len(batch), np.int64), np.zeros(len(batch))
        filled = [k for k, t in enumerate(batch) if t]
        if not filled:
            return n_pieces, scores
        shown = [batch[k].replace(MARK, " ") for k in filled]
        encoded = [(t[1:] if t[0] == " " else t).encode() for t in shown]
        data = np.frombuffer(b"".join(encoded), np.uint8)
        offsets = np.r_[0, np.cumsum([len(x) for x in encoded])].astype(np.int64)
        space = np.flatnonzero(data == 0x20)
        starts, ends = np.sort(np.r_[offsets[:-1], space + 1]), np.sort(np.r_[space, offsets[1:]])
        n_units = 1 + np.searchsorted(space, offsets[1:]) - np.searchsorted(space, offsets[:-1])
        raw = data.tobytes()

        def make(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            values = [self.unit(MARK + raw[a:b].decode()) for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            return np.array(values, np.float64).reshape(-1), np.full(len(values), 2, np.int64)

        begin, _ = self.pool.look_up(data, starts, ends, make)
        first = np.r_[0, np.cumsum(n_units)][:-1]
        n_pieces[filled] = np.add.reduceat(self.pool.pool[begin], first).astype(np.int64)
        scores[filled] = np.add.reduceat(self.pool.pool[begin + 1], first)
        return n_pieces, scores


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ViterbiCounter(read_pieces(path))
        for batch in batches:
            _, offsets = common.utf8(batch.column("text"))
            for i, j in common.chunks(offsets, STEP_BYTES):
                n, score = counter.texts([x or "" for x in batch.column("text").slice(i, j - i).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(n), pa.array(score)], ["doc_id", "n_tokens", "best_score"])

    return run


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_tokens, best_score."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_counter(vocabulary_path), "doc_id long, n_tokens long, best_score double")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(common.read_documents(spark, sf_dir), default_vocabulary())
