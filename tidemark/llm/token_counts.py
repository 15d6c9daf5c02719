"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary's pieces in a text; dynamic programming carries, for each position, the
best score and its number of pieces, never the pieces. Ties follow the tokenizer: of equal scores the piece that starts first
wins, and an unknown character (smallest score less 10) only wins strictly; it counts as its UTF-8 bytes where the vocabulary
falls back to bytes, else a run of them counts as one piece.

A text is cut where no piece can reach across: before a space mark that follows another character, and at control characters
no piece holds. The best path of the whole is the best paths of the parts, so parts are counted once and remembered, up to a
bound. Sums of scores are exact (double precision within a part).

Defined results: null and empty texts have 0 tokens; texts are read whole; repeated rows are counted alike; an empty table
gives no rows; the counts replace a column of the same name. The vocabulary is read once, on the driver, and sent out; its
size is that of the file. Workers that are used again know it by a digest of all that counts depend on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000


class UnigramVocabulary:
    """Pieces with scores, as plain values that can be sent to the executors."""

    def __init__(self, scores: dict[str, float], byte_fallback: bool, dummy_prefix: bool = True) -> None:
        self.scores, self.byte_fallback, self.dummy_prefix = scores, byte_fallback, dummy_prefix

    @classmethod
    def load(cls, path: str) -> UnigramVocabulary:
        """The normal pieces of a sentencepiece model file, whose stored scores are read as unigram scores."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = model.normalize("AéＡ  x ")
        if probe.removeprefix(SPACE) != f"AéＡ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("only vocabularies without text normalisation are supported")
        ids = range(model.get_piece_size())
        normal = {model.id_to_piece(i): model.get_score(i) for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))}
        return cls(normal, any(model.is_byte(i) for i in ids), probe.startswith(SPACE))

    def digest(self) -> str:
        """Names the vocabulary by its content."""
        return hashlib.sha256(repr((sorted(self.scores.items()), self.byte_fallback, self.dummy_prefix)).encode("utf-8", "surrogatepass")).hexdigest()

    def counter(self) -> Callable[[str | None], int]:
        """text -> number of tokens, for one worker."""
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            automaton.add_word(piece, (len(piece), score))
        automaton.make_automaton()
        unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        held = set("".join(self.scores))
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.scores)
        apart = "".join(c for c in map(chr, range(32)) if c not in held)
        cut = re.compile(f"{SPACE}+[^{SPACE}{re.escape(apart)}]*|[^{SPACE}{re.escape(apart)}]+|[{re.escape(apart)}]+") if not crossing else None
        known: dict[str, tuple[int, bool, bool]] = {}
        single = {p for p in self.scores if len(p) == 1}
        fallback = self.byte_fallback

        def part(text: str) -> tuple[int, bool, bool]:
            """Pieces of one part; whether it begins and ends with an unknown character."""
            n = len(text)
            best: list[float] = [0.0] * (n + 1)
            count, ends = [0] * (n + 1), [-1] * (n + 1)  # ends: where the last piece starts
            lost = [False] * (n + 1)
            done = 0

            def fill(upto: int) -> None:
                # Positions that no match ended at are reached by an unknown character alone.
                nonlocal done
                while done < upto:
                    done += 1
                    if text[done - 1] not in single:
                        score = best[done - 1] + unknown
                        if ends[done] < 0 or score > best[done]:
                            more = len(text[done - 1].encode("utf-8", "replace")) if fallback else int(not lost[done - 1])
                            best[done], count[done], ends[done], lost[done] = score, count[done - 1] + more, done - 1, True

            for last, (size, score) in automaton.iter(text):
                end, start = last + 1, last + 1 - size
                fill(last)
                total = best[start] + score
                if ends[end] < 0 or total > best[end]:
                    best[end], count[end], ends[end], lost[end] = total, count[start] + 1, start, False
            fill(n)
            if fallback or not n:
                return count[n], False, False
            at = n
            while ends[at] > 0:
                at = ends[at]
            return count[n], lost[at], lost[n]

        def tokens(text: str | None) -> int:
            if not text:
                return 0
            text = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
            total, open_run = 0, False
            for p in cut.findall(text) if cut else [text]:
                found = known.get(p)
                if found is None:
                    found = part(p)
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[p] = found
                n, begins, ends = found
                total += n - (open_run and begins)
                open_run = ends
            return total

        return tokens


_COUNTERS: dict[str, Callable[[str | None], int]] = {}


def count_tokens(documents: DataFrame, vocabulary: UnigramVocabulary, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """documents with the number of tokens of each whole text. No shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    key = vocabulary.digest()

    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _COUNTERS:  # workers that are used again keep their automaton
            _COUNTERS.clear()
            _COUNTERS[key] = shared.value.counter()
        for texts in batches:
            yield texts.map(_COUNTERS[key], na_action=None).astype("int64")

    return documents.withColumn(out, F.pandas_udf(counts, "long")(F.col(text)))
