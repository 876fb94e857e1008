"""Token counts under a unigram model, by dynamic programming over a trie of the distinct pre-tokens.

A pre-token is a word with the vocabulary's word-start mark in front.  Its count is the number of pieces in the
segmentation of the greatest total score; of equal totals that with fewer pieces counts.  A character that no piece
covers stands for its UTF-8 bytes, one piece each, at ``UNKNOWN`` below the worst score.

The distinct new pre-tokens of a batch are visited in the order of their trie (sorted), and the forward scores, one per
prefix, stay on a stack: a prefix shared with the word before is not computed again.  Counts at the words' ends are
kept in a bounded table that takes words until it is full and lives as long as the worker.  No shuffle is needed, and nothing but the counts is gathered.

Defined cases: null, empty and blank texts count 0 words and 0 tokens; words of any length are segmented whole (long
ones are not kept in the table); each input row gives one output row, with its id, null or repeated as it is; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches

UNKNOWN = 10.0
MARK = "▁"
TABLE_WORDS = 600_000
GROUP_CHARS = 1 << 20
LONG_WORD = 64


def load_pieces(model_path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece model, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


class UnigramCounter:
    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        self.counts: dict[bytes, int] = {}

    def extend(self, word: str, forward: list[tuple[float, int]], shared: int) -> None:
        """Forward scores of ``word`` beyond its first ``shared`` characters; ``forward[i]`` belongs to prefix i.

        A state is (score, -pieces), so that the greater state is the better one.
        """
        del forward[shared + 1 :]
        score_of = self.pieces.get
        for end in range(shared + 1, len(word) + 1):
            best = None
            for begin in range(max(0, end - self.longest), end):
                score = score_of(word[begin:end])
                if score is not None:
                    before = forward[begin]
                    state = (before[0] + score, before[1] - 1)
                    if best is None or state > best:
                        best = state
            if word[end - 1] not in self.pieces:
                before, n = forward[end - 1], len(word[end - 1].encode())
                state = (before[0] + n * self.unknown, before[1] - n)
                if best is None or state > best:
                    best = state
            forward.append(best)

    def count_new(self, new: list[bytes]) -> dict[bytes, int]:
        """Counts of distinct pre-tokens, sharing the forward scores of common prefixes."""
        found, forward, last = {}, [(0.0, 0)], ""
        for raw in sorted(new):
            word = MARK + raw.decode()
            shared, most = 0, min(len(word), len(last), len(forward) - 1)
            while shared < most and word[shared] == last[shared]:
                shared += 1
            self.extend(word, forward, shared)
            found[raw], last = -forward[-1][1], word
        return found

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(words, tokens) of each text; texts are taken in groups of bounded size."""
        counts, group, held = [], [], 0
        for text in texts:
            group.append((text or "").encode().split())
            held += len(text or "")
            if held > GROUP_CHARS:
                counts += self._count_group(group)
                group, held = [], 0
        return counts + self._count_group(group)

    def _count_group(self, group: list[list[bytes]]) -> list[tuple[int, int]]:
        known = self.counts
        found = self.count_new(list({w for tokens in group for w in tokens if w not in known}))
        if len(known) < TABLE_WORDS:
            known.update((w, n) for w, n in found.items() if len(w) <= LONG_WORD)
        return [(len(tokens), sum([known[w] if w in known else found[w] for w in tokens])) for tokens in group]


_COUNTERS: dict[str, UnigramCounter] = {}


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if model_path not in _COUNTERS:
            _COUNTERS[model_path] = UnigramCounter(load_pieces(model_path))
        counter = _COUNTERS[model_path]
        for batch in batches:
            counts = counter.count(batch["text"].tolist())
            frame = pd.DataFrame(counts, columns=["n_words", "n_tokens"])
            frame.insert(0, "doc_id", batch["doc_id"].where(~batch["no_id"]).astype("Int64").values)
            yield frame

    bound_batches(docs.sparkSession)
    key = F.col(id_col).cast("long")
    rows = docs.select(
        F.coalesce(key, F.lit(0).cast("long")).alias("doc_id"), key.isNull().alias("no_id"), F.col(text_col).alias("text")
    )
    return rows.mapInPandas(run, "doc_id long, n_words long, n_tokens long")
