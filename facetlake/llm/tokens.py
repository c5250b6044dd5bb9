"""Token counts of whole texts with a public tokenizer.

Texts are cut at white space, where no token of the tokenizer can run across, so
that a long text is many short pieces. Each distinct piece is encoded once for a
worker's memory; pieces go to the tokenizer in batches of about equal bytes, and
only lengths come back.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from facetlake.llm.shared import text_columns

#: Bytes of a batch for the tokenizer, and pieces whose counts a worker remembers.
BATCH_BYTES, REMEMBERED = 1 << 18, 1_000_000


#: In a long text of a byte-level tokenizer, the space between two letters starts a token.
BETWEEN_LETTERS = re.compile(r"(?<=[^\W\d_])(?= [^\W\d_])")
#: White space to str.split() but not to the tokenizers.
ODD_SPACES, SPLIT = re.compile("[\x1c-\x1f]"), re.compile("[^ \t\n\r\x0b\x0c]+")


def cut(text: str, at: int) -> list[str]:
    """Parts of about `at` characters of a text for a byte-level tokenizer, cut only before a space between letters."""
    parts, start = [], 0
    while len(text) - start > at and (m := BETWEEN_LETTERS.search(text, start + at)):
        parts.append(text[start : m.start()])
        start = m.start()
    return [*parts, text[start:]]


def balanced(texts: list[str], size: int = BATCH_BYTES) -> Iterator[list[str]]:
    """The texts in batches of about `size` bytes."""
    batch: list[str] = []
    held = 0
    for text in texts:
        batch.append(text)
        held += len(text) if text.isascii() else len(text.encode())
        if held >= size:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


class Counter:
    """Counts tokens of texts; keeps the counts of pieces that it has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            a, b, both = self.encode(["a", "b", " \n a  b "])
            #: Whether the tokenizer drops white space, so that counts of pieces between it add up.
            self.drops = a + b == both
            self.parts = lambda text: cut(text, BATCH_BYTES)
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.drops = False
            self.parts = lambda text: [text]
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        return [n for batch in balanced(texts, 16 * BATCH_BYTES) for n in (self._pieces(batch) if self.drops else self._texts(batch))]

    def _pieces(self, texts: list[str]) -> list[int]:
        pieces = [SPLIT.findall(x) if ODD_SPACES.search(x) else x.split() for x in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for batch in balanced([p for p in set().union(*pieces) if p not in self.known]):
            self.known.update(zip(batch, self.encode(batch), strict=True))
        return [sum(map(self.known.__getitem__, words)) for words in pieces]

    def _texts(self, texts: list[str]) -> list[int]:
        parts = [self.parts(x) for x in texts]
        n = iter([n for batch in balanced([p for x in parts for p in x]) for n in self.encode(batch)])
        return [sum(next(n) for _ in x) for x in parts]


@lru_cache(4)
def counter(path: str) -> Counter:
    """The worker's own counter; it outlives a task."""
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    Nulls: a null text counts as an empty one, with no token; a null doc_id stays null. A long text is cut where no
    token can run across, and counted whole; nothing depends on order, so there are no ties.
    Repeated rows each give a row; other columns are ignored; an empty table gives an empty one.
    """
    import public_tokenizers

    path = public_tokenizers.path(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = counter(path).counts([x or "" for x in batch.column(1).to_pylist()])
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return text_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
