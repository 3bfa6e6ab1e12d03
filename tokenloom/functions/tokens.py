"""Text to token ids.

The built-in tokenizer hashes whitespace-separated words into ``vocab_size`` ids and runs
entirely inside Spark. Any other tokenizer plugs in through :func:`external_tokenizer`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from tokenloom.functions.hashing import hex_prefix_number

TOKENS = T.ArrayType(T.IntegerType())

# Fixed value: vocabularies below this size fit two bytes per id.
TWO_BYTE_VOCAB = 65536


@dataclass(frozen=True)
class HashTokenizer:
    """Words to ids by md5; the two ids after the vocabulary are EOS and BOS."""

    vocab_size: int = 50000
    add_bos: bool = False
    add_eos: bool = True
    max_len: int | None = None

    @property
    def eos_id(self) -> int:
        return self.vocab_size

    @property
    def bos_id(self) -> int:
        return self.vocab_size + 1

    @property
    def id_count(self) -> int:
        return self.vocab_size + 2

    def ids(self, text: Column) -> Column:
        """Token ids, truncated first and then given their BOS/EOS."""
        ids = F.transform(
            words(text),
            lambda w: (hex_prefix_number(F.md5(w), 8) % self.vocab_size).cast("int"),
        )
        if self.max_len is not None:
            ids = truncate(ids, self.max_len)
        return add_specials(
            ids,
            bos_id=self.bos_id if self.add_bos else None,
            eos_id=self.eos_id if self.add_eos else None,
        )

    def count(self, text: Column) -> Column:
        """``size(ids(text))`` without hashing a word."""
        n = word_count(text)
        if self.max_len is not None:
            n = F.least(n, F.lit(self.max_len))
        return (n + F.lit(int(self.add_bos) + int(self.add_eos))).cast("bigint")


def words(text: Column) -> Column:
    """Pieces between blanks and newlines, never empty ones.

    Splitting at a single literal character needs no regular expression.
    """
    return F.array_remove(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def truncate(ids: Column, max_len: int) -> Column:
    return F.slice(ids, 1, max_len)


def add_specials(ids: Column, bos_id: int | None = None, eos_id: int | None = None) -> Column:
    """Prepend BOS and append EOS; a tokenizer without the id leaves that end alone."""
    parts = [ids]
    if bos_id is not None:
        parts.insert(0, F.array(F.lit(bos_id).cast("int")))
    if eos_id is not None:
        parts.append(F.array(F.lit(eos_id).cast("int")))
    return F.concat(*parts) if len(parts) > 1 else ids


def num_tokens(ids: Column) -> Column:
    return F.size(ids).cast("bigint")


def token_width(vocab_size: Column) -> Column:
    """Bytes per stored id."""
    return F.when(vocab_size < TWO_BYTE_VOCAB, F.lit(2)).otherwise(F.lit(4))


def check_ids(ids: Column, vocab_size: int) -> Column:
    """``ids`` unchanged, or an error naming the first id outside the vocabulary."""
    low, high = F.array_min(ids), F.array_max(ids)
    bad = F.when(high >= vocab_size, high).when(low < 0, low)
    message = F.concat(F.lit("token id "), bad.cast("string"), F.lit(f" outside vocabulary of {vocab_size}"))
    return F.when(bad.isNotNull(), F.raise_error(message).cast(TOKENS)).otherwise(ids)


def external_tokenizer(load: Callable[[], Callable[[list[str]], list[list[int]]]], batch_size: int = 1024):
    """A column function text -> ids around any tokenizer library.

    ``load`` runs once per task on the executor and returns a batch encoder; only the text
    column crosses to Python, ``batch_size`` rows per encoder call.
    """

    @F.pandas_udf(TOKENS)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for texts in batches:
            rows: list[list[int]] = []
            values = texts.tolist()
            for start in range(0, len(values), batch_size):
                rows.extend(encoder(values[start : start + batch_size]))
            yield pd.Series(rows, index=texts.index, dtype=object)

    return encode


def tokenizer_json(settings: str) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """Loader for the text of a ``tokenizer.json``, which travels to the executors with the job."""

    def load():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(settings)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return load
