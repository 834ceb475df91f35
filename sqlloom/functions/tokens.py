"""Tokenizers for supervision tables.

The built-in one is a pure column expression. A trained one plugs in as an
Arrow-batched pandas UDF through ``plugged``.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

from sqlloom.functions.text import WS, text_or_empty

# Ship the functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"

PIECE = (
    r"<\|im_start\|>|<\|im_end\|>|\p{L}++|\p{N}++|[^\p{L}\p{N}" + WS.strip("[]") + r"]"
)

Encoder = Callable[[Column, int], Column]


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(text), F.lit(PIECE), F.lit(0))


def piece_id(piece: Column) -> Column:
    """28 bits of a hash, shifted by one so that 0 stays free for padding."""
    return F.conv(F.substring(F.md5(piece), 1, 7), 16, 10).cast("int") + F.lit(1)


def hashed(text: Column, max_length: int | None = None) -> Column:
    """Built-in encoder: token ids of the first max_length pieces, of all without a limit."""
    found = pieces(text)
    return F.transform(found if max_length is None else F.slice(found, 1, max_length), piece_id)


#: PIECE on ASCII texts.
ASCII_PIECE = r"<\|im_start\|>|<\|im_end\|>|[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x09-\x0d\x1c-\x20]"


#: Pieces a task remembers at once.
REMEMBERED = 2**17


def _ascii_ids(max_length: int) -> Callable[[Column], Column]:
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = re.compile(ASCII_PIECE).findall
        known: dict[str, int] = {}

        def ids(text: str) -> list[int]:
            pieces = found(text)[:max_length]
            for piece in pieces:
                if piece not in known:
                    known[piece] = int(hashlib.md5(piece.encode("ascii")).hexdigest()[:7], 16) + 1
            return [known[piece] for piece in pieces]

        for batch in batches:
            if len(known) > REMEMBERED:
                known.clear()
            yield pd.Series([None if text is None else ids(text) for text in batch], dtype="object")

    return encode


def limited_ids(text: Column, max_length: int) -> Column:
    """hashed() of the first max_length pieces. ASCII texts, whose pieces repeat a lot, are cut in
    Arrow batches with the ids of pieces remembered; others by the column expression."""
    ascii_text = F.octet_length(text) == F.length(text)
    quick = _ascii_ids(max_length)(F.when(ascii_text, text))
    return F.when(ascii_text, quick).otherwise(hashed(text, max_length))


def plugged(make_encoder: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Encoder:
    """Encoder around a trained tokenizer. make_encoder runs once per task and gives a
    function from a batch of texts to their ids."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for batch in batches:
            yield pd.Series(encoder(batch.fillna("").tolist()))

    return lambda text, max_length: F.slice(encode(text), 1, max_length)
