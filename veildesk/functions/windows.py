"""Cut texts into windows a token classifier can read."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens per window without the two boundary tokens, sentence ends, spaces.
# An underscore separates words like a space does.
WINDOW_TOKENS = 254
SENTENCE_END = ".!?:;"
_SPACES = (
    "_\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

Tokenizer = Callable[[str], list[int]]  # a word -> the lengths of its pieces


def one_token(word: str) -> list[int]:
    return [len(word)]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _is_one_of(codes: np.ndarray, chars: str) -> np.ndarray:
    return np.isin(codes, _codes(chars), kind="sort")


def token_table(text: str, pieces: Tokenizer = one_token) -> np.ndarray:
    """Rows (start, end, word number) of every token."""
    space = np.concatenate(([True], _is_one_of(_codes(text), _SPACES), [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    words = np.arange(len(starts))
    if pieces is not one_token:
        lengths = [pieces(text[s:e]) for s, e in zip(starts, ends)]
        words = np.repeat(words, [len(n) for n in lengths])
        bounds = [s + np.cumsum([0, *n]) for s, n in zip(starts, lengths)]
        starts = np.concatenate([b[:-1] for b in bounds]) if bounds else starts
        ends = np.concatenate([b[1:] for b in bounds]) if bounds else ends
    return np.stack((starts, ends, words), axis=1).astype(np.int64)


def window_bounds(tokens: np.ndarray, text: str, size: int = WINDOW_TOKENS) -> list[tuple[int, int]]:
    """Token ranges: after a sentence end in the second half, else at a word, else full."""
    n = len(tokens)
    # Token i can open a window if token i - 1 ends a word; better if it ends a sentence.
    words = np.flatnonzero(tokens[1:, 2] != tokens[:-1, 2]) + 1
    last_chars = _codes(text)[tokens[words - 1, 1] - 1]
    stops = words[_is_one_of(last_chars, SENTENCE_END)]
    bounds, low = [], 0
    while low < n:
        high = min(low + size, n)
        if high < n:
            for cuts, floor in ((stops, low + size // 2), (words, low)):
                i = np.searchsorted(cuts, high, side="right") - 1
                if i >= 0 and cuts[i] > floor:
                    high = int(cuts[i])
                    break
        bounds.append((low, high))
        low = high
    return bounds


def chunk_windows(text: Column, pieces: Tokenizer = one_token, size: int = WINDOW_TOKENS) -> Column:
    """``array<struct<start,end,n_tokens>>`` of each text, by an Arrow function."""

    @F.pandas_udf("array<struct<start:int,end:int,n_tokens:int>>")
    def cut(texts: pd.Series) -> pd.Series:
        def windows(text):
            if text is None:
                return None
            tokens = token_table(text, pieces)
            return [
                {"start": int(tokens[a, 0]), "end": int(tokens[b - 1, 1]), "n_tokens": b - a}
                for a, b in window_bounds(tokens, text, size)
            ]

        return texts.map(windows)

    return cut(text)
