"""Token counts of a text's sections, from one encoding of the whole text.

Encoding sections apart gives other tokens than the text has. So a text is encoded once, the character span of each token is taken from the
lengths of the tokens' bytes, and the sorted spans of tokens and sections are joined. A token that crosses a border belongs to the
section that holds most of its characters; of equal shares, the first.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped

_encodings: dict = {}


def _encoding(path: str, pattern: str):
    """The encoding of a rank file, and the length in bytes of every token."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _encodings[path]


def token_spans(text: str, lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of every token. Tokens that share the bytes of one character both have it in their span."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    if len(data) == len(text):
        return starts, ends
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def allocate(first: np.ndarray, end: np.ndarray, sections: np.ndarray) -> np.ndarray:
    """Section of every token; section i covers the characters from ``sections[i]`` up to the next one's."""
    a = np.searchsorted(sections, first, side="right") - 1
    b = np.searchsorted(sections, end - 1, side="right") - 1
    for i in np.flatnonzero(a != b):
        borders = np.clip(np.append(sections[a[i] + 1:b[i] + 1], end[i]), first[i], end[i])
        a[i] += int(np.argmax(np.diff(np.insert(borders, 0, first[i]))))
    return a


def section_tokens(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, section, start, end, n_tokens, n_crossing) for every line of every text, with its line break.

    ``start`` and ``end`` are characters; ``n_crossing`` counts the tokens of the section that reach beyond it. Sections of a text cover it
    without gaps, so their tokens add up to the text's. A null or empty text is one empty section. Repeated rows give
    equal rows; other columns are ignored; an empty table gives an empty result.
    """

    def run(batch):
        encoding, lengths = _encoding(ranks_path, pattern)
        rows, parts = [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            text = text or ""
            ids = np.array(encoding.encode_ordinary(text), dtype=np.int64)
            codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            sections = np.insert(np.flatnonzero(codes[:-1] == 10) + 1, 0, 0)
            first, end = token_spans(text, lengths, ids)
            own = allocate(first, end, sections)
            ends = np.append(sections[1:], len(text))
            crossing = (first < sections[own]) | (end > ends[own])
            n = len(sections)
            rows.append(np.full(n, i))
            parts.append((np.arange(n), sections, ends, np.bincount(own, minlength=n), np.bincount(own[crossing], minlength=n)))
        at = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *(pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts))],
                                         [id_col, "section", "start", "end", "n_tokens", "n_crossing"])

    return mapped(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")), run,
                  f"`{id_col}` long, section long, start long, end long, n_tokens long, n_crossing long")
