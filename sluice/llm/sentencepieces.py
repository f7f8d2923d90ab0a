"""SentencePiece encoding and decoding by a table of last tokens.

Merging pairs by score gives every prefix of a text one encoding, and so one last token. A token ends a prefix if the encoding of
what comes before it ends in a token the two of which stay apart when they are merged alone: no merge crosses a border that no
pair of neighbours crosses. So one pass over the matches of an automaton of all pieces, with a remembered test of pairs, gives the
last token of every prefix, and the tokens are read off backwards from the end.

A text is cut first where no piece holds the two bytes beside the cut, as no merge can cross it. The parts recur, like
words do, and a part met before is not encoded again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped

#: Parts whose ids and pairs whose test a Python worker remembers; beyond this it starts anew.
CACHE_PARTS, CACHE_PAIRS = 250_000, 500_000
#: Texts encoded at once, in bytes; a longer text is encoded by itself.
TEXT_BYTES = 1 << 21

# Fixed values of the model format: kinds of pieces, the mark of a space, and what stands for an unknown character.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
SPACE = "▁"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the runs [start, start + length), one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class PieceModel:
    """A merge-type piece model: ids of texts and texts of ids."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = np.array([p.type for p in proto.pieces], dtype=np.int64)
        if (trained.model_type != BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces
                or trained.treat_whitespace_as_suffix or not np.isin(kinds, [NORMAL, UNKNOWN, CONTROL, BYTE]).all()
                or (kinds == BYTE).sum() != 256):
            raise ValueError(f"{path}: not a merge-type model with byte pieces that leaves texts as they are")
        self.prefix = spec.add_dummy_prefix
        self.control = kinds == CONTROL
        byte_ids = [0] * 256
        surface, texts = [], {}
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                value = int(p.piece[1:-1], 16)
                byte_ids[value] = i
                surface.append(bytes([value]))
            elif p.type == NORMAL:
                texts[p.piece.replace(SPACE, " ")] = (i, p.score)
                surface.append(p.piece.replace(SPACE, " ").encode())
            else:
                surface.append(trained.unk_surface.encode() if p.type == UNKNOWN else b"")
        self.byte_ids, self.scores = byte_ids, {t: s for t, (_, s) in texts.items()}
        # what a decoded id stands for, and whether it loses its space at the beginning of a text
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.surface_lengths = np.array([len(s) for s in surface], dtype=np.int64)
        self.surface_starts = np.cumsum(self.surface_lengths) - self.surface_lengths
        self.spaced = np.array([k == NORMAL and s[:1] == b" " for k, s in zip(kinds, surface)])
        # tokens: all pieces, and single characters that only occur within longer ones
        tokens = list(texts) + sorted({c for t in texts for c in t} - texts.keys())
        self.tokens = tokens
        self.token_ids = [(texts[t][0],) if t in texts else self._bytes(t) for t in tokens]
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.automaton.add_word(t, (len(t), i))
        if tokens:
            self.automaton.make_automaton()
        self.joined = np.zeros((256, 256), dtype=bool)
        for t in texts:
            raw = np.frombuffer(t.encode(), dtype=np.uint8)
            self.joined[raw[:-1], raw[1:]] = True
        self.joined[:, 0x80:0xC0] = True  # within a character
        self.whole: dict[int, bool] = {}
        self.apart: dict[int, bool] = {}
        self.forget()

    def forget(self):
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0
        self.starts, self.lengths = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)

    def _bytes(self, c: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass"))

    def merged(self, text: str) -> list[str]:
        """The definition: the pair of neighbours of the highest score, the first of equals, becomes one, until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [self.scores.get(a + b) for a, b in zip(parts, parts[1:])]
            found = [s for s in pairs if s is not None]
            if not found:
                break
            i = pairs.index(max(found))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _is_whole(self, token: int) -> bool:
        out = self.whole.get(token)
        if out is None:
            out = self.whole[token] = len(self.merged(self.tokens[token])) == 1
        return out

    def _stay_apart(self, a: int, b: int) -> bool:
        key = a * len(self.tokens) + b
        out = self.apart.get(key)
        if out is None:
            if len(self.apart) >= CACHE_PAIRS:
                self.apart.clear()
            left, right = self.tokens[a], self.tokens[b]
            out = self.apart[key] = self.merged(left + right) == [left, right]
        return out

    def encode_part(self, part: str) -> list[int]:
        """Ids of one part of a text, its spaces plain."""
        last = [-2] * (len(part) + 1)  # last token of every prefix; -1: a character of no piece, which nothing joins
        size = [1] * (len(part) + 1)
        filled = 0
        for end, (length, token) in self.automaton.iter(part) if self.tokens else ():
            end += 1
            while filled < end - 1:
                filled += 1
                if last[filled] == -2:
                    last[filled] = -1
            if last[end] != -2:
                continue
            before = last[end - length] if end > length else -1
            if self._is_whole(token) if before == -1 else self._stay_apart(before, token):
                last[end], size[end] = token, length
        out: list[int] = []
        at = len(part)
        while at:
            out.extend(reversed(self.token_ids[last[at]] if last[at] >= 0 else self._bytes(part[at - 1])))
            at -= size[at]
        out.reverse()
        return out

    def _learn(self, parts: list[str]):
        if self.known and len(self.known) + len(parts) > CACHE_PARTS:
            self.forget()
            return False
        ids = [self.encode_part(p) for p in parts]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        n, total = len(self.known), int(lengths.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + len(parts) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        self.pool[self.used:self.used + total] = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=total)
        self.starts[n:n + len(parts)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n:n + len(parts)] = lengths
        self.known.update(zip(parts, range(n, n + len(parts))))
        self.used += total
        return True

    def _parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(parts, bounds): the parts of text i are ``bounds[i]`` up to ``bounds[i + 1]``."""
        texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), SPACE, " ")
        if self.prefix:
            none, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(space, texts, none))
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        cut = np.ones(len(data), dtype=bool)
        cut[1:] = ~self.joined[data[:-1], data[1:]]
        cut[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        starts = np.flatnonzero(cut)
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)),
                                                 pa.py_buffer(np.ascontiguousarray(data)))
        return parts, np.searchsorted(starts, offsets)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text i are ``ids[bounds[i]:bounds[i + 1]]``; a null has none."""
        parts, bounds = self._parts(texts)
        flat = parts.dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        while True:
            new = [p for p in distinct if p not in self.known]
            if not new or self._learn(new):
                break
        code = np.fromiter((self.known[p] for p in distinct), dtype=np.int64, count=len(distinct))
        code = code[flat.indices.to_numpy(zero_copy_only=False)] if len(distinct) else np.zeros(0, dtype=np.int64)
        lengths = self.lengths[code]
        ids = self.pool[ragged(self.starts[code], lengths)]
        return ids, np.concatenate([[0], np.cumsum(lengths)])[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ``ids[bounds[i]:bounds[i + 1]]``."""
        lengths = self.surface_lengths[ids]
        data = self.surface[ragged(self.surface_starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[bounds]
        out = []
        for i in range(len(bounds) - 1):
            a, b = bounds[i], bounds[i + 1]
            while a < b and self.control[ids[a]]:
                a += 1
            start = int(ends[i]) + int(self.prefix and a < b and self.spaced[ids[a]])
            try:
                out.append(data[start:ends[i + 1]].decode())
            except UnicodeDecodeError:
                out.append(self._mended(ids[a:b]).removeprefix(" " if start > ends[i] else ""))
        return out

    def _mended(self, ids: np.ndarray) -> str:
        """Text of ids with byte pieces that are no characters: each such byte becomes a replacement character."""
        raw = b"".join(self.surface[s:s + n].tobytes() for s, n in zip(self.surface_starts[ids], self.surface_lengths[ids]))
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at:at + n].decode())
                    break
                except UnicodeDecodeError:
                    pass
            else:
                n = 1
                out.append("�")
            at += n
        return "".join(out)


_models: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    if path not in _models:
        _models.clear()
        _models[path] = PieceModel(path)
    return _models[path]


def _ranges(sizes: np.ndarray):
    """Row ranges of about ``TEXT_BYTES`` each."""
    ends = np.cumsum(sizes)
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + TEXT_BYTES, side="right")))
        yield i, j
        i = j


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id_col, ids[, decoded]) of every row: the ids of its whole text, without marks of begin and end, and with ``decoded`` the
    text that those ids give again.

    A null or empty text has no ids and decodes to the empty text. Texts of any length are encoded whole; the mark of a space and a space are the
    same to the model, so the former decodes as the latter. Repeated rows and rows without an id get a row each; further columns are ignored,
    whatever their names. An empty table gives an empty result. A model of another type is a ``ValueError``.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch):
        model = _model(model_path)
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in _ranges(sizes):
            ids, bounds = model.encode(batch.column(1).slice(a, b - a))
            cols = [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
            if decoded:
                cols.append(pa.array(model.decode(ids, bounds), pa.string()))
            yield pa.RecordBatch.from_arrays(cols, [id_col, "ids", "decoded"][:len(cols)])

    return mapped(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")), run,
                  f"`{id_col}` {kind}, ids array<int>" + (", decoded string" if decoded else ""))


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of every row of ids; null or no ids give the empty text, bytes that are no character a replacement
    character each, and ids beyond the vocabulary an error. Further columns are ignored; repeated rows get a row each."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batch):
        model = _model(model_path)
        lists = batch.column(1)
        bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
        ids = pc.fill_null(lists.flatten(), 0).to_numpy(zero_copy_only=False)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(model.surface_lengths)):
            raise ValueError(f"id beyond the {len(model.surface_lengths)} pieces of the model")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.decode(ids, bounds.astype(np.int64)), pa.string())], [id_col, "text"])

    return mapped(encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("_ids")), run, f"`{id_col}` {kind}, text string")
