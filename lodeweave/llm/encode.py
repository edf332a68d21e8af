"""Encoding a corpus with a public byte-pair tokenizer, by prefix dynamic programming.

Every prefix of a piece has exactly one valid last token: the one that may
follow the last token of the prefix before it. Two tokens may follow each
other if merging the bytes of both gives these two tokens again. Storing each
prefix's last token therefore stores the encoding of every prefix, so that
bytes can be appended, and a text can be edited, without starting anew.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of what a worker remembers; beyond them it forgets and computes again.
PIECES, PAIRS, PIECE_CHARS = 200_000, 1_000_000, 48


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where a public vocabulary file is, by its name."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    """The pattern that cuts a text into pieces before the merges."""
    import public_tokenizers

    return public_tokenizers.PATTERN


class PrefixEncoder:
    """Exact byte-pair encoding; ``ranks`` gives each token's id, lower ids being merged first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.tails = {t[k:] for t in ranks for k in range(len(t))}
        self.pieces = regex.compile(pattern)
        self._known: dict[str, tuple[int, ...]] = {}
        self._follows: dict[tuple[int, int], bool] = {}

    def merged(self, piece: bytes) -> list[int]:
        """The encoding by its definition: merge the adjacent pair of the lowest id until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, first: int, second: int) -> bool:
        """Whether the two tokens stay as they are when their bytes are merged."""
        pair = (first, second)
        known = self._follows.get(pair)
        if known is None:
            if len(self._follows) >= PAIRS:
                self._follows.clear()
            known = self._follows[pair] = self.merged(self.token[first] + self.token[second]) == [first, second]
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """The last tokens of all prefixes of ``data``, where those of the first len(last) bytes are known already."""
        ranks, token, tails = self.ranks, self.token, self.tails
        for end in range(len(last) + 1, len(data) + 1):
            fits: list[tuple[int, int]] = []
            start = end - 1
            while start >= 0 and (tail := data[start:end]) in tails:
                if tail in ranks:
                    fits.append((start, ranks[tail]))
                start -= 1
            for start, candidate in reversed(fits):
                if self.may_follow(last[start - 1], candidate) if start else self.merged(token[candidate]) == [candidate]:
                    last.append(candidate)
                    break
            else:
                raise ValueError(f"no token for byte {data[end - 1]}")
        return last

    def spell(self, last: list[int]) -> list[int]:
        """The encoding that the last tokens of all prefixes stand for."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.token[last[end - 1]])
        return out[::-1]

    def piece(self, piece: str) -> tuple[int, ...]:
        """The encoding of one piece."""
        known = self._known.get(piece)
        if known is None:
            data = piece.encode("utf-8")
            whole = self.ranks.get(data)
            known = (whole,) if whole is not None else tuple(self.spell(self.extend(data, [])))
            if len(piece) <= PIECE_CHARS:
                if len(self._known) >= PIECES:
                    self._known.clear()
                self._known[piece] = known
        return known

    def encode(self, text: str | None) -> list[int]:
        """The encoding of a text; an empty list for an empty and for a null text."""
        out: list[int] = []
        if text:
            known, slow = self._known, self.piece
            for piece in self.pieces.findall(text):
                ids = known.get(piece)
                out.extend(ids if ids is not None else slow(piece))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.token[i] for i in ids).decode("utf-8")


class EncodedText:
    """A text with the encoding of every prefix of every piece, that can be appended to and edited exactly."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.spans: list[tuple[int, int, list[int]]] = []
        self.touched = 0
        self.edit(0, 0, text)

    @property
    def ids(self) -> list[int]:
        return [i for _, _, last in self.spans for i in self.encoder.spell(last)]

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace text[start:stop]. Only pieces that the edit can reach are encoded again.

        A piece is cut with one character of the text behind it in view, so
        pieces that end before ``start`` stay. Behind the edit everything
        stays from where a new cut falls on an old one.
        """
        kept = 0
        while kept < len(self.spans) and self.spans[kept][1] < start:
            kept += 1
        text = self.text[:start] + new + self.text[stop:]
        shift, beyond = len(text) - len(self.text), {s: k for k, (s, _, _) in enumerate(self.spans) if s > stop}
        spans, at = self.spans[:kept], self.spans[kept - 1][1] if kept else 0
        old = self.spans[kept] if kept < len(self.spans) else None
        for m in self.encoder.pieces.finditer(text, at):
            if m.start() > start + len(new) and m.start() - shift in beyond:
                spans.extend((s + shift, e + shift, last) for s, e, last in self.spans[beyond[m.start() - shift] :])
                break
            data, last = m.group().encode("utf-8"), []
            if old and m.start() == old[0]:  # the bytes before the edit keep their tokens
                common = len(self.text[old[0] : min(start, old[1], m.end())].encode("utf-8"))
                last = old[2][:common]
            self.touched += len(data) - len(last)
            spans.append((m.start(), m.end(), self.encoder.extend(data, last)))
        self.text, self.spans = text, spans


_encoders: dict[str, PrefixEncoder] = {}


def encoder(path: str | None = None) -> PrefixEncoder:
    """The encoder of a vocabulary file of ranks; one per process and file."""
    path = path or vocabulary_path()
    if path not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path] = PrefixEncoder(ranks, split_pattern())
    return _encoders[path]


def encode_texts(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, lengths_only: bool = False) -> DataFrame:
    """df's other columns and the encoding of ``text`` as array<int>, or only its length.

    Null and empty texts get an empty list. Whole texts are encoded, special
    tokens' strings as ordinary text. No shuffle: one pass over the scan.
    A column of df that has the name ``out`` already is replaced.
    """
    path = path or vocabulary_path()
    others = [c for c in df.columns if c not in (text, out)]
    kind = T.IntegerType() if lengths_only else T.ArrayType(T.IntegerType())
    shape = T.StructType([*[df.schema[c] for c in others], T.StructField(out, kind)])
    step = 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, encode = to_arrow_schema(shape), encoder(path).encode
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                rows = [encode(t) for t in part.column(len(others)).to_pylist()]
                made = pa.array(map(len, rows), pa.int32()) if lengths_only else pa.array(rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made.cast(schema.field(out).type)], schema=schema)

    return df.select(*others, text).mapInArrow(run, shape)


def token_counts(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """df's other columns and the number of tokens of ``text``; 0 for null and empty texts."""
    return encode_texts(df, text, out, path, lengths_only=True)


def ids_of(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids."""
    return encode_texts(documents.select(F.col("doc_id"), "text"), path=path)
