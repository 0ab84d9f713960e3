"""Encoding of a corpus with a public byte-level BPE vocabulary, through a sentencepiece model written from it.

The model file is serialised here, field by field, from the vocabulary's ranks: each token's bytes are mapped to printable
characters as byte-level BPE does, its score is its negative rank, normalisation is the identity. sentencepiece then merges
the best-scored neighbours first, which is byte-level BPE. Texts are cut into pre-tokens by the vocabulary's pattern and
each distinct pre-token is encoded once per worker. The model (about 1 MB, bounded by the vocabulary) is broadcast; the
encoding is a map over Arrow batches without a shuffle.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the pre-token pattern of the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: distinct pre-tokens a worker keeps; beyond it the memory starts anew
REMEMBERED = 400_000
NORMAL, UNKNOWN, BPE, ABSENT = 1, 2, 2, (1 << 64) - 1


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where it prints, else the next one from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


def read_ranks(path: str = VOCABULARY) -> list[bytes]:
    """The tokens in the order of their ids."""
    with open(path, "rb") as f:
        by_rank = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [by_rank[i] for i in range(len(by_rank))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(tag: int, n: int) -> bytes:
    return _varint(tag << 3) + _varint(n)


def _message(tag: int, body: bytes) -> bytes:
    return _varint(tag << 3 | 2) + _varint(len(body)) + body


def model_bytes(tokens: list[bytes]) -> bytes:
    """The sentencepiece ModelProto of the vocabulary; piece i is token i, the unknown piece comes last."""
    to_char = byte_characters()
    piece = lambda text, score, kind: _message(1, _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))
    pieces = b"".join(piece("".join(to_char[b] for b in t), -float(i), NORMAL) for i, t in enumerate(tokens))
    trainer = _number(3, BPE) + _number(40, len(tokens)) + b"".join(_number(k, ABSENT) for k in (41, 42, 43))
    identity = _message(1, b"identity") + b"".join(_number(k, 0) for k in (3, 4, 5))
    return pieces + piece("<unk>", 0.0, UNKNOWN) + _message(2, trainer) + _message(3, identity)


class Encoder:
    def __init__(self, model: bytes, pattern: str = PATTERN):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.to_char = {b: c for b, c in enumerate(byte_characters())}
        self.known: dict[str, list[int]] = {}

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's begin and end."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        flat, ends = [], np.zeros(len(texts) + 1, dtype=np.int32)
        for i, text in enumerate(texts):
            parts = self.split(text or "")
            new = [p for p in {*parts} if p not in self.known]
            if new:
                mapped = [p.encode().decode("latin-1").translate(self.to_char) for p in new]
                self.known.update(zip(new, self.sp.encode(mapped, num_threads=1)))
            own = [k for p in parts for k in self.known[p]]
            flat.append(np.array(own, dtype=np.int32))
            ends[i + 1] = ends[i] + len(own)
        return np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32), ends


def encode(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids array<int> of every row of documents (doc_id, text), without special tokens.

    Null and empty texts give an empty list; strings of special tokens are ordinary text. One output row per input row,
    in whole texts. Other columns are ignored; an empty table gives no rows.
    """
    model = documents.sparkSession.sparkContext.broadcast(model_bytes(read_ranks(vocabulary)))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch in it:
            for at in range(0, batch.num_rows, 500):  # few texts at a time bound the memory of long ones
                part = batch.slice(at, 500)
                ids, ends = encoder.encode_batch(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], names=["doc_id", "ids"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(batches, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text of each row of encoded (doc_id, ids), by the inverse mapping. Null or empty ids give an empty text; ids outside the vocabulary give U+FFFD."""
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.value
        spell = lambda i: known[i] if i is not None and 0 <= i < len(known) else "�".encode()
        for batch in it:
            texts = [b"".join(map(spell, ids or [])).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(batches, "doc_id bigint, text string")
