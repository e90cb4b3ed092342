"""Byte-level BPE through a sentencepiece model that is written straight from a rank file.

Every token becomes a piece: its bytes as the usual printable stand-ins, its score the negative
rank, so the piece merged first is the one of least rank. Normalisation is the identity. Texts are
split by the pattern, each match is encoded apart, and ids are decoded by the inverse mapping.

Null texts count as empty: no ids, the digests of nothing. Repeated rows give repeated rows.
"""

from __future__ import annotations

import array
import base64
import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkEncoder
from .common import ship, steps

CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
UNKNOWN = "<unk>"


def stand_ins() -> list[str]:
    """A printable character for each byte: itself where it prints, else the next free one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    lines = (line.split() for line in Path(path).read_bytes().splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in (x for x in lines if x)}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; one more piece is the unknown one."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    table = dict(enumerate(stand_ins()))
    model = proto.ModelProto()
    for rank, token in sorted((r, t) for t, r in ranks.items()):
        if rank != len(model.pieces):
            raise ValueError(f"ranks must be gapless from 0; {rank} follows {len(model.pieces) - 1}")
        model.pieces.add(piece=token.decode("latin-1").translate(table), score=-float(rank))
    model.pieces.add(piece=UNKNOWN, score=-float(len(ranks)), type=proto.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(ranks)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes whole texts by one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.tokens = [t for _, t in sorted((r, t) for t, r in self.ranks.items())]
        self.split = regex.compile(pattern).findall
        self.table = dict(enumerate(stand_ins()))
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.chunks = ChunkEncoder(self._encode)

    def _matches(self, found: list[str]) -> dict[str, list[int]]:
        """Ids of each match: the token it is as a whole, else merged from its bytes."""
        raw = {m: m.encode() for m in found}
        out = {m: [self.ranks[b]] for m, b in raw.items() if b in self.ranks}
        rest = [m for m in raw if m not in out]
        mapped = [raw[m].decode("latin-1").translate(self.table) for m in rest]
        out.update(zip(rest, self.pieces.encode(mapped, out_type=int, num_threads=1), strict=True))
        return out

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        matches = [self.split(t) for t in texts]
        ids = self._matches(list({m for found in matches for m in found}))
        for found in matches:
            yield array.array("I", [i for m in found for i in ids[m]]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        return self.chunks.ids(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One per worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number and digest of each whole text's ids, and the digest of the bytes they decode to."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in steps(batch, "text"):
                ids = own.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids], pa.string()),
                    ],
                    names=[c.split()[0] for c in CODED.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, CODED)
