"""SentencePiece encoding with byte spans in the original text, and decoding."""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tessera.llm.common import worker_cache

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁".encode()
BYTE_TYPE, NORMAL_TYPES = 6, (1, 4, 5)


class CharMap:
    """The compiled character map: a double-array trie over UTF-8, and the strings that replace its keys."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size:]
        self.seen: dict[bytes, bytes] = {}

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at ``at``, and what replaces it."""
        units, node, best = self.units, 0, None
        if not units:
            return None
        node ^= (units[0] >> 10) << ((units[0] & 0x200) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                best = i + 1 - at, start
        return best and (best[0], self.strings[best[1]:self.strings.index(b"\0", best[1])])


class PieceCodec:
    """A SentencePiece model with source alignment."""

    def __init__(self, proto: bytes):
        spec = model_pb2.ModelProto.FromString(proto)
        self.norm, self.suffix = spec.normalizer_spec, spec.trainer_spec.treat_whitespace_as_suffix
        if not spec.trainer_spec.byte_fallback:
            raise ValueError("only models with byte fallback tell each piece's length from its id")
        self.map = CharMap(self.norm.precompiled_charsmap)
        self.space = SPACE if self.norm.escape_whitespaces else b" "
        self.width = np.array([1 if p.type == BYTE_TYPE else len(p.piece.encode()) if p.type in NORMAL_TYPES else 0
                               for p in spec.pieces], np.int64)
        self.lib = sentencepiece.SentencePieceProcessor(model_proto=proto)

    def normalise(self, text: bytes) -> tuple[int, np.ndarray]:
        """Bytes of the normalised text, and the original offset of each of its bytes and of its end."""
        if not text:
            return 0, np.zeros(1, np.int64)
        if not self.map.units and not self.norm.remove_extra_whitespaces:
            # Nothing is rewritten but spaces: repeat each offset as often as its byte comes out.
            raw = np.frombuffer(text, np.uint8)
            align = np.repeat(np.arange(len(raw)), np.where(raw == 32, len(self.space), 1))
            pad = np.full(len(self.space) if self.norm.add_dummy_prefix else 0, len(raw) if self.suffix else 0)
            align = np.concatenate([align, pad] if self.suffix else [pad, align])
            return len(align), np.append(align, len(raw))
        out, align = self._rewrite(text)
        return len(out), np.array(align, np.int64)

    def _rewrite(self, text: bytes) -> tuple[bytes, list[int]]:
        out, align, squeeze, space = bytearray(), [], self.norm.remove_extra_whitespaces, self.space

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            align.extend([at] * len(piece))

        at, after_space, begun = 0, squeeze, False
        while at < len(text):
            hit = self.map.longest(text, at)
            if hit:
                width, new = hit
            else:
                lead = text[at]
                width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = text[at:at + width]
            if after_space:
                new = new.lstrip(b" ")
            if new or not squeeze:
                if not begun:
                    begun = True
                    if self.norm.add_dummy_prefix and not self.suffix:
                        put(space, at)
                for i in range(len(new)):
                    put(space if new[i:i + 1] == b" " else new[i:i + 1], at)
                if new:
                    after_space = squeeze and new.endswith(b" ")
            at += width
        end = at
        while squeeze and out.endswith(space):
            end = align[len(out) - len(space)]
            del out[-len(space):], align[-len(space):]
        if begun and self.suffix and self.norm.add_dummy_prefix:
            put(space, end)
        return bytes(out), align + [end]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the byte of the original text that ends each piece; it starts where the one before ends."""
        ids = np.array(self.lib.encode(text, num_threads=1), np.int32)
        size, align = self.normalise(text.encode())
        ends = np.cumsum(self.width[ids])
        if size != (ends[-1] if len(ends) else 0):
            raise ValueError("pieces don't cover the normalised text")
        return ids, align[ends].astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.lib.decode(ids.tolist())


def codec(proto: bytes) -> PieceCodec:
    cache, key = worker_cache(), ("pieces", hashlib.sha256(proto).digest())
    if key not in cache:
        cache[key] = PieceCodec(proto)
    return cache[key]


def encode_pieces(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
                  rows: int = 256) -> DataFrame:
    """(id, ids, ends, decoded) for every row: piece ids, the end of each piece's span and the ids decoded again.

    Spans are byte offsets into the original text's UTF-8 and tile it: a piece
    starts where the one before ends, the first at 0.  A piece that holds part
    of a character's normalised form has an empty span up to the part that ends
    it.  NULL text is taken as empty, and empty text has no pieces and decodes
    to empty.  Ids and rows may repeat or be NULL.  The model travels with the
    tasks; nothing is shuffled, and results leave in batches of ``rows`` rows.
    """
    with open(model, "rb") as f:
        proto = f.read()

    def run(batches):
        coder = codec(proto)
        lists = lambda xs: pa.ListArray.from_arrays(
            np.cumsum([0, *map(len, xs)]).astype(np.int32), np.concatenate([*xs, np.zeros(0, np.int32)]))
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                part = batch.slice(a, rows)
                coded = [coder.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists([c[0] for c in coded]), lists([c[1] for c in coded]),
                     pa.array([coder.decode(c[0]) for c in coded], pa.string())], ["id", "ids", "ends", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>, ends array<int>, decoded string")


def piece_digests(docs: DataFrame) -> DataFrame:
    """Per row: its number of pieces, and SHA-256 of their comma-joined ids and of the text that these decode to."""
    out = encode_pieces(docs)
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_pieces(spark, sf_dir: str) -> DataFrame:
    return piece_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
