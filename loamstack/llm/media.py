"""Telephony audio as a media column.

A payload of 8-bit samples is stored losslessly as a WAV file whose samples are
mu-law or A-law codes, and beside it the linear PCM that lookup tables expand it to, resampled
to twice the rate.  PCM is stored folded (the reversible prediction step of the 5/3 wavelet), in
which resampled sound takes little more room than the sound that it was made from; unfolding
gives it back whole.  Both are read back for their features.  ADPCM blocks (IMA, 64 bytes)
are decoded by numpy, one step for the blocks of many rows at once.

Defined results: a null or empty text is a payload of 64 zero bytes; equal texts
give equal values; a null key stays null; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import memory, store

UNIT = 64
RATE = 8000
MULAW, ALAW, IMA_ADPCM = 7, 6, 17
#: Payload bytes expanded at a time.
CHUNK_BYTES = 2 << 20
#: Bytes that a writer holds before it writes a row group.
ROW_GROUP_BYTES = 16 << 20

#: The step sizes of the IMA ADPCM standard.
IMA_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
])
#: How each code moves the step index.
IMA_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8])


def mulaw_table() -> np.ndarray:
    """Linear 16-bit value of each mu-law code (ITU-T G.711)."""
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 3) + 0x84 << (code >> 4 & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """Linear 16-bit value of each A-law code (ITU-T G.711)."""
    code = np.arange(256) ^ 0x55
    part, low = code >> 4 & 7, (code & 15) << 4
    size = np.where(part == 0, low + 8, low + 0x108 << np.maximum(part - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


def _adpcm_tables() -> tuple[np.ndarray, np.ndarray]:
    """For step index * 16 + code: the signed change and the next step index."""
    index, code = np.divmod(np.arange(89 * 16), 16)
    step = IMA_STEPS[index]
    change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
    return np.where(code & 8, -change, change).astype(np.int32), np.clip(index + IMA_MOVES[code & 7], 0, 88).astype(np.int32)


MULAW_PCM, ALAW_PCM = mulaw_table(), alaw_table()
ADPCM_CHANGE, ADPCM_NEXT = _adpcm_tables()


def decode_adpcm(payload: bytes | np.ndarray) -> np.ndarray:
    """Samples of mono IMA ADPCM blocks of 64 bytes, as int16 [block, 121]."""
    blocks = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    out = np.empty((121, len(blocks)), np.int16)
    value = blocks[:, 0].astype(np.int32) | blocks[:, 1].astype(np.int8).astype(np.int32) << 8
    index = np.minimum(blocks[:, 2], 88).astype(np.int32)
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(120):
        byte = codes[k >> 1]
        at = index * 16 + (byte >> 4 if k & 1 else byte & 15)
        value = np.clip(value + ADPCM_CHANGE[at], -32768, 32767)
        index = ADPCM_NEXT[at]
        out[k + 1] = value
    return out.T


def resample_double(pcm: np.ndarray) -> np.ndarray:
    """Twice the rate by linear interpolation; the last sample is held."""
    wide = pcm.astype(np.int32)
    out = np.empty(2 * len(pcm), np.int16)
    out[::2] = pcm
    out[1::2] = wide + np.append(wide[1:], wide[-1:]) >> 1
    return out


def fold(pcm: np.ndarray) -> bytes:
    """The even samples, then how far each odd one is from the mean of its neighbours (modulo 2^16); undone by ``unfold``."""
    even, odd = pcm[::2].astype(np.int32), pcm[1::2].astype(np.int32)
    after = np.append(even[1:], even[-1:])[: len(odd)]
    return pcm[::2].astype("<i2").tobytes() + (odd - (even[: len(odd)] + after >> 1)).astype(np.uint16).astype("<u2").tobytes()


def unfold(stored: bytes) -> np.ndarray:
    """PCM of ``fold``'s bytes."""
    both = np.frombuffer(stored, "<i2")
    even, apart = both[: len(both) + 1 >> 1].astype(np.int32), both[len(both) + 1 >> 1 :].astype(np.int32)
    out = np.empty(len(both), np.int16)
    out[::2] = even
    out[1::2] = (apart + (even[: len(apart)] + np.append(even[1:], even[-1:])[: len(apart)] >> 1)).astype(np.uint16).view(np.int16)
    return out


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % UNIT if raw else UNIT), len(raw)


def to_wav(payload: bytes, codec: int = MULAW, rate: int = RATE) -> bytes:
    """A mono WAV file; the payload is its sample codes (or ADPCM blocks), unchanged."""
    if codec == IMA_ADPCM:
        form, samples = struct.pack("<HHIIHHHH", codec, 1, rate, rate * UNIT // 121, UNIT, 4, 2, 121), len(payload) // UNIT * 121
    else:
        form, samples = struct.pack("<HHIIHHH", codec, 1, rate, rate, 1, 8, 0), len(payload)
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(payload)) + payload
    return b"RIFF" + struct.pack("<I", len(body)) + body


def from_wav(media: bytes) -> tuple[int, bytes]:
    """(codec, payload) of a WAV file, by its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, codec, payload = 12, 0, b""
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            codec = struct.unpack_from("<H", media, at + 8)[0]
        elif name == b"data":
            payload = media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    return codec, payload


def expand(media: bytes) -> np.ndarray:
    """Linear PCM at the stored rate."""
    codec, payload = from_wav(media)
    if codec == IMA_ADPCM:
        return decode_adpcm(payload).reshape(-1)
    return (MULAW_PCM if codec == MULAW else ALAW_PCM)[np.frombuffer(payload, np.uint8)]


def _signal(pcm: np.ndarray) -> str:
    wide = pcm.astype(np.int64)
    rms = int(np.sqrt(int(np.dot(wide, wide)) / len(wide)))
    turns = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
    return f"{int(wide.max())}/{int(wide.min())}/{rms}/{turns}"


def _write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memory.begin("media")
    for rows in batches:
        made = [payload_of(t if isinstance(t, str) else None) for t in rows["text"]]
        yield pd.DataFrame({"doc_id": rows["doc_id"], "n_bytes": [n for _, n in made], "media": [to_wav(p) for p, _ in made]})


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out, at = [], 0
        media = rows["media"].tolist()
        stored = iter(rows["pcm"]) if "pcm" in rows else None
        while at < len(media):
            part, size = [], 0
            while at < len(media) and (not part or size < CHUNK_BYTES):
                part.append(media[at])
                size += len(media[at])
                at += 1
            payloads = [from_wav(m)[1] for m in part]
            samples = decode_adpcm(b"".join(payloads))
            block = 0
            for m, p in zip(part, payloads):
                codes = np.frombuffer(p, np.uint8)
                mu = MULAW_PCM[codes]
                blocks = len(p) // UNIT
                adpcm = samples[block : block + blocks].reshape(-1)
                block += blocks
                raw = (unfold(next(stored)) if stored is not None else resample_double(mu)).astype("<i2").tobytes()
                out.append((
                    len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-UNIT:]), len(m), hashlib.sha256(m).hexdigest(),
                    f"mulaw={_signal(mu)};alaw={_signal(ALAW_PCM[codes])};adpcm={_signal(adpcm)};pcm16k={len(raw) // 2}/{zlib.crc32(raw)}",
                ))
        columns = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        made = pd.DataFrame(out, columns=columns)
        made.insert(0, "n_bytes", rows["n_bytes"].to_numpy())
        made.insert(0, "doc_id", rows["doc_id"].to_numpy())
        yield made


def _pcm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield pd.DataFrame({"doc_id": rows["doc_id"], "rate": 2 * RATE, "pcm": [resample_double(expand(m)).astype("<i2").tobytes() for m in rows["media"]]})


def _with_pcm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In frames of some ``CHUNK_BYTES``, as PCM takes four times the room of its payload."""
    for rows in batches:
        ends = np.cumsum([len(t) if isinstance(t, str) else 0 for t in rows["text"]]) // CHUNK_BYTES
        for _, part in rows.groupby(ends, sort=False):
            for made in _write(iter([part])):
                yield made.assign(pcm=[fold(resample_double(expand(m))) for m in made["media"]])


def media_column(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text as a mu-law WAV file."""
    return docs.select("doc_id", "text").mapInPandas(_write, "doc_id long, n_bytes long, media binary")


def pcm_column(media: DataFrame) -> DataFrame:
    """(doc_id, rate, pcm): the stored files expanded and resampled to 16 kHz, 16-bit little-endian."""
    return media.select("doc_id", "media").mapInPandas(_pcm, "doc_id long, rate int, pcm binary")


def media_and_pcm(docs: DataFrame) -> DataFrame:
    """``media_column`` with the folded PCM of ``pcm_column`` beside each file."""
    return docs.select("doc_id", "text").mapInPandas(_with_pcm, "doc_id long, n_bytes long, media binary, pcm binary")


def media_features(media: DataFrame) -> DataFrame:
    """Features of the files, and of their stored PCM where ``media`` has it."""
    return media.select("doc_id", "n_bytes", "media", *(["pcm"] if "pcm" in media.columns else [])).mapInPandas(
        _features, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    # Small row groups, as a row's sound takes five times the room of its text.
    stored = store.materialize(media_and_pcm(docs), "media", compression="zstd", **{"parquet.compression.codec.zstd.level": "9", "parquet.block.size": str(ROW_GROUP_BYTES)})
    return media_features(stored)
