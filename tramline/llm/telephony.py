"""Telephony audio columns: mu-law, A-law and IMA ADPCM to PCM, resampling, and WAVE storage.

Companded samples expand through 256-entry tables made from the companding rules; the ADPCM blocks of many texts decode
side by side, one numpy step for the same nibble of all blocks.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import Scratch, cut, doc_texts, flat, table

#: WAVE format tags (fixed values).
PCM, A_LAW, MU_LAW, IMA_ADPCM = 0x0001, 0x0006, 0x0007, 0x0011
RATE, RATE_OUT = 8000, 6000
UNIT = 64
#: Bytes of payload that the decoders hold at a time; longer ones come in pieces.
PIECE = 1 << 20


def mu_law_table() -> np.ndarray:
    """The 14-bit mu-law expansion, scaled to 16 bits: bits are inverted; sign, 3-bit exponent, 4-bit mantissa."""
    code = ~np.arange(256) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    """The 13-bit A-law expansion, scaled to 16 bits: even bits are inverted; exponent 0 is linear."""
    code = np.arange(256) ^ 0x55
    exponent, mantissa = (code >> 4) & 7, (code & 0x0F) << 4
    size = np.where(exponent == 0, mantissa + 8, (mantissa + 0x108) << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


MU, A = mu_law_table(), a_law_table()
#: IMA ADPCM step sizes and index moves (fixed values of the format).
STEPS = np.array(
    [
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209,
        230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024,
        3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086,
        29794, 32767,
    ]
)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2)


#: By step index times 16 plus nibble: the signed move of the value, and the next step index times 16.
CODE = np.arange(len(STEPS) * 16)
STEP, NIBBLE = STEPS[CODE >> 4], CODE & 15
SIZE = (STEP >> 3) + np.where(NIBBLE & 4, STEP, 0) + np.where(NIBBLE & 2, STEP >> 1, 0) + np.where(NIBBLE & 1, STEP >> 2, 0)
DELTA = np.where(NIBBLE & 8, -SIZE, SIZE).astype(np.int32)
NEXT = (np.clip((CODE >> 4) + MOVES[NIBBLE], 0, len(STEPS) - 1) << 4).astype(np.int32)


def adpcm(blocks: np.ndarray) -> np.ndarray:
    """(n, size) bytes, a mono IMA block a row, to (n, 1 + 2 * (size - 4)) samples; header: first sample, step index, 0.

    All blocks go side by side, a nibble at a time. A step index beyond the table's end is read as the last one, so any
    bytes decode.
    """
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(STEPS) - 1) << 4
    codes = blocks[:, 4:].T.astype(np.int32)
    out = np.empty((1 + 2 * len(codes), len(blocks)), np.int16)
    out[0] = value
    for k, code in enumerate(codes):
        for half, nibble in enumerate((code & 15, code >> 4)):
            nibble += index
            value += DELTA.take(nibble)
            np.clip(value, -32768, 32767, out=value)
            index = NEXT.take(nibble)
            out[1 + 2 * k + half] = value
    return out.T


def resampled_many(samples: np.ndarray, at: np.ndarray, rate: int, rate_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Many sounds in one array (n + 1 offsets) at another rate: linear interpolation at exact rational places, in integers.

    A sound of n samples becomes ceil(n * rate_out / rate); beyond its last sample that one is repeated.
    """
    if rate == rate_out or not len(samples):
        return samples, at
    common = gcd(rate, rate_out)
    up, down = rate_out // common, rate // common
    size = np.diff(at)
    number = -(-size * up // down)
    to = np.append(0, np.cumsum(number))
    place = (np.arange(to[-1]) - np.repeat(to[:-1], number)) * down
    left = place // up
    part = (place - left * up).astype(np.int32)
    left += np.repeat(at[:-1], number)
    right = np.minimum(left + 1, np.repeat(at[1:] - 1, number))
    wide = samples.astype(np.int32)
    return ((wide.take(left) * (up - part) + wide.take(right) * part) // up).astype(np.int16), to


def resample(samples: np.ndarray, rate: int, rate_out: int) -> np.ndarray:
    return resampled_many(samples, np.array([0, len(samples)]), rate, rate_out)[0]


def wave(payload: bytes, tag: int, rate: int, block: int = 1) -> bytes:
    """A mono WAVE file; block: bytes of a format's unit (1 companded sample, 2 for PCM, an ADPCM block)."""
    bits = {PCM: 16, IMA_ADPCM: 4}.get(tag, 8)
    extra = struct.pack("<HH", 2, 1 + 2 * (block - 4)) if tag == IMA_ADPCM else b"" if tag == PCM else struct.pack("<H", 0)
    per_second = rate * block // (1 + 2 * (block - 4)) if tag == IMA_ADPCM else rate * block
    head = struct.pack("<HHIIHH", tag, 1, rate, per_second, block, bits) + extra
    pad = b"\0" * (len(payload) % 2)
    body = b"WAVEfmt " + struct.pack("<I", len(head)) + head + b"data" + struct.pack("<I", len(payload)) + payload + pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def opened(media: bytes) -> tuple[int, int, int, bytes]:
    """Format tag, rate, block size and payload of a WAVE file; ValueError for anything else."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, found = 12, None
    while at + 8 <= len(media):
        size = struct.unpack_from("<I", media, at + 4)[0]
        if media[at : at + 4] == b"fmt ":
            tag, _, rate, _, block = struct.unpack_from("<HHIIH", media, at + 8)
            found = tag, rate, block
        elif media[at : at + 4] == b"data" and found:
            return *found, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAVE file without format or data")


def decoded(payload: bytes, tag: int, block: int) -> np.ndarray:
    """PCM samples of a payload."""
    data = np.frombuffer(payload, np.uint8)
    if tag == PCM:
        return np.frombuffer(payload[: len(payload) // 2 * 2], "<i2")
    if tag == IMA_ADPCM:
        return adpcm(data[: len(data) // block * block].reshape(-1, block)).ravel()
    return (MU if tag == MU_LAW else A)[data]


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(owner, begin, end) of the stretches of payloads that are looked at together: `most` bytes or one piece of a long one."""
    number = np.maximum(-(-sizes // most), 1)
    owner = np.repeat(np.arange(len(sizes)), number)
    begin = (np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)) * most
    end = np.minimum(begin + most, sizes[owner])
    group = (np.cumsum(end - begin) - 1) // most
    new = (group[1:] != group[:-1]) | (owner[1:] == owner[:-1])  # no two pieces of one payload together
    for part in np.split(np.arange(len(owner)), np.flatnonzero(new) + 1):
        yield owner[part], begin[part], end[part]


class Tally:
    """Of many sounds, each given in one piece or several in order: samples, peak, sum of absolute values, changes of sign, and CRC-32."""

    def __init__(self, n: int):
        self.samples, self.peak, self.total, self.turns = (np.zeros(n, np.int64) for _ in range(4))
        self.crc, self.sign = [0] * n, np.full(n, -1, np.int8)

    def add(self, owner: np.ndarray, x: np.ndarray, at: np.ndarray) -> None:
        """A piece of each owner, without empty ones; an owner comes once in a call."""
        size = np.abs(x.astype(np.int32))
        below = (x < 0).view(np.int8)
        turn = np.zeros(len(x), np.int64)
        turn[1:] = below[1:] != below[:-1]
        first = below[at[:-1]]
        turn[at[:-1]] = (self.sign[owner] >= 0) & (self.sign[owner] != first)
        self.sign[owner] = below[at[1:] - 1]
        self.samples[owner] += np.diff(at)
        self.peak[owner] = np.maximum(self.peak[owner], np.maximum.reduceat(size, at[:-1]))
        self.total[owner] += np.add.reduceat(size, at[:-1], dtype=np.int64)
        self.turns[owner] += np.add.reduceat(turn, at[:-1])
        data = memoryview(x.astype("<i2")).cast("B")
        for k, a, b in zip(owner.tolist(), (2 * at[:-1]).tolist(), (2 * at[1:]).tolist(), strict=True):
            self.crc[k] = zlib.crc32(data[a:b], self.crc[k])

    def told(self) -> list[str]:
        return [f"{n}:{peak}:{total}:{turns}:{crc}" for n, peak, total, turns, crc in zip(self.samples.tolist(), self.peak.tolist(), self.total.tolist(), self.turns.tolist(), self.crc, strict=True)]


def sounds(payloads: list[bytes], tag: int, block: int = 1, rate: int = RATE, rate_out: int = RATE_OUT) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(owner, samples, offsets) of stretches of payloads (whole UNITs each), as resampled PCM; a long one comes in pieces.

    A piece ends with a block of the format and between two places of the resampler, so pieces join without a seam.
    """
    whole = UNIT * (rate // gcd(rate, rate_out))
    for owner, begin, end in pieces(np.array([len(x) for x in payloads]), max(whole, PIECE // whole * whole)):
        data = b"".join([payloads[k][a:b] for k, a, b in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True)])
        pcm = decoded(data, tag, block)
        at = np.append(0, np.cumsum((end - begin) * len(pcm) // len(data)))
        yield owner, *resampled_many(pcm, at, rate, rate_out)


def described(payloads: list[bytes], tag: int, block: int = 1, rate: int = RATE, rate_out: int = RATE_OUT) -> list[str]:
    """Each payload's resampled PCM in figures (see Tally)."""
    out = Tally(len(payloads))
    for stretch in sounds(payloads, tag, block, rate, rate_out):
        out.add(*stretch)
    return out.told()


def pcm_waves(media: list[bytes], rate_out: int) -> list[bytes]:
    """Each of the files (of any of the formats, and whole UNITs) as 16-bit PCM at another rate."""
    files, out = [opened(x) for x in media], [b""] * len(media)
    for tag, rate, block in {x[:3] for x in files}:
        own = [k for k, x in enumerate(files) if x[:3] == (tag, rate, block)]
        held: list[list[memoryview]] = [[] for _ in own]
        for owner, x, at in sounds([files[k][3] for k in own], tag, block, rate, rate_out):
            data = memoryview(x.astype("<i2")).cast("B")
            for k, a, b in zip(owner.tolist(), (2 * at[:-1]).tolist(), (2 * at[1:]).tolist(), strict=True):
                held[k].append(data[a:b])
        for k, parts in zip(own, held, strict=True):
            out[k] = wave(b"".join(parts), PCM, rate_out, 2)
    return out


def padded(text: bytes) -> bytes:
    return text + b"\0" * (max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def stored(docs: DataFrame, tag: int = MU_LAW) -> DataFrame:
    """doc_id, n_bytes and media: each text's padded bytes as the samples (or ADPCM blocks of 64 bytes) of a WAVE file."""
    rows = doc_texts(docs)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            data, offsets = flat(batch.column("text"))
            media = [wave(padded(data[a:b].tobytes()), tag, RATE, UNIT if tag == IMA_ADPCM else 1) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(offsets[1:] - offsets[:-1]), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def resampled(media: DataFrame, rate_out: int = RATE_OUT) -> DataFrame:
    """The table of `stored` with a column `pcm`: its media as 16-bit PCM WAVE files at rate_out."""

    def convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "media"):
            pcm = pcm_waves([x.as_buffer().to_pybytes() for x in batch.column("media")], rate_out)
            yield batch.append_column("pcm", pa.array(pcm, pa.binary()))

    kind = media.schema["doc_id"].dataType.simpleString()
    return media.mapInArrow(convert, f"doc_id {kind}, n_bytes long, media binary, pcm binary")


def digests(media: DataFrame) -> DataFrame:
    """What the stored bytes hold, read back (the table of `resampled`).

    The feature describes the stored PCM, and the payload as it would be under the other codecs, A-law and ADPCM.
    """
    others = {"a": (A_LAW, 1), "ima": (IMA_ADPCM, UNIT)}

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "media"):
            whole = [x.as_buffer().to_pybytes() for x in batch.column("media")]
            payloads = [opened(x)[3] for x in whole]
            heard = [opened(x.as_buffer().to_pybytes())[3] for x in batch.column("pcm")]
            features = [[f"pcm={x}" for x in described(heard, PCM, 2, RATE_OUT, RATE_OUT)]]  # at its own rate: as stored
            features += [[f"{name}={x}" for x in described(payloads, tag, block)] for name, (tag, block) in others.items()]
            columns = [
                pa.array([len(x) for x in payloads], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in payloads]), pa.array([zlib.crc32(x[-UNIT:]) for x in payloads], pa.int64()),
                pa.array([len(x) for x in whole], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in whole]), pa.array([" ".join(x) for x in zip(*features, strict=True)]),
            ]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], names=["doc_id", "n_bytes", *names])

    kind = media.schema["doc_id"].dataType.simpleString()
    return media.mapInArrow(read, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


#: Sound is larger than text: large pages and a high level keep the table near the size of its input.
KEPT_TIGHT = {"parquet.compression.codec.zstd.level": "12", "parquet.page.size": str(8 << 20)}


def op2_telephony_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as mu-law WAVE files and their resampled PCM in a kept table, and what is read back from it.

    Null text counts as empty (64 zero bytes); null ids, repeated rows and an empty table pass through row by row.
    """
    rows = resampled(stored(table(spark, sf_dir, "documents")))
    return digests(Scratch(spark, "media").keep(rows, "media", **KEPT_TIGHT))
