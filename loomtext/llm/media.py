"""Media columns: byte payloads as MPEG audio streams, written and read back.

A payload travels as the ancillary data of silent MPEG-1 Layer III frames (mono, 32 kHz, where every bitrate has a
whole frame length): an ID3v2 tag with the payload's length, a VBR header frame with frame count, byte count and a
seek table, full frames of the highest bitrate, a last one of the lowest bitrate that holds the rest, and an ID3v1
tag. Each data frame has its CRC-16. The reader needs none of that to be in place: it looks for the next header that
another one (or the end) follows or whose CRC is right, skips what is between, and counts what it skipped.

Damaged streams are read as far as they can be: what is no frame is skipped, a length tag that is no number is as if it
were not there, and a null stream or one without frames has no rate and an empty payload.

Defined cases: a null or empty text has a payload of 64 zero bytes; equal payloads give equal streams; texts of any
length are handled a document at a time; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, materialize

#: Fixed values of the format: bitrates in kbit/s by header index (MPEG-1 Layer III), sample rates, samples a frame.
KBPS = [0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320]
RATES = [44100, 48000, 32000]
FRAME_SAMPLES = 1152
RATE = 32000
#: Bytes of side information of a mono frame, which is what is written, and of one with two channels.
SIDE, SIDE_OF_TWO = 17, 32
DATA_AT = 4 + 2 + SIDE
#: Payload bytes that frames of each bitrate hold.
ROOM = {k: 144 * k * 1000 // RATE - DATA_AT for k in KBPS[1:]}
PAYLOAD_UNIT, FULL = 64, 320


@lru_cache(4096)
def crc16(protected: bytes) -> int:
    """The format's CRC (polynomial 0x8005, start 0xFFFF) of the header's last two bytes and the side information."""
    crc = 0xFFFF
    for byte in protected:
        crc ^= byte << 8
        for _ in range(8):
            crc = ((crc << 1) ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


@lru_cache(64)
def frame_head(kbps: int, protected: bool) -> bytes:
    head = bytes([0xFF, 0xFA | (not protected), KBPS.index(kbps) << 4 | RATES.index(RATE) << 2, 0xC0])
    return head + (struct.pack(">H", crc16(head[2:] + bytes(SIDE))) if protected else b"") + bytes(SIDE)


def pad(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return data + bytes(max(PAYLOAD_UNIT, -(-len(data) // PAYLOAD_UNIT) * PAYLOAD_UNIT) - len(data))


def _synchsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def encode(payload: bytes) -> bytes:
    body = []
    for at in range(0, len(payload), ROOM[FULL]):
        part = payload[at : at + ROOM[FULL]]
        kbps = FULL if len(part) == ROOM[FULL] else next(k for k in KBPS[1:] if ROOM[k] >= len(part))
        body.append(frame_head(kbps, True) + part + bytes(ROOM[kbps] - len(part)))
    note = b"\x03payload_bytes\x00" + str(len(payload)).encode()
    tag = b"TXXX" + _synchsafe(len(note)) + b"\0\0" + note
    tag = b"ID3\x04\0\0" + _synchsafe(len(tag)) + tag
    first = 144 * 32 * 1000 // RATE
    total, offset, starts = first + sum(map(len, body)), first, []
    for b in body:
        starts.append(offset)
        offset += len(b)
    toc = bytes(min(255, starts[len(body) * i // 100] * 256 // total) for i in range(100))
    vbr = frame_head(32, False) + b"Xing" + struct.pack(">III", 7, len(body), total) + toc
    return tag + vbr + bytes(first - len(vbr)) + b"".join(body) + b"TAG" + bytes(124) + b"\xff"


def _frame_length(buf: bytes, at: int) -> tuple[int, int, int] | None:
    """(length, kbps, rate) of a Layer III header at ``at``, or None."""
    if at + 4 > len(buf) or buf[at] != 0xFF or buf[at + 1] & 0xFE != 0xFA:
        return None
    b = buf[at + 2]
    if not 0 < b >> 4 < 15 or b >> 2 & 3 == 3:
        return None
    kbps, rate = KBPS[b >> 4], RATES[b >> 2 & 3]
    return 144 * kbps * 1000 // rate + (b >> 1 & 1), kbps, rate


def _checked(buf: bytes, at: int) -> bool:
    """Whether the frame has a CRC and it is right."""
    return not buf[at + 1] & 1 and struct.unpack(">H", buf[at + 4 : at + 6])[0] == crc16(buf[at + 2 : at + 4] + buf[at + 6 : at + 6 + _side(buf, at)])


def _side(buf: bytes, at: int) -> int:
    return SIDE if buf[at + 3] >> 6 == 3 else SIDE_OF_TWO


def _vbr_header(data: bytes) -> dict:
    """Frame count, byte count and seek table of a VBR header; each is there only if its flag is set."""
    flags, at, out = int.from_bytes(data[:4]), 4, {"frames": None, "bytes": None, "toc": b""}
    for bit, name in ((1, "frames"), (2, "bytes")):
        if flags & bit and len(data) >= at + 4:
            out[name] = int.from_bytes(data[at : at + 4])
            at += 4
    if flags & 4:
        out["toc"] = data[at : at + 100]
    return out


def decode(buf: bytes) -> dict:
    """Tags, VBR header, frames and payload of a stream; damaged parts are skipped up to the next sure header."""
    at, end, tags, vbr = 0, len(buf), {}, None
    if buf[:3] == b"ID3" and end >= 10:
        size = sum((b & 0x7F) << s for b, s in zip(buf[6:10], (21, 14, 7, 0), strict=True))
        at = 10
        while at + 10 <= min(end, 10 + size) and buf[at : at + 4].isalnum():
            n = sum((b & 0x7F) << s for b, s in zip(buf[at + 4 : at + 8], (21, 14, 7, 0), strict=True))
            key, _, value = buf[at + 11 : at + 10 + n].partition(b"\0")
            tags[key.decode("utf-8", "replace")] = value.decode("utf-8", "replace")
            at += 10 + n
        at = 10 + size
    if end >= 128 and buf[end - 128 : end - 125] == b"TAG":
        end -= 128
    offsets, kbps_sum, crc_ok, crc_seen, skipped, parts, samples, played = [], 0, 0, 0, 0, [], 0, None
    while at + 4 <= end:
        head = _frame_length(buf, at)
        if not head or at + head[0] > end or not (at + head[0] + 4 > end or _frame_length(buf, at + head[0]) or _checked(buf, at)):
            found = buf.find(b"\xff", at + 1, end)
            skipped += (found if found >= 0 else end) - at
            at = found if found >= 0 else end
            continue
        length, kbps, rate = head
        if played not in (None, rate):
            # A stream keeps its rate, so this is no header of it.
            skipped += 1
            at += 1
            continue
        side = _side(buf, at)
        if not offsets and vbr is None and buf[at + 4 + side : at + 8 + side] == b"Xing":
            vbr, played = _vbr_header(buf[at + 8 + side : at + length]), rate
        else:
            played = rate
            offsets.append(at)
            samples += FRAME_SAMPLES
            kbps_sum += kbps
            data = at + 4 + side
            if not buf[at + 1] & 1:
                data += 2
                crc_seen += 1
                crc_ok += _checked(buf, at)
            parts.append(buf[data : at + length])
        at += length
    # Frames are padded only where the payload ends, so it is a prefix of what they carry.
    told = tags.get("payload_bytes", "")
    length = int(told) if told.isascii() and told.isdecimal() and len(told) < 19 else None
    return {
        "tags": tags, "vbr": vbr, "rate": played, "offsets": offsets, "samples": samples, "kbps": kbps_sum / max(1, len(offsets)),
        "crc_ok": crc_ok, "crc_seen": crc_seen, "skipped": skipped, "payload": b"".join(parts)[:length],
    }


def seek(buf: bytes, samples: int) -> int:
    """Byte offset of the frame that plays sample number ``samples``."""
    return decode(buf)["offsets"][samples // FRAME_SAMPLES]


ENCODED = "doc_id long, n_bytes long, media binary"
DECODED = "doc_id long, n_bytes long, payload binary, media binary, media_samples long, sample_rate int, seek_offsets array<long>, crc_ok int, crc_seen int, kbps double, vbr_frames long, vbr_bytes long, skipped long"
#: Rows of input handled and emitted together.
STEP = 256


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            yield batch.slice(at, STEP)


def encode_media(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): every text's UTF-8 bytes as a stream."""

    def run(batches):
        for b in _slices(batches):
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, raw), pa.int64()), pa.array([encode(pad(r)) for r in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ENCODED)


def decode_media(df: DataFrame) -> DataFrame:
    """What the streams hold: payload, exact duration (samples at a rate), frame offsets and checks."""
    names = ["payload", "media_samples", "seek_offsets", "crc_ok", "crc_seen", "kbps", "vbr_frames", "vbr_bytes", "skipped"]
    types = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        for b in _slices(batches):
            out, rate = [], []
            for m in b.column(2).to_pylist():
                d = decode(m or b"")
                v = d["vbr"] or {"frames": None, "bytes": None}
                rate.append(d["rate"])
                out.append((d["payload"], d["samples"], d["offsets"], d["crc_ok"], d["crc_seen"], d["kbps"], v["frames"], v["bytes"], d["skipped"]))
            made = dict(zip(names, (pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)), strict=True))
            made |= {"doc_id": b.column(0), "n_bytes": b.column(1), "media": b.column(2), "sample_rate": pa.array(rate, pa.int32())}
            order = [c.split()[0] for c in DECODED.split(", ")]
            yield pa.RecordBatch.from_arrays([made[c] for c in order], order)

    return df.mapInArrow(run, DECODED)


def op8_media(spark, sf_dir):
    d = decode_media(materialize(encode_media(documents(spark, sf_dir)), "media"))
    seconds = F.format_string("%d/%d", "media_samples", "sample_rate")
    seeks = F.crc32(F.array_join(F.col("seek_offsets").cast("array<string>"), ",").cast("binary"))
    feature = F.concat_ws(
        ";", F.concat(F.lit("seconds="), seconds), F.format_string("frames=%d", F.size("seek_offsets")), F.format_string("vbr=%d,%d", "vbr_frames", "vbr_bytes"),
        F.format_string("crc=%d/%d", "crc_ok", "crc_seen"), F.concat(F.lit("kbps="), F.round("kbps", 3).cast("string")), F.format_string("skipped=%d", "skipped"), F.format_string("seek=%08x", seeks),
    )
    return d.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64)")).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )
