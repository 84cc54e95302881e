"""Media columns: WAV payloads, short-time Fourier transforms, peak-pair fingerprints.

A media value is stored as the bytes of a WAV file, written and read by the
wave module.  Its fingerprint is the classic spectral-peak one: frames are
transformed, the strongest bin of each band that also stands out against the
frames beside it is a peak, and every peak is paired with the peaks that
follow it closely.  A pair is one 64-bit number, time in the upper 32 bits and
(band-limited) both bins and their distance in the lower, so a fingerprint is
an array coded by time.

Nulls, empty and long texts: a null text counts as empty; an empty text has a
payload of 64 zero bytes and a fingerprint without pairs; long texts are read
whole, their frames in parts.  Of equally strong bins of a band the lowest is
its peak, and of equal frames in a row the first.  Repeated rows give repeated results; an empty table gives none.  Other
columns of the input are never looked at.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.batches import arrow_map, table, text_slices

#: Fixed values of the stored form and of the transform.
RATE, FRAME, HOP, BANDS, FAN, REACH = 8000, 512, 256, 4, 3, 63
#: Frames that are transformed at once.
FRAMES = 8192
SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_peaks long, fingerprint array<long>"
_WINDOW = np.hanning(FRAME).astype(np.float32)


def payload(data: bytes, unit: int = 64) -> bytes:
    """The data and bytes 0 up to a positive multiple of unit."""
    return data.ljust(max(unit, -(-len(data) // unit) * unit), b"\0")


def wav_bytes(samples: bytes, rate: int = RATE) -> bytes:
    """A WAV file of 8-bit mono samples."""
    with wave.open(out := io.BytesIO(), "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(rate)
        f.writeframes(samples)
    return out.getvalue()


def wav_samples(media: bytes) -> bytes:
    """The samples of a WAV file, through the wave module."""
    with wave.open(io.BytesIO(media), "rb") as f:
        return f.readframes(f.getnframes())


def n_frames(samples: bytes) -> int:
    """Frames of samples; the last is filled with silence."""
    return max(1, -(-(len(samples) - FRAME) // HOP) + 1)


def stft(samples: bytes, first: int = 0, end: int | None = None) -> np.ndarray:
    """Magnitudes of the frames from first to end, one row a frame."""
    end = n_frames(samples) if end is None else end
    x = np.frombuffer(samples, np.uint8)[first * HOP : (end - 1) * HOP + FRAME].astype(np.float32) - 128
    x = np.pad(x, (0, (end - first - 1) * HOP + FRAME - len(x)))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    return np.abs(np.fft.rfft(frames * _WINDOW, axis=1)[:, 1:])


def peaks(samples: bytes, together: int = FRAMES) -> tuple[np.ndarray, np.ndarray]:
    """(frame, bin) of the peaks, by time and then by bin.

    `together` frames are transformed at once, and one on either side of them, so memory does not grow with the text.
    """
    n, found = n_frames(samples), []
    for first in range(0, n, together):
        end = min(n, first + together)
        low, high = max(0, first - 1), min(n, end + 1)
        bands = stft(samples, low, high).reshape(high - low, BANDS, -1)
        best, top = bands.argmax(2), bands.max(2)
        edge = np.pad(top, ((1, 1), (0, 0)), constant_values=-1)
        t, b = np.nonzero((top > edge[:-2]) & (top >= edge[2:]) & (top > 0))
        own = (t >= first - low) & (t < end - low)
        t, b = t[own], b[own]
        found.append((t + low, best[t, b] + b * bands.shape[2]))
    return tuple(np.concatenate(x) for x in zip(*found))


def fingerprint(samples: bytes) -> np.ndarray:
    """time << 32 | first bin << 20 | second bin << 8 | distance, in order of time."""
    t, f = peaks(samples)
    codes = []
    for step in range(1, FAN + 1):
        dt = t[step:] - t[:-step]
        code = (t[:-step] << 32) | (f[:-step] << 20) | (f[step:] << 8) | dt
        codes.append(code[dt <= REACH])
    return np.sort(np.concatenate(codes)).astype(np.int64) if codes else np.zeros(0, np.int64)


def _rows(batches):
    kind = pa.schema([
        ("doc_id", pa.int64()),
        *((n, pa.int64()) for n in ("n_bytes", "payload_bytes")),
        ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()),
        ("media_bytes", pa.int64()),
        ("media_sha256", pa.string()),
        ("feature", pa.string()),
        ("n_peaks", pa.int64()),
        ("fingerprint", pa.list_(pa.int64())),
    ])
    for batch in batches:
        for rows, text in text_slices(batch):
            out = []
            for value in text:
                data = value.as_py().encode()
                media = wav_bytes(payload(data))
                back = wav_samples(media)
                codes = fingerprint(back)
                out.append((
                    len(data),
                    len(back),
                    hashlib.sha256(back).hexdigest(),
                    zlib.crc32(back[-64:]),
                    len(media),
                    hashlib.sha256(media).hexdigest(),
                    f"{len(codes)}:{hashlib.sha256(codes.tobytes()).hexdigest()}",
                    len(np.unique(codes >> 32)),
                    codes,
                ))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip(cols, list(kind)[1:]))],
                schema=kind,
            )


def media_columns(docs: DataFrame) -> DataFrame:
    """A row per document with the stored form's sizes and digests and its fingerprint."""
    return arrow_map(docs.select("doc_id", "text"), _rows, SCHEMA)


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media columns of every document, its stored form's digests and its fingerprint."""
    return media_columns(table(spark, sf_dir, "documents"))
