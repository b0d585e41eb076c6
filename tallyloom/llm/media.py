"""Media columns: texts as WAV bytes, and spectral fingerprints read back from them.

``to_wav`` writes a text's UTF-8 bytes, zero-padded to a positive multiple of 64, as the samples of
an 8-bit mono WAV file in a binary column.  ``wav_features`` reads such a column with the wave
module: payload digests, and a fingerprint from the short-time Fourier transform.  Frames overlap by
half under a periodic Hann window, the first one reaching half a frame before the first sample, so
the windows add up to 1 over every sample and none is left out.  The strongest
local peaks of each frame pair with the later peaks of that frame and of the next frames; a pair's code is time, first
frequency, second frequency and time step, and the codes in order of time are a fingerprint array.
Both are map-side only: nothing is shuffled, and a text is a row's business alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE, UNIT = 8000, 64
FRAME, HOP, PEAKS, AHEAD = 512, 256, 3, 2
#: Frames transformed at a time, so that a very long text needs no more memory than this many.
FRAMES = 2048


def wav_bytes(payload: bytes) -> bytes:
    import io
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(RATE)
        f.writeframes(payload)
    return out.getvalue()


def wav_payload(media: bytes) -> bytes:
    import io
    import wave

    with wave.open(io.BytesIO(media), "rb") as f:
        if (f.getnchannels(), f.getsampwidth()) != (1, 1):
            raise ValueError("not an 8-bit mono WAV")
        return f.readframes(f.getnframes())


def frames_of(n_samples: int) -> int:
    """Frames whose windows cover the samples: one starts half a frame before the first, the last one at a sample."""
    return -(-n_samples // HOP) + 1


def peaks(samples: bytes):
    """(frame, bin) of up to PEAKS largest local maxima of each frame's magnitude spectrum, frames in order, then bins."""
    import numpy as np

    x = np.frombuffer(samples, np.uint8)
    n_frames = frames_of(len(x))
    window, level = np.hanning(FRAME + 1)[:-1], np.round(x.mean()) if len(x) else 0.0
    for at in range(0, n_frames, FRAMES):
        n = min(FRAMES, n_frames - at)
        piece = np.full((n - 1) * HOP + FRAME, level)  # silence before the first sample and after the last
        begin = at * HOP - HOP
        part = x[max(0, begin) : begin + len(piece)]
        piece[max(0, -begin) : max(0, -begin) + len(part)] = part
        frames = np.lib.stride_tricks.sliding_window_view(piece, FRAME)[::HOP]
        size = np.abs(np.fft.rfft((frames - frames.mean(axis=1, keepdims=True)) * window, axis=1))
        size = np.round(size, 3)  # so that a last bit of rounding decides no tie
        top = np.zeros_like(size)
        middle = size[:, 1:-1]
        top[:, 1:-1] = np.where((middle > size[:, :-2]) & (middle >= size[:, 2:]), middle, 0.0)
        best = np.sort(np.argsort(-top, axis=1, kind="stable")[:, :PEAKS], axis=1)
        frame, k = np.nonzero(np.take_along_axis(top, best, axis=1) > 0)
        yield np.stack([frame + at, best[frame, k]], axis=1)


def fingerprint(samples: bytes) -> list[int]:
    """Time-coded pair codes in order: frame << 24 | first bin << 14 | second bin << 4 | frames between.

    A sound without spectral peaks (constant samples) has an empty fingerprint.
    """
    import numpy as np

    found = np.concatenate(list(peaks(samples)))
    codes = []
    for step in range(1, PEAKS * (AHEAD + 1)):  # places on, within the frames ahead
        a, b = found[:-step], found[step:]
        gap = b[:, 0] - a[:, 0] if len(a) else np.zeros(0, np.int64)
        near = gap <= AHEAD
        codes.append(a[near, 0] << 24 | a[near, 1] << 14 | b[near, 1] << 4 | gap[near])
    return np.sort(np.concatenate(codes)).tolist() if codes else []


def to_wav(docs: DataFrame, *, text: str = "text", media: str = "media") -> DataFrame:
    """``docs`` and the binary column ``media``: each whole text as a WAV file.

    Null and empty texts are 64 zero samples.  Every row stays, repeated ones too; equal texts give
    equal bytes.  A column already named ``media`` is replaced, all others kept.  An empty table gives
    no rows.  A WAV file holds at most 4 GiB; a longer text fails the job.
    """

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            raw = [(t or "").encode() for t in texts]
            yield pd.Series([wav_bytes(b + bytes(-len(b) % UNIT or (0 if b else UNIT))) for b in raw], dtype=object)

    return docs.withColumn(media, encode(F.col(f"`{text}`").cast("string")))


def wav_features(rows: DataFrame, *, media: str = "media") -> DataFrame:
    """``rows`` and ``media_features``: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, pairs.

    ``pairs`` is the fingerprint array; ``feature`` sums it up: frames, pairs and a digest of the
    codes.  A null media value has null features; bytes that are no 8-bit mono WAV fail the job.
    Every row stays, repeated ones too; a column already named ``media_features`` is replaced, all
    others kept.  An empty table gives no rows.
    """
    schema = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pairs array<long>"

    @F.pandas_udf(schema)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import hashlib
        import zlib

        import numpy as np

        names = [c.split()[0] for c in schema.split(", ")]
        for column in batches:
            out = []
            for value in column:
                if value is None:
                    out.append((None,) * len(names))
                    continue
                value = bytes(value)
                payload = wav_payload(value)
                pairs = fingerprint(payload)
                digest = hashlib.blake2b(np.array(pairs, "<i8").tobytes(), digest_size=12).hexdigest()
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(value), hashlib.sha256(value).hexdigest(), f"stft:{frames_of(len(payload))}:{len(pairs)}:{digest}", pairs))
            yield pd.DataFrame(out, columns=names)

    return rows.withColumn("media_features", read(F.col(f"`{media}`")))
