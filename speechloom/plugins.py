"""Boundaries to what Spark doesn't have: encoders, resamplers, tokenizers, compatibility forms."""

from __future__ import annotations

import io
import math
import unicodedata
import wave
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StringType, StructField, StructType


class Encoder(Protocol):
    """Turns mono samples at `rate` into codes[codebook][frame]."""

    rate: int

    def encode(self, batch: list[list[float]]) -> list[list[list[int]]]: ...


class Decoder(Protocol):
    rate: int

    def decode(self, batch: list[list[list[int]]]) -> list[list[float]]: ...


class Energy:
    """A stand-in encoder for tests: codes from the mean of each frame, the same for any batching."""

    rate = 24_000

    def __init__(self, codebooks: int = 8, size: int = 2048, per_second: float = 12.5):
        self.codebooks, self.size, self.step = codebooks, size, int(self.rate / per_second)

    def encode(self, batch):
        import numpy as np

        out = []
        for samples in batch:
            x = np.asarray(samples, np.float64)
            sums = np.pad(x, (0, -len(x) % self.step)).reshape(-1, self.step).sum(1)
            level = ((sums / self.step + 1) / 2 * (self.size - 1)).astype(int).tolist()
            out.append([[(v + k) % self.size for v in level] for k in range(self.codebooks)])
        return out

    def decode(self, batch):
        """Each frame at the level of its first codebook."""
        return [[(v / (self.size - 1)) * 2 - 1 for v in codes[0] for _ in range(self.step)] if len(codes) else [] for codes in batch]


#: Codec frames in a second — fixed value
PER_SECOND = 12.5


def frames_of(samples: int, rate: int, per_second: float = PER_SECOND) -> int:
    """Frames that so many samples give; the last one may be filled up."""
    return math.ceil(samples / (rate / per_second))


def encode_padded(model: Encoder, batch: list[list[float]], per_second: float = PER_SECOND) -> list[list[list[int]]]:
    """A batch filled up with silence to its longest member; of the codes only the frames of the samples are kept.

    Samples that are missing or empty give no codes.
    """
    some = [x for x in batch if x is not None and len(x)]
    longest = max(map(len, some), default=0)
    codes = iter(model.encode([[*x, *[0.0] * (longest - len(x))] for x in some]) if some else [])
    return [[row[: frames_of(len(x), model.rate, per_second)] for row in next(codes)] if x is not None and len(x) else [] for x in batch]


def encoder_udf(make: Callable[[], Encoder], batch: int = 16, per_second: float = PER_SECOND) -> Callable[[Column], Column]:
    """The model is made once for each worker; samples pass in Arrow batches and are encoded in padded ones."""

    @F.pandas_udf("array<array<int>>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in batches:
            out: list = []
            for at in range(0, len(s), batch):
                out += encode_padded(model, list(s[at : at + batch]), per_second)
            yield pd.Series(out)

    return encode


def decoder_udf(make: Callable[[], Decoder], batch: int = 16) -> Callable[[Column], Column]:
    """Samples of code matrices, by a model made once for each worker."""

    @F.pandas_udf("array<float>")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in batches:
            out: list = []
            for at in range(0, len(s), batch):
                out += model.decode([[] if x is None else [list(row) for row in x] for x in s[at : at + batch]])
            yield pd.Series(out)

    return decode


def wave_samples(content: bytes) -> tuple[list[float], int]:
    """(mono samples in -1 to 1, rate) of a WAV file of 8, 16 or 32 bits; channels are averaged."""
    import numpy as np

    with wave.open(io.BytesIO(content)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    kind = {1: np.uint8, 2: "<i2", 4: "<i4"}[width]
    x = np.frombuffer(raw, kind).astype(np.float32)
    x = (x - 128) / 128 if width == 1 else x / float(1 << 8 * width - 1)
    return x.reshape(-1, channels).mean(1).tolist() if channels > 1 else x.tolist(), rate


@F.pandas_udf(StructType([StructField("samples", ArrayType(FloatType())), StructField("rate", IntegerType())]))
def wave_decode(content: pd.Series) -> pd.DataFrame:
    """Audio files as samples; null for one that can't be read, to be filtered and counted. Other formats need a library."""

    def one(c):
        try:
            return wave_samples(bytes(c))
        except (wave.Error, EOFError, KeyError, TypeError):
            return None, None

    return pd.DataFrame([one(c) for c in content], columns=["samples", "rate"])


def resampled(x, source: int, rate: int, zeros: int = 16):
    """Samples at `rate` by a Hann-windowed sinc of so many zero crossings on each side; of the lower rate's band only.

    Weights are made to sum to 1 at each place, so a constant stays one up to the edges. int(n * rate / source) samples.
    """
    import numpy as np

    x = np.asarray(x, np.float32)
    if source == rate or not len(x):
        return x
    n, cut = len(x) * rate // source, min(1.0, rate / source)
    reach = math.ceil(zeros / cut)
    taps = np.arange(-reach, reach + 1)
    out = np.empty(n, np.float32)
    for first in range(0, n, 1 << 14):  # so that a long file needs no table of all its weights
        t = np.arange(first, min(n, first + (1 << 14))) * (source / rate)
        at = np.floor(t).astype(np.int64)[:, None] + taps
        far = (t[:, None] - at) * cut
        weight = np.where(np.abs(far) < zeros, np.sinc(far) * (0.5 + 0.5 * np.cos(np.pi * far / zeros)), 0.0)
        weight[(at < 0) | (at >= len(x))] = 0
        out[first : first + len(t)] = (weight * x[np.clip(at, 0, len(x) - 1)]).sum(1) / weight.sum(1)
    return out


def resampler_udf(rate: int) -> Callable[[Column, Column], Column]:
    """resampled() as a function of the samples and their rate; null without either."""

    @F.pandas_udf("array<float>")
    def resample(samples: pd.Series, source: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or pd.isna(r) else resampled(x, int(r), rate) for x, r in zip(samples, source, strict=True)])

    return resample


def token_length_udf(make: Callable[[], Callable[[str], list]]) -> Callable[[Column], Column]:
    """Token counts by any tokenizer: `make()` gives a function from text to tokens, once for each worker."""

    @F.pandas_udf("long")
    def length(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenize = make()
        for s in batches:
            yield s.map(lambda t: 0 if t is None else len(tokenize(t)))

    return length


@F.arrow_udf(StringType())
def nfkc(s: pa.Array) -> pa.Array:
    """Compatibility composition, which goes before ids.folded(). Not for codec strings. Of an Arrow batch, a hundred texts at a
    time are Python's; session.bound_batches() bounds the batch."""
    normal = lambda t: None if t is None else unicodedata.normalize("NFKC", t)
    parts = [pa.array(map(normal, s.slice(at, 100).to_pylist()), pa.string()) for at in range(0, len(s), 100)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def consistent_udf(offset: int, codebooks: int, size: int) -> Callable[[Column], Column]:
    """Alphabet.consistent() in time proportional to the string."""

    @F.pandas_udf(StringType())
    def consistent(s: pd.Series) -> pd.Series:
        def one(text):
            if not text:
                return text
            book = [max(-1, min(codebooks - 1, (ord(c) - offset) // size)) for c in text]
            wait, out = max(0, book[0]), []
            for c, k in zip(text, book, strict=True):
                if k == wait:
                    out.append(c)
                    wait = (wait + 1) % codebooks
            return "".join(out)

        return s.map(one)

    return consistent
