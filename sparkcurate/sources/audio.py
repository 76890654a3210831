"""16 kHz mono 16-bit WAV clips as arrays of samples."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

RATE = 16_000


def decode_wav(content: bytes) -> list[float]:
    """Samples from -1 up to 1; other rates, channels or widths are an error."""
    with wave.open(io.BytesIO(content)) as w:
        if (w.getframerate(), w.getnchannels(), w.getsampwidth()) != (RATE, 1, 2):
            raise ValueError("not 16 kHz mono 16-bit")
        return (np.frombuffer(w.readframes(w.getnframes()), "<i2") / 32768.0).astype(np.float32).tolist()


@F.pandas_udf(ArrayType(FloatType()))
def wav_samples(content: pd.Series) -> pd.Series:
    return content.map(decode_wav)


def clips(spark: SparkSession, path: str) -> DataFrame:
    """(clip, samples) of WAV files; the path may have patterns."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1).alias("clip"), wav_samples("content").alias("samples"))
