"""Batch functions that a caller brings, such as a scorer or a normaliser: started once in a worker, asked by batches, paired with their rows."""

from __future__ import annotations

import subprocess
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

Batch = Callable[[list[str]], list]


class OracleError(ValueError):
    """A reply that doesn't fit its texts."""


_started: dict[str, Batch] = {}


def _once(key: str, start: Callable[[], Batch]) -> Batch:
    """The function that start gives, made once in this worker and kept until another is asked for."""
    if key not in _started:
        _started.clear()
        _started[key] = start()
    return _started[key]


def asked(df: DataFrame, text_col: str, start: Callable[[], Batch], answer: str, kind: str, batch: int = 1_000, one_line: bool = False) -> DataFrame:
    """df with the column answer: for each text what the function says of it.

    start runs in each worker, once, and gives a function from a list of texts to a list of as many
    answers of that kind (a type's name). It gets up to batch texts at a time. Rows and answers go together through the batch, so
    that they can't be mispaired; a reply that is shorter or longer is an error, never a row less. A null text
    isn't asked about: its answer is null. one_line makes a text with a line end an error, for functions that
    speak a line a text. The function must answer a text alike whenever it is asked, as a lost task asks again.
    """
    if answer in df.columns:
        raise ValueError(f"there is a column {answer}")
    key = uuid.uuid4().hex
    answer_type = T.StructType.fromDDL(f"a {kind}")[0].dataType
    schema = T.StructType([*df.schema.fields, T.StructField(answer, answer_type)])
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                texts = part.column(place).to_pylist()
                some = [t for t in texts if t is not None]
                if one_line and (bad := [t for t in some if "\n" in t or "\r" in t]):
                    raise OracleError(f"texts with line ends: {bad[:3]}")
                function = function or _once(key, start)
                said = list(function(some)) if some else []
                if len(said) != len(some):
                    raise OracleError(f"{len(said)} answers for {len(some)} texts")
                rest = iter(said)
                answers = [None if t is None else next(rest) for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(answers, to_arrow_type(answer_type))], names=schema.names)

    return df.mapInArrow(run, schema)


def line_command(command: list[str]) -> Callable[[], Batch]:
    """For asked(): a program that reads a text a line and writes an answer a line, run once for each batch."""

    def start() -> Batch:
        def function(texts: list[str]) -> list[str]:
            said = subprocess.run(command, input="\n".join(texts) + "\n", capture_output=True, text=True, check=True).stdout
            return said.removesuffix("\n").split("\n") if said else []

        return function

    return start


def drop_hits(examples: DataFrame, text_col: str, start: Callable[[], Batch], group: str, batch: int = 1_000) -> tuple[DataFrame, DataFrame]:
    """drop_keyword_hits() with the verdicts of a caller's function."""
    from .decontam import drop_keyword_hits

    judged = asked(examples, text_col, start, "__verdict", "boolean", batch, one_line=True)
    kept, stats = drop_keyword_hits(judged, F.col("__verdict"), group)
    return kept.drop("__verdict"), stats


def normalized(df: DataFrame, text_col: str, start: Callable[[], Batch], batch: int = 1_000) -> DataFrame:
    """df with the caller's normal form in the place of each text."""
    out = asked(df, text_col, start, "__normal", "string", batch, one_line=True)
    return out.withColumn(text_col, F.col("__normal")).drop("__normal")
