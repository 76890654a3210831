"""Document quality from lines: a linear-chain conditional random field, length-weighted marginals."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded_batches, kept, lean, load, placed

#: Labelled documents that the field is fitted on, at most; those with the smallest hashes.
FIT_DOCS = 3_000
#: Lines of them, at most, in all; documents are taken while they fit.
FIT_LINES = 120_000
THRESHOLD = 0.3
#: Texts of more bytes go through the field in runs of lines of about so many; shorter ones go side by side.
RUN_BYTES = 1 << 18
STEPS, ROUNDS, RATE, DECAY = 120, 3, 0.15, 1e-4

_UPPER, _LOWER, _DIGIT, _SPACE, _SHOUT, _BAR, _STOP, _HIGH, _OTHER = range(9)


def _classes() -> np.ndarray:
    kind = np.full(256, _OTHER, np.uint8)
    for chars, k in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), (b"abcdefghijklmnopqrstuvwxyz", _LOWER), (b"0123456789", _DIGIT), (b" \t\r\x0b\x0c", _SPACE), (b"!", _SHOUT), (b"|", _BAR), (b".,;:?'\"-()", _STOP)):
        kind[list(chars)] = k
    kind[128:] = _HIGH
    return kind


KIND = _classes()
MIX = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Features of a line itself; its neighbours' come after, zeros beyond either end.
OWN = 13


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features with neighbours' and a constant, bytes of each line, lines of each text); an empty text has one empty line."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_ends = np.cumsum(sizes + 1)  # one past each text's last line end
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n_lines = np.diff(np.concatenate([[0], np.searchsorted(ends, text_ends - 1, side="right")]))
    length = ends - starts
    kinds = KIND[data]
    n = np.maximum(length, 1)
    share = np.zeros((len(ends), 9))
    for k in range(9):
        total = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)])
        share[:, k] = (total[ends] - total[starts]) / n
    space = (kinds == _SPACE) | (data == 10)
    begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stop = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(MIX[data])])
    word = (total[stop] - total[begin]) * np.uint64(2) + (stop - begin).astype(np.uint64)
    line = np.searchsorted(ends, begin)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    words = np.bincount(line, minlength=len(ends))
    some = np.maximum(words, 1)
    own = np.zeros((len(ends), OWN))
    own[:, 0] = np.log1p(length) / 6
    own[:, 1:7] = np.minimum(1, share[:, [_UPPER, _DIGIT, _SHOUT, _BAR, _OTHER, _STOP]] * [2, 4, 8, 20, 8, 4])
    own[:, 7] = share[:, _HIGH]
    own[:, 8] = np.bincount(line, weights=same, minlength=len(ends)) / some
    own[:, 9] = np.minimum(length / some, 30) / 10
    own[:, 10] = share[:, _LOWER]
    own[:, 11] = np.where(length > 0, (kinds[np.maximum(ends - 1, 0)] == _STOP), False)
    own[:, 12] = words == 0
    first = np.cumsum(n_lines) - n_lines
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[first + n_lines - 1] = 0, 0
    return np.hstack([own, before, after, np.ones((len(ends), 1))]), length, n_lines


@dataclass
class Field:
    """Scores of good (1) against bad (0): emission by features, trans[a, b] from a line's label to the next's;
    a document's share of good text goes through the logistic function of slope and offset."""

    weights: np.ndarray
    trans: np.ndarray
    slope: float = 0.0
    offset: float = 0.0

    def share(self, x: np.ndarray, lengths: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        """Each text's share of good text: its lines' marginals weighted by their bytes."""
        good, _, _ = self.marginals(x, n_lines)
        weight, first = np.maximum(lengths, 1), np.cumsum(n_lines) - n_lines
        return np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)

    def score(self, x: np.ndarray, lengths: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.slope * self.share(x, lengths, n_lines) - self.offset))

    def marginals(self, x: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Each line's probability of good, the expected pairs of labels, the sum of log partition functions.

        All texts go forward and backward line by line, side by side.
        """
        score = np.zeros((len(x), 2))
        score[:, 1] = x @ self.weights
        return self.passes(score, n_lines)

    def passes(self, score: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        order = np.argsort(-n_lines, kind="stable")
        first, n = (np.cumsum(n_lines) - n_lines)[order], n_lines[order]
        alive = np.searchsorted(-n, -np.arange(1, (int(n[0]) if len(n) else 0) + 1), side="right")
        forward, backward = score.copy(), np.zeros_like(score)
        move = np.exp(self.trans)
        for t in range(1, len(alive)):
            at = first[: alive[t]] + t
            forward[at] += _log_times(forward[at - 1], move)
        for t in range(len(alive) - 1, 0, -1):
            at = first[: alive[t]] + t
            backward[at - 1] = _log_times(backward[at] + score[at], move.T)
        last = first + n - 1
        z = np.logaddexp(forward[last, 0], forward[last, 1])
        log_z = np.zeros(len(score))
        log_z[np.repeat(first, n) + _within(n)] = np.repeat(z, n)
        good = np.exp(np.minimum(0, forward[:, 1] + backward[:, 1] - log_z))
        later = np.ones(len(score), bool)
        later[first] = False
        at = np.flatnonzero(later)
        both = forward[at - 1][:, :, None] + self.trans + (score[at] + backward[at])[:, None, :] - log_z[at][:, None, None]
        return good, np.exp(both).sum(0), float(z.sum())


def chain(field: Field, text: bytes) -> tuple[float, float]:
    """(good, all): a long text's bytes in good lines by their marginals, and its bytes; a line has one at least.

    The text is cut into runs of whole lines. A forward pass keeps the message at each run's start, a
    backward pass makes the run's messages again and weighs its marginals, so that one run is held at
    a time. Neighbouring lines of other runs are there for the features.
    """
    cuts = [0]
    while (at := text.find(b"\n", cuts[-1] + RUN_BYTES)) >= 0:
        cuts.append(at + 1)
    cuts.append(len(text) + 1)
    runs = list(zip(cuts[:-1], cuts[1:], strict=True))

    def emissions(begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        first = text.rfind(b"\n", 0, begin - 1) + 1 if begin else 0
        last = text.find(b"\n", end) if end <= len(text) else len(text)
        x, length, _ = line_features([text[first : last if last >= 0 else len(text)]])
        inner = slice(int(begin > 0), len(x) - int(end <= len(text)))
        score = np.zeros((len(x), 2))
        score[:, 1] = x @ field.weights
        return score[inner], length[inner]

    starts, forward = [], None
    for run in runs:
        starts.append(forward)
        forward = _messages(emissions(*run)[0], field.trans, forward)[-1]
    good = whole = 0.0
    later = np.zeros(2)
    for run, before in zip(reversed(runs), reversed(starts), strict=True):
        score, length = emissions(*run)
        ahead = _messages(score, field.trans, before)
        # backwards, a line's message takes in the lines after it; the last one's comes from the next run
        back = np.zeros_like(score)
        back[-1] = later
        if len(score) > 1:
            back[:-1] = _messages(score[:0:-1], field.trans.T, None, first=later)[::-1]
        both = ahead + back
        good += float((np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1])) * np.maximum(length, 1)).sum())
        whole += float(np.maximum(length, 1).sum())
        top = score[0] + back[0]
        later = np.logaddexp(field.trans[:, 0] + top[0], field.trans[:, 1] + top[1])
        later -= later.max()
    return good, whole


def _messages(score: np.ndarray, trans: np.ndarray, before: np.ndarray | None, first: np.ndarray | None = None) -> np.ndarray:
    """Messages along a chain, up to a constant each: forward ones, where before is that of the line ahead of it, if
    any; or, with first, backward ones: of the line that ends the chain first is the message, and score[k] is of
    the line whose message came k-th.

    Steps are 2 x 2 matrices; the chain is folded into rows, whose products are made side by side and then
    joined row by row.
    """
    n = len(score)
    wide = int(np.ceil(np.sqrt(n)))
    rows = -(-n // wide)
    step = np.full((rows * wide, 2, 2), -np.inf)
    step[:, 0, 0] = step[:, 1, 1] = 0.0
    # step[k][a, b]: from label a of the message before to label b of this one
    step[:n] = trans[None] + score[:, None, :] if first is None else score[:, :, None] + trans[None]
    start = first if first is not None else before
    if start is None:
        step[0] = np.broadcast_to(score[0], (2, 2))
        start = np.array([0.0, -np.inf])
    step = step.reshape(rows, wide, 2, 2)
    total = np.empty_like(step)
    total[:, 0] = step[:, 0]
    for k in range(1, wide):
        a, b = total[:, k - 1], step[:, k]
        x = np.logaddexp(a[:, :, 0, None] + b[:, None, 0, :], a[:, :, 1, None] + b[:, None, 1, :])
        total[:, k] = x - x.max((1, 2), keepdims=True)
    out = np.empty((rows, wide, 2))
    for r in range(rows):
        out[r] = np.logaddexp(start[0] + total[r, :, 0], start[1] + total[r, :, 1])
        out[r] -= out[r].max(1, keepdims=True)
        start = out[r, -1]
    return out.reshape(-1, 2)[:n]


def _log_times(log_left: np.ndarray, move: np.ndarray) -> np.ndarray:
    top = log_left.max(1, keepdims=True)
    return np.log(np.exp(log_left - top) @ move) + top


def _within(n: np.ndarray) -> np.ndarray:
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(n) else 0) - np.repeat(ends - n, n)


def fit(x: np.ndarray, n_lines: np.ndarray, lengths: np.ndarray, good_doc: np.ndarray) -> Field:
    """Fits by likelihood of the lines' labels. Lines first have their document's label; then lines of bad
    documents that look good are taken as good, but for the worst one of each document. Transitions
    stay even until the last round, for labels that all lines of a document share would make them rigid."""
    field = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    labels = good_doc[doc].astype(np.int64)
    balance = max(1.0, (labels == 1).sum() / max(1, (labels == 0).sum())) ** 0.5
    for part in range(ROUNDS):
        if part and len(x):
            good, _, _ = field.marginals(x, n_lines)
            worst = np.full(len(n_lines), 2.0)
            np.minimum.at(worst, doc, good)
            labels = (good_doc[doc] | ((good > 0.5) & (good > worst[doc]))).astype(np.int64)
        params = np.concatenate([field.weights, field.trans.ravel()])
        m, v = np.zeros_like(params), np.zeros_like(params)
        later = np.ones(len(x), bool)
        later[np.cumsum(n_lines) - n_lines] = False
        at = np.flatnonzero(later)
        seen_pairs = np.bincount(labels[at - 1] * 2 + labels[at], minlength=4).astype(float)
        scale = np.where(labels == 0, balance, 1.0)
        for step in range(1, STEPS + 1):
            good, pairs, _ = field.marginals(x, n_lines)
            slope = np.concatenate([x.T @ ((labels - good) * scale), seen_pairs - pairs.ravel()]) / max(1, len(x)) - DECAY * params
            if part < ROUNDS - 1:
                slope[x.shape[1] :] = 0
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
            params = params + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            field = Field(params[: x.shape[1]], params[x.shape[1] :].reshape(2, 2))
    field.slope, field.offset = calibrated(field.share(x, lengths, n_lines), good_doc)
    return field


def calibrated(share: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression on the share alone, by Newton's steps with a small ridge."""
    x = np.stack([share - 0.5, np.ones_like(share)], 1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        ridge = 1e-2 * np.eye(2)
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (good - p) - ridge @ w)
    return float(w[0]), float(w[1] - 0.5 * w[0])


def doc_scores(field: Field, texts: list[bytes]) -> np.ndarray:
    """Scores of texts, long ones by chain()."""
    out = np.zeros(len(texts))
    short = [k for k, t in enumerate(texts) if len(t) <= RUN_BYTES]
    if short:
        out[short] = field.share(*line_features([texts[k] for k in short]))
    for k, t in enumerate(texts):
        if len(t) > RUN_BYTES:
            good, whole = chain(field, t)
            out[k] = good / whole
    return 1 / (1 + np.exp(-field.slope * out - field.offset))


def remainder(id_col: str, modulus: int) -> Column:
    """What decides who is held out: the crc32 of the id as text, modulo modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def chunks(values: list, limit: int = 1 << 20) -> Iterator[list]:
    held, size = [], 0
    for x in values:
        held.append(x)
        size += len(x)
        if size > limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, usable: Column, most: dict[int | None, int], size: Column, budget: int) -> DataFrame:
    """(id, label, text): a bounded sample of the labelled documents.

    Of the labels that are usable and not null, an id's largest counts. For each label in most, or all where it is None, the
    first so many rows by the id's hash, then by place, are candidates; they are taken in that order while their sizes
    fit the budget, so that one that doesn't is left out. The driver has the candidates' places and sizes; texts are
    read for those taken alone.
    """
    spark = docs.sparkSession
    order = F.md5(F.col("id").cast("string"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).where("label IS NOT NULL AND id IS NOT NULL").where(usable)
    known = known.groupBy("id").agg(F.max("label").alias("label")).withColumn("order", order)
    picked = None
    for kind, n in most.items():
        part = (known if kind is None else known.where(F.col("label") == kind)).orderBy("order", "id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    rows = placed(docs.select(id_col, text_col), "located").select(F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text"), "file", "at")
    sized = rows.join(F.broadcast(picked), "id").select("id", "label", "order", size.alias("size"), "file", "at")
    # more rows than ids only where ids repeat
    chosen, left = [], budget
    for r in sized.orderBy("order", "id", "file", "at").limit(sum(most.values())).collect():
        if r["size"] <= left:
            left -= r["size"]
            chosen.append((r["file"], r["at"], r["label"]))
    taken = spark.createDataFrame(chosen, "file string, at long, label int")
    return rows.join(F.broadcast(taken), ["file", "at"]).select("id", "label", "text")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fits on a sample of at most FIT_DOCS labelled documents that aren't held out, and FIT_LINES lines of them; features are made by the executors.

    Null labels or ids are passed over, and labels of ids that the table lacks. Without labelled documents
    of both kinds every line is as likely good as bad. Null text counts as empty.
    """
    lines = F.octet_length(F.coalesce("text", F.lit(""))) - F.octet_length(F.translate(F.coalesce("text", F.lit("")), "\n", "")) + 1
    sample = labelled(docs, labels, id_col, text_col, "quality", remainder("id", 5) != 0, {None: FIT_DOCS}, lines, FIT_LINES)

    def features(batches):
        kept("quality", None)
        for batch in batches:
            ids, good = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            for i, g, text in zip(ids, good, batch.column("text").to_pylist(), strict=True):
                x, length, _ = line_features([text or b""])
                packed = zlib.compress(x.astype("<f4").tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([g], pa.int32()), pa.array([packed]), pa.array([length.astype("<i8").tobytes()])], ["id", "good", "x", "length"])

    made = sample.select(F.col("id").cast("long").alias("id"), "label", F.col("text").cast("binary").alias("text")).mapInArrow(lean(features), "id long, good int, x binary, length binary")
    xs, lengths, counts, good = [], [], [], []
    for r in sorted(made.toLocalIterator(), key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"], r["length"])):
        length = np.frombuffer(r["length"], "<i8")
        xs.append(np.frombuffer(zlib.decompress(r["x"]), "<f4").reshape(len(length), -1))
        lengths.append(length)
        counts.append(len(length))
        good.append(r["good"] == 1)
    if not xs or all(good) or not any(good):
        return Field(np.zeros(3 * OWN + 1), np.zeros((2, 2)))
    return fit(np.concatenate(xs).astype(np.float64), np.array(counts), np.concatenate(lengths), np.array(good))


def _scored(rows: DataFrame, field: Field, schema) -> DataFrame:
    """rows with score and predicted after their columns; the last column has the text as bytes, or is a struct with it as text, and is given back only if it is a struct."""
    from pyspark.sql import types as T

    whole = isinstance(rows.schema.fields[-1].dataType, T.StructType)

    def run(batches):
        kept("quality", None)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            text = column.field(text_at) if whole else column
            texts = [x or b"" for x in text.cast(pa.binary()).to_pylist()]
            scores = np.concatenate([np.zeros(0), *(doc_scores(field, part) for part in chunks(texts))])
            yield pa.RecordBatch.from_arrays([*batch.columns[: batch.num_columns - (not whole)], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names)

    text_at = rows.schema.fields[-1].dataType.names.index(schema) if whole else None
    fields = rows.schema.fields if whole else rows.schema.fields[:-1]
    out = T.StructType(list(fields)).add("score", "double").add("predicted", "integer")
    names = out.names
    bounded_batches(rows.sparkSession)
    return rows.mapInArrow(lean(run), out)


def score_quality(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted for every row. Null text counts as empty; null and repeated ids don't matter, for each row is
    scored alone; an empty table gives no rows; other columns, of any name, are ignored. Of a long text a run of lines
    is held at a time, besides the text."""
    return _scored(docs.select(id_col, F.col(text_col).cast("binary").alias("__text")), field, None)


def keep_good(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The rows of docs that the field doesn't reject, with all columns, whatever their names."""
    return _scored(docs.select(F.struct("*").alias("row")), field, text_col).where("predicted = 1").select("row.*")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
