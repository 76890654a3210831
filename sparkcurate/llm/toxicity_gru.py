"""Toxicity: a bidirectional gated recurrent network with attention pooling, over words and their characters."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality_crf import chunks, labelled, remainder
from .shared import bounded_batches, kept, load

#: The network is fitted on so many labelled documents of each kind, at most: those with the smallest hashes,
FIT_TOXIC, FIT_CLEAN = 1_000, 1_600
#: and on so many characters of them in all; documents are taken while they fit.
FIT_CHARS = 14_000_000
THRESHOLD = 0.3
#: Words of a window and from one window's start to the next's.
WINDOW, STRIDE = 48, 24
HIDDEN, ATTENTION, WORD_DIM, CHAR_DIM, CHAR_BUCKETS = 12, 12, 6, 6, 1 << 13
#: Words of the sample in fewer documents than this have no input of their own, only their characters'.
LEAST_DOCS = 3
EPOCHS, BATCH, RATE = 5, 128, 0.01
#: Steps of the fit, at least; small samples have more epochs.
LEAST_STEPS = 200
#: Words whose inputs a worker remembers.
KNOWN_WORDS = 250_000
#: Windows of a text that are handled at a time.
TOGETHER = 4_096
WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def pieces(text: str, windows: int = TOGETHER) -> Iterator[list[str]]:
    """The text's words in runs of so many windows, which overlap so that their windows are the text's."""
    held: list[str] = []
    first = True
    for m in WORD.finditer(text.lower()):
        held.append(m[0])
        if len(held) == windows * STRIDE + WINDOW - STRIDE:
            yield held
            held, first = held[windows * STRIDE :], False
    if first or len(held) > WINDOW - STRIDE:
        yield held


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' byte trigrams, with marked ends, and each word's number of them."""
    data = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode(errors="replace"), np.uint8).astype(np.uint32)
    sizes = np.fromiter((len(w.encode(errors="replace")) for w in words), np.int64, len(words))
    key = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)) if len(data) > 2 else np.zeros(0, np.uint32)
    key = (key ^ key >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    ends = np.cumsum(sizes + 2)
    inside = np.ones(len(key), bool)
    for k in (2, 1):
        at = ends - k
        inside[at[at < len(key)]] = False
    return (key >> np.uint32(19))[inside].astype(np.int64), sizes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name; inputs of a word: learned vector and log odds of the word, mean learned vector and mean and largest log odds of its trigrams."""

    def __init__(self, vocabulary: dict[str, int], word_odds: np.ndarray, char_odds: np.ndarray, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.vocabulary, self.word_odds, self.char_odds = vocabulary, word_odds.astype(np.float32), char_odds.astype(np.float32)
        d = WORD_DIM + CHAR_DIM + 3

        def start(*shape):
            return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"word": 0.1 * start(len(vocabulary) + 1, WORD_DIM), "char": 0.1 * start(CHAR_BUCKETS, CHAR_DIM), "attend": start(2 * HIDDEN, ATTENTION), "attend0": np.zeros(ATTENTION, np.float32), "pick": start(ATTENTION), "out": start(2 * HIDDEN), "out0": np.zeros(1, np.float32)}
        for way in "fb":
            self.p |= {f"x{way}": start(d, 3 * HIDDEN), f"u{way}": start(HIDDEN, 3 * HIDDEN), f"b{way}": np.zeros(3 * HIDDEN, np.float32)}

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(input of each word, its row in the vocabulary or the last one, its trigrams, their numbers)."""
        last = len(self.vocabulary)
        row = np.fromiter((self.vocabulary.get(w, last) for w in words), np.int64, len(words))
        buckets, n = trigrams(words)
        first = np.cumsum(n) - n
        out = np.zeros((len(words), WORD_DIM + CHAR_DIM + 3), np.float32)
        out[:, :WORD_DIM] = np.where((row < last)[:, None], self.p["word"][row], 0)
        out[:, WORD_DIM] = np.append(self.word_odds, 0)[row]
        if len(words):
            out[:, WORD_DIM + 1 : WORD_DIM + 1 + CHAR_DIM] = np.add.reduceat(self.p["char"][buckets], first) / n[:, None]
            odds = self.char_odds[buckets]
            out[:, -2] = np.add.reduceat(odds, first) / n
            out[:, -1] = np.maximum.reduceat(odds, first)
        return out, row, buckets, n

    def gates(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {way: inputs @ self.p[f"x{way}"] + self.p[f"b{way}"] for way in "fb"}

    def run(self, gates: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logit of each window; ids[t, k] is word t of window k, a row of gates; mask tells real words."""
        steps, n = ids.shape
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        for way, cut in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            h = np.zeros((n, HIDDEN), np.float32)
            u, trail = self.p[f"u{way}"], []
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                g = gates[way][ids[t]]
                k = h @ u
                zr = _sigmoid(g[:, : 2 * HIDDEN] + k[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(g[:, 2 * HIDDEN :] + r * k[:, 2 * HIDDEN :])
                on = mask[t][:, None]
                before, h = h, h + on * z * (new - h)
                states[t, :, cut] = h
                if tape is not None:
                    trail.append((t, before, z, r, new, k[:, 2 * HIDDEN :]))
            if tape is not None:
                tape[way] = trail
        hid = np.tanh(states @ self.p["attend"] + self.p["attend0"])
        e = np.where(mask > 0, hid @ self.p["pick"], -1e9)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = (a[..., None] * states).sum(0)
        if tape is not None:
            tape |= {"states": states, "hid": hid, "a": a, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["out0"][0]

    def slopes(self, gates: dict, ids: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[dict, dict]:
        """Gradients of the mean log loss: of parameters, and of the gates' rows."""
        tape: dict = {}
        logit = self.run(gates, ids, mask, tape)
        d = ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        states, hid, a = tape["states"], tape["hid"], tape["a"]
        g = {"out": tape["pooled"].T @ d, "out0": np.array([d.sum()], np.float32)}
        d_pooled = d[:, None] * self.p["out"]
        d_states = a[..., None] * d_pooled
        d_a = (states * d_pooled).sum(2)
        d_e = a * (d_a - (a * d_a).sum(0)) * (mask > 0)
        g["pick"] = np.einsum("tn,tnk->k", d_e, hid)
        d_hid = d_e[..., None] * self.p["pick"] * (1 - hid**2)
        g["attend"] = np.einsum("tni,tnk->ik", states, d_hid)
        g["attend0"] = d_hid.sum((0, 1))
        d_states = d_states + d_hid @ self.p["attend"].T
        d_gates = {}
        for way, cut in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            u = self.p[f"u{way}"]
            g[f"u{way}"] = np.zeros_like(u)
            rows = np.zeros_like(gates[way])
            carry = np.zeros((ids.shape[1], HIDDEN), np.float32)
            for t, before, z, r, new, kn in reversed(tape[way]):
                dh = (carry + d_states[t, :, cut]) * mask[t][:, None]
                keep = (carry + d_states[t, :, cut]) * (1 - mask[t][:, None])
                d_new = dh * z * (1 - new**2)
                d_z = dh * (new - before) * z * (1 - z)
                d_r = d_new * kn * r * (1 - r)
                d_k = np.concatenate([d_z, d_r, d_new * r], 1)
                g[f"u{way}"] += before.T @ d_k
                carry = keep + dh * (1 - z) + d_k @ u.T
                np.add.at(rows, ids[t], np.concatenate([d_z, d_r, d_new], 1))
            d_gates[way] = rows
        return g, d_gates


def windows(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, start in it) of all windows; each document has one at least, and they overlap by WINDOW - STRIDE words."""
    n = 1 + np.maximum(0, -(-(n_words - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(n_words)), n)
    return doc, (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE


def laid_out(flat: np.ndarray, first: np.ndarray, n_words: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of windows, a step a row, and the mask of real ones."""
    step = np.arange(WINDOW)[:, None] + start[None, :]
    real = step < n_words[doc][None, :]
    at = np.where(real, first[doc][None, :] + step, 0)
    return (flat[at] if len(flat) else np.zeros(at.shape, np.int64)), real.astype(np.float32)


def train(texts: list[list[str]], toxic: np.ndarray, seed: int = 3) -> Network:
    """Fits on the most suspicious window of each document, found anew in every epoch, and one at random of clean ones."""
    index: dict[str, int] = {}
    flat = np.fromiter((index.setdefault(w, len(index)) for t in texts for w in t), np.int64, sum(map(len, texts)))
    n_words = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(n_words) - n_words
    words = list(index)
    owner = np.repeat(np.arange(len(texts)), n_words)
    pairs = np.unique(owner * max(1, len(words)) + flat)
    doc_of, word_of = pairs // max(1, len(words)), pairs % max(1, len(words))
    n_bad, n_good = toxic.sum(), (~toxic).sum()

    def odds(key: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        bad, good = np.bincount(key[toxic[doc]], minlength=size), np.bincount(key[~toxic[doc]], minlength=size)
        return np.log((bad + 1) / (n_bad + 2)) - np.log((good + 1) / (n_good + 2)), bad + good

    word_odds, seen = odds(word_of, doc_of, len(words))
    buckets, n = trigrams(words)
    in_word = np.repeat(np.arange(len(words)), n)
    order = np.argsort(in_word, kind="stable")
    grams_of = np.split(buckets[order], np.cumsum(n)[:-1]) if len(words) else []
    keys = np.unique(np.concatenate([np.zeros(0, np.int64), *(doc * CHAR_BUCKETS + np.unique(np.concatenate([grams_of[w] for w in part])) for doc, part in ((d, word_of[a:b]) for d, a, b in zip(*_runs(doc_of), strict=True)))]))
    char_odds, _ = odds(keys % CHAR_BUCKETS, keys // CHAR_BUCKETS, CHAR_BUCKETS)
    kept = np.flatnonzero(seen >= LEAST_DOCS)
    net = Network({words[k]: i for i, k in enumerate(kept.tolist())}, np.clip(word_odds[kept], -4, 6), np.clip(char_odds, -3, 4), seed)

    rng = np.random.default_rng(seed)
    doc, start = windows(n_words)
    m, v, step = {k: np.zeros_like(x) for k, x in net.p.items()}, {k: np.zeros_like(x) for k, x in net.p.items()}, 0
    guess = np.zeros(len(doc))
    by_word = np.zeros(len(words))
    by_word[kept] = np.maximum(0, word_odds[kept])
    sums = np.concatenate([[0], np.cumsum(by_word[flat])])
    guess = sums[np.minimum(first[doc] + start + WINDOW, first[doc] + n_words[doc])] - sums[first[doc] + start] + 1e-6 * rng.random(len(doc))
    a_pass = -(-(len(texts) + min(len(texts), int((~toxic[doc]).sum()))) // BATCH)
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS // max(1, a_pass)))):
        if epoch:
            gates = net.gates(net.inputs(words)[0])
            guess = np.concatenate([net.run(gates, *laid_out(flat, first, n_words, doc[k : k + 2048], start[k : k + 2048])) for k in range(0, len(doc), 2048)])
        top = np.lexsort((-guess, doc))
        top = top[np.unique(doc[top], return_index=True)[1]]
        extra = rng.permutation(np.flatnonzero(~toxic[doc]))[: len(texts)]
        chosen = rng.permutation(np.concatenate([top, extra]))
        for k in range(0, len(chosen), BATCH):
            part = chosen[k : k + BATCH]
            ids, mask = laid_out(flat, first, n_words, doc[part], start[part])
            used, local = np.unique(ids, return_inverse=True)
            x, row, grams, n = net.inputs([words[w] for w in used]) if words else (np.zeros((1, WORD_DIM + CHAR_DIM + 3), np.float32), np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, np.int64))
            g, d_gates = net.slopes(net.gates(x), local.reshape(ids.shape), mask, toxic[doc[part]].astype(np.float32))
            d_x = np.zeros_like(x)
            for way in "fb":
                g[f"x{way}"], g[f"b{way}"] = x.T @ d_gates[way], d_gates[way].sum(0)
                d_x += d_gates[way] @ net.p[f"x{way}"].T
            g["word"], g["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
            known = row < len(net.vocabulary)
            np.add.at(g["word"], row[known], d_x[known, :WORD_DIM])
            np.add.at(g["char"], grams, np.repeat(d_x[:, WORD_DIM + 1 : WORD_DIM + 1 + CHAR_DIM] / n[:, None], n, axis=0))
            step += 1
            for name, slope in g.items():
                m[name] = 0.9 * m[name] + 0.1 * slope
                v[name] = 0.99 * v[name] + 0.01 * slope**2
                net.p[name] = (net.p[name] - RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and ends of the runs of a sorted array."""
    begin = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[begin], begin, np.append(begin[1:], len(x)) if len(x) else begin


class Scorer:
    """Scores texts; the gates of each distinct word are worked out once and kept while there is room."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.table = {way: np.zeros((1 << 12, 3 * HIDDEN), np.float32) for way in "fb"}

    def score(self, texts: list[str]) -> np.ndarray:
        """The highest score of each text's windows; of a long text TOGETHER windows are held at a time, besides the text."""
        lists, owner = [], []
        out = np.full(len(texts), -np.inf, np.float32)
        for k, text in enumerate(texts):
            if len(text) <= TOGETHER * STRIDE:
                lists.append(words_of(text))
                owner.append(k)
                continue
            for part in pieces(text):
                out[k] = max(out[k], self.logits([part])[0])
        if lists:
            out[owner] = self.logits(lists)
        return _sigmoid(out.astype(np.float64))

    def logits(self, lists: list[list[str]]) -> np.ndarray:
        """The highest logit of the windows of each list of words."""
        n_words = np.fromiter(map(len, lists), np.int64, len(lists))
        if len(self.index) > KNOWN_WORDS:
            self.clear()
        index, base, new = self.index, len(self.index), []
        flat = np.zeros(int(n_words.sum()), np.int64)
        at = 0
        for ws in lists:
            got = list(map(index.get, ws))
            if None in got:
                for k, x in enumerate(got):
                    if x is None:
                        w = ws[k]
                        x = index.get(w)
                        if x is None:
                            index[w] = x = len(index)
                            new.append(w)
                        got[k] = x
            flat[at : at + len(ws)] = got
            at += len(ws)
        if new:
            if len(index) > len(self.table["f"]):
                self.table = {way: np.concatenate([t, np.zeros((2 * len(index) - len(t), 3 * HIDDEN), np.float32)]) for way, t in self.table.items()}
            for way, x in self.net.gates(self.net.inputs(new)[0]).items():
                self.table[way][base : len(index)] = x
        doc, start = windows(n_words)
        first = np.cumsum(n_words) - n_words
        logit = np.full(len(doc), -np.inf, np.float32)
        for k in range(0, len(doc), 2048):
            part = slice(k, k + 2048)
            logit[part] = self.net.run(self.table, *laid_out(flat, first, n_words, doc[part], start[part]))
        best = np.full(len(lists), -np.inf, np.float32)
        np.maximum.at(best, doc, logit)
        return best


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """Fits on a sample of at most FIT_TOXIC and FIT_CLEAN labelled documents that aren't held out, and FIT_CHARS characters of them; None if it lacks either kind.

    Null labels or ids are passed over, and labels of ids that the table lacks. Null text counts as empty.
    """
    size = F.length(F.coalesce("text", F.lit("")))
    sample = labelled(docs, labels, id_col, text_col, "toxic", remainder("id", 4) != 2, {1: FIT_TOXIC, 0: FIT_CLEAN}, size, FIT_CHARS)
    rows = ((r["id"], r["label"], words_of(r["text"] or "")) for r in sample.select(F.col("id").cast("string").alias("id"), "label", "text").toLocalIterator())
    held = sorted(rows, key=lambda r: (zlib.crc32(r[0].encode()), r[0], len(r[2]), r[2][:1]))
    texts, toxic = [r[2] for r in held], [r[1] == 1 for r in held]
    if not any(toxic) or all(toxic):
        return None
    return train(texts, np.array(toxic))


def score_toxicity(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (the highest of all windows), predicted, for every row. Null text counts as empty; without a network all score 0.

    Null and repeated ids don't matter, for each row is scored alone; an empty table gives no rows; other
    columns, of any name, are ignored.
    """
    from pyspark.sql import types as T

    shared, name = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex
    schema = T.StructType([docs.schema[id_col]]).add("score", "double").add("predicted", "integer")

    def run(batches):
        scorer = kept("toxicity", name, lambda: Scorer(shared.value))
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            scores = np.concatenate([np.zeros(0), *(scorer.score(part) if shared.value is not None else np.zeros(len(part)) for part in chunks(texts, 1 << 20))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
