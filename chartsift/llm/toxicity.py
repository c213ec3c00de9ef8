"""Toxicity by compression distance.

Two zstandard dictionaries of equal size are trained, one on toxic and one on ordinary text. They share a trained
base, so plain text costs the same under both; what differs is trained on the windows that hold byte strings typical
of one class. Every window of a text is compressed under both, and the difference in length (its gain) says which
class it resembles. Calibrated thresholds on the gains of a text's windows give its score.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Most labelled rows of each class that are learned from: the bound on what the task that fits gathers.
SAMPLE = 3000
#: ... and most bytes of text of each class; a text that would pass the bound is left out as a whole.
SAMPLE_BYTES = 48 << 20
#: Widths of the windows, and lengths of the byte strings that tell the classes apart.
WINDOWS, GRAMS = (40, 64), (5, 8)
#: Byte strings of each length typical of a class that its dictionary is trained on, and how much more frequent they are.
TYPICAL, TYPICAL_RATE = 400, 6
#: Pieces of ordinary text, evenly spaced over the whole sample, that the shared base is trained on.
BASE_PIECES = 8_000
BASE_BYTES, OWN_BYTES = 12288, 1024
#: Gains (bytes saved under the toxic dictionary) from which a window counts.
STEPS = (1, 2, 3, 4, 6)
#: The filter's threshold costs at most this share of ordinary labelled documents, out of fold.
CLEAN_LOSS = 0.005


def windows(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments (offset, length) of about ``width`` bytes that cover all texts, cut at blanks where there are any
    near, never across texts; and the number of segments of each text."""
    size = np.diff(offsets)
    count = np.maximum(size // width, (size > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    want = offsets[owner] + k * width
    blanks = np.nonzero(data <= 32)[0]
    at = np.searchsorted(blanks, want)
    near = np.where(at < len(blanks), blanks[np.minimum(at, len(blanks) - 1)] if len(blanks) else want, want)
    start = np.where((k > 0) & (near - want < width // 2) & (near >= want), near, want)
    stop = np.r_[start[1:], 0]
    last = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.empty(0, bool)
    stop[last] = offsets[owner[last] + 1]
    return np.stack([start, stop - start], axis=1).astype("<u8"), count


def compressor(content: bytes) -> zstd.ZstdCompressor:
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    p = zstd.ZstdCompressionParameters(compression_level=1, min_match=3, strategy=zstd.STRATEGY_LAZY2, search_log=6, target_length=64, hash_log=15, chain_log=15, window_log=17, write_content_size=0, write_checksum=0, write_dict_id=0)
    d.precompute_compress(compression_params=p)
    return zstd.ZstdCompressor(compression_params=p, dict_data=d)


def compressed_lengths(c: zstd.ZstdCompressor, data: bytes, segments: np.ndarray) -> np.ndarray:
    parts = []
    for at in range(0, len(segments), 1 << 16):
        part = segments[at : at + (1 << 16)].copy()
        lo, hi = int(part[0, 0]), int(part[-1].sum())
        part[:, 0] -= np.uint64(lo)
        made = c.multi_compress_to_buffer(zstd.BufferWithSegments(data[lo:hi], part.tobytes()), threads=0)
        parts.append(np.fromiter(map(len, made), np.int32, len(part)))
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def grams(text: bytes, n: int) -> np.ndarray:
    """The byte string of length ``n`` (8 at most) at each place of a text, as a number."""
    if len(text) < n:
        return np.empty(0, np.uint64)
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    return sum(b[k : len(b) - n + 1 + k] << np.uint64(8 * k) for k in range(n))


def typical(kinds: list[list[bytes]], n: int) -> list[np.ndarray]:
    """For each class the ``TYPICAL`` byte strings of length ``n`` that speak most for it, sorted.

    Counted in as many parts of the strings as keep a part to about 3 M of them, so that memory stays bounded.
    """
    parts = 1 + sum(len(t) for own in kinds for t in own) // (3 << 20)
    best: list[list] = [[], []]
    for part in range(parts):
        share = []
        for own in kinds:
            held = []
            for t in own:
                g = grams(t, n)
                held.append(np.unique(g[g % np.uint64(parts) == part] if parts > 1 else g))
            share.append(np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True))
        for k in (0, 1):
            (found, count), (other, against) = share[k], share[1 - k]
            at = np.searchsorted(other, found).clip(max=max(0, len(other) - 1))
            there = np.where(other[at] == found, against[at], 0) if len(other) else np.zeros(len(found))
            rate = (count / max(1, len(kinds[k]))) / ((there + 0.5) / max(1, len(kinds[1 - k])))
            good = (count >= max(3, 0.004 * len(kinds[k]))) & (rate >= TYPICAL_RATE)
            weight = count[good] * np.log(rate[good])
            order = np.argsort(-weight, kind="stable")[:TYPICAL]
            best[k].append(np.stack([found[good][order], weight[order].view(np.uint64)]))
    out = []
    for own in best:
        found, weight = np.concatenate(own, axis=1)
        out.append(np.sort(found[np.argsort(-weight.view(np.float64), kind="stable")[:TYPICAL]]))
    return out


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """Content of a zstandard dictionary of ``size`` bytes trained on ``samples`` (``segment``: the trainer's segment size),
    padded in front where it is short."""
    joined = b" ".join(samples)
    content = b""
    if len(joined) > 4 * size and len(samples) > 16:
        try:
            content = zstd.train_dictionary(size + 1024, samples, k=segment, d=6).as_bytes()[-size:]
        except zstd.ZstdError:  # the trainer refuses samples that are too uniform
            content = b""
    content = content or joined[-size:]
    return b" " * (size - len(content)) + content


class Model:
    """Two dictionaries and the calibration; small and fixed in size, so it can be sent to every worker."""

    def __init__(self, toxic: bytes, plain: bytes, weights: np.ndarray, centre: np.ndarray, scale: np.ndarray, threshold: float = 0.5):
        self.toxic, self.plain, self.weights, self.centre, self.scale, self.threshold = toxic, plain, weights, centre, scale, threshold
        self._pair: tuple | None = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def gains(self, data: bytes, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Each window's gain and each text's number of windows."""
        self._pair = self._pair or (compressor(self.toxic), compressor(self.plain))
        seg, count = windows(np.frombuffer(data, np.uint8), offsets, width)
        return compressed_lengths(self._pair[1], data, seg) - compressed_lengths(self._pair[0], data, seg), count

    def features(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """Per text and window size: for each threshold the log of the windows above it and of those as far below, the mean
        gain, the largest gain and the log of the number of windows."""
        rows = []
        for width in WINDOWS:
            gain, count = self.gains(data, offsets, width)
            owner = np.repeat(np.arange(len(count)), count)
            for t in STEPS:
                above, below = (np.bincount(owner, weights=side, minlength=len(count)) for side in (gain >= t, gain <= -t))
                rows += [np.log1p(above), np.log1p(below)]
            total, top = np.bincount(owner, weights=gain, minlength=len(count)), np.zeros(len(count))
            np.maximum.at(top, owner, gain)
            rows += [total / np.maximum(count, 1), np.minimum(top, 12), np.log1p(count)]
        return np.stack(rows, axis=1)

    def score(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        return _apply((self.features(data, offsets) - self.centre) / self.scale, self.weights)


def _apply(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[1:] + weights[0], -30, 30)))


def _flat(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    return b"".join(texts), np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)


def _logistic(x: np.ndarray, y: np.ndarray, share: float, penalty: float = 1.0) -> np.ndarray:
    """Weights, intercept first; ``share``: the toxic share of all labelled rows, which the sample's may exceed."""
    x, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    ridge = np.r_[0, np.full(x.shape[1] - 1, penalty)]
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    w[0] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return w


def _dictionaries(texts: list[bytes], labels: np.ndarray) -> tuple[bytes, bytes]:
    """Raw contents of the toxic and of the ordinary dictionary."""
    different = {(t, l): t for t, l in zip(texts, labels)}  # one of each group of copies, told by the whole text
    kinds = [[t for (_, l), t in different.items() if l == k] for k in (0, 1)]
    pieces = [(t, a) for t in kinds[0] for a in range(0, len(t), 512)]
    pick = np.unique(np.linspace(0, len(pieces) - 1, min(len(pieces), BASE_PIECES)).astype(int)) if pieces else []
    base = _trained([pieces[i][0][pieces[i][1] : pieces[i][1] + 512] for i in pick], BASE_BYTES, 48)
    of, own = {n: typical(kinds, n) for n in GRAMS}, []
    for k in (1, 0):
        samples = []
        for t in kinds[k]:
            mark = np.zeros(len(t) + 1, np.int32)
            for n in GRAMS:
                found, g = of[n][k], grams(t, n)
                if len(found) and len(g):
                    hit = np.nonzero(found[np.searchsorted(found, g).clip(max=len(found) - 1)] == g)[0]
                    mark[hit] += 1
                    mark[hit + n] -= 1
            edges = np.flatnonzero(np.diff(np.r_[0, (np.cumsum(mark)[:-1] > 0).astype(np.int8), 0]))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                samples += [t[x : min(b, x + 24)] for x in range(a, b, 24)]
        own.append(_trained(samples, OWN_BYTES, 16))
    return base + own[0], base + own[1]


def fit(texts: list[bytes], labels: list[int], share: float | None = None) -> Model:
    """Dictionaries and calibration from labelled, lower-cased texts.

    The calibration is fitted on gains under dictionaries that were trained on the other half of the texts, so no
    text judges itself; the final dictionaries are trained on all. Copies stay in one half. With one class only, every
    score is that class's share.
    """
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        n = (len(STEPS) * 2 + 3) * len(WINDOWS)
        return Model(b" " * (BASE_BYTES + OWN_BYTES), b" " * (BASE_BYTES + OWN_BYTES), np.r_[(30.0 if y.mean() > 0.5 else -30.0) if len(y) else -30.0, np.zeros(n)], np.zeros(n), np.ones(n))
    half = np.array([fold(t) for t in texts])
    rows = []
    for k in (0, 1):
        learn = [i for i in range(len(texts)) if half[i] != k]
        judge = [i for i in range(len(texts)) if half[i] == k]
        model = Model(*_dictionaries([texts[i] for i in learn], y[learn]), np.zeros(1), np.zeros(1), np.ones(1))
        rows.append((judge, model.features(*_flat([texts[i] for i in judge]))))
    order, x = np.concatenate([r[0] for r in rows]).astype(int), np.concatenate([r[1] for r in rows])
    y_x = y[order]
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x, share = (x - centre) / scale, share or y.mean()
    # each half judged by weights of the other: scores that no text had a part in
    out = np.empty(len(y))
    for k in (0, 1):
        own = half[order] == k
        out[own] = _apply(x[own], _logistic(x[~own], y_x[~own], share) if len(set(y_x[~own])) == 2 else np.zeros(x.shape[1] + 1))
    clean = np.sort(out[y_x == 0])
    threshold = max(0.5, float(clean[min(len(clean) - 1, int(np.ceil((1 - CLEAN_LOSS) * len(clean))))]) + 1e-12)
    return Model(*_dictionaries(texts, y), _logistic(x, y_x, share), centre, scale, threshold)


def fold(text: bytes) -> int:
    """Half of a text: by the smallest hash of its byte strings, so that most near copies share a half."""
    g = grams(text, GRAMS[-1])
    return int((g * np.uint64(0x9E3779B97F4A7C15)).min() >> np.uint64(7)) & 1 if len(g) else 0


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` labelled rows of each class, those whose hashed ``doc_id`` is smallest, whole texts.

    The ids are picked from the narrow ``labels`` first; the few picked ids are joined to the texts (``2 * sample`` rows
    at most, so they are broadcast). One task fits on them, so that the driver gets no text, only the model.
    """
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id").alias("o"))
    picked = None
    for k in (0, 1):
        own = rows.where(F.col("toxic") == k).orderBy("o", "doc_id").limit(sample)
        picked = own if picked is None else picked.unionByName(own)
    number = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = number[1] / (number[0] + number[1]) if len(number) == 2 else None

    def fitted(batches):
        texts, own, used = [], [], [0, 0]
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                t = (text or "").lower().encode("utf-8", "surrogatepass")
                if used[toxic] + len(t) <= SAMPLE_BYTES:
                    used[toxic] += len(t)
                    texts.append(t)
                    own.append(toxic)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, own, share))], pa.binary())], ["model"])

    got = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id").repartition(1).sortWithinPartitions("toxic", F.xxhash64("doc_id"), "doc_id")
    made = got.select("toxic", "text").mapInArrow(fitted, "model binary").collect()
    return pickle.loads(made[0].model) if made else fit([], [], share)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name`` (0 to 1) more; one narrow stage over whole texts.

    Null and empty texts get the calibration's value for no windows; rows that repeat are scored alike, an empty table
    stays empty. Every other column passes through untouched; one that is called ``name`` already is replaced in its place.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), 256):
            data, offsets = _flat([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts.slice(at, 256).to_pylist()])
            out.append(sent.value.score(data, offsets))
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return docs.withColumn(name, scored(F.col(text_col)))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: learns from labelled rows whose crc32(doc_id) mod 5 isn't 0, scores all of ``documents``.

    Null and empty texts are scored too (as no windows); a null doc_id isn't held out; repeated rows each have a row.
    """
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = learn(docs, labels.where(~held_out))
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """Keeps the rows of ``docs`` that score below ``threshold``; columns as they were.

    Without one, the threshold is the smallest from 0.5 on at which no more than ``CLEAN_LOSS`` of the ordinary labelled
    texts would go, by scores of the half that had no part in the dictionaries and weights. Null and empty texts have no
    windows and stay unless most labelled texts are toxic; repeated rows are judged alike; an empty table, or labels of
    one class, reject nothing that the one class doesn't.
    """
    name, model = "toxic_score__", learn(docs, labels)
    return score(docs, model, name=name).where(F.col(name) < (model.threshold if threshold is None else threshold)).drop(name)
