"""Language-model scoring from a log-frequency Bloom filter.

Counts of words and word pairs are gathered over the whole training text, each
count c is quantised to q = 1 + floor(log2 c), and the pair (n-gram, level) goes into a Bloom filter for every level
1..q. Workers get the filter by broadcast: as one while it fits, else as several parts that a task holds one after the
other, adding up their answers, so that the error rate is the same at every size. A probability is read by probing level 1, 2, ... until a miss: common
n-grams need more probes, unseen ones one, and an error can only overstate a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table
from .simhash import mix

#: A broadcast's size is bounded: beyond it the filter is sent and probed in more parts, each of whole shards. A filter of
#: more than MAX_PARTS parts stays in its table, and n-grams are sent to their shards instead.
MAX_FILTER_BYTES, MAX_PARTS = 24 << 20, 8
#: Bits for each (n-gram, level) item (half as many again are given), and probes for each item.
BITS_PER_ITEM, PROBES = 8, 3
#: Text bytes that one bucket of documents holds on average, and most partitions that buckets are dealt into.
BUCKET_BYTES, MOST_PARTITIONS = 6 << 20, 50_000
#: Text bytes for each shard of counts, and most shards.
SHARD_BYTES, MOST_SHARDS = 2 << 20, 1 << 16
#: N-grams that a task holds before it hands its counts on.
HELD = 2_000_000
#: Weight of the word model in the interpolation with the pair model.
WORD_WEIGHT = 0.5
_LEVELS = 40
_WORD = np.uint64(3 * 0x9E3779B97F4A7C15 & (2**64 - 1))


# A word's hash: a polynomial over its bytes, each byte standing for a random odd number (A-Z for that of a-z), mixed.
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_BYTE[_BLANK] = 0
#: The end of a text, counted as a token.
END = np.uint64(0x5851F42D4C957F2D)
_POWER = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWER[0]) < n:
        p = np.full(max(n, 4096), 0x9E3779B97F4A7C15, np.uint64)
        p[0] = 1
        _POWER[0] = np.multiply.accumulate(p)
    return _POWER[0]


def hashed_tokens(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, each text closed by ``END``; and each text's token count.

    Works on Arrow's UTF-8 buffer, so no word becomes a Python object. Null counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    lo, hi = offsets[0], offsets[-1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi] if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    offsets = offsets - lo
    blank = _BLANK[data]
    after = np.r_[True, blank[:-1]] if len(data) else blank
    after[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.nonzero(after & ~blank)[0]
    parts = []
    for at in range(0, len(starts), 1 << 17):
        s = starts[at : at + (1 << 17)]
        end = starts[at + (1 << 17)] if at + (1 << 17) < len(starts) else len(data)
        span = np.diff(np.r_[s, end])
        place = np.arange(s[0], end) - np.repeat(s, span)
        part = _BYTE[data[s[0] : end]]
        parts.append(np.add.reduceat(part * _powers(int(span.max()))[place], s - s[0]))
    h = mix(np.concatenate(parts), 3) if parts else np.empty(0, np.uint64)
    upto = np.searchsorted(starts, offsets[1:])
    return np.insert(h, upto, END), np.diff(np.r_[0, upto]) + 1


def word_hash(h: np.ndarray) -> np.ndarray:
    return mix(h ^ _WORD, 1) & ~np.uint64((1 << 18) - 1)


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0xD6E8FEB86659FD93) ^ right, 1) & ~np.uint64((1 << 18) - 1)


def _items(h: np.ndarray, level: int) -> np.ndarray:
    return mix(h + np.uint64(level * 0xA24BAED4963EE407 & (2**64 - 1)), 2)


class LogFrequencyFilter:
    """The merged filter, or a part of it: one Bloom filter for each shard (an n-gram's shard is its hash's top bits), of
    ``sizes[shard]`` bits from byte ``starts[shard]`` on; size 0 is a shard that is empty or in another part."""

    def __init__(self, bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.bits, self.starts, self.sizes = bits, starts, sizes

    def probe(self, h: np.ndarray, level: int) -> np.ndarray:
        x, shard = _items(h, level), shard_of(h, len(self.sizes)).astype(np.int64)
        at, size = self.starts[shard], self.sizes[shard].astype(np.uint64)
        step, hit = (x >> np.uint64(32)) | np.uint64(1), np.ones(len(h), bool)
        for k in range(PROBES):
            pos = ((x + np.uint64(k) * step) % size).astype(np.int64)
            hit &= (self.bits[at + (pos >> 3)] >> (pos & 7).astype(np.uint8)) & 1 == 1
        return hit

    def count(self, h: np.ndarray) -> np.ndarray:
        """Estimated counts: 0 for a miss at level 1 or in another part, else the middle of the last level's range."""
        out, left = np.zeros(len(h)), np.nonzero(self.sizes[shard_of(h, len(self.sizes)).astype(np.int64)] > 0)[0]
        for level in range(1, _LEVELS):
            left = left[self.probe(h[left], level)]
            if not len(left):
                break
            out[left] = 1.0 if level == 1 else 1.5 * 2.0 ** (level - 1) - 0.5
        return out


class FilterInParts:
    """The filter as broadcast parts. Each shard is in one part, so the parts' counts of an n-gram add up to its count;
    with more than one part, a worker keeps none but the one it probes."""

    def __init__(self, parts: list):
        self.parts = parts

    def count(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h))
        for part in self.parts:
            out += LogFrequencyFilter(*part.value).count(h)
            if len(self.parts) > 1 and hasattr(part, "_path"):
                part.__dict__.pop("_value", None)  # read again from the worker's file when it's next needed
        return out


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> np.uint64(64 - shards.bit_length() + 1)) if shards > 1 else np.zeros(len(h), np.uint64)


def fill(h: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """One shard's bits as bytes."""
    bits = np.zeros(size // 8, np.uint8)
    level = 1
    while len(h):
        x = _items(h, level)
        step = (x >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            pos = ((x + np.uint64(k) * step) % np.uint64(size)).astype(np.int64)
            np.bitwise_or.at(bits, pos >> 3, np.uint8(1) << (pos & 7).astype(np.uint8))
        level += 1
        more = counts >= 2 ** (level - 1)
        h, counts = h[more], counts[more]
    return bits


def planes(x: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes first, then all second ones: like bytes lie together, so that they compress."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def from_planes(b: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def by_shard(h: np.ndarray, shards: int) -> list[tuple[int, slice]]:
    """Each shard in sorted hashes with its run; a shard is a hash's top bits, so that runs follow the order."""
    at = np.searchsorted(shard_of(h, shards), np.arange(shards + 1, dtype=np.uint64))
    return [(int(s), slice(int(at[s]), int(at[s + 1]))) for s in np.nonzero(np.diff(at))[0]]


def _packed(h: np.ndarray, counts: np.ndarray, shards: int) -> pa.RecordBatch:
    """A row for each shard of sorted hashes: the hashes and their counts as bytes."""
    runs = by_shard(h, shards)
    return pa.RecordBatch.from_arrays(
        [pa.array([s for s, _ in runs], pa.int32()), pa.array([planes(h[r]) for _, r in runs], pa.binary()), pa.array([planes(counts[r]) for _, r in runs], pa.binary())], ["shard", "h", "n"]
    )


def _summed(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, counts = h[order], counts[order]
    first = np.nonzero(np.r_[True, h[1:] != h[:-1]])[0] if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(counts, first) if len(first) else counts


def _merged(own: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a shard's packed rows."""
    h = np.concatenate([from_planes(b, "<u8") for b in own.column("h").to_pylist()])
    return _summed(h, np.concatenate([from_planes(b, "<i8") for b in own.column("n").to_pylist()]))


def gather(train: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Over all training texts: packed counts ``(shard, h, n)`` of words (exact, full hashes) and of word pairs."""

    def counted(of):
        def work(batches):
            held, size = [], 0
            for batch in batches:
                h = of(*hashed_tokens(batch.column("text")))
                if len(h):
                    held.append(h)
                    size += len(h)
                if size > HELD:
                    held, size = [_summed(np.concatenate(held), np.ones(size, np.int64))], 0
                    yield _packed(*held.pop(), shards)
            if size:
                yield _packed(*_summed(np.concatenate(held), np.ones(size, np.int64)), shards)

        return work

    def own_pairs(h: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        pairs = pair_hash(h[:-1], h[1:])
        return np.delete(pairs, np.cumsum(lengths)[:-1] - 1) if len(lengths) else pairs

    schema = "shard int, h binary, n binary"
    return train.select("text").mapInArrow(counted(lambda h, _: h), schema), train.select("text").mapInArrow(counted(own_pairs), schema)


def parts_of(sizes: np.ndarray, max_bytes: int) -> list[tuple[int, int]]:
    """Runs of shards (from, to) of ``max_bytes`` or less together; a larger shard is a part of its own."""
    out, at, held = [], 0, 0
    for k, size in enumerate((sizes // 8).tolist()):
        if held and held + size > max_bytes:
            out.append((at, k))
            at, held = k, 0
        held += size
    return [*out, (at, len(sizes))]


def build(train: DataFrame, text_bytes: int, max_bytes: int = MAX_FILTER_BYTES, max_parts: int = MAX_PARTS) -> tuple[FilterInParts | None, DataFrame, DataFrame, int, int, int]:
    """Filter (None: too large to send), its table ``(shard, bits)``, exact word counts ``(shard, h, n)``, all tokens,
    different tokens and the number of shards of ``train(text)``.

    Shards grow with the text (a power of two up to ``MOST_SHARDS``), so that a task merges a bounded part. A shard has
    ``BITS_PER_ITEM`` bits and a half for each of its items, however many there are. Counts are merged and turned to bits in
    the task that gets them; the driver gathers and broadcasts shards of ``max_bytes`` at a time, ``max_parts`` times at most.
    """
    shards = min(MOST_SHARDS, 1 << max(3, (text_bytes // SHARD_BYTES).bit_length()))
    words, pairs = gather(train, shards)

    def summed(own: pa.Table) -> pa.Table:
        h, n = _merged(own)
        return pa.table({"shard": own.column("shard")[:1], "h": pa.array([planes(h)], pa.binary()), "n": pa.array([planes(n)], pa.binary()), "total": [int(n.sum())], "different": [len(n)]})

    words = cut(words.groupBy("shard").applyInArrow(summed, "shard int, h binary, n binary, total long, different long"))
    total, different = words.agg(F.sum("total"), F.sum("different")).first()

    def word_items(batches):
        for batch in batches:
            for h, n in zip(batch.column("h").to_pylist(), batch.column("n").to_pylist()):
                yield _packed(*_summed(word_hash(from_planes(h, "<u8")), from_planes(n, "<i8")), shards)

    def filled(own: pa.Table) -> pa.Table:
        h, n = _merged(own)
        items = float((1 + np.floor(np.log2(n))).sum())
        size = int(max(4096, 1.5 * items * BITS_PER_ITEM)) // 8 * 8
        return pa.table({"shard": own.column("shard")[:1], "bits": pa.array([fill(h, n, size).tobytes()], pa.binary())})

    items = pairs.unionByName(words.select("shard", "h", "n").mapInArrow(word_items, "shard int, h binary, n binary"))
    made = cut(items.groupBy("shard").applyInArrow(filled, "shard int, bits binary"))
    sizes = np.zeros(shards, np.int64)
    for r in made.select("shard", F.length("bits").alias("n")).collect():
        sizes[r.shard] = r.n * 8
    runs, parts = parts_of(sizes, max_bytes), []
    for a, b in runs if len(runs) <= max_parts else []:
        of = np.where((np.arange(shards) >= a) & (np.arange(shards) < b), sizes, 0)
        starts = np.r_[0, np.cumsum(of[:-1]) // 8].astype(np.int64)
        bits = np.zeros(int(of.sum()) // 8, np.uint8)
        for r in made.where(F.col("shard").between(a, b - 1)).collect():
            bits[starts[r.shard] : starts[r.shard] + len(r.bits)] = np.frombuffer(r.bits, np.uint8)
        parts.append(train.sparkSession.sparkContext.broadcast((bits, starts, of)))
    return FilterInParts(parts) if parts else None, made, words, int(total or 0), int(different or 0), shards


def asked_for(h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket's texts: different words, and different n-grams as the filter knows them with each token's place in these
    and each neighbouring pair's, so that counts in their order can be laid out again.

    Tasks get a bucket's texts in any order, and what is asked by one is laid out by another: a pair across two texts
    would depend on that order, so the end's own n-gram stands in its place (``log_probabilities`` doesn't read it).
    """
    words, at = np.unique(h, return_inverse=True)
    pairs = pair_hash(h[:-1], h[1:])
    pairs[np.cumsum(lengths)[:-1] - 1] = word_hash(np.array([END]))
    grams, places = np.unique(np.concatenate([word_hash(words), pairs]), return_inverse=True)
    return words, grams, np.concatenate([places[: len(words)][at], places[len(words) :]])


def log_probabilities(counts: np.ndarray, n: int, first: np.ndarray, total: int, different: int) -> np.ndarray:
    """log10 probability of each of the ``n`` tokens of a run of texts given the one before it; ``first`` marks a text's
    start; ``counts`` are the filter's for each token, then for each pair of neighbours.

    The smoothed word model and the pairs' relative frequency are interpolated; both come from the filter's estimated
    counts alone. After an unseen word, and at a text's start, the word model stands alone.
    """
    word = counts[:n]
    p = (word + 0.1) / (total + 0.1 * (different + 1))
    if n > 1:
        pair = np.minimum(counts[n:], np.minimum(word[:-1], word[1:]))
        seen = (word[:-1] > 0) & ~first[1:]
        p[1:] = np.where(seen, (1 - WORD_WEIGHT) * pair / np.maximum(word[:-1], 1) + WORD_WEIGHT * p[1:], p[1:])
    return np.log10(p)


def score(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_FILTER_BYTES, max_parts: int = MAX_PARTS) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs``.

    ``train`` has a column ``text_col`` with the texts to learn from. Exact word counts are never broadcast: documents are
    dealt into buckets of about ``BUCKET_BYTES``, a bucket's different words go to their shards as sorted hashes, and their
    counts alone come back, in the same order. A filter of more than ``max_parts`` broadcasts is asked in the same way.
    Null and empty texts are the end token alone; ids may repeat or be null (rows with one id and text share a bucket);
    extra columns play no part; with no training text every count and both scores are 0; an empty table gives an empty
    one. Words are told apart by 64-bit hashes.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    model, made, words, total, different, shards = build(train.select(F.col(text_col).alias("text")), size, max_bytes, max_parts)
    buckets = max(1, size // BUCKET_BYTES)
    dealt = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(buckets)).cast("int").alias("bucket")).repartition(int(min(buckets, MOST_PARTITIONS)), "bucket")
    sent = model is not None

    def asked(own: pa.Table) -> pa.Table:
        h, lengths = hashed_tokens(own.column("text"))
        different_words, grams, _ = asked_for(h, lengths) if not sent else (np.unique(h), None, None)
        rows = [(kind, s, planes(x[r])) for kind, x in ((0, different_words), (1, grams)) if x is not None for s, r in by_shard(x, shards)]
        bucket = own.column("bucket")[0].as_py() if len(own) else 0
        return pa.table({"bucket": pa.array([bucket] * len(rows), pa.int32()), "kind": pa.array([r[0] for r in rows], pa.int32()), "shard": pa.array([r[1] for r in rows], pa.int32()), "h": pa.array([r[2] for r in rows], pa.binary())})

    def answers(asked_: pa.Table, n_of) -> pa.Table:
        n = [planes(n_of(from_planes(h, "<u8"))) for h in asked_.column("h").to_pylist()]
        return pa.table({"bucket": asked_.column("bucket"), "kind": asked_.column("kind"), "shard": asked_.column("shard"), "n": pa.array(n, pa.binary())})

    def exact(asked_: pa.Table, counts: pa.Table) -> pa.Table:
        h, n = _merged(counts) if len(counts) else (np.empty(0, np.uint64), np.empty(0, np.int64))
        h, n = np.r_[h, np.uint64(2**64 - 1)], np.r_[n, 0]

        def look(own: np.ndarray) -> np.ndarray:
            at = np.searchsorted(h[:-1], own)
            return np.where(h[at] == own, n[at], 0)

        return answers(asked_, look)

    def estimated(asked_: pa.Table, filters: pa.Table) -> pa.Table:
        sizes = np.zeros(shards, np.int64)
        bits = np.zeros(0, np.uint8)
        for s, b in zip(filters.column("shard").to_pylist(), filters.column("bits").to_pylist()):
            bits, sizes[s] = np.frombuffer(b, np.uint8), len(b) * 8
        own = LogFrequencyFilter(bits, np.zeros(shards, np.int64), sizes)
        return answers(asked_, lambda h: (2 * own.count(h)).astype(np.int64) if len(bits) else np.zeros(len(h), np.int64))

    wanted, answer = dealt.groupBy("bucket").applyInArrow(asked, "bucket int, kind int, shard int, h binary"), "bucket int, kind int, shard int, n binary"
    known = wanted.where("kind = 0").groupBy("shard").cogroup(words.select("shard", "h", "n").groupBy("shard")).applyInArrow(exact, answer)
    if not sent:
        known = known.unionByName(wanted.where("kind = 1").groupBy("shard").cogroup(made.groupBy("shard")).applyInArrow(estimated, answer))
    floor = np.log10(total + 0.1 * (different + 1))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def scored(own: pa.Table, counts: pa.Table) -> pa.Table:
        h, lengths = hashed_tokens(own.column("text"))
        if not len(h):
            return pa.table({"id": own.column("id"), **{c: pa.array([], pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")}, **{c: pa.array([], pa.float64()) for c in ("base_score", "score")}})
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        first = np.zeros(len(h), bool)
        first[starts] = True
        back: list[list] = [[], []]
        for _, kind, n in sorted(zip(counts.column("shard").to_pylist(), counts.column("kind").to_pylist(), counts.column("n").to_pylist())):
            back[kind].append(from_planes(n, "<i8"))
        n = np.concatenate(back[0])[np.unique(h, return_inverse=True)[1]]
        base = lm_score = np.zeros(len(h))
        if total:
            base = np.log10(n + 0.1) - floor
            _, grams, places = asked_for(h, lengths)
            estimate = model.count(grams) if sent else np.concatenate(back[1]) / 2
            lm_score = log_probabilities(estimate[places], len(h), first, total, different)
        return pa.table({"id": own.column("id"), "n_tokens": lengths, "n_known": np.add.reduceat((n > 0).astype(np.int64), starts), "train_tokens": np.full(len(lengths), total, np.int64), "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(lm_score, starts)})

    return dealt.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(scored, schema)


def op4_bloom_lm(spark, sf_dir: str) -> DataFrame:
    """Contract query: all of ``documents``, learning from those whose crc32(doc_id) mod 10 isn't 0 (nor null)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    out = score(docs, docs.where(F.coalesce(~held_out, F.lit(False))))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(F.crc32(F.col("id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
