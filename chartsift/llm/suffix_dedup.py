"""Exact removal of repeated passages by deep-shallow suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts elsewhere goes. Suffixes are first screened
without loss: each ``length``-byte string has a canonical anchor, the smallest hash among the ``KMER``-byte strings
in it, so equal strings have equal anchors at equal places. The starts that share an anchor form a block of at most
``2 * length - KMER`` bytes. Blocks whose anchor occurs once can hold no repeat; blocks that are equal as a whole are
repeats as a whole and are counted, not moved. What is left, one representative of each different block, is sorted by
suffix within its anchor's group: multikey quicksort to ``SHALLOW`` bytes, then a blind trie for each group that still
ties. The order's common-prefix lengths, to the right of the anchor and (read backwards) to the left, say for each
place of the string in the block whether another block has it too.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, join_spread, table

LENGTH, KMER = 400, 256
#: Depth in bytes to which the multikey quicksort goes before blind tries take over.
SHALLOW = 16
#: A group of more blocks than this is divided by a longer common string before it is sorted (32 MB at most).
GROUP = 32768
#: Texts are hashed in pieces of this many starts, so the hashing needs bounded memory for texts of any length.
PIECE = 1 << 20
_MASK = (1 << 64) - 1
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 17)
        both = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def blocks_of(text: bytes, length: int = LENGTH, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """Blocks of a text: (anchor hash, block hash, first start, anchor - first start, starts - 1), one entry each."""
    parts = []
    for at in range(0, max(0, len(text) - length + 1), PIECE):
        b = np.frombuffer(text, np.uint8, min(PIECE + length - 1, len(text) - at), at)
        power, inverse = _powers(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTES[b] * power[: len(b)], out=total[1:])
        h = _mixed((total[kmer:] - total[:-kmer]) * inverse[: len(b) - kmer + 1])
        width, starts = length - kmer + 1, len(b) - length + 1
        keyed = (h & np.uint64(_MASK ^ ((1 << 22) - 1))) | np.arange(len(h), dtype=np.uint64)
        pad = -len(keyed) % width
        grid = np.concatenate([keyed, np.full(pad, _MASK, np.uint64)]).reshape(-1, width)
        left, right = np.minimum.accumulate(grid, axis=1).ravel(), np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(right[:starts], left[width - 1 : width - 1 + starts]) & np.uint64((1 << 22) - 1)).astype(np.int64)
        first = np.nonzero(np.r_[True, anchor[1:] != anchor[:-1]])[0]
        last = np.r_[first[1:], starts] - 1
        p = anchor[first]
        whole = (total[last + length] - total[first]) * inverse[first]
        shape = ((p - first) * 1024 + (last - first)).astype(np.uint64)
        parts.append((h[p], _mixed(whole + _mixed(shape + np.uint64(1))), first + at, p - first, last - first))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix of two byte strings that agree up to ``at``."""
    lo, hi = at, min(len(a), len(b))
    step = 16
    while lo < hi:
        n = min(lo + step, hi)
        if a[lo:n] == b[lo:n]:
            lo, step = n, step * 2
        elif n - lo == 1:
            return lo
        else:
            hi, step = n - 1 if n - lo == 2 and a[lo] == b[lo] else n, max(1, (n - lo) // 2)
            if n - lo == 2 and a[lo] == b[lo]:
                return lo + 1
    return lo


class BlindTrie:
    """Patricia trie that keeps branching depths and branching bytes alone; strings are looked at to verify."""

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth, self.root = strings, depth, None

    def _byte(self, i: int, at: int) -> int:
        s = self.strings[i]
        return s[at] if at < len(s) else -1

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = [i]
            return
        node = self.root  # a leaf is [id, ...] (equal strings); a branch is (depth, {byte: child})
        while isinstance(node, tuple):
            node = node[1].get(self._byte(i, node[0])) or next(iter(node[1].values()))
        a, b = self.strings[i], self.strings[node[0]]
        d = common_prefix(a, b, self.depth)
        if d == len(a) == len(b):
            node.append(i)
            return
        parent, byte, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < d:
            parent, byte = node, self._byte(i, node[0])
            node = node[1][byte]
        if isinstance(node, tuple) and node[0] == d:
            node[1][self._byte(i, d)] = [i]
            return
        old = node
        while isinstance(old, tuple):
            old = next(iter(old[1].values()))
        split = (d, {self._byte(old[0], d): node, self._byte(i, d): [i]})
        if parent is None:
            self.root = split
        else:
            parent[1][byte] = split

    def ordered(self) -> tuple[list[int], list[int]]:
        """Ids in order and the common prefix of each with the one before (the first: 0)."""
        order, lcp, stack, between = [], [], [(self.root, 0)], 0
        while stack:
            node, between = stack.pop()
            if isinstance(node, tuple):
                children = [node[1][k] for k in sorted(node[1])]
                stack += [(c, node[0]) for c in reversed(children[1:])]
                stack.append((children[0], between))
            else:
                for k, i in enumerate(node):
                    order.append(i)
                    lcp.append(between if k == 0 else len(self.strings[i]))
        return order, lcp


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Suffix order and common-prefix lengths: multikey quicksort on 8-byte keys, then blind tries for the ties."""
    order: list[int] = []
    lcp: list[int] = []
    stack = [(list(range(len(strings))), 0)] if strings else []
    while stack:
        group, depth = stack.pop()
        if len(group) > 1 and depth < shallow:
            pivot = strings[group[len(group) // 2]][depth : depth + 8]
            less = [i for i in group if strings[i][depth : depth + 8] < pivot]
            same = [i for i in group if strings[i][depth : depth + 8] == pivot]
            more = [i for i in group if strings[i][depth : depth + 8] > pivot] if len(less) + len(same) < len(group) else []
            stack += [x for x in ((more, depth), (same, depth + 8), (less, depth)) if x[0]]
            continue
        if len(group) == 1:
            part, between = group, [0]
        else:
            trie = BlindTrie(strings, min(depth, min(len(strings[i]) for i in group)))
            for i in group:
                trie.insert(i)
            part, between = trie.ordered()
        lcp += [common_prefix(strings[order[-1]], strings[part[0]]) if order else 0, *between[1:]]
        order += part
    return order, lcp


def cover(groups: list[tuple[list[bytes], list[bytes]]], length: int = LENGTH, kmer: int = KMER) -> list[list[tuple[int, int] | None]]:
    """For each block of each group (right parts from the anchor on, left parts read backwards): the furthest bytes
    left and right of the anchor that a ``length``-byte string shared with another block of the group covers."""
    sizes = [len(g[0]) for g in groups]
    total, base = sum(sizes), np.r_[0, np.cumsum(sizes)].astype(np.int64)
    rank, lcps, lens = np.empty((2, total), np.int64), np.empty((2, total), np.int64), np.empty((2, total), np.int64)
    for g, (right, left) in enumerate(groups):
        for side, strings in enumerate((right, left)):
            order, lcp = deep_shallow(strings)
            rank[side, base[g] + np.array(order)] = np.arange(base[g], base[g + 1])
            lcps[side, base[g] : base[g + 1]] = lcp
            lcps[side, base[g]] = -1
            lens[side, base[g] : base[g + 1]] = [len(s) for s in strings]
    far = np.full((2, total), -1, np.int64)
    for l in range(length - kmer + 1):
        r = length - l
        own = np.nonzero((lens[0] >= r) & (lens[1] >= l))[0]
        if len(own) < 2:
            continue
        same_r, same_l = np.cumsum(lcps[0] < r)[rank[0, own]], np.cumsum(lcps[1] < l)[rank[1, own]]
        both = same_r * (total + 1) + same_l
        _, where, count = np.unique(both, return_inverse=True, return_counts=True)
        hit = own[count[where] > 1]
        far[0, hit], far[1, hit] = np.maximum(far[0, hit], r), np.maximum(far[1, hit], l)
    return [[(int(far[1, i]), int(far[0, i])) if far[0, i] >= 0 else None for i in range(base[g], base[g + 1])] for g in range(len(groups))]


def _sorted_groups(rows: DataFrame, length: int, kmer: int) -> DataFrame:
    """``(h, ctx, lo, hi)``: what the suffix order of each group finds covered, relative to the block's first byte."""

    def work(batches):
        held: dict[int, list] = {}
        size = 0

        def flush(keys):
            taken = [held.pop(k) for k in keys]
            groups = [([b[o:] for _, _, o, b in rows_], [b[:o][::-1] for _, _, o, b in rows_]) for rows_ in taken]
            out = []
            for rows_, spans in zip(taken, cover(groups, length, kmer)):
                out += [(h, c, o - s[0], o + s[1]) for (h, c, o, _), s in zip(rows_, spans) if s]
            return pd.DataFrame(out, columns=["h", "ctx", "lo", "hi"])

        for df in batches:
            for g, h, c, o, b in zip(df["g"].tolist(), df["h"].tolist(), df["ctx"].tolist(), df["off"].tolist(), df["body"]):
                held.setdefault(g, []).append((h, c, o, b))
                size += len(b)
            if size > 1 << 24 and len(held) > 1:
                yield flush(list(held)[:-1])
                size = sum(len(x[3]) for v in held.values() for x in v)
        if held:
            yield flush(list(held))

    return rows.select("g", "h", "ctx", "off", "body").repartition("g").sortWithinPartitions("g").mapInPandas(work, "h long, ctx long, lo int, hi int")


def row_key(id_col: str, text_col: str):
    """One number for a row, whether its id is null or repeats."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, kmer: int = KMER, group: int = GROUP) -> DataFrame:
    """``(id, spans)`` for the rows that hold a repeat; spans: sorted byte ranges (start, end), which may overlap.

    ``id`` is ``row_key`` of the row: rows that repeat are places of their own, and so are rows with one id (or none) and
    different texts. An anchor or block with very many places is dealt over several tasks. A group of over ``group`` different blocks is divided by what a shared string must extend
    the anchor by: half of the rest to the right or half to the left, again and again; at the last level a group's
    members share a whole string, and counting them is enough. So no task gets an unbounded group, and nothing is lost.
    """
    schema = "id long, h long, ctx long, first long, off int, more int"

    def scan(batches):
        for df in batches:
            ids, parts = df["id"].to_numpy(), []
            for k, t in enumerate(df["text"]):
                if t is not None and len(t) * 4 >= length:
                    h, c, first, off, more = blocks_of(t.encode("utf-8", "surrogatepass"), length, kmer)
                    if len(h):
                        parts.append((np.full(len(h), ids[k]), h.view(np.int64), c.view(np.int64), first, off, more))
            if parts:
                yield pd.DataFrame(dict(zip(("id", "h", "ctx", "first", "off", "more"), (np.concatenate(x) for x in zip(*parts)))))

    source = docs.select(row_key(id_col, text_col).alias("id"), F.col(text_col).alias("text"))
    blocks = source.mapInPandas(scan, schema)
    often = cut(blocks.groupBy("h").agg(F.count("*").alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b")).where("n > 1").select("h", "n", (F.col("a") == F.col("b")).alias("same")))
    number = often.agg(F.sum("n")).first()[0] or 0
    near = cut(join_spread(blocks, often, ["h"], number))
    by_ctx = cut(near.where("not same").groupBy("h", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("id", "first", "off", "more")).alias("one")))
    whole_ctx = by_ctx.where("n > 1").select("h", "ctx", "n")
    whole = near.where("same").select("id", "first", "more").unionByName(join_spread(near.where("not same"), whole_ctx, ["h", "ctx"], number).select("id", "first", "more"))
    spans = whole.select("id", F.col("first").alias("lo"), (F.col("first") + F.col("more") + length).alias("hi"))

    wanted = by_ctx.select("h", "ctx", "one.*").groupBy("id").agg(F.collect_list(F.struct("h", "ctx", "first", "off", "more")).alias("blocks"))

    def bodies(batches):
        for df in batches:
            out = []
            for t, found in zip(df["text"], df["blocks"]):
                b = t.encode("utf-8", "surrogatepass")
                out += [(x["h"], x["ctx"], x["off"], b[x["first"] : x["first"] + x["more"] + length]) for x in found]
            yield pd.DataFrame(out, columns=["h", "ctx", "off", "body"])

    rows = cut(source.join(wanted, "id").mapInPandas(bodies, "h long, ctx long, off int, body binary"))
    level = rows.select(F.col("h").alias("g"), "*", F.lit(0).alias("l"), F.lit(0).alias("r"))
    found, rest = None, length - kmer
    while True:
        sizes = level.groupBy("g").agg(F.count("*").alias("n"))
        hot = cut(sizes.where(F.col("n") > group).select("g"))
        none = hot.isEmpty()
        cool = level if none else level.join(hot, "g", "left_anti")
        done = _sorted_groups(cool, length, kmer)
        found = done if found is None else found.unionByName(done)
        if none:
            break
        halves, open_ = level.join(hot, "g", "left_semi"), F.lit(rest) - F.col("l") - F.col("r")
        step = F.ceil(open_ / 2).cast("int")
        parts = None
        for l, r in ((F.col("l"), F.col("r") + step), (F.col("l") + step, F.col("r"))):
            x = halves.where(open_ > 0).withColumns({"nl": l, "nr": r}).where((F.col("off") >= F.col("nl")) & (F.length("body") >= F.col("off") + kmer + F.col("nr")))
            x = x.select(F.xxhash64("h", "nl", "nr", F.substring("body", F.col("off") + 1 - F.col("nl"), F.col("nl") + kmer + F.col("nr"))).alias("g"), "h", "ctx", "off", "body", F.col("nl").alias("l"), F.col("nr").alias("r"))
            parts = x if parts is None else parts.unionByName(x)
        ends = parts.where(F.col("l") + F.col("r") == rest)
        twice = ends.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
        found = found.unionByName(ends.join(twice, "g", "left_semi").select("h", "ctx", (F.col("off") - F.col("l")).alias("lo"), (F.col("off") + F.lit(kmer) + F.col("r")).alias("hi")))
        level = cut(parts.where(F.col("l") + F.col("r") < rest))
    reach = found.groupBy("h", "ctx").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    partial = by_ctx.where("n = 1").select("h", "ctx", "one.id", "one.first").join(reach, ["h", "ctx"])
    spans = spans.unionByName(partial.select("id", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi")))
    return spans.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges united where they overlap or touch."""
    out: list[list[int]] = []
    for lo, hi in spans:
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, kmer: int = KMER, group: int = GROUP) -> DataFrame:
    """One row per row of ``docs``: ``(id, kept, n_bytes, spans)``, kept being the UTF-8 bytes that stay.

    Null and empty texts give no bytes and no spans; texts shorter than ``length`` stay whole; extra columns play no
    part; a null id is as good as any; an empty table gives an empty one. Removal may cut inside a character, hence
    binary.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row"))
    joined = source.join(repeated_spans(docs, id_col, text_col, length, kmer, group).withColumnRenamed("id", "row"), "row", "left")

    def apply(batches):
        for df in batches:
            out = []
            for t, found in zip(df["text"], df["spans"]):
                b = (t or "").encode("utf-8", "surrogatepass")
                ranges = merge([(x["lo"], x["hi"]) for x in found]) if found is not None else []
                at, kept = 0, []
                for lo, hi in ranges:
                    kept.append(b[at:lo])
                    at = hi
                out.append((b"".join([*kept, b[at:]]), len(b), [{"lo": lo, "hi": hi} for lo, hi in ranges]))
            yield pd.DataFrame({"id": df["id"], "kept": [x[0] for x in out], "n_bytes": [x[1] for x in out], "spans": [x[2] for x in out]})

    return joined.mapInPandas(apply, "id long, kept binary, n_bytes long, spans array<struct<lo:bigint,hi:bigint>>")


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 400-byte repeats over the whole of ``documents``."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str | None], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The same by a table of all strings, for tests: id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = {i: (t or "").encode("utf-8", "surrogatepass") for i, t in texts.items()}
    seen: dict[bytes, int] = {}
    for b in raw.values():
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = {}
    for i, b in raw.items():
        ranges = merge([(s, s + length) for s in range(len(b) - length + 1) if seen[b[s : s + length]] > 1])
        kept = bytes(c for at, c in enumerate(b) if not any(lo <= at < hi for lo, hi in ranges))
        out[i] = (len(b), len(b) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest())
    return out
