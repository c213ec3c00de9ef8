"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within ``max_bits`` agree in one segment up to a
single bit. Each distinct fingerprint is indexed under every one-wildcard variant of each segment (one bit blanked);
an equality on the variant brings the candidates together, and the number of differing bits is verified inside the
bucket. Nothing is paired outside a bucket, and a bucket gives a spanning forest instead of all its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, table

#: A bucket of more distinct fingerprints than this is divided by a second index over the bits that its key left open.
BUCKET = 16384
#: The same for fingerprints of more than a word, whose oversized buckets are compared by pairs of parts.
PART = 4096
#: Bytes of shingle sets that are compared in one place; a group with more is compared by pairs of parts.
SETS = 2 << 20
#: Members of groups up to which their ids are broadcast to fetch the texts (16 bytes each), more are joined.
BROADCAST_MEMBERS = 500_000
#: Up to this many oversized buckets are known to each task by broadcast, more are joined.
KNOWN_BUCKETS = 200_000
#: Rows of the bucket's distance matrix made at once.
BLOCK = 512


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Unsigned XXH64 (seed 42) of each run of ``size`` words, joined by single spaces; fewer words: the whole sequence."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, n, h = b" ".join(found), max(1, len(found) - size + 1), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[min(size, len(found)) - 1 :] - 1).tolist()
    return np.fromiter((h(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, n)


def mix(h: np.ndarray, k: int) -> np.ndarray:
    """Word ``k`` of a wider hash made from a 64-bit one (k = 0: the hash itself)."""
    if k:
        h = h + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return h


def fingerprint(text: str | None, size: int, bits: int = 64) -> list[int]:
    """``bits / 64`` signed 64-bit words; a bit is 1 if set in more than half of the hashes; no words: zero."""
    h, out = shingle_hashes(text, size), []
    for k in range(bits // 64):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 16):
            part = mix(h[at : at + (1 << 16)], k).astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(ones * 2 > len(h)).view(">i8")[0]) if len(h) else 0)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, bits: int = 64) -> DataFrame:
    """``(id, fp)`` per row, fp an array of signed words."""

    @F.pandas_udf("array<bigint>")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size, bits) for t in texts])

    return docs.select(F.col(id_col).alias("id"), fp(F.col(text_col)).alias("fp"))


def segments(bits: int, count: int) -> list[tuple[int, int]]:
    """``count`` near-equal segments (offset, length) of at most 32 bits, counted from the highest bit."""
    edges = [round(i * bits / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variant_keys(fp: np.ndarray, cuts: list[tuple[int, int]], tag: np.ndarray | None = None) -> np.ndarray:
    """One-wildcard keys of each fingerprint (rows of uint64 words): segment number, blanked bit and what is left."""
    big, out = np.unpackbits(np.ascontiguousarray(fp.astype(">u8")).view(np.uint8).reshape(len(fp), -1), axis=1), []
    for k, (at, length) in enumerate(cuts):
        value = big[:, at : at + length].astype(np.int64) @ (1 << np.arange(length - 1, -1, -1, dtype=np.int64))
        for bit in range(length):
            out.append((value & ~np.int64(1 << bit)) | np.int64((k << 40) | (bit << 32)))
    return np.stack(out, axis=1) if out else np.empty((len(fp), 0), np.int64)


def segment_values(fp: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """Segment number and value of each segment of each fingerprint."""
    big = np.unpackbits(np.ascontiguousarray(fp.astype(">u8")).view(np.uint8).reshape(len(fp), -1), axis=1)
    return np.stack([big[:, at : at + length].astype(np.int64) @ (1 << np.arange(length - 1, -1, -1, dtype=np.int64)) | np.int64(k << 40) for k, (at, length) in enumerate(cuts)], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count(a[:, None, k] ^ b[None, :, k]).astype(np.int32) for k in range(a.shape[1]))


def bucket_labels(fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Index of a representative of each fingerprint's component within one bucket, by blocks of the distance matrix."""
    label = np.arange(len(fp))
    while True:
        new = label.copy()
        for at in range(0, len(fp), BLOCK):
            near = distances(fp[at : at + BLOCK], fp) <= max_bits
            new[at : at + BLOCK] = np.where(near, label[None, :], len(fp)).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def neighbour_labels(fp: np.ndarray, max_bits: int) -> np.ndarray:
    """The same for single-word fingerprints and at most two bits, by looking up each fingerprint's neighbours: linear."""
    one = fp[:, 0]
    order = np.argsort(one, kind="stable")
    values, label = one[order], np.arange(len(one))
    single = [np.uint64(1 << i) for i in range(64)]
    masks = single + ([a ^ b for i, a in enumerate(single) for b in single[:i]] if max_bits > 1 else []) if max_bits else []
    pairs = []
    for m in masks:
        look = values ^ m
        pos = np.searchsorted(values, look).clip(max=len(values) - 1)
        hit = (values[pos] == look) & (values < look)
        pairs.append(np.stack([np.nonzero(hit)[0], pos[hit]]))
    a, b = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.empty(len(one), np.int64)
    out[order] = order[label]
    return out


def bucket_edges(key: np.ndarray, cid: np.ndarray, fp: np.ndarray, max_bits: int, small: int = 32) -> np.ndarray:
    """Verified links of a run of whole buckets: all pairs of buckets of up to ``small``, else a spanning forest."""
    again = key[1:] == key[:-1]
    keep = np.r_[again, False] | np.r_[False, again] if len(key) else np.empty(0, bool)  # rows come in order of their key
    key, cid, fp = key[keep], cid[keep], fp[keep]
    order = np.lexsort((cid, key))
    key, cid, fp = key[order], cid[order], fp[order]
    found, starts = [], np.nonzero(np.r_[True, key[1:] != key[:-1]])[0] if len(key) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(key)])
    left = np.repeat(starts + sizes, sizes) - np.arange(len(key))
    rows = np.nonzero(np.repeat(sizes, sizes) <= small)[0]
    for d in range(1, small):
        rows = rows[left[rows] > d]
        if not len(rows):
            break
        near = rows[sum(np.bitwise_count(fp[rows, k] ^ fp[rows + d, k]).astype(np.int32) for k in range(fp.shape[1])) <= max_bits]
        found.append(np.stack([cid[near], cid[near + d]], axis=1))
    for at, n in zip(starts[sizes > small], sizes[sizes > small]):
        part = slice(at, at + n)
        label = (neighbour_labels if n > BUCKET and fp.shape[1] == 1 and max_bits <= 2 else bucket_labels)(fp[part], max_bits)
        own, c = np.arange(len(label)), cid[part]
        found.append(np.stack([c[own != label], c[label[own != label]]], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)


def forest(edges: np.ndarray) -> np.ndarray:
    """As few links as hold the same components together: each node to its component's smallest."""
    if not len(edges):
        return edges
    nodes, at = np.unique(edges, return_inverse=True)
    a, b = at.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.nonzero(label != np.arange(len(nodes)))[0]
    return np.stack([nodes[own], nodes[label[own]]], axis=1)


def by_part_pairs(key: np.ndarray, cid: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows go where when each bucket is dealt into ``parts`` parts: (row, key), a row to each pair of its bucket's
    parts that has its own in it. Any two rows of a bucket meet in such a pair; a bucket of one part stays as it is."""
    own = (mix(cid.view(np.uint64), 3) % parts.astype(np.uint64)).astype(np.int64)
    row = np.repeat(np.arange(len(key)), np.maximum(parts - 1, 1))
    other = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(parts - 1, 1)) - np.maximum(parts - 1, 1), np.maximum(parts - 1, 1))
    other = other + (other >= own[row])
    low, high = np.minimum(own[row], other), np.maximum(own[row], other)
    pair = mix(mix(key[row].view(np.uint64), 1) + (low * parts[row] + high).astype(np.uint64), 2).view(np.int64)
    return row, np.where(parts[row] > 1, pair, key[row])


def in_buckets(rows: DataFrame, max_bits: int, words: int) -> DataFrame:
    """Links found in the buckets of ``(key, cid, w0..)``: rows are dealt by key and cut to whole buckets as they come; a task
    hands on a spanning forest of what all its buckets link."""
    names = [f"w{k}" for k in range(words)]

    def work(batches):
        held: list[pd.DataFrame] = []
        links, size = np.empty((0, 2), np.int64), 0

        def found(df: pd.DataFrame) -> np.ndarray:
            fp = np.stack([df[c].to_numpy(np.int64).view(np.uint64) for c in names], axis=1)
            e = bucket_edges(df["key"].to_numpy(np.int64), df["cid"].to_numpy(np.int64), fp, max_bits)
            return forest(np.concatenate([links, e]))

        for df in batches:
            held.append(df)
            size += len(df)
            if size > 400_000:
                df = pd.concat(held, ignore_index=True)
                last = df["key"].to_numpy() == df["key"].iloc[-1]
                held, size = [df[last]], int(last.sum()) if not last.all() else 0
                if not last.all():
                    links = found(df[~last])
        if held:
            df = pd.concat(held, ignore_index=True)
            if len(df):
                links = found(df)
        yield pd.DataFrame({"src": links[:, 0], "dst": links[:, 1]})

    return rows.repartition("key").sortWithinPartitions("key").mapInPandas(work, "src long, dst long")


def linked_classes(docs: DataFrame, id_col: str, text_col: str, size: int, max_bits: int, bits: int, cuts: list[tuple[int, int]], bucket: int, exact: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fingerprints ``(id, fp)``, their classes ``(fp, cid)``, and ``(node, component)`` of the classes with a link.

    Rows with equal fingerprints are one class before anything is indexed, so copies cost nothing. Each variant of each
    class goes to its bucket in one exchange. Which buckets may be oversized is known before from the counts of the
    segments' values, a few rows a class: a bucket joins the fingerprints of two values, so the commoner one has half of it.
    """
    names = [f"w{k}" for k in range(bits // 64)]
    fps = cut(fingerprints(docs, id_col, text_col, size, bits))
    classes = fps.where(F.col("id").isNotNull()).groupBy("fp").agg(F.min("id").alias("cid"))
    tasks = int(min(50_000, 1 + fps.count() // 4000))
    flat = cut(classes.select("cid", *[F.col("fp")[k].alias(c) for k, c in enumerate(names)]).repartition(tasks, "cid"))
    schema = "key long, cid long, " + ", ".join(f"{c} long" for c in names)
    most = bucket if exact else min(bucket, PART)

    def words_of(df: pd.DataFrame) -> np.ndarray:
        return np.stack([df[c].to_numpy(np.int64).view(np.uint64) for c in names], axis=1)

    def variants(batches):
        for whole in batches:
            for at in range(0, len(whole), 4000):
                df = whole.iloc[at : at + 4000]
                keys = variant_keys(words_of(df), cuts)
                yield pd.DataFrame({"key": keys.ravel(), "cid": np.repeat(df["cid"].to_numpy(), keys.shape[1])} | {c: np.repeat(df[c].to_numpy(), keys.shape[1]) for c in names})

    def counted(batches):
        for df in batches:
            value, n = np.unique(segment_values(words_of(df), cuts), return_counts=True)
            yield pd.DataFrame({"value": value, "n": n})

    def wildcards(batches):
        for df in batches:
            for value, n in zip(df["value"].tolist(), df["n"].tolist()):
                own = range(cuts[value >> 40][1])
                yield pd.DataFrame({"key": [(value & ~(1 << bit)) | (bit << 32) for bit in own], "n": [n] * len(own)})

    def divided(batches):
        """Oversized buckets by a second index, lossless for two bits, or else by pairs of parts."""
        for whole in batches:
            for at in range(0, len(whole), 4000):
                df = whole.iloc[at : at + 4000]
                key, cid, parts = (df[c].to_numpy(np.int64) for c in ("key", "cid", "parts"))
                if exact:
                    half, fp = ([(32, 16), (48, 16)], [(0, 16), (16, 16)]), words_of(df)
                    keys = np.where(((key >> 40) > 0)[:, None], variant_keys(fp, half[1]), variant_keys(fp, half[0]))
                    many = (mix(np.repeat(key, keys.shape[1]).view(np.uint64), 1) ^ mix(keys.ravel().view(np.uint64), 2)).view(np.int64)
                    row = np.repeat(np.arange(len(df)), keys.shape[1])
                    hot = parts[row] > 1
                    row, key = np.r_[row[hot], np.nonzero(parts <= 1)[0]], np.r_[many[hot], key[parts <= 1]]
                else:
                    row, key = by_part_pairs(key, cid, parts)
                yield pd.DataFrame({"key": key} | {c: df[c].to_numpy()[row] for c in ["cid", *names]})

    keyed = flat.mapInPandas(variants, schema)
    values = cut(flat.mapInPandas(counted, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")).where(F.col("n") > most // 2))
    if not values.isEmpty():
        parts = cut(values.mapInPandas(wildcards, "key long, n long").groupBy("key").agg(F.greatest(F.lit(2), F.ceil(2 * F.max("n") / most)).alias("parts")))
        known = keyed.join(F.broadcast(parts) if parts.count() <= KNOWN_BUCKETS else parts, "key", "left")
        keyed = known.select("key", "cid", *names, F.coalesce("parts", F.lit(1)).cast("long").alias("parts")).mapInPandas(divided, schema)
    return fps, classes, components(in_buckets(keyed, max_bits, len(names)))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, max_bits: int = 2, bits: int = 64, count: int | None = None, bucket: int = BUCKET, exact_split: bool | None = None
) -> DataFrame:
    """``(id, fp, component_id)`` for each row of ``docs``: the smallest id reachable over links of ``max_bits`` or fewer.

    ``count`` segments are cut; with ``count >= (max_bits + 1) / 2`` no link can be lost, since one segment then
    differs by at most a bit. A bucket that may have over ``bucket`` distinct fingerprints is divided: for 64-bit
    fingerprints and up to two bits by one-wildcard variants of the two halves of the segments that the key left open
    (again lossless, and such a part has at most 2^18 members by construction); for wider ones one of over ``PART`` is dealt
    into parts by a hash, and each pair of parts is a bucket of its own, so that all members still meet. Null and empty
    texts have the fingerprint zero; null ids are kept as a row with a null component; rows may repeat; extra columns play
    no part; an empty table gives an empty one.
    """
    exact = exact_split if exact_split is not None else bits == 64 and max_bits <= 2
    fps, classes, roots = linked_classes(docs, id_col, text_col, size, max_bits, bits, segments(bits, count or (max_bits + 2) // 2), bucket, exact)
    joined = classes.join(roots, F.col("cid") == F.col("node"), "left").select("fp", F.coalesce("component", "cid").alias("component_id"))
    return fps.join(joined, "fp", "left").select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def similar_links(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of sets (sorted, distinct numbers) with a Jaccard similarity of ``similarity`` or more: enough of them that every
    such pair is connected.

    Sets are compared with leaders: the first that is like no leader before is the next one. Two sets that are like
    different leaders can only be alike if the leaders are within three times the distance (the Jaccard distance is a
    metric); of such clusters, unless connected already, each member of the smaller one is compared with all, once at most.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    universe, code = np.unique(np.concatenate(sets), return_inverse=True) if n else (np.empty(0), np.empty(0, np.int64))
    of, at = np.repeat(np.arange(n), size), np.r_[0, np.cumsum(size)]
    label, out = np.arange(n), []

    def like(i: int) -> np.ndarray:
        mark = np.zeros(len(universe), bool)
        mark[code[at[i] : at[i + 1]]] = True
        shared = np.bincount(of[mark[code]], minlength=n)
        return shared / np.maximum(size + size[i] - shared, 1)

    def tie(i: int, near: np.ndarray) -> None:
        for j in near[label[near] != label[i]].tolist():
            if label[j] != label[i]:
                out.append((i, j))
                label[label == label[j]] = label[i]

    leaders, owner, close, compared = [], np.full(n, -1), [], np.zeros(n, bool)
    for i in range(n):
        if owner[i] < 0:
            likeness = like(i)
            near = np.nonzero(likeness >= similarity)[0]
            owner[near[owner[near] < 0]] = owner[i] = i
            compared[i] = True
            tie(i, near)
            close += [(i, j) for j in leaders if likeness[j] >= 1 - 3 * (1 - similarity)]
            leaders.append(i)
    for a, b in close:
        if label[a] != label[b]:
            members = min((np.nonzero((owner == x) & ~compared)[0] for x in (a, b)), key=len)
            for i in members.tolist():
                compared[i] = True  # with all others, so never again
                tie(i, np.nonzero(like(i) >= similarity)[0])
    return out


def verified_links(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, size: int, similarity: float, most: int = SETS) -> DataFrame:
    """``(src, dst)``: of the groups ``(node, component)`` of ids, links that connect all pairs whose sets of ``size``-word
    shingles have the Jaccard similarity. A group whose sets have over ``most`` bytes is dealt into parts by a hash, and
    each pair of parts is compared, so that all members still meet."""
    few = members.count() <= BROADCAST_MEMBERS
    texts = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")).join(F.broadcast(members) if few else members, "node")

    def as_sets(batches):
        for df in batches:
            yield pd.DataFrame({"node": df["node"], "component": df["component"], "own": [np.unique(shingle_hashes(t, size)).tobytes() for t in df["text"]]})

    sets = cut(texts.mapInPandas(as_sets, "node long, component long, own binary"))
    big = cut(sets.groupBy("component").agg(F.sum(F.length("own")).alias("bytes")).where(F.col("bytes") > most).select("component", F.ceil(2 * F.col("bytes") / most).cast("int").alias("parts")))
    keyed = sets.select(F.col("component").alias("key"), "node", "own")
    number = big.count()
    if number:
        known = sets.join(F.broadcast(big) if number <= KNOWN_BUCKETS else big, "component", "left").withColumn("p", F.pmod(F.xxhash64("node"), "parts").cast("int"))
        other = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: o != F.col("p")))
        spread = known.select("component", "node", "own", "p", F.explode(other).alias("o"))
        keyed = spread.select(F.when(F.col("o") < 0, F.col("component")).otherwise(F.xxhash64("component", F.least("p", "o"), F.greatest("p", "o"))).alias("key"), "node", "own")

    def compared(batches):
        def links(own: list) -> pd.DataFrame:
            found = similar_links([np.frombuffer(b, np.uint64) for _, b in own], similarity) if len(own) > 1 else []
            return pd.DataFrame({"src": [own[i][0] for i, _ in found], "dst": [own[j][0] for _, j in found]}, dtype="int64")

        held, last = [], None
        for df in batches:
            for key, node, own in zip(df["key"].tolist(), df["node"].tolist(), df["own"]):
                if key != last and held:
                    yield links(held)
                    held = []
                last = key
                held.append((node, own))
        if held:
            yield links(held)

    return keyed.repartition("key").sortWithinPartitions("key").mapInPandas(compared, "src long, dst long")


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 3-word shingles, links at two or fewer bits, over the whole of ``documents``."""
    found = near_duplicates(table(spark, sf_dir, "documents"), size=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), F.col("component_id"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8, bits: int = 192, count: int = 10, max_bits: int = 47, most: int = SETS) -> DataFrame:
    """Keeps the row with the smallest ``doc_id`` of each near-duplicate group, with the columns of ``docs``.

    Near duplicates are texts whose sets of ``size``-word shingles have a Jaccard similarity of ``similarity`` or more, and
    what such pairs connect. Fingerprints only look for candidates: at 0.8, 29 of 192 bits differ on average (deviation 5),
    so ``max_bits`` is that and 3.6 deviations; ``count`` segments of 16 bits, each with one wildcard, bring a pair at
    exactly 0.8 together with probability 0.96, at 0.85 with 0.99. Every candidate group is then compared by its real
    sets. Texts of one fingerprint are one class; null, empty and blank texts are one such class. Rows with a null id are
    kept; rows that repeat an id stay if the id stays; an empty table stays empty.
    """
    cuts = [(16 * k, 16) for k in range(count)]
    fps, classes, roots = linked_classes(docs, "doc_id", "text", size, max_bits, bits, cuts, PART, False)
    members = cut(roots)
    links = verified_links(docs.where(F.col("doc_id").isNotNull()), members, "doc_id", "text", size, similarity, most)
    alike = components(links).where(F.col("node") != F.col("component")).select(F.col("node").alias("cid"), F.lit(True).alias("later"))
    # a class goes but for its smallest id, and that too if the class is linked to one with a smaller id
    of = classes.join(alike, "cid", "left")
    out = fps.where(F.col("id").isNotNull()).join(of, "fp").where(F.col("later") | (F.col("id") != F.col("cid"))).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(out, "doc_id", "left_anti").select(*docs.columns)
