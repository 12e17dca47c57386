"""Problem 5: new batches against all history.

Every text is a vector of word counts hashed into WIDTH buckets, kept in an
inverted file: cells are a band of text lengths and the nearest of CENTROIDS
directions, and hold the full vectors. Two texts that share, in order, at
least SHARE of the words of the longer have a product of square-rooted counts
of at least SHARE times the longer length (each shared word adds at least one),
so lengths and angles bound every cell: a query is taken only to blocks with a
cell that can still hold a holder, cells inside a block are skipped by the
same bounds, and what passes is reranked by its full vector, then by the longest
common subsequence of word hashes, bit-parallel. The bounds are exact: no
holder is lost. Texts equal after normalisation form one class with its
smallest id, so copies cost one vector however many there are.

The index is a Parquet folder. A batch is probed against it and then appended,
so that a later batch costs its own vectors and the cells it probes.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loamstone.functions.arrow import flat_map
from loamstone.sources.tables import shared_dir, spread, table, written

WIDTH = 512
SHARE = 0.85
CENTROIDS = 24
SAMPLE = 4000  # texts that the centroids are fitted on; they decide speed only, never the result
BLOCK = 8_192  # vectors of a block of a small index; vectors of long texts count as several
STREAM = 65_536  # vectors of a block at most; they pass by, so this bounds the time of a task and not its memory
LONG = 500  # words for which a vector counts once
CHUNK = 16_384  # queries that a task holds; those of long texts count as several
SLICE = 1_024  # rows that are compared at once
FLUSH = 1 << 20  # words of queries that leave the sender in one Arrow batch
ANGLE = math.acos(SHARE)
TAG = re.compile(r"<[^<>\n]{0,300}>")
WORD = re.compile(r"[^\W_]+")
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"  # soft hyphen, zero-width signs, byte order mark
VECTOR = "doc_id long, digest string, n int, seq binary"
MEETING = "part int, side int, centroid int, n int, id long, last_id long, digest string, seq binary, angle float"


def words(text: str | None) -> list[str]:
    """Words without case, spacing, punctuation, markup and Unicode form."""
    if not text:
        return []
    if "<" in text:
        text = TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).casefold()
        text = unicodedata.normalize("NFKC", text)
        if any(c in text for c in INVISIBLE):
            text = text.translate(dict.fromkeys(map(ord, INVISIBLE)))
        return WORD.findall(text)
    return WORD.findall(text.lower())


def vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n, seq) of every text with words, of docs (doc_id, text); null and blank texts have none.

    seq holds the 32-bit hash of every word in its order: the full vector is
    the histogram of the hashes over WIDTH buckets, and the order serves the
    rerank, so that probing a batch reads no text of the history. Two of some
    hundred words of a pair of texts share a hash about once in 50 000 pairs,
    which moves their common words by one.
    """

    def make():
        import xxhash

        known: dict[str, int] = {}

        def one(i, t):
            w = words(t)
            if not w:
                return []
            if len(known) > 500_000:
                known.clear()
            for x in set(w):
                if x not in known:
                    known[x] = xxhash.xxh32_intdigest(x.encode("utf-8", "surrogatepass"), 7)
            joined = " ".join(w).encode("utf-8", "surrogatepass")
            return [(i, xxhash.xxh128_hexdigest(joined), len(w), array("I", map(known.__getitem__, w)).tobytes())]

        return one

    return flat_map(docs.select("doc_id", "text"), make, VECTOR)


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    v = full = (1 << len(a)) - 1
    for w in b:
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def reaches(where: dict[int, int], n: int, b: list[int], need: int) -> bool:
    """Whether the common subsequence of a text of n words, given by the places of its words, and b has need words; ends early where it cannot."""
    v = full = (1 << n) - 1
    left = len(b)
    for k in range(0, left, 24):
        for w in b[k : k + 24]:
            m = where.get(w)
            if m is not None:
                u = v & m
                v = ((v + u) | (v - u)) & full
        done = min(k + 24, left)
        if n - v.bit_count() + left - done < need:
            return False
    return n - v.bit_count() >= need


def near(a: list[str], b: list[str]) -> bool:
    """Whether the texts share in order at least SHARE of the words of the longer."""
    longer = max(len(a), len(b))
    return min(len(a), len(b)) >= SHARE * longer and lcs(a, b) >= SHARE * longer - 1e-9


def band(n):
    """Band of a length; texts that can be near lie in the same or a neighbouring one."""
    return np.floor(np.log(n) / -math.log(SHARE)).astype(int)


def unit(counts: np.ndarray) -> np.ndarray:
    m = np.sqrt(counts)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)


def matrix(column: list[bytes]) -> np.ndarray:
    """Word counts by bucket of each sequence of coordinates."""
    out = np.zeros((len(column), WIDTH), dtype=np.float32)
    for s in range(0, len(column), 256):
        part = column[s : s + 256]
        rows = np.repeat(np.arange(len(part)), [len(x) // 4 for x in part])
        flat = np.frombuffer(b"".join(part), dtype="<u4") % WIDTH
        out[s : s + 256] = np.bincount(rows * WIDTH + flat, minlength=len(part) * WIDTH).reshape(-1, WIDTH)
    return out


def fit_centroids(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS, rounds: int = 8) -> np.ndarray:
    """Directions of k-means on a bounded sample of texts; deterministic."""
    total = max(1, docs.count())
    share = min(1.0, 1.5 * sample / total)
    part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(sample)
    rows = sorted(vectors(part).select("digest", "seq").collect())
    if not rows:
        return np.eye(1, WIDTH, dtype=np.float32)
    x = unit(matrix([bytes(r["seq"]) for r in rows]))
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        near_ = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near_ == j].sum(axis=0) if (near_ == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c.astype(np.float32)


ZONE = 4  # bands of a folder


def _figures(df: DataFrame, size, least: str, most: str, angle: str) -> DataFrame:
    return df.groupBy("band", "centroid").agg(size.alias("size"), F.min(least).alias("least"), F.max(most).alias("most"), F.max(angle).alias("angle"))


INDEX = "doc_id long, last_id long, digest string, n int, seq binary, band int, centroid int, angle float"


def place(classes: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Classes (doc_id, last_id, digest, n, seq) with their cell and angle to its centroid."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = unit(matrix(b.column(4).to_pylist()))
            s = x @ centroids.T
            best = s.argmax(axis=1)
            angle = np.arccos(np.clip(s[np.arange(len(best)), best], -1, 1))
            n = np.array(b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(band(n), pa.int32()), pa.array(best, pa.int32()), pa.array(angle, pa.float32())], names=["doc_id", "last_id", "digest", "n", "seq", "band", "centroid", "angle"])

    return classes.mapInArrow(run, INDEX)


def classes(vecs: DataFrame) -> DataFrame:
    """One row for each class of equal texts: smallest and largest id; copies are joined on the map side first."""
    g = vecs.groupBy("digest").agg(F.min(F.struct("doc_id", "n", "seq")).alias("first"), F.max("doc_id").alias("last_id"))
    return g.select("first.doc_id", "last_id", "digest", "first.n", "first.seq")


class CellIndex:
    """A persisted inverted file of text vectors in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, centroids: np.ndarray):
        self.spark, self.path, self.centroids = spark, path, centroids

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None, centroids: np.ndarray | None = None) -> CellIndex:
        """Index of docs (doc_id, text); every text with words gets in."""
        import uuid

        spark = docs.sparkSession
        c = fit_centroids(docs) if centroids is None else centroids
        index = cls(spark, path or f"{shared_dir(spark)}/cells_{uuid.uuid4().hex}", c)
        index.append(docs)
        spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(c)], "centroid int, direction array<float>").coalesce(1).write.mode("overwrite").parquet(f"{index.path}/centroids")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CellIndex:
        rows = sorted(spark.read.parquet(f"{path}/centroids").collect())
        return cls(spark, path, np.array([r["direction"] for r in rows], dtype=np.float32))

    def append(self, docs: DataFrame) -> None:
        """Add the texts of docs (doc_id, text)."""
        self.append_placed(place(classes(vectors(docs)), self.centroids))

    def append_placed(self, placed: DataFrame) -> None:
        """Add placed classes: one more part of the folder, split by zones of lengths, and the figures of its cells."""
        import uuid

        part = f"{self.path}/cells/part={uuid.uuid4().hex}"
        placed.withColumn("zone", F.floor(F.col("band") / ZONE).cast("int")).write.partitionBy("zone").parquet(part)
        new = self.spark.read.schema(INDEX + ", zone int").parquet(part)
        _figures(new, F.count("*"), "n", "n", "angle").coalesce(1).write.mode("append").parquet(f"{self.path}/figures")

    def cells(self, bands: list[int]) -> DataFrame:
        """The vectors of some bands; folders of other zones are not read."""
        zones = sorted({b // ZONE for b in bands})
        c = self.spark.read.schema(INDEX + ", part string, zone int").parquet(f"{self.path}/cells")
        return c.where(F.col("zone").isin(zones) & F.col("band").isin(sorted(set(bands)))).drop("part", "zone")

    def statistics(self) -> list:
        """Size, lengths and widest angle of every cell, from the figures of the parts: at most bands x centroids rows."""
        figures = self.spark.read.schema("band int, centroid int, size long, least int, most int, angle float").parquet(f"{self.path}/figures")
        return _figures(figures, F.sum("size"), "least", "most", "angle").collect()

    def probe(self, queries: DataFrame) -> DataFrame:
        """(q_id, q_digest, x_id): the indexed class of smallest id that is near a query class, at least; further ones where it meets several blocks.

        queries: the columns of INDEX. Only x_id below the query's largest id
        and classes of different digests are given. A block streams past the
        queries of a chunk, so a task holds CHUNK queries and one Arrow batch
        however large index, batch and blocks are.
        """
        spark, empty = self.spark, "q_id long, q_digest string, x_id long"
        rank = _chain(self.centroids)
        stats = sorted(self.statistics(), key=lambda r: (r["band"], rank[r["centroid"]]))
        if not stats:
            return spark.createDataFrame([], empty)
        weights = [r["size"] * max(1, -(-r["most"] // LONG)) for r in stats]
        most = min(STREAM, max(BLOCK, sum(weights) // (4 * spark.sparkContext.defaultParallelism)))
        cells, number, room = [], -1, 0
        for r, weight in zip(stats, weights):
            split = -(-weight // most)
            if split > 1 or room < weight:
                number, room = number + 1, most
            cells.append((r["band"], r["centroid"], number, split))
            number += split - 1
            room = room - weight if split == 1 else 0
        reach = _reach(stats, cells, number + 1, self.centroids)

        def count(batches):
            for b in batches:
                total = np.zeros(number + 1, dtype=np.int64)
                heavy = np.maximum(1, -(-b.column("n").to_numpy() // LONG))
                for at, blocks in reach(b):
                    np.add.at(total, blocks, heavy[at])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(number + 1), pa.int32()), pa.array(total)], names=["block", "weight"])

        asked = queries.select("digest", "n", "seq", "doc_id", "last_id")
        loads = asked.mapInArrow(count, "block int, weight long").groupBy("block").agg(F.sum("weight").alias("weight")).where("weight > 0").collect()
        # first group of every block that a query reaches, and its chunks of queries
        first, chunks, groups = np.full(number + 1, -1), np.zeros(number + 1, dtype=np.int64), 0
        for r in sorted(loads):
            first[r["block"]], chunks[r["block"]] = groups, -(-r["weight"] // CHUNK)
            groups += int(chunks[r["block"]])
        if not groups:
            return spark.createDataFrame([], empty)

        schema = to_arrow_schema(StructType.fromDDL(MEETING))

        def send(batches):
            for b in batches:
                part = np.array([int(d[:8], 16) for d in b.column("digest").to_pylist()], dtype=np.int64)
                words_ = b.column("n").to_numpy().astype(np.int64)
                for at, blocks in reach(b):
                    group = first[blocks] + part[at] % chunks[blocks]
                    piece = np.cumsum(words_[at]) // FLUSH
                    for k in np.split(np.arange(len(at)), np.nonzero(np.diff(piece))[0] + 1):
                        if len(k):
                            t = b.take(pa.array(at[k]))
                            zero = pa.array(np.zeros(len(k), dtype=np.int32))
                            yield pa.RecordBatch.from_arrays([pa.array(group[k], pa.int32()), zero, zero, t.column("n"), t.column("doc_id"), t.column("last_id"), t.column("digest"), t.column("seq"), pa.array(np.zeros(len(k), dtype=np.float32))], schema=schema)

        sent = asked.mapInArrow(send, MEETING)
        places = spark.createDataFrame(cells, "band int, centroid int, block int, split int")
        ranges = spark.createDataFrame([(k, int(first[k]), int(first[k] + chunks[k] - 1)) for k in range(number + 1) if chunks[k]], "block int, low int, high int")
        bands = sorted({band_ for k, (band_, _, at, split) in enumerate(cells) if chunks[at : at + split].any()})
        held = self.cells(bands).join(F.broadcast(places), ["band", "centroid"]).withColumn("block", (F.col("block") + F.pmod(F.xxhash64("digest"), F.col("split"))).cast("int"))
        held = held.join(F.broadcast(ranges), "block").withColumn("part", F.explode(F.sequence("low", "high")))
        held = held.select("part", F.lit(1).alias("side"), "centroid", "n", F.col("doc_id").alias("id"), "last_id", "digest", "seq", "angle")
        met = sent.unionByName(held).repartitionById(groups, F.col("part")).sortWithinPartitions("part", "side", "centroid", "n")
        return met.mapInArrow(_meet(self.centroids), empty)


def _chain(directions: np.ndarray) -> list[int]:
    """Rank of every centroid in a chain of nearest ones, so that cells of like direction share a block and fewer queries reach it."""
    rank, at, near_ = [-1] * len(directions), 0, directions @ directions.T
    for k in range(len(directions)):
        rank[at] = k
        left = [j for j, r in enumerate(rank) if r < 0]
        at = max(left, key=lambda j: near_[at, j], default=at)  # noqa: B023
    return rank


def _reach(stats: list, cells: list[tuple], blocks: int, directions: np.ndarray):
    """Rows of a batch with digest, n and seq, and the blocks whose bounds leave room for a holder of them, some rows at a time."""
    cent = np.array([r["centroid"] for r in stats])
    least, most, angle = (np.array([r[k] for r in stats], dtype=np.float64) for k in ("least", "most", "angle"))
    inside = np.zeros((len(cells), blocks), dtype=np.float32)
    for k, (_, _, at, split) in enumerate(cells):
        inside[k, at : at + split] = 1

    def run(b):
        n, seq = b.column("n").to_numpy().astype(np.float64)[:, None], b.column("seq")
        for s in range(0, b.num_rows, SLICE):
            e = min(s + SLICE, b.num_rows)
            ang = np.arccos(np.clip(unit(matrix(seq.slice(s, e - s).to_pylist())) @ directions.T, -1, 1))
            ok = (most >= SHARE * n[s:e] - 1e-6) & (least <= n[s:e] / SHARE + 1e-6) & (ang[:, cent] - angle <= ANGLE + 1e-3)
            at, to = np.nonzero(ok.astype(np.float32) @ inside)
            yield at + s, to

    return run


class _Asked:
    """The queries of a chunk by length, and the smallest id that each has met so far."""

    def __init__(self, pieces: list[pa.RecordBatch], directions: np.ndarray):
        t = pa.Table.from_batches(pieces).sort_by("n")
        self.n, self.id, self.digest = t["n"].to_numpy().astype(np.float32), t["id"].to_numpy(), t["digest"].to_pylist()
        self.below, self.met = t["last_id"].to_numpy().copy(), np.zeros(t.num_rows, dtype=bool)
        self.seq = t["seq"].to_pylist()
        self.counts = np.empty((t.num_rows, WIDTH), dtype=np.uint16 if self.n.max() < 1 << 16 else np.uint32)
        self.angle = np.empty((t.num_rows, len(directions)), dtype=np.float32)
        for s in range(0, t.num_rows, SLICE):
            c = self.counts[s : s + SLICE] = matrix(self.seq[s : s + SLICE])
            self.angle[s : s + SLICE] = np.arccos(np.clip(unit(c) @ directions.T, -1, 1))

    def meet(self, x: pa.RecordBatch) -> None:
        """Indexed vectors of one centroid by length; cells are pruned by angle, slices by length."""
        lens, xid, c = x.column("n").to_numpy().astype(np.float32), x.column("id").to_numpy(), x.column("centroid")[0].as_py()
        xb, xd, widest = x.column("seq").to_pylist(), x.column("digest").to_pylist(), x.column("angle").to_numpy().max()
        low, high = np.searchsorted(self.n, SHARE * lens[0] - 1e-3), np.searchsorted(self.n, lens[-1] / SHARE + 1e-3, side="right")
        ok = low + np.nonzero(self.angle[low:high, c] - widest <= ANGLE + 1e-3)[0]
        if not len(ok):
            return
        xc = matrix(xb)
        xv = np.sqrt(xc)
        for s in range(0, len(ok), 256):
            qq = ok[s : s + 256]
            lo, hi = np.searchsorted(lens, SHARE * self.n[qq[0]] - 1e-3), np.searchsorted(lens, self.n[qq[-1]] / SHARE + 1e-3, side="right")
            if lo >= hi:
                continue
            longer = np.maximum(self.n[qq][:, None], lens[None, lo:hi])
            qc = self.counts[qq].astype(np.float32)
            at, bt = np.nonzero((np.sqrt(qc) @ xv[lo:hi].T >= SHARE * longer - 1e-2 - 1e-4 * longer) & (xid[lo:hi][None] < self.below[qq][:, None]))
            if not len(at):
                continue
            # the histograms' common part bounds the common subsequence from above
            common = np.concatenate([np.minimum(qc[at[k : k + 1024]], xc[lo + bt[k : k + 1024]]).sum(axis=1) for k in range(0, len(at), 1024)])
            keep = common >= SHARE * longer[at, bt] - 1e-2
            places: dict[int, int] = {}
            last = -1
            for a, j in zip(at[keep], lo + bt[keep]):
                i = qq[a]
                if xid[j] >= self.below[i] or self.digest[i] == xd[j]:
                    continue
                if i != last:
                    last, places = i, {}
                    for k, w in enumerate(np.frombuffer(self.seq[i], "<u4").tolist()):
                        places[w] = places.get(w, 0) | 1 << k
                need = math.ceil(SHARE * max(int(self.n[i]), int(lens[j])) - 1e-9)
                if reaches(places, int(self.n[i]), np.frombuffer(xb[j], "<u4").tolist(), need):
                    self.below[i], self.met[i] = xid[j], True

    def found(self) -> pa.RecordBatch:
        k = np.nonzero(self.met)[0]
        return pa.RecordBatch.from_arrays([pa.array(self.id[k], pa.int64()), pa.array([self.digest[i] for i in k], pa.string()), pa.array(self.below[k], pa.int64())], names=["q_id", "q_digest", "x_id"])


def _meet(directions: np.ndarray):
    """Rows of MEETING by part, side, centroid and length: the queries of a part are held, its vectors pass by."""

    def run(batches):
        part, waiting, asked = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(k).to_numpy() for k in ("part", "side", "centroid")])
            edges = [0, *(np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1).tolist(), b.num_rows]
            for s, e in zip(edges, edges[1:]):
                if keys[0, s] != part:
                    if asked is not None:
                        yield asked.found()
                    part, waiting, asked = keys[0, s], [], None
                if keys[1, s] == 0:
                    waiting.append(b.slice(s, e - s))
                elif waiting or asked is not None:
                    if asked is None:
                        asked, waiting = _Asked(waiting, directions), []
                    for k in range(s, e, SLICE):
                        asked.meet(b.slice(k, min(SLICE, e - k)))
        if asked is not None:
            yield asked.found()

    return run


def holders(docs: DataFrame, batch: DataFrame, index: CellIndex | None = None) -> DataFrame:
    """(doc_id, first_doc_id, exact) of every batch row with an earlier holder, the smallest id of all.

    docs and batch: (doc_id, text); a holder is a row of either with a smaller
    id. exact: the first holder's text is equal after normalisation. The index
    of docs is built where none is given; the batch is appended to it.
    Null and blank texts have no holder. A row repeated under one id is one.
    """
    index = CellIndex.build(docs) if index is None else index
    new = written(vectors(batch), "batch_vectors")
    batch_classes = written(place(classes(new), index.centroids), "batch_classes")
    index.append_placed(batch_classes)
    pairs = written(index.probe(batch_classes), "near_pairs")
    links = pairs.select(F.col("q_digest").alias("digest"), F.col("x_id").alias("holder"), F.lit(False).alias("exact"))
    # equal texts: the index holds each class under its smallest id
    digests = new.select("doc_id", "digest").distinct()
    bands = [r["band"] for r in batch_classes.select("band").distinct().collect()]
    same = index.cells(bands).select("digest", F.col("doc_id").alias("holder")).join(batch_classes.select("digest"), "digest", "left_semi").withColumn("exact", F.lit(True))
    all_ = links.unionByName(same)
    found = digests.join(all_, "digest").where(F.col("holder") < F.col("doc_id"))
    return found.groupBy("doc_id").agg(F.min(F.struct("holder", (~F.col("exact")).alias("inexact"))).alias("h")).select("doc_id", F.col("h.holder").alias("first_doc_id"), (~F.col("h.inexact")).alias("exact"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, batch = table(spark, sf_dir, "documents"), table(spark, sf_dir, "batch_docs")
    return holders(spread(docs.select("doc_id", "text")), spread(batch.select("doc_id", "text"))).select("first_doc_id", "doc_id")


def content_hash(text):
    """SHA-256 of the text after NFC, without control characters, white space collapsed, lower case, trimmed."""
    import hashlib

    if text is None:
        return None
    t = unicodedata.normalize("NFC", text)
    t = "".join(c for c in t if c in "\t\n\r\x0b\x0c" or unicodedata.category(c) != "Cc")
    return hashlib.sha256(" ".join(t.split()).lower().encode("utf-8", "surrogatepass")).hexdigest()


def p5_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch row: held exactly, held nearly or new, with the earliest holder, when its hash was first seen and how often the registry saw it.

    first_seen is compared as an instant across its spellings; a hash that is
    known only from texts no longer at hand is an exact hold without an id,
    whether or not its time can be read.
    """
    batch = table(spark, sf_dir, "batch_docs").select("doc_id", "batch_no", "text")
    hashed = flat_map(batch, lambda: lambda i, b, t: [(i, b, content_hash(t) if t and t.strip() else None)], "doc_id long, batch_no int, hash string").dropDuplicates(["doc_id"])
    seen = table(spark, sf_dir, "content_hashes").where("hash is not null")
    instant = F.coalesce(*[F.try_to_timestamp(F.col("first_seen"), F.lit(p)) for p in ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd'T'HHmmssX", "yyyy-MM-dd")], F.col("first_seen").try_cast("timestamp"))  # the cast reads fractions of any length
    # only hashes of the batch pass the semi join, so the history is scanned but not shuffled beyond the matches
    mine = hashed.select("hash").where("hash is not null").distinct()
    seen = seen.join(mine, "hash", "left_semi").groupBy("hash").agg(F.min(instant).alias("first_seen"), F.lit(True).alias("known"))
    registry = table(spark, sf_dir, "corpus_doc_registry").where("content_hash <> ''").join(mine.withColumnRenamed("hash", "content_hash"), "content_hash", "left_semi").groupBy(F.col("content_hash").alias("hash")).agg(F.sum("observation_count").alias("observations"))
    h = holders(table(spark, sf_dir, "documents").select("doc_id", "text"), batch.select("doc_id", "text"))
    out = hashed.join(h, "doc_id", "left").join(seen, "hash", "left").join(registry, "hash", "left")
    status = F.when(F.col("exact") | (F.col("first_doc_id").isNull() & F.col("known")), "exact").when(F.col("first_doc_id").isNotNull(), "near").otherwise("new")
    return out.select("doc_id", "batch_no", status.alias("status"), "first_doc_id", "first_seen", "observations")
