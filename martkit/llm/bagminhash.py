"""Near-duplicate classes by BagMinHash over multisets of word shingles.

Signature.  Every shingle has a Poisson process over (weight x time).  The weight axis is
cut hierarchically into the cells [0,1), [1,2), [2,4), [4,8), ...; each cell has a process
of its own with a rate equal to its width, and a point in a cell gets its unit of weight
from the binary digits of a hash.  A document that holds a shingle c times sees the points
whose weight is below c.  Points are dealt to the ``M`` signature places; a place keeps the
point of smallest time.  Two documents agree in a place with probability equal to their
weighted Jaccard similarity.  Points are made in ascending time only up to a limit at which
all places are filled, so the work per document is about its shingles plus M ln M.

Classes.  Documents with equal multisets are one member from here on.  Members that share a
band meet one member of that band's bucket, chosen by a hash that differs from band to band;
the links are verified on the exact multisets and joined into components.  That work is
linear in the size of a bucket, however large.  In buckets that still hold several
components, every member outside the bucket's largest one is then compared with all members
of other components, block by block: those whose signatures could be similar enough are
verified in place, and only links between components leave the task.  No pair is capped or
sampled away.

Members are numbered by their multiset, not by an id, and a text is fetched by its 128-bit
hash, so ids may repeat or be null.

Defined cases: null and empty texts, and texts without words, have no shingles and are
classes of their own; a text of fewer than five words is one shingle; rows that repeat an
id fall into one class, whatever their texts; a null id joins nothing, but its text is
compared as any other; a class is named by its smallest id, and by null if all its ids are
null; of a class the rows of that id are kept, or, if all ids are null, the rows of one of
its texts; an empty table gives an empty result; only id and text are read, so extra columns
cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, ship, store, table
from .phrase_index import words
from .pieces import Cache

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
M = BANDS * ROWS
#: a pair is verified if at least this share of its signature places agree; 3.7 standard
#: deviations below the similarity that counts
LIKELY = 0.65
#: members of a bucket that one task compares with as many others
BLOCK = 512

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


_WORDS: Cache = Cache(xxhash.xxh64_intdigest, 50_000)


def shingles(text: str | None, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each occurs."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_WORDS.__getitem__, w), np.uint64, len(w))
    n = max(1, len(h) - width + 1)
    s = np.zeros(n, np.uint64)
    for i in range(min(width, len(h))):
        s = s * _A + _mix(h[i: i + n] + _B)
    return np.unique(_mix(s), return_counts=True)


def signature(hashes: np.ndarray, counts: np.ndarray, m: int = M) -> np.ndarray:
    """BagMinHash signature: for each place the identity of its earliest point."""
    total = float(counts.sum())
    limit = (math.log(m) + 4.6) / total
    cells = [(0, 0, 1)]  # number, lower end, width
    while cells[-1][1] + cells[-1][2] < counts.max():
        low = cells[-1][1] + cells[-1][2]
        cells.append((len(cells), low, low))
    while True:
        times, places, points = [], [], []
        for number, low, width in cells:
            live = counts > low
            own, weight = hashes[live], counts[live]
            rate, at, k = m * float(width), np.zeros(len(own)), 0
            step = int(min(256, max(1, rate * limit * 1.2 + (3 if rate * limit > 1 else 0))))
            while len(own):
                serial = np.arange(k, k + step, dtype=np.uint64) + np.uint64(number << 40)
                x = _mix(own[:, None] + _A * (serial[None, :] + np.uint64(1)))
                u = ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
                t = at[:, None] + np.cumsum(-np.log(u), axis=1) / rate
                early = t <= limit
                r, c = np.nonzero(early)
                if len(r):
                    ids = x[r, c]
                    y = _mix(ids ^ _C)
                    cell = low + (((y & np.uint64(0xFFFFFFFF)) * np.uint64(width)) >> np.uint64(32)).astype(np.int64)
                    seen = cell < weight[r]
                    times.append(t[r, c][seen])
                    places.append((((y >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32))[seen].astype(np.int64))
                    points.append(ids[seen])
                more = early[:, -1]
                own, weight, at, k = own[more], weight[more], t[more, -1], k + step
        t, place, point = map(np.concatenate, (times, places, points)) if times else (np.zeros(0),) * 3
        out, filled = np.zeros(m, np.uint64), np.zeros(m, bool)
        if len(t):
            order = np.argsort(-t, kind="stable")
            out[place[order]] = point[order]
            filled[place] = True
        if filled.all():
            return out
        limit *= 1.6


def bands(sig: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    rows = sig.reshape(n_bands, -1)
    h = _mix(np.arange(n_bands, dtype=np.uint64) + _A)
    for i in range(rows.shape[1]):
        h = _mix(h * _A + rows[:, i])
    return h.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    either = float(a[1].sum() + b[1].sum()) - both
    return both / either if either else 0.0


def sketch(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, t0, t1, digest, bands, places) of every row; digest is null without shingles.

    ``t0`` and ``t1`` are two hashes of the text.
    """
    ship(spark)

    def make(batches):
        for b in batches:
            digests, band, place = [], [], []
            for text in b.column(1):
                s, c = shingles(text.as_py())
                if not len(s):
                    digests.append(None), band.append(None), place.append(None)
                    continue
                sig = signature(s, c)
                digests.append(hashlib.blake2b(s.tobytes() + c.tobytes(), digest_size=16).digest())
                band.append(bands(sig))
                place.append((sig >> np.uint64(32)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(digests, pa.binary()), pa.array(band, pa.list_(pa.int64())),
                 pa.array(place, pa.binary())],
                ["doc_id", "t0", "t1", "digest", "bands", "places"])

    return with_text_hashes(docs.select(F.col("doc_id").cast("bigint"), "text")).select("doc_id", "text", "t0", "t1").mapInArrow(
        released(make), "doc_id bigint, t0 bigint, t1 bigint, digest binary, bands array<bigint>, places binary")


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a text (a null text counts as empty)."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def with_text_hashes(docs: DataFrame) -> DataFrame:
    """``docs`` with the hashes of the text as columns t0 and t1."""
    t0, t1 = text_hashes(F.col("text"))
    return docs.withColumns({"t0": t0, "t1": t1})


class IdFilter:
    """A Bloom filter over ids of at most ``MOST_BITS`` bits (4 MB), built by grouped bit sums.

    It only spares rows that a later join would drop; it never decides on its own.
    """

    MOST_BITS, SALTS = 1 << 25, 4

    def __init__(self, ids: DataFrame):
        n = ids.count()
        self.bits = min(self.MOST_BITS, max(1 << 12, 1 << (16 * n).bit_length()))

        def mark(batches):
            for b in batches:
                at = np.concatenate([self._at(b.column(0).to_numpy(), k) for k in range(self.SALTS)])
                cells, masks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
                if len(at):
                    cells, place = np.unique(at >> np.uint64(6), return_inverse=True)
                    masks = np.zeros(len(cells), np.uint64)
                    np.bitwise_or.at(masks, place, np.uint64(1) << (at & np.uint64(63)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.view(np.int64)), pa.array(masks.view(np.int64))], ["cell", "mask"])

        rows = ids.mapInArrow(released(mark), "cell bigint, mask bigint").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
        self.cells = np.zeros(self.bits // 64, np.uint64)
        self.cells[rows["cell"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)

    def _at(self, ids: np.ndarray, salt: int) -> np.ndarray:
        return _mix(ids.astype(np.int64).view(np.uint64) * _A + np.uint64(salt)) & np.uint64(self.bits - 1)

    def keep(self, docs: DataFrame, id_col: str) -> DataFrame:
        cells, at, salts = self.cells, self._at, self.SALTS

        @F.pandas_udf("boolean")
        def may_hold(ids: pd.Series) -> pd.Series:
            known = ids.notna().to_numpy()
            x = ids.fillna(0).to_numpy()
            for k in range(salts):
                p = at(x, k)
                known = known & ((cells[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)) == 1)
            return pd.Series(known)

        return docs.filter(may_hold(F.col(id_col)))


def texts_of(spark: SparkSession, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored (id, text) of the members ``wanted`` (id, t0, t1, owner, no_owner): the text of
    one row with these hashes and that id; other documents' texts are not shuffled."""
    rows = with_text_hashes(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    rows = IdFilter(wanted.select("t0")).keep(rows, "t0")
    mine = rows.withColumns({"owner": F.coalesce("doc_id", F.lit(0)), "no_owner": F.col("doc_id").isNull()})
    found = mine.join(wanted, ["t0", "t1", "owner", "no_owner"])
    return store(spark, found.groupBy("id").agg(F.max("text").alias("text")), "candidate-texts")


def verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) whose exact multisets are similar enough.

    A text is repeated once per pair only in flight; ``b`` may be one id in very many pairs,
    so the join on it is left to adaptive skew splitting and a task keeps a few multisets.
    """
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))

    def check(batches):
        known: OrderedDict = OrderedDict()
        for batch in batches:
            keep = []
            for b, ta, tb in zip(batch.column(1), batch.column(2), batch.column(3)):
                key = b.as_py()
                if key not in known:
                    known[key] = shingles(tb.as_py())
                    if len(known) > 64:
                        known.popitem(last=False)
                keep.append(overlap(shingles(ta.as_py()), known[key]) >= similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep, pa.bool_())), batch.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(released(check), "a bigint, b bigint")


def _roots(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, root): each vertex of ``edges`` follows smallest neighbours down to a local minimum."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")),
                             F.struct(F.col("b").alias("id"), F.col("a").alias("other"))))
    near = edges.select(ends.alias("end")).select("end.*").groupBy("id")
    up = store(spark, near.agg(F.least("id", F.min("other")).alias("root")), "roots")
    while True:
        over = up.select(F.col("id").alias("root"), F.col("root").alias("above"))
        jumped = store(spark, up.join(over, "root").select("id", F.col("root").alias("was"), F.col("above").alias("root")), "roots")
        up = jumped.select("id", "root")
        if not jumped.filter(F.col("was") != F.col("root")).limit(1).count():
            return up


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, label): the smallest id linked to each id.

    Every round merges each vertex into the local minimum it leads to and keeps the distinct
    links between the merged vertices, so a round reads fewer links than the one before.
    """
    edges, labels = links, None
    while True:
        roots = _roots(spark, edges)
        if labels is None:
            labels = roots.select("id", F.col("root").alias("label"))
        else:
            labels = relabel(spark, labels, roots)
        for end in ("a", "b"):
            edges = edges.join(roots.select(F.col("id").alias(end), F.col("root").alias(f"of_{end}")), end)
        edges = edges.select(F.greatest("of_a", "of_b").alias("a"), F.least("of_a", "of_b").alias("b"))
        edges = store(spark, edges.filter("a <> b").distinct(), "merged-links")
        if not edges.limit(1).count():
            return labels


def relabel(spark: SparkSession, labels: DataFrame, roots: DataFrame) -> DataFrame:
    """``labels`` (id, label) with each label replaced by its (id, root), where it has one."""
    over = roots.select(F.col("id").alias("label"), "root")
    named = labels.join(over, "label", "left").select("id", F.coalesce("root", "label").alias("label"))
    return store(spark, named, "labels")


def link_block(ids, labels, places, marks, texts, rest, band: int, similarity: float) -> list[tuple[int, int]]:
    """Links between different components of one block of a bucket.

    Rows with ``rest`` are compared with the rows without.  Pairs that share an earlier band
    are left to that band's bucket; pairs already connected in this block are skipped.  A link
    is given by the labels of the two components.
    """
    root = {x: x for x in labels}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    bags: dict[int, tuple] = {}

    def bag(k):
        if k not in bags:
            bags[k] = shingles(texts[k])
        return bags[k]

    x = np.flatnonzero(~rest)
    out = []
    for k in np.flatnonzero(rest):
        same = (places[x] == places[k]).mean(axis=1)
        likely = (same >= LIKELY) & (labels[x] != labels[k])
        if band:
            likely &= ~(marks[x, :band] == marks[k, :band]).any(axis=1)
        for j in x[likely][np.argsort(-same[likely], kind="stable")]:
            a, b = find(labels[k]), find(labels[j])
            if a != b and overlap(bag(k), bag(j)) >= similarity:
                root[max(a, b)] = min(a, b)
                out.append((max(labels[k], labels[j]), min(labels[k], labels[j])))
    return out


def late_links(mixed: DataFrame, members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between different components in the buckets of ``mixed``.

    ``mixed`` has (band, hash, id, label, base) with base the label of the bucket's largest
    component.  Members outside the base ("rest") meet all members, block by block.
    """
    key = ["band", "hash"]
    sizes = mixed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_all"), F.sum((F.col("label") != F.col("base")).cast("int")).alias("n_rest"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    rows = mixed.join(sizes, key).join(members.select("id", "places", "bands"), "id").join(texts, "id")
    at = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), blocks(n)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    as_all = F.transform(upto("n_rest"), lambda j: F.struct(at("n_all", 1).alias("i"), j.alias("j"), F.lit(False).alias("rest")))
    as_rest = F.transform(upto("n_all"), lambda i: F.struct(i.alias("i"), at("n_rest", 2).alias("j"), F.lit(True).alias("rest")))
    spots = F.when(F.col("label") != F.col("base"), F.concat(as_all, as_rest)).otherwise(as_all)
    dealt = rows.withColumn("spot", F.explode(spots)).select("band", "hash", "id", "label", "places", "bands", "text", "spot.*")

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        links = link_block(
            pdf["id"].to_numpy(), pdf["label"].to_numpy(),
            np.frombuffer(b"".join(pdf["places"]), "<u4").reshape(len(pdf), -1), np.array(pdf["bands"].tolist()),
            pdf["text"].tolist(), pdf["rest"].to_numpy(), int(key[0]), similarity)
        return pd.DataFrame({"a": [a for a, _ in links], "b": [b for _, b in links]}, dtype=np.int64)

    return dealt.groupBy("band", "hash", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, t0, t1, class_id, kept): the smallest id of the class of each document.

    Classes are the connected components of "similarity of the shingle multisets is at
    least ``similarity``"; the document whose id is the class id is kept.  ``t0`` and ``t1``
    are hashes of the row's text (``with_text_hashes``), which tell rows of one id apart.
    """
    ship(spark)
    rows = store(spark, sketch(spark, docs), "bag-sketches")
    known = rows.filter(F.col("digest").isNotNull())
    # the row of a member that speaks for it: its smallest id, null last
    owner = F.struct(F.col("doc_id").isNull().alias("no_owner"), F.coalesce("doc_id", F.lit(0)).alias("owner"), "t0", "t1")
    members = known.groupBy("digest").agg(
        F.min(owner).alias("row"), F.first("bands").alias("bands"), F.first("places").alias("places"))
    # a number for each member, fixed by storing it
    members = store(spark, members.select(F.monotonically_increasing_id().alias("id"), "digest", "row.*", "bands", "places"), "bag-members")
    buckets = members.select("id", F.posexplode("bands").alias("band", "hash"))
    choice = F.min(F.struct(F.xxhash64("id", "band").alias("order"), "id")).alias("first")
    first = buckets.groupBy("band", "hash").agg(choice, F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select("band", "hash", F.col("first.id").alias("first"))
    shared = store(spark, buckets.join(first, ["band", "hash"]), "bag-buckets")
    stars = shared.filter("id <> first").select(F.greatest("id", "first").alias("a"), F.least("id", "first").alias("b"))
    stars = store(spark, stars.distinct(), "bag-stars")
    wanted = shared.select("id").distinct().join(members.select("id", "t0", "t1", "owner", "no_owner"), "id")
    texts = texts_of(spark, docs, store(spark, wanted, "bag-candidates"))
    links = store(spark, verify(stars, texts, similarity).unionByName(_same_id(known, members)), "bag-links")
    labels = components(spark, links)
    named = shared.join(labels, "id", "left").select("band", "hash", "id", F.coalesce("label", "id").alias("label"))
    counts = named.groupBy("band", "hash", "label").agg(F.count(F.lit(1)).alias("n"))
    several = counts.groupBy("band", "hash").agg(
        F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    several = several.select("band", "hash", F.col("most.label").alias("base"))
    mixed = store(spark, named.join(several, ["band", "hash"]), "bag-mixed")
    late = store(spark, late_links(mixed, members, texts, similarity).distinct(), "bag-late")
    if late.limit(1).count():
        merged = components(spark, late).select("id", F.col("label").alias("root"))
        labels = relabel(spark, named.select("id", "label").distinct(), merged)
    of_digest = members.select("digest", "id").join(labels, "id", "left").select(
        "digest", F.coalesce("label", "id").alias("label"))
    labelled = known.select("doc_id", "t0", "t1", "digest").join(of_digest, "digest").drop("digest")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("class_id"), F.col("t0").alias("k0"), F.col("t1").alias("k1"))
    # stored, so that a class that very many documents share is split in the join
    classes = store(spark, labelled.groupBy("label").agg(F.min(row).alias("row")).select("label", "row.*"), "bag-classes")
    same_text = (F.col("t0") == F.col("k0")) & (F.col("t1") == F.col("k1"))
    kept = F.when(F.col("no_id"), same_text).otherwise(F.col("doc_id").eqNullSafe(F.col("class_id")))
    with_class = labelled.join(classes, "label").select("doc_id", "t0", "t1", "class_id", kept.alias("kept"))
    alone = rows.filter(F.col("digest").isNull())
    return with_class.unionByName(alone.select("doc_id", "t0", "t1", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")))


def _same_id(known: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between members that share an id: each with the smallest one of the id."""
    several = known.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("digest").alias("first"), F.max("digest").alias("last")).filter("first <> last")
    pairs = known.select("doc_id", "digest").join(several.select("doc_id", "first"), "doc_id").filter("digest <> first")
    number = members.select("id", "digest")
    pairs = pairs.select("digest", "first").distinct().join(number, "digest").withColumnRenamed("id", "x").drop("digest")
    pairs = pairs.join(number.select(F.col("id").alias("y"), F.col("digest").alias("first")), "first")
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
