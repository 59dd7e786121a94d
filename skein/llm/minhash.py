"""Near-duplicate classes by DartMinHash signatures, banded joining and exact similarity.

Elements are shingles of five lower-cased words (all words of a shorter text), with weight 1 each, or with their
number of occurrences. Each element throws darts on its region, weight by rank: a Poisson process whose randomness is
a hash of the element, so that equal elements throw equal darts in every text. Unit-wide layers split a region by
weight, and a dart above the element's weight misses. Each dart falls on one of ``K`` coordinates, and the earliest
dart of a coordinate is its value. About K (ln K + 3) darts are needed whatever the length of the text: the rank up to
which darts are thrown is set by the text's total weight, and doubled where a coordinate stayed empty. Two texts agree
in a coordinate with the probability of their weighted Jaccard similarity.

Joining: texts with equal element sets are one node. Bands of ``ROWS`` coordinates are bucket keys.

1. In each bucket every member is compared with the bucket's leader, the member with most bucket fellows.
2. Where a bucket still holds several components, each member is compared with its likeliest partners in others, by
   their signatures.
3. Where it still does, all pairs of members in different components are compared. Pairs inside a component need no
   comparison: they would change no class. The pairs are counted by products of 0/1 matrices where the members meet,
   and only links that join components leave a task.

All comparisons are of the whole element sets (32-bit shingle hashes), and no pair of a bucket is left out. Leaders are
sent once to each ``BLOCK`` of their fellows. Steps 2 and 3 read a bucket in blocks of ``BLOCK`` members, each pair of
blocks a task of its own, so no bucket is cut off or gathered whole; blocks of a bucket's greatest component do not
meet each other. With 24 bands of 5 a pair of similarity 0.8 shares no bucket with probability 0.00007.

Components are found by passing on least labels with shortcuts, each step written to the shared checkpoint folder.

There is one row for each row of the input. Null texts and texts without words are classes of their own. Repeated rows
have one class. Rows of one id with different texts are different documents: each has the class of its own text. A null
id has a null class. Ties of leaders go to the least node. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.text import MULTIPLIER, SpanHash, byte_view, filled, mix, slices, small_batches, words_of
from skein.session import checkpointed

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
K = BANDS * ROWS
BLOCK = 1024
PARTNERS = 2
#: Elements that a matrix product takes at once.
COLUMNS = 2048
SLICE = 1 << 19


def elements(texts: pa.Array, size: int = SHINGLE, weights: str = "set") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and weight of each distinct shingle of each text, by row, then hash.

    ``weights``: "set" gives weight 1, "count" the number of occurrences.
    """
    data, off = byte_view(pc.utf8_lower(filled(texts)))
    start, end, row = words_of(data, off)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
    word = SpanHash(data)(start, end)
    first = np.searchsorted(row, np.arange(len(off) - 1))
    last = np.searchsorted(row, np.arange(len(off) - 1), side="right")
    n = len(word)
    h = np.zeros(n, np.uint64)
    for k in range(size):  # words after the text's end count as none
        inside = np.arange(k, n + k) < last[row]
        h = mix(h * np.uint64(3) + np.where(inside, word[np.minimum(np.arange(k, n + k), n - 1)], np.uint64(k)) + MULTIPLIER)
    whole = (np.arange(n) + size <= last[row]) | (np.arange(n) == first[row])
    h, row = h[whole], row[whole]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(h))).astype(float)
    return h[at], row[at], count if weights == "count" else np.ones(len(at))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _layers(h: np.ndarray, row: np.ndarray, weight: np.ndarray):
    """Unit-wide weight layers of each element: hash, row and how much of the layer the element's region fills."""
    n = np.ceil(weight).astype(np.int64)
    which = np.repeat(np.arange(len(h)), n)
    layer = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return mix(h[which] + layer.astype(np.uint64) * MULTIPLIER), row[which], np.minimum(weight[which] - layer, 1.0)


def dart_signatures(h: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """k values (uint32) for each of n rows; rows without elements have zeros."""
    seed, row, fill = _layers(h, row, weight)
    total = np.bincount(row, fill, minlength=n)
    out = np.zeros((n, k), np.uint32)
    todo = total > 0
    limit = k * (np.log(k) + 3) / np.maximum(total, 1e-300)
    while todo.any():
        at = np.flatnonzero(todo[row])
        time = np.zeros(len(at))
        cells, times, values = [], [], []
        dart = 0
        while len(at):
            code = mix(seed[at] + np.uint64((dart + 1) * 0xD1342543DE82EF95 % (1 << 64)))
            time = time - np.log(_uniform(code))
            early = time < limit[row[at]]
            at, time, code = at[early], time[early], code[early]
            value = mix(code ^ MULTIPLIER)
            hit = _uniform(mix(value ^ np.uint64(0xA5A5A5A5))) < fill[at]
            cells.append(row[at][hit] * k + (value[hit] >> np.uint64(32)).astype(np.int64) % k)
            times.append(time[hit])
            values.append(value[hit].astype(np.uint32))
            dart += 1
        cell, when, value = np.concatenate(cells), np.concatenate(times), np.concatenate(values)
        late_first = np.argsort(-when, kind="stable")
        flat, filled_ = out.reshape(-1), np.zeros(n * k, bool)
        flat[cell[late_first]] = value[late_first]  # the earliest is written last
        filled_[cell] = True
        todo &= ~filled_.reshape(n, k).all(1)
        limit = np.where(todo, 2 * limit, limit)
    return out


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit bucket key for each row and band."""
    n, k = signatures.shape
    parts = signatures.reshape(n, bands, k // bands).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * MULTIPLIER), (n, bands)).copy()
    for i in range(k // bands):
        key = mix(key * np.uint64(5) + parts[:, :, i])
    return key.view(np.int64)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, a hash that tells texts of one id apart, and text."""
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("sub"), F.col(text).alias("text"))


def sketches(docs: DataFrame, weights: str = "set") -> DataFrame:
    """id, sub, two digests of the element set (null without elements), bucket keys and signature of every text."""
    small_batches(docs.sparkSession)

    def run(batches):
        for piece in slices(batches, "text", SLICE):
            n = len(piece)
            h, row, weight = elements(piece.column("text"), weights=weights)
            sig = dart_signatures(h, row, weight, n)
            there = np.bincount(row, minlength=n) > 0
            starts = np.searchsorted(row, np.arange(n))
            sums = []
            for salt in (1, 2):
                c = np.concatenate(([0], np.cumsum(mix(h * np.uint64(2 * salt + 1) + weight.astype(np.uint64) + MULTIPLIER)))).astype(np.uint64)
                ends = np.searchsorted(row, np.arange(n), side="right")
                sums.append(pa.array((c[ends] - c[starts]).view(np.int64), mask=~there))
            keys = pa.array(list(band_keys(sig)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("sub"), *sums, keys, pa.array([s.tobytes() for s in sig], pa.binary())], names=["id", "sub", "d1", "d2", "keys", "sig"])

    return docs.mapInArrow(run, "id long, sub long, d1 long, d2 long, keys array<long>, sig binary")


def element_sets(texts: DataFrame, weights: str) -> DataFrame:
    """id and sorted 32-bit hashes of the elements of every text (an element of weight n is n elements)."""
    small_batches(texts.sparkSession)

    def run(batches):
        for piece in slices(batches, "text"):
            h, row, _ = _layers(*elements(piece.column("text"), weights=weights))
            parts = np.split((h >> np.uint64(32)).astype(np.uint32).view(np.int32), np.searchsorted(row, np.arange(1, len(piece))))
            yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array([np.unique(p) for p in parts], pa.list_(pa.int32()))], names=["id", "elements"])

    return texts.mapInArrow(run, "id long, elements array<int>")


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, size) whose Jaccard similarity reaches the threshold; an a has no more b than the greatest size.

    The sets of all b of an a come in blocks, each after the set of a, which so is sent once a block and not with every
    pair. There are as many blocks as the size asks for, in powers of two, so that a block stays small whatever pairs of
    smaller sizes fall into it.
    """
    blocks = F.greatest(F.lit(1), F.pow(F.lit(2), F.ceil(F.log2(F.col("size") / BLOCK)))).cast("int")
    tails = pairs.select("a", F.pmod(F.xxhash64("b"), blocks).cast("int").alias("block"), F.lit(1).alias("kind"), F.col("b").alias("id"))
    heads = tails.select("a", "block").distinct().select("a", "block", F.lit(0).alias("kind"), F.col("a").alias("id"))
    laid = heads.union(tails).join(sets, "id").repartition("a", "block").sortWithinPartitions("a", "block", "kind")

    def run(batches):
        head = np.zeros(0, np.int32)
        for batch in batches:
            lists, out = batch.column("elements"), []
            flat, off = lists.values.to_numpy(), lists.offsets.to_numpy()
            for k, (a, kind, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "kind", "id")))):
                own = flat[off[k] : off[k + 1]]
                if kind == 0:
                    head = own
                    continue
                both = np.count_nonzero(head[np.minimum(np.searchsorted(head, own), len(head) - 1)] == own)
                if both >= (threshold - 1e-12) * (len(head) + len(own) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return laid.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for each end of an edge (a, b); the label is the least id of the component."""
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = checkpointed(labels)
    while True:
        heard = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, F.col("id") == F.col("a"), "left").select("id", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("id").alias("via"), F.col("label").alias("there"))
        stepped = lower.join(jump, F.col("label") == F.col("via"), "left").select("id", "old", F.least("label", "there").alias("label"))
        stepped = checkpointed(stepped)
        if stepped.filter("label < old").isEmpty():
            return labels
        labels = stepped.select("id", "label")


def _mixed(named: DataFrame) -> DataFrame:
    """key, the label with most members, and the members with that label and with others, of buckets of several labels."""
    each = named.groupBy("key", "label").agg(F.count("*").alias("n"))
    top = each.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("labels")).filter("labels > 1")
    return top.select("key", F.col("top.label").alias("main"), F.col("top.n").alias("n_main"), (F.col("all") - F.col("top.n")).alias("n_rest"))


def _tasks(rows: DataFrame, *columns: str) -> DataFrame:
    """key, i, j, block and columns of each member of mixed buckets, once for each pair of blocks that it is in.

    The blocks of the main label come first; they meet those of the rest only, and the rest all.
    """
    count = {k: F.ceil(F.col(k) / BLOCK).cast("int") for k in ("n_main", "n_rest")}
    main = F.col("label") == F.col("main")
    own = F.when(main, F.pmod(F.xxhash64("id"), count["n_main"])).otherwise(count["n_main"] + F.pmod(F.xxhash64("id"), count["n_rest"])).cast("int")
    spread = rows.withColumn("block", own).withColumn("first", F.when(main, count["n_main"]).otherwise(0)).withColumn("last", count["n_main"] + count["n_rest"] - 1)
    tasks = F.transform(F.sequence("first", "last"), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    return spread.withColumn("task", F.explode(tasks)).select("key", "task.i", "task.j", "block", *columns)


def _by_task(spread: DataFrame, group, schema: str) -> DataFrame:
    """``group(table)`` for the rows of each (key, i, j), which come one group after the other."""
    spread = spread.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            name = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
            lo = 0
            for hi in range(1, len(name) + 1):
                if hi == len(name) or name[hi] != name[lo]:
                    if held and name[lo] != at:
                        yield group(pa.Table.from_batches(held))
                        held = []
                    at = name[lo]
                    held.append(batch.slice(lo, hi - lo))
                    lo = hi
        if held:
            yield group(pa.Table.from_batches(held))

    return spread.mapInArrow(run, schema)


def _partners(rows: DataFrame) -> DataFrame:
    """Pairs (a, b, size) of each member of a task with the likeliest few in other components, by signature.

    ``rows``: key, i, j, block, id, label, sig, n (members of the bucket).
    """

    def group(t: pa.Table) -> pa.RecordBatch:
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        ids, label, block = (t[c].to_numpy() for c in ("id", "label", "block"))
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint32).reshape(len(ids), -1)
        out = []
        for own, other in [(i, j), (j, i)][: 1 + (i != j)]:
            left, right = np.flatnonzero(block == own), np.flatnonzero(block == other)
            if not len(right):
                continue
            for p in left:
                agree = np.where(label[right] != label[p], (sig[right] == sig[p]).mean(1), -1)
                best = np.argsort(-agree, kind="stable")[:PARTNERS]
                out += [(ids[p], ids[right[q]]) for q in best if agree[q] >= 0]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        size = pa.array([PARTNERS * t["n"][0].as_py()] * len(pairs), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(pairs.min(1)), pa.array(pairs.max(1)), size], names=["a", "b", "size"])

    return _by_task(rows, group, "a long, b long, size long").groupBy("a", "b").agg(F.max("size").alias("size"))


def _intersections(parts: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common elements of each member of ``left`` with each of ``right``, by products of 0/1 matrices."""
    member = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    _, column, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    often = count[column] > 1
    member, column = member[often], (np.cumsum(count > 1) - 1)[column[often]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        has = np.zeros((len(parts), COLUMNS), np.float32)
        has[member[a:b], column[a:b] - lo] = 1
        out += has[left] @ has[right].T
    return out


def _links(rows: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join the components of each task, by exact similarities of all its members.

    ``rows``: key, i, j, block, id, label, elements.
    """

    def group(t: pa.Table) -> pa.RecordBatch:
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        ids, label, block = (t[c].to_numpy() for c in ("id", "label", "block"))
        parts = [e.values.to_numpy() for e in t["elements"]]
        size = np.array([len(p) for p in parts])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        both = _intersections(parts, left, right)
        either = size[left][:, None] + size[right][None, :] - both
        near = (both >= (threshold - 1e-9) * either) & (label[left][:, None] != label[right][None, :])
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for x, y in zip(*(k.tolist() for k in np.nonzero(near))):
            a, b = find(int(label[left[x]])), find(int(label[right[y]]))
            if a != b:
                root[a] = b
                out.append(sorted((int(ids[left[x]]), int(ids[right[y]]))))
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return _by_task(rows, group, "a long, b long")


def _classes(docs: DataFrame, doc_id: str, text: str, threshold: float, weights: str) -> DataFrame:
    """id, sub, label and class_id of every row; the label, null for texts without words, tells classes apart."""
    texts = keyed(docs, doc_id, text)
    made = checkpointed(sketches(texts, weights))
    known = made.filter(F.col("id").isNotNull() & F.col("d1").isNotNull())
    # Keys and signatures are the same for all texts of a digest, so any of them will do.
    nodes = known.groupBy("d1", "d2").agg(F.min(F.struct("id", "sub")).alias("p"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
    nodes = checkpointed(nodes.select(F.monotonically_increasing_id().alias("id"), "d1", "d2", F.col("p.id").alias("rep"), F.col("p.sub").alias("sub"), "keys", "sig"))
    slots = nodes.select("id", F.explode("keys").alias("key"))
    sizes = checkpointed(slots.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
    shared = slots.join(sizes, "key")
    degree = shared.groupBy("id").agg(F.sum("size").alias("degree"))
    shared = checkpointed(shared.join(degree, "id"))
    leader = checkpointed(shared.groupBy("key").agg((-F.max(F.struct("degree", (-F.col("id")).alias("minus")))["minus"]).alias("leader")))
    wanted = nodes.join(shared.select("id").distinct(), "id", "left_semi").select(F.col("rep").alias("id"), "sub", F.col("id").alias("node"))
    once = texts.join(wanted, ["id", "sub"]).dropDuplicates(["node"]).select(F.col("node").alias("id"), "text")
    sets = checkpointed(element_sets(once, weights))
    tried = shared.join(leader, "key").filter("id != leader").groupBy(F.col("leader").alias("a"), F.col("id").alias("b")).agg(F.max("size").alias("size"))
    links = checkpointed(similar(checkpointed(tried), sets, threshold))
    labels = components(links)
    for step in ("partners", "all"):
        named = shared.select("key", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        mixed = checkpointed(_mixed(named))
        if mixed.isEmpty():
            break
        members = named.join(mixed, "key")
        if step == "partners":
            rows = _tasks(members.withColumn("n", F.col("n_main") + F.col("n_rest")), "id", "label", "n").join(nodes.select("id", "sig"), "id")
            found = similar(checkpointed(_partners(rows)), sets, threshold)
        else:
            found = _links(_tasks(members, "id", "label").join(sets, "id"), threshold).distinct()
        found = checkpointed(found)
        if not found.isEmpty():
            links = checkpointed(links.union(found))
            labels = components(links)
    least = labels.join(nodes.select("id", "rep"), "id").groupBy("label").agg(F.min("rep").alias("class_id"))
    joined = labels.join(least, "label")
    of = checkpointed(nodes.select("id", "d1", "d2", "rep").join(joined, "id", "left").select("d1", "d2", F.coalesce("label", "id").alias("label"), F.coalesce("class_id", "rep").alias("class_id")))
    named = known.select("id", "sub", "d1", "d2").join(of, ["d1", "d2"]).select("id", "sub", "label", "class_id")
    rest = made.filter(F.col("id").isNull() | F.col("d1").isNull())
    return named.union(rest.select("id", "sub", F.lit(None).cast("long").alias("label"), F.col("id").alias("class_id")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY, weights: str = "set") -> DataFrame:
    """``doc_id`` and ``class_id`` of every row: the least id of the texts linked by similarities from the threshold on."""
    return _classes(docs, doc_id, text, threshold, weights).select(F.col("id").alias(doc_id), "class_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class: that of its least id, of several texts of that id the one of least hash.

    Rows with null ids stay. Of repeated rows one stays, but for texts without words, which are classes of their own.
    """
    found = _classes(docs, doc_id, text, threshold, "set")
    best = found.filter(F.col("label").isNotNull() & (F.col("id") == F.col("class_id"))).groupBy("label").agg(F.min(F.struct("id", "sub")).alias("p"))
    best = best.select(F.col("p.id").alias("__id"), F.col("p.sub").alias("__sub"), F.lit(True).alias("__one"))
    alone = found.filter(F.col("label").isNull() & F.col("id").isNotNull()).select(F.col("id").alias("__id"), F.col("sub").alias("__sub"), F.lit(False).alias("__one")).distinct()
    marked = docs.withColumn("__hash", F.xxhash64(text))
    kept = marked.join(best.union(alone), (F.col(doc_id) == F.col("__id")) & (F.col("__hash") == F.col("__sub")))
    one = kept.filter("__one").dropDuplicates(["__id", "__sub"]).unionByName(kept.filter("not __one"))
    return one.select(docs.columns).unionByName(docs.filter(F.col(doc_id).isNull()))


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class and whether it stands for it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).withColumn("kept", F.col("doc_id") == F.col("class_id"))


#: The same classes by comparing all documents that share a shingle; for tables of a few thousand documents.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0) t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM r JOIN both_ways ON a = id)
SELECT id AS doc_id, min(root) AS class_id, id = min(root) AS kept FROM r GROUP BY id"""
