"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut from the back into full pieces, which are sequences by themselves; only the
remainders, all shorter than a sequence, are packed. They are dealt by hash into shards of about ``SHARD`` pieces. Each
shard is a problem that ``ISLANDS`` islands solve, each with a population of packings that begins with best-fit
decreasing. A crossover takes whole bins of the second parent, best-filled first, into the first and removes the bins
that hold a duplicate of their pieces; a mutation opens some bins, mostly poor ones. Either way the displaced pieces go
back in two steps: bins with room swap up to two of their pieces for up to two displaced ones where that fills them
better (a fuller bin dominates), and what is left then goes in by best fit, largest first. An island stops once it meets
the bound that no packing can beat, or packs ``PATIENCE`` pieces again without getting better. After each of ``ROUNDS`` rounds
an island's elite packing also goes to the next island of its shard. The best packing of a shard keeps its well-filled
bins; the pieces of all others are dealt again into fewer shards and packed once more, until a level has a single shard
or fills bins for less than a tenth of its pieces.

A task works on one island: SHARD pieces and POPULATION packings of them. All random numbers come from the shard,
island and round, so a lost task gives the same packing again. An island hands out its elite twice, to itself and to
the next one, in one pass: no round is computed twice. The pieces (ids, lengths, checksums, no tokens) and each level's
result are written to the shared checkpoint folder.

Null texts read as empty and have the end id only; null ids are documents too, each row one; repeated rows are separate
documents; equal lengths are packed in the order of the rows' numbers; an empty table gives no rows. Columns other than
id and text are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.bpe import check_ranks
from skein.llm.text import filled, slices, small_batches
from skein.session import checkpointed

CAPACITY = 1024
END_ID = 2
SHARD = 4096
ISLANDS = 3
ROUNDS = 2
POPULATION = 5
#: Pieces that are packed again without a better packing coming out before an island stops: eight generations of a shard.
PATIENCE = 8 * SHARD
#: Generations at most, as a multiple of those.
LONGEST = 5
#: A bin's largest pieces that are tried in twos when it swaps.
TWOS = 6
#: Share of a bin's capacity from which it is left as it is when shards are joined.
FULL = 0.99


@lru_cache(maxsize=2)
def encoder(ranks: str, pattern: str, vocabulary: str):
    """A function from a text to its ids, those of the tokenizers file ``vocabulary`` without special tokens added.

    The rank file beside it has the same vocabulary but for the added tokens. Where one of their strings stands in a
    text it is one id, and what is before and after it is encoded by itself; of two that begin at a place the longer counts.
    """
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(vocabulary, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError(f"{vocabulary} has added tokens that look at or take what is beside them")
    added = {t["content"]: t["id"] for t in tokens}
    ordinary = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
    if not added:
        return ordinary
    split = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})").split

    def encode(text: str) -> list[int]:
        first, *rest = split(text)
        ids = ordinary(first)
        for token, part in zip(rest[::2], rest[1::2]):
            ids.append(added[token])
            ids += ordinary(part)
        return ids

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece of n ids: one if they fit, else full ones after a first that may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, ranks: str, pattern: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of every document: doc_id, piece, start, length and the checksum of its ids."""
    small_batches(docs.sparkSession)

    def run(batches):
        encode = encoder(ranks, pattern, vocabulary)
        for piece in slices(batches, text):
            rows = []
            for d, t in zip(piece.column(doc_id).to_pylist(), filled(piece.column(text)).to_pylist()):
                ids = np.array([*encode(t), end_id], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((d, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Room:
    """Open bins by the room left in them; the best fit is the lowest set bit at or above a size."""

    def __init__(self, capacity: int) -> None:
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self.mask |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        """Room and number of a bin with the least room of at least ``size``."""
        fits = self.mask >> size
        if not fits:
            return None
        room = size + (fits & -fits).bit_length() - 1
        number = self.bins[room].pop()
        if not self.bins[room]:
            self.mask &= ~(1 << room)
        return room, number


def best_fit(bins: list[list[int]], items: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """The bins with the items put in, each into the bin that it leaves the least room in, else into a new one."""
    room = Room(capacity)
    for i, b in enumerate(bins):
        if left := capacity - sum(sizes[k] for k in b):
            room.add(left, i)
    for k in items:
        size = sizes[k]
        if got := room.take(size):
            left, i = got
            bins[i].append(k)
        else:
            left, i = capacity, len(bins)
            bins.append([k])
        if left > size:
            room.add(left - size, i)
    return bins


class Loose:
    """Displaced pieces by size. Sets of sizes are bits of integers, so that fits and sums of two are found at once."""

    def __init__(self, items: list[int], sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.of: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = self.mirror = 0
        for k in items:
            self.add(k)

    def add(self, k: int) -> None:
        size = self.sizes[k]
        self.of[size].append(k)
        self.mask |= 1 << size
        self.mirror |= 1 << self.capacity - size

    def take(self, size: int) -> int:
        k = self.of[size].pop()
        if not self.of[size]:
            self.mask &= ~(1 << size)
            self.mirror &= ~(1 << self.capacity - size)
        return k

    def largest(self, room: int) -> int:
        """The greatest size that fits, or 0."""
        fits = self.mask & (2 << room) - 1
        return fits.bit_length() - 1 if fits else 0

    def two(self, total: int) -> tuple[int, int] | None:
        """Sizes of two pieces that come to exactly ``total``."""
        both = self.mask & self.mirror >> self.capacity - total
        if not total % 2 and both >> total // 2 & 1 and len(self.of[total // 2]) < 2:
            both &= ~(1 << total // 2)
        return (low := (both & -both).bit_length() - 1, total - low) if both else None

    def items(self) -> list[int]:
        """All pieces, largest first, then by number."""
        return [k for own in reversed(self.of) for k in sorted(own)]


def dominate(bins: list[list[int]], loose: Loose, sizes: list[int], capacity: int) -> None:
    """Each bin with room swaps none, one or two pieces for one or two loose ones as long as that fills it better."""
    for b in bins:
        room = capacity - sum(sizes[k] for k in b)
        while room and loose.mask:
            top = sorted(b, key=lambda k: -sizes[k])[:TWOS]
            out = [(), *((k,) for k in b), *((x, y) for i, x in enumerate(top) for y in top[:i])]
            gain, best = 0, None
            for gone in out:
                size = sum(sizes[k] for k in gone)
                one = loose.largest(size + room)
                if one - size > gain:
                    gain, best = one - size, (gone, (one,))
                    if gain == room:
                        break
                if pair := loose.two(size + room):
                    gain, best = room, (gone, pair)
                    break
            if not best:
                break
            gone, come = best
            added = [loose.take(size) for size in come]
            for k in gone:
                b.remove(k)
                loose.add(k)
            b += added
            room -= gain


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones: sum of squared fills."""
    return -len(bins), sum((sum(sizes[k] for k in b) / capacity) ** 2 for b in bins)


def put_back(bins: list[list[int]], displaced: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """The bins with the displaced pieces: swaps of dominance first, then best fit."""
    loose = Loose(displaced, sizes, capacity)
    dominate(bins, loose, sizes, capacity)
    return best_fit(bins, loose.items(), sizes, capacity)


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, share: float) -> list[list[int]]:
    """The first parent with the best-filled ``share`` of the second's bins injected whole."""
    ranked = sorted(b, key=lambda x: -sum(sizes[k] for k in x))
    injected = [list(x) for x in ranked[: max(1, int(len(ranked) * share))]]
    there = {k for x in injected for k in x}
    child, displaced = injected, []
    for x in a:
        if there.isdisjoint(x):
            child.append(list(x))
        else:
            displaced += [k for k in x if k not in there]
    return put_back(child, displaced, sizes, capacity)


def mutated(a: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """The packing with two bins to a tenth of them opened, the emptier the likelier, and their pieces put back."""
    ranked = sorted(a, key=lambda x: sum(sizes[k] for k in x))
    n = len(ranked)
    many = int(2 * max(1.0, n / 20) ** rng.random())
    opened = set((n * rng.random(many) ** 4).astype(int).tolist())
    kept = [list(x) for i, x in enumerate(ranked) if i not in opened]
    return put_back(kept, [k for i in opened for k in ranked[i]], sizes, capacity)


def evolve(sizes: list[int], capacity: int, seeds: list[list[list[int]]], rng: np.random.Generator, population: int = POPULATION, patience: int = PATIENCE) -> list[list[int]]:
    """The fittest packing after some generations from the seeds, best-fit decreasing and its disturbances."""
    waits = max(1, patience // max(1, len(sizes)))
    down = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    least = -(-sum(sizes) // capacity)
    people: list[tuple[tuple[int, float], list[list[int]]]] = []

    def born(bins: list[list[int]]) -> None:
        people.append((fitness(bins, sizes, capacity), bins))

    for seed in [*seeds, best_fit([], down, sizes, capacity)]:
        born(seed)
    if -max(p[0] for p in people)[0] > least:
        while len(people) < population:
            noise = rng.normal(0, capacity / 64, len(sizes))
            born(best_fit([], sorted(range(len(sizes)), key=lambda k: (-(sizes[k] + noise[k]), k)), sizes, capacity))
    people.sort(key=lambda p: p[0], reverse=True)
    stale = 0
    for g in range(LONGEST * waits):
        best = people[0][0]
        if -best[0] <= least or stale >= waits:
            break
        i, j = rng.choice(len(people), 2, replace=False)
        born(mutated(people[min(i, j)][1], sizes, capacity, rng) if g % 2 else crossover(people[i][1], people[j][1], sizes, capacity, float(rng.uniform(0.2, 0.8))))
        people = sorted(people, key=lambda p: p[0], reverse=True)[:population]
        stale = 0 if people[0][0] > best else stale + 1
    return people[0][1]


def _encoded(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for i, b in enumerate(bins):
        for k in b:
            out[k] = i
    return out


def _bins(codes: list[int]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(max(codes, default=-1) + 1)]
    for k, i in enumerate(codes):
        out[i].append(k)
    return out


def pack(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``items`` (row long, length long; lengths from 1 to the capacity) with ``sequence_id`` and ``offset``."""
    spark = items.sparkSession
    left, done, last, level = items.select("row", "length"), [], False, 0
    schema = "shard long, row long, length long, bin long, offset long, fill long"
    n = left.count()
    while n and not last:
        shards = max(1, -(-n // shard))
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)))
        # A shard is one row of arrays, bounded by its share of the hash; islands and rounds then move single rows.
        rows = dealt.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("row", "length"))).alias("items"))
        islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
        state = rows.select("shard", islands.alias("island"), F.col("items.row").alias("rows"), F.col("items.length").alias("sizes"), F.array().cast("array<array<int>>").alias("seeds"))
        # Work is by rows, not bytes, so the number of tasks is given; adaptive execution would merge them.
        tasks = min(shards * ISLANDS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        for r in range(ROUNDS):
            state = _round(state.repartition(tasks, "shard", "island"), level, r, capacity)
            if r < ROUNDS - 1:
                own = F.first("rows").alias("rows"), F.first("sizes").alias("sizes")
                state = state.groupBy("shard", "island").agg(*own, F.array_sort(F.collect_list(F.struct("guest", "elite"))).alias("e")).select("shard", "island", "rows", "sizes", F.col("e.elite").alias("seeds"))
        best = state.filter("not guest").groupBy("shard").agg(F.max_by(F.struct("rows", "sizes", "elite"), F.struct("fit", -F.col("island"))).alias("b")).select("shard", "b.*")
        packed = checkpointed(best.mapInArrow(_laid_out(capacity), schema))
        poor = packed.filter(F.col("fill") < int(FULL * capacity)).select("row", "length")
        again = poor.count()
        last = shards == 1 or 10 * again > 9 * n  # then another level would fill few bins more
        keep = packed if last else packed.filter(F.col("fill") >= int(FULL * capacity))
        done.append(keep.select("row", (F.lit(level << 56) + F.col("shard") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"), "offset"))
        left, n, level = poor, again, level + 1
    if not done:
        return spark.createDataFrame([], "row long, sequence_id long, offset long")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


STATE = "shard long, island int, guest boolean, rows array<long>, sizes array<long>, elite array<int>, fit struct<bins:int,fill:double>"


def _round(state: DataFrame, level: int, r: int, capacity: int) -> DataFrame:
    """Each island evolves from its seeds; the elite is the bin number of every item.

    It is handed out for the island itself and, as a guest, for the next one of its shard.
    """

    def run(frames):
        for f in frames:
            out = []
            for s, i, rows, sizes, seeds in zip(f["shard"], f["island"], f["rows"], f["sizes"], f["seeds"]):
                sizes = [int(x) for x in sizes]
                rng = np.random.default_rng([level, r, int(s), int(i)])
                elite = evolve(sizes, capacity, [_bins([int(x) for x in seed]) for seed in seeds], rng)
                bins, fill = fitness(elite, sizes, capacity)
                made = rows, sizes, _encoded(elite, len(sizes)), {"bins": bins, "fill": fill}
                out.append((s, i, False, *made))
                if r < ROUNDS - 1:
                    out.append((s, (i + 1) % ISLANDS, True, *made))
            yield pd.DataFrame(out, columns=["shard", "island", "guest", "rows", "sizes", "elite", "fit"])

    return state.mapInPandas(run, STATE)


def _laid_out(capacity: int):
    """A row for each item of the best packing: its bin, its place there and the bin's fill."""

    def run(batches):
        for b in batches:
            for s, rows, sizes, elite in zip(*(b.column(k).to_pylist() for k in ("shard", "rows", "sizes", "elite"))):
                r, n, e = np.array(rows, np.int64), np.array(sizes, np.int64), np.array(elite, np.int64)
                order = np.lexsort((r, e))
                r, n, e = r[order], n[order], e[order]
                ends = np.cumsum(n)
                first = np.concatenate(([0], np.flatnonzero(np.diff(e)) + 1))
                base = np.repeat((ends - n)[first], np.diff(np.concatenate((first, [len(e)]))))
                fill = np.bincount(e, n).astype(np.int64)[e]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), s, np.int64)), *map(pa.array, (r, n, e, ends - n - base, fill))], names=["shard", "row", "length", "bin", "offset", "fill"])

    return run


def packed_documents(docs: DataFrame, ranks: str, pattern: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there, gapless from 0."""
    check_ranks(vocabulary, ranks)
    cut_up = pieces(docs, ranks, pattern, vocabulary, doc_id, text, capacity).withColumn("row", F.monotonically_increasing_id())
    held = checkpointed(cut_up)  # row numbers are fixed from here on
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = held.filter(F.col("length") == capacity).select("*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).select(names)
    rest = held.filter(F.col("length") < capacity)
    return full.unionByName(rest.join(pack(rest, capacity), "row").select(names))


def op8_ga_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op8: every document's pieces of at most 1024 ids in as few sequences as can be."""
    import public_tokenizers as tokens

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed_documents(docs, tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN, tokens.path("byte_bpe_50k.json"))
