"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Pieces are dealt by hash into blocks of bounded size. Several islands evolve each
block from seeds of their own: an individual is a list of bins, crossover injects
whole well-filled bins of one parent into the other, drops that parent's bins
holding a duplicate, and best-fits the displaced pieces, largest first. Between
epochs each island sends its elite to the next island of its block. The best
individual of a block stays; pieces of its badly filled bins are dealt anew with
those of other blocks, until one block is left. A task holds one block's lengths
and population, whatever the size of the input.
"""

from __future__ import annotations

import math
import random
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import stage
from txlens.llm.tokens import CACHE_ENTRIES, END_ID, default_tokenizer_path, encoder

CAPACITY = 2048
BLOCK = 2048
ISLANDS = 3
POPULATION = 4
GENERATIONS = 5
EPOCHS = 2
LEVELS = 6
LEAST_BINS = 8       # bins that a block's tokens fill on average, at least
WELL_FILLED = 0.995  # a bin at least this full is kept by crossover and after a round

_UID = "__uid"
_STATE = "block long, island int, uids binary, sizes binary, people binary, rank double"


class Bins:
    """One individual: bins of piece numbers, with best fit by remaining room."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        self.open = 0  # bit r: some bin has room r

    def add_bin(self, pieces: list[int], room: int) -> None:
        self._file(len(self.bins), room)
        self.bins.append(pieces)
        self.room.append(room)

    def _file(self, b: int, room: int) -> None:
        self.by_room.setdefault(room, []).append(b)
        self.open |= 1 << room

    def best_fit(self, piece: int) -> None:
        """Into the fullest bin that takes the piece, else a new bin."""
        size = self.sizes[piece]
        fits = self.open >> size
        if not fits:
            self.add_bin([piece], self.capacity - size)
            return
        room = size + (fits & -fits).bit_length() - 1
        same = self.by_room[room]
        b = same.pop()
        if not same:
            self.open &= ~(1 << room)
        self.bins[b].append(piece)
        self.room[b] = room - size
        self._file(b, room - size)

    def fill(self, pieces: list[int]) -> Bins:
        for p in pieces:
            self.best_fit(p)
        return self

    def fitness(self) -> float:
        """Fewer bins first; then the mean squared fill, which prefers full bins with one slack bin."""
        c = self.capacity
        return -len(self.bins) + sum(((c - r) / c) ** 2 for r in self.room) / (len(self.bins) + 1)

    def labels(self) -> np.ndarray:
        out = np.zeros(len(self.sizes), "<i4")
        for b, pieces in enumerate(self.bins):
            out[pieces] = b
        return out

    @classmethod
    def of_labels(cls, labels: np.ndarray, sizes: list[int], capacity: int) -> Bins:
        out = cls(sizes, capacity)
        bins: list[list[int]] = [[] for _ in range(int(labels.max()) + 1)]
        for p, b in enumerate(labels.tolist()):
            bins[b].append(p)
        for pieces in bins:
            out.add_bin(pieces, capacity - sum(sizes[p] for p in pieces))
        return out


def cross(keeper: Bins, giver: Bins, rng: random.Random) -> Bins:
    """Half of the giver's well-filled bins go whole into the keeper; the displaced pieces are best-fitted."""
    slack = keeper.capacity * (1 - WELL_FILLED)
    good = [b for b, r in enumerate(giver.room) if r <= slack]
    given = rng.sample(good, len(good) // 2) if len(good) > 1 else good
    taken = set()
    child = Bins(keeper.sizes, keeper.capacity)
    for b in given:
        child.add_bin(list(giver.bins[b]), giver.room[b])
        taken.update(giver.bins[b])
    loose: list[int] = []
    for b, pieces in enumerate(keeper.bins):
        if taken.isdisjoint(pieces) and not (keeper.room[b] > slack and rng.random() < 0.5):
            child.add_bin(list(pieces), keeper.room[b])
        else:
            loose += [p for p in pieces if p not in taken]
    loose.sort(key=keeper.sizes.__getitem__, reverse=True)
    return child.fill(loose)


def evolve(people: list[Bins], rng: random.Random, generations: int, size: int) -> list[Bins]:
    """The fittest ``size`` after so many generations; a perfect individual ends the search."""
    total, capacity = sum(people[0].sizes), people[0].capacity
    least = -(-total // capacity)
    people = sorted(people, key=Bins.fitness, reverse=True)[:size]
    for _ in range(generations):
        if len(people[0].bins) <= least:
            break
        first, second = rng.sample(people, 2) if len(people) > 1 else (people[0], people[0])
        children = [cross(first, second, rng), cross(second, first, rng)]
        people = sorted([*people, *children], key=Bins.fitness, reverse=True)[:size]
    return people


def found(sizes: list[int], capacity: int, rng: random.Random, size: int) -> list[Bins]:
    """Best-fit decreasing, then best fit over orders disturbed more and more."""
    people = []
    for k in range(size):
        noise = 0.15 * k * capacity
        order = sorted(range(len(sizes)), key=lambda p: -sizes[p] - noise * rng.random())
        people.append(Bins(sizes, capacity).fill(order))
    return people


def _pack(people: list[Bins]) -> bytes:
    return b"".join(p.labels().tobytes() for p in people)


def pack_round(items: DataFrame, blocks: int, capacity: int, islands: int, population: int, generations: int,
               epochs: int, seed: int) -> DataFrame:
    """The best individual found for each block: ``block, uids, sizes, people`` (labels of one individual)."""

    def start(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        sizes = pdf["length"].tolist()
        rng = random.Random(f"{seed}:{key}")
        people = evolve(found(sizes, capacity, rng, population), rng, generations, population)
        return _state(key, pdf["uid"].to_numpy("<i8").tobytes(), pdf["length"].to_numpy("<i4").tobytes(), people)

    def go_on(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["elite"] == 0].iloc[0]
        sizes = np.frombuffer(own["sizes"], "<i4").tolist()
        labels = np.frombuffer(b"".join(pdf.sort_values("elite")["people"]), "<i4").reshape(-1, len(sizes))
        rng = random.Random(f"{seed}:{key}:{len(pdf)}:{own['rank']}")
        people = evolve([Bins.of_labels(one, sizes, capacity) for one in labels], rng, generations, population)
        return _state(key, own["uids"], own["sizes"], people)

    def _state(key, uids, sizes, people) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "island": [key[1]], "uids": [uids], "sizes": [sizes],
                             "people": [_pack(people)], "rank": [people[0].fitness()]})

    dealt = items.select(F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(blocks)).alias("block"),
                         F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "uid", "length")
    state = dealt.groupBy("block", "island").applyInPandas(start, _STATE)
    one = F.length("sizes")  # bytes of one individual's labels
    for epoch in range(1, epochs):
        state = stage(state, f"pack-epoch{epoch}")
        elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.lit(None).cast("binary").alias("uids"),
                             F.lit(None).cast("binary").alias("sizes"), F.substring("people", F.lit(1), one).alias("people"), "rank",
                             F.lit(1).alias("elite"))
        state = (state.withColumn("elite", F.lit(0)).unionByName(elite)
                 .groupBy("block", "island").applyInPandas(go_on, _STATE))
    best = F.max_by(F.struct("uids", "sizes", F.substring("people", F.lit(1), one).alias("people")), F.struct("rank", -F.col("island")))
    return state.groupBy("block").agg(best.alias("b")).select("block", "b.*")


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS,
         population: int = POPULATION, generations: int = GENERATIONS, epochs: int = EPOCHS, seed: int = 7) -> DataFrame:
    """``uid, sequence_id, offset`` for every piece of a staged table ``(uid, length)``.

    ``uid`` is unique and not negative, 0 < length <= capacity. Pieces that fill a
    sequence alone get one; the others evolve. Sequence ids are unique numbers
    without meaning; offsets run without gaps from 0. Same input and parameters give the
    same packing.
    """
    alone = pieces.where(F.col("length") == capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items, out, level, closing = pieces.where(F.col("length") < capacity).select("uid", "length"), alone, 0, False
    count, tokens = items.agg(F.count(F.lit(1)), F.sum("length")).first()
    while count:
        # Blocks of several bins' tokens, so that one bin of each is a small part of it.
        blocks = max(1, min(math.ceil(count / block), tokens // (LEAST_BINS * capacity)))
        last, slack = blocks == 1, capacity * (1 - WELL_FILLED)

        def unfold(batches: Iterator[pd.DataFrame], level=level, last=last, slack=slack, closing=closing) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for b, uids, sizes, people in zip(batch["block"], batch["uids"], batch["sizes"], batch["people"]):
                    uid, size, label = np.frombuffer(uids, "<i8"), np.frombuffer(sizes, "<i4"), np.frombuffer(people, "<i4")
                    fill = np.bincount(label, size)
                    order = np.argsort(label, kind="stable")
                    ends = np.cumsum(size[order])
                    firsts = np.searchsorted(label[order], label[order])
                    offset = ends - size[order] - (ends[firsts] - size[order][firsts])
                    if last:
                        whole = np.ones(len(fill), bool)
                    elif closing:
                        whole = (np.arange(len(fill)) != fill.argmin()) | (fill >= capacity - slack)
                    else:
                        whole = fill >= capacity - slack
                    yield pd.DataFrame({"uid": uid[order], "length": size[order].astype("i8"), "done": whole[label[order]], "offset": offset.astype("i8"),
                                        "sequence_id": (level << 56) + (int(b) << 24) + label[order].astype("i8")})

        best = pack_round(items, blocks, capacity, islands, population, generations, epochs, seed + level)
        placed = stage(best.mapInPandas(unfold, "uid long, length long, done boolean, offset long, sequence_id long"), f"pack-level{level}")
        out = out.unionByName(placed.where("done").select("uid", "sequence_id", "offset"))
        items = placed.where("not done").select("uid", "length")
        left, tokens = items.agg(F.count(F.lit(1)), F.sum("length")).first()
        # Where few bins fill up any more, all but the emptiest of each block are closed from now on.
        closing = closing or level >= LEVELS - 1 or left > 0.9 * count
        count, level = left, level + 1
    return out


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
               tokenizer: str | None = None, end_id: int = END_ID, entries: int = CACHE_ENTRIES) -> DataFrame:
    """Staged pieces ``__uid, doc_id, piece, start, length, ids_crc32`` of every row.

    A document is its ids and ``end_id``; only one longer than ``capacity`` is
    cut, into full pieces after a first piece that may be shorter. Null texts are
    empty (one piece with the end id). Repeated rows and null ids are pieces of
    their own.
    """
    path = tokenizer or default_tokenizer_path()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = encoder(path, entries), struct.pack("<I", end_id)
        for batch in batches:
            rows = []
            for i, ids in zip(batch["_id"], enc.ids_of(batch["_text"])):
                data = ids + end
                n = len(data) // 4
                bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                rows += [(i, k, a, b - a, zlib.crc32(data[4 * a:4 * b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            yield pd.DataFrame(rows, columns=["_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    pieces = rows.mapInPandas(cut, "_id string, piece int, start long, length long, ids_crc32 long")
    kind = docs.schema[id_col].dataType
    pieces = pieces.select(F.monotonically_increasing_id().alias(_UID), F.col("_id").cast(kind).alias(id_col), "piece", "start", "length", "ids_crc32")
    return stage(pieces, "pieces")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   tokenizer: str | None = None, **options) -> DataFrame:
    """Every piece of every document with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    See ``cut_pieces`` for the pieces and ``pack`` for the options. Other columns
    of ``docs`` are ignored; an empty table gives no rows.
    """
    pieces = cut_pieces(docs, id_col, text_col, capacity, tokenizer)
    places = pack(pieces.select(F.col(_UID).alias("uid"), "length"), capacity, **options)
    return pieces.join(places.withColumnRenamed("uid", _UID), _UID).drop(_UID)
