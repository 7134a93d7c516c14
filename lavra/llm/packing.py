"""Filling fixed-capacity containers with texts.

Sizes are tokens. A text larger than the capacity is cut into pieces of the capacity (at the last token that ends a
character) and a rest; no other text is divided. Items are placed online by sum of squares: of all fill levels that have a
container with room, and of opening a new one, the choice that leaves the sum of the squared numbers of containers at each
level smallest; the numbers are kept in a level array, ties go to the fullest container.

Items are spread over blocks by a hash, about ``BLOCK`` a block, and each block is packed by itself; the containers a block
leaves unfilled are then packed once more as items of their level, in blocks again. The blocks hold ids and sizes only.

Defined results: null and empty texts take no room and are in no container; repeated rows are items of their own; a
character larger than the capacity is divided between pieces, the first of which holds its place; capacities below 1 are
none; the number of blocks follows from the number of items, so that every size is handled alike; containers follow from
the rows alone, not from how they are spread; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.tokens import TOKENIZER, encode, encoder
from lavra.runtime import cut, map_batches, small

BLOCK = 40_000
#: Containers filled less than this go through the second packing.
AGAIN = 0.98


class Levels:
    """The level array: how many open containers have each fill level, and which."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, size: int) -> int:
        """The container an item of this size goes into."""
        c, n = self.capacity, self.counts
        best, level = (2 * n[size] + 1 if size < c else 0), 0
        if size < c:
            change = 2 * (n[1 + size : c + 1] - n[1 : c - size + 1]) + 2
            change[-1] -= 1  # a filled container leaves the array
            change[n[1 : c - size + 1] == 0] = np.iinfo(np.int64).max
            i = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[i] <= best:
                level = i + 1
        if level:
            box = self.open[level].pop()
            n[level] -= 1
        else:
            box = self.made
            self.made += 1
        if level + size < c:
            self.open[level + size].append(box)
            n[level + size] += 1
        return box


def pack(sizes, capacity: int) -> list[int]:
    """The container of each item, in order."""
    levels = Levels(capacity)
    return [levels.place(int(s)) for s in sizes]


def text_pieces(text: str, capacities: list[int], path: str = TOKENIZER) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each capacity the pieces of a text: ``(first token, tokens, start, end)``, positions in characters."""
    enc = encoder(path)
    sizes = [len(enc.decode_single_token_bytes(t)) for t in encode(text, path)]  # bytes of each token
    n = len(sizes)
    out = {c: [(0, n, 0, len(text))] for c in capacities if n <= c}
    if len(out) == len(capacities):
        return out
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    starts = (data & 0xC0) != 0x80
    ends = np.cumsum(sizes)
    at_character = np.ones(n, dtype=bool)
    at_character[:-1] = starts[ends[:-1]]
    characters = np.concatenate([[0], np.cumsum(starts)])
    for c in capacities:
        if n <= c:
            continue
        parts, at, pos = [], 0, 0
        while at < n:
            to = min(n, at + c)
            while at < to < n and not at_character[to - 1]:
                to -= 1
            to = to if to > at else min(n, at + c)
            end = int(characters[ends[to - 1]])
            parts.append((at, to - at, pos, end))
            at, pos = to, end
        out[c] = parts
    return out


def items(documents: DataFrame, containers: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """``recipiente_id, capacity, doc_id, same, piece, first_token, tokens, start_pos, end_pos``; ``same`` stands for the text."""
    kinds = [(r.recipiente_id, r.capacidade_tokens) for r in containers.select("recipiente_id", "capacidade_tokens").distinct().collect() if r.capacidade_tokens and r.capacidade_tokens > 0]  # the kinds of containers asked for

    def run(batches):
        for ids, same, texts in batches:
            out: list[list] = [[] for _ in range(9)]
            for i, h, text in zip(ids, same, texts):
                if not text:
                    continue
                by = text_pieces(text, sorted({c for _, c in kinds}), path)
                for r, c in kinds:
                    for k, part in enumerate(by[c]):
                        for column, v in zip(out, (r, c, i, h, k, *part)):
                            column.append(v)
            yield out

    return map_batches(documents.select("doc_id", F.xxhash64("text").alias("same"), "text"), run, "recipiente_id int, capacity int, doc_id long, same long, piece int, first_token int, tokens int, start_pos int, end_pos int")


def _packed(things: DataFrame, block: int) -> DataFrame:
    """``recipiente_id, key, box, level`` of ``recipiente_id, capacity, key, tokens``."""
    n = things.groupBy("recipiente_id").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    spread = things.join(small(n), "recipiente_id").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("order", kind="stable")
        r, b = group["recipiente_id"].iloc[0], group["block"].iloc[0]
        boxes = pack(group["tokens"].to_numpy(), int(group["capacity"].iloc[0]))
        out = pd.DataFrame({"recipiente_id": group["recipiente_id"], "key": group["key"], "box": [f"{r}.{b}.{x}" for x in boxes], "tokens": group["tokens"]})
        out["level"] = out.groupby("box")["tokens"].transform("sum")
        return out[["recipiente_id", "key", "box", "level"]]

    spread = spread.withColumn("order", F.xxhash64("key", F.lit(7)))
    return spread.groupBy("recipiente_id", "block").applyInPandas(run, "recipiente_id int, key string, box string, level long")


def containers_of(documents: DataFrame, containers: DataFrame, path: str = TOKENIZER, block: int = BLOCK) -> DataFrame:
    """``recipiente_id, container, doc_id, piece, first_token, tokens, start_pos, end_pos``: what is in every container."""
    # repeated rows are told apart by a number, which one of them has which makes no difference
    made = items(documents, containers, path)
    counted = made.groupBy(*made.columns).agg(F.count("*").cast("int").alias("times")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("times"))))
    all_items = cut(counted.withColumn("key", F.concat_ws("-", "doc_id", F.hex("same"), "piece", "k")))
    full = all_items.where("tokens = capacity").withColumn("container", F.concat_ws(".", "recipiente_id", F.lit("full"), "key"))
    first = cut(_packed(all_items.where("tokens < capacity").select("recipiente_id", "capacity", "key", "tokens"), block))
    size = all_items.select("recipiente_id", "capacity").distinct()
    loose = first.groupBy("recipiente_id", "box").agg(F.first("level").alias("tokens")).join(small(size), "recipiente_id").where(F.col("tokens") < AGAIN * F.col("capacity"))
    second = cut(_packed(loose.select("recipiente_id", "capacity", F.col("box").alias("key"), "tokens"), block)).select("recipiente_id", F.col("key").alias("box"), F.concat(F.lit("m"), "box").alias("merged"))
    placed = first.join(second, ["recipiente_id", "box"], "left").select("recipiente_id", "key", F.coalesce("merged", "box").alias("container"))
    done = all_items.join(placed, ["recipiente_id", "key"])
    columns = ("recipiente_id", "container", "doc_id", "piece", "first_token", "tokens", "start_pos", "end_pos")
    return done.select(*columns).unionByName(full.select(*columns))
