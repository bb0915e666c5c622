"""Problem 7: documents into containers of fixed capacity, with little unused space.

First-fit decreasing: the items of a group are taken from the largest down and each goes into the
first container with room for it.  A tournament tree over the containers' free space finds that
container in log(n) steps.  Groups are drawn at random by a hash of the document, so that each has
the size distribution of the whole and is packed by one task on its own; only (document, tokens)
pairs are shuffled, and a group never holds more than about ``group_items`` items.

A document larger than the capacity, and only such a document, is split: into full containers and
one remainder, which is packed like any other item.  Between two items of a container stand
``separator_tokens``.

Defined results: documents that are null or have no tokens take no space and are left out; a
container spec without a positive capacity packs nothing, a null separator counts as none, a spec
listed twice counts once; ties in size are broken by document id, so results are reproducible.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.session import BROADCAST_ROWS, materialize

#: Items in a group; large enough that the last, part-filled containers don't count.
GROUP_ITEMS = 20_000


def first_fit_decreasing(sizes: np.ndarray, capacity: int, separator: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Container number and place in it for sizes that are sorted from the largest down.

    Every size must lie in 1..capacity.  With one separator more in the capacity, each item can be
    charged one separator, the one after it.
    """
    n = len(sizes)
    room = capacity + separator
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [room] * (2 * leaves)  # winner of each match: the most free space below
    count = [0] * n
    bins, places = np.empty(n, np.int64), np.empty(n, np.int64)
    for i, size in enumerate(sizes.tolist()):
        need = size + separator
        node = 1
        while node < leaves:  # the leftmost container with room
            node += node
            if tree[node] < need:
                node += 1
        number = node - leaves
        bins[i], places[i] = number, count[number]
        count[number] += 1
        free = tree[node] = tree[node] - need
        node >>= 1
        while node:  # replay the matches on the way up
            a, b = tree[node + node], tree[node + node + 1]
            best = a if a > b else b
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1
        del free
    return bins, places


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    capacity, separator = int(pdf["capacity"].iloc[0]), int(pdf["separator"].iloc[0])
    pdf = pdf.sort_values(["size", "doc_id", "part"], ascending=[False, True, True], kind="stable")
    bins, places = first_fit_decreasing(pdf["size"].to_numpy(), capacity, separator)
    return pd.DataFrame(
        {
            "container_name": pdf["container_name"].to_numpy(), "group_no": pdf["group_no"].to_numpy(), "container_no": bins,
            "place": places, "doc_id": pdf["doc_id"].to_numpy(), "part": pdf["part"].to_numpy(), "n_parts": pdf["n_parts"].to_numpy(),
            "n_tokens": pdf["size"].to_numpy(),
        }
    )


_OUT = (
    "container_name string, group_no int, container_no long, place long, doc_id long, part int, n_parts int, n_tokens long"
)


def pack(sizes: DataFrame, specs: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Where each document, or each part of one, goes.

    ``sizes``: doc_id, n_tokens.  ``specs``: container_name, capacity_tokens, separator_tokens; a
    table of a few rows, whose number is checked before it is broadcast.
    """
    # Written once, as counting the items would otherwise compute the sizes again.
    sizes = materialize(sizes.where("n_tokens > 0").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("n_tokens").cast("long").alias("n_tokens")), "sizes")
    kinds = (
        specs.where("capacity_tokens > 0 and container_name is not null")
        .groupBy("container_name").agg(F.max(F.struct("capacity_tokens", "separator_tokens")).alias("s"))
        .select("container_name", F.col("s.capacity_tokens").cast("long").alias("capacity"), F.greatest(F.lit(0), F.coalesce("s.separator_tokens", F.lit(0))).cast("long").alias("separator"))
    )
    if kinds.count() > BROADCAST_ROWS:
        raise ValueError(f"more than {BROADCAST_ROWS} kinds of containers")
    parts = F.ceil(F.col("n_tokens") / F.col("capacity")).cast("int")
    items = (
        sizes.crossJoin(F.broadcast(kinds))  # each document once for each of a few kinds of containers
        .withColumn("n_parts", parts)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        .withColumn("size", F.least(F.col("capacity"), F.col("n_tokens") - F.col("part") * F.col("capacity")))
    )
    # The number of groups follows the number of items of the kind with the most.
    most = items.groupBy("container_name").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    groups = max(1, math.ceil(most / group_items))
    drawn = items.withColumn("group_no", F.pmod(F.xxhash64("doc_id", "part", "container_name"), F.lit(groups)).cast("int"))
    return drawn.select("container_name", "group_no", "capacity", "separator", "doc_id", "part", "n_parts", "size").groupBy("container_name", "group_no").applyInPandas(_pack, _OUT)


def fill(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Of each container kind: containers, tokens, share of the space filled, and the least number
    of containers that any packing of these items could need."""
    used = packed.groupBy("container_name", "group_no", "container_no").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("k"))
    by = used.groupBy("container_name").agg(
        F.count(F.lit(1)).alias("n_containers"), F.sum("k").alias("n_items"), F.sum("t").alias("n_tokens")
    )
    kinds = specs.groupBy("container_name").agg(F.max("capacity_tokens").cast("long").alias("capacity_tokens"))
    return by.join(kinds, "container_name").select(
        "container_name", "capacity_tokens", "n_containers", "n_items", "n_tokens",
        (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill"),
        F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"),
    )
