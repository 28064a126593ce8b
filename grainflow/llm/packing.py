"""Filling containers of fixed capacity with items, by swap-based local search.

Items are dealt by hash into groups of about GROUP items, which are packed independently. Within a
group a best-fit start is improved: items move, or are exchanged one for one or two for one, from
emptier into fuller bins whenever that raises the sum of the squared fills, until nothing does. The
groups' underfull bins are then searched once more together.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .token_sizes import VOCABULARY, token_sizes

GROUP = 8000
#: bins that are full but for this share are left alone
FULL = 0.002


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: the largest items first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # sorted (room, bin)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = bisect_left(room, (sizes[k], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(bins)
            bins.append([])
        bins[b].append(k)
        insort(room, (left - sizes[k], b))
    return bins


def improve(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """The bins after the local search, without empty ones.

    The emptiest bin gives: each of its items x moves into a bin with room for it, or goes there in
    exchange for one smaller item or two that together are smaller, the exchange that leaves the
    least room. Each step takes from an emptier into a fuller bin, so the sum of squares grows and
    the search ends. Within a pass, bins that are full, or can't give any more, drop out; passes are
    repeated until one changes nothing.
    """
    fill = [sum(sizes[k] for k in b) for b in bins]
    items = [sorted((sizes[k], k) for k in b) for b in bins]
    while _pass(items, fill, capacity):
        pass
    return [[k for _, k in b] for b in items if b]


def _pass(items: list[list[tuple[int, int]]], fill: list[int], capacity: int) -> bool:
    """One pass of improve() over the bins' sorted items and fills, in place; whether it changed any."""
    changed = False
    live = {j for j in range(len(items)) if items[j] and fill[j] < capacity * (1 - FULL)}
    for a in sorted(live, key=lambda j: (fill[j], j)):
        live.discard(a)
        others = sorted(live, key=lambda j: (-fill[j], j))
        again = True
        while again and items[a]:
            again = False
            for x in sorted(items[a], reverse=True):
                best = None  # (room left, bin, what comes back)
                for j in others:
                    if fill[j] < fill[a]:
                        break
                    room = capacity - fill[j]
                    if not room:
                        continue
                    if x[0] <= room:
                        got = (room - x[0], j, ())
                    else:
                        got = _exchange(items[j], x[0], room, j)
                    if got is not None and (best is None or got < best):
                        best = got
                        if not best[0]:
                            break
                if best is None:
                    continue
                _, j, back = best
                items[a].remove(x)
                insort(items[j], x)
                delta = x[0]
                for y in back:
                    items[j].remove(y)
                    insort(items[a], y)
                    delta -= y[0]
                fill[a] -= delta
                fill[j] += delta
                again = changed = True
                break
    return changed


def _exchange(have: list[tuple[int, int]], x: int, room: int, j: int) -> tuple | None:
    """The item, or two, of a bin that make just enough room for x and are smaller than x together."""
    need = x - room
    best = None
    at = bisect_left(have, (need, -1))
    if at < len(have) and have[at][0] < x:
        best = (room + have[at][0] - x, j, (have[at],))
    lo, hi = 0, len(have) - 1
    while lo < hi:
        both = have[lo][0] + have[hi][0]
        if both < need:
            lo += 1
        else:
            if both < x and (best is None or room + both - x < best[0]):
                best = (room + both - x, j, (have[lo], have[hi]))
            hi -= 1
    return best


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; every size is 1..capacity."""
    return improve(best_fit(sizes, capacity), sizes, capacity)


def packed(sizes: DataFrame, specs: DataFrame, group: int = GROUP) -> DataFrame:
    """spec_id, container, doc_id, piece, tokens, fill from sizes (key, tokens) and specs (spec_id,
    capacity_tokens, sep_tokens).

    sep_tokens lie between two items of a container. A document larger than the capacity is cut into
    full pieces, which are containers of their own, and a rest that is packed like an item; all others
    are piece 0. fill is the container's tokens with separators. Documents of no tokens are left out,
    as are specs without a positive capacity. container is unique within a spec.
    """
    total = sizes.where("tokens > 0").count()
    groups = max(1, -(-total // group))
    kinds = dict(specs.dtypes)
    wanted = specs.where("capacity_tokens > 0").select("spec_id", "capacity_tokens", "sep_tokens").distinct().collect()  # a row per spec
    each = [F.struct(F.lit(r[0]).cast(kinds["spec_id"]).alias("spec_id"), F.lit(r[1]).alias("capacity_tokens"), F.lit(r[2] or 0).alias("sep_tokens")) for r in wanted]
    none = F.array().cast(f"array<struct<spec_id:{kinds['spec_id']},capacity_tokens:int,sep_tokens:int>>")
    x = sizes.where("tokens > 0").withColumn("spec", F.explode(F.array(*each) if each else none)).select("key", "tokens", "spec.*")
    cap = F.col("capacity_tokens")
    x = x.withColumn("full", (F.col("tokens") / cap).cast("bigint")).withColumn("rest", F.col("tokens") % cap)
    whole = x.where("tokens > capacity_tokens and full > 0").select(
        "spec_id",
        F.explode(F.sequence(F.lit(1), F.col("full"))).alias("piece"),
        F.col("key").alias("doc_id"),
        cap.cast("bigint").alias("tokens"),
    )
    whole = whole.select("spec_id", F.concat_ws(":", F.lit("d"), F.col("doc_id").cast("string"), F.col("piece").cast("string")).alias("container"), "doc_id", F.col("piece").cast("int").alias("piece"), "tokens", F.col("tokens").alias("fill"))
    items = x.select(
        "spec_id",
        (F.col("capacity_tokens") + F.col("sep_tokens")).cast("bigint").alias("capacity"),
        "sep_tokens",
        F.pmod(F.xxhash64("key"), F.lit(groups)).alias("part"),
        F.col("key").alias("doc_id"),
        F.when(F.col("tokens") > cap, F.col("full") + 1).otherwise(0).cast("int").alias("piece"),
        F.when(F.col("tokens") > cap, F.col("rest")).otherwise(F.col("tokens")).cast("bigint").alias("tokens"),
    ).where("tokens > 0")
    kind = items.schema["doc_id"].dataType.simpleString()
    kind_s = items.schema["spec_id"].dataType.simpleString()

    def named(pdf: pd.DataFrame, bins: list[list[int]], name: str) -> pd.DataFrame:
        order = [k for b in bins for k in b]
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        out = pdf.iloc[order][["spec_id", "doc_id", "piece", "tokens", "capacity", "sep_tokens"]].copy()
        sep = int(pdf["sep_tokens"].iloc[0])
        fills = np.bincount(number, out["tokens"].to_numpy() + sep, minlength=len(bins)).astype(np.int64) - sep
        out["container"] = [f"{name}:{n}" for n in number]
        out["fill"] = fills[number]
        return out[["spec_id", "container", "doc_id", "piece", "tokens", "fill", "capacity", "sep_tokens"]]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable")  # the result must not depend on the order of arrival
        sep, capacity = int(pdf["sep_tokens"].iloc[0]), int(pdf["capacity"].iloc[0])
        return named(pdf, pack((pdf["tokens"] + sep).tolist(), capacity), f"g:{pdf['part'].iloc[0]}")

    def again(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["container", "doc_id", "piece"], kind="stable").reset_index(drop=True)
        sep, capacity = int(pdf["sep_tokens"].iloc[0]), int(pdf["capacity"].iloc[0])
        bins = [list(x) for x in pdf.groupby("container").indices.values()]
        return named(pdf, improve(bins, (pdf["tokens"] + sep).tolist(), capacity), f"r:{pdf['part'].iloc[0]}")

    cols = f"spec_id {kind_s}, container string, doc_id {kind}, piece int, tokens bigint, fill bigint, capacity bigint, sep_tokens int"
    rest = stored(items.groupBy("spec_id", "part").applyInPandas(one, cols), "packed")
    # the groups' underfull containers are searched once more together
    short = F.col("fill") + F.col("sep_tokens") < F.col("capacity") * (1 - FULL)
    most = rest.where(short).groupBy("spec_id").count().agg(F.max("count")).first()[0] or 0
    left = rest.where(short).withColumn("part", F.pmod(F.xxhash64("container"), F.lit(max(1, -(-most // group)))))
    left = left.groupBy("spec_id", "part").applyInPandas(again, cols)
    return whole.unionByName(rest.where(~short).unionByName(left).drop("capacity", "sep_tokens"))


def containers(docs: DataFrame, key: str, text: str, specs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """packed() of the documents' sizes in tokens; repeated keys count once, with their largest text."""
    sizes = token_sizes(docs, key, text, path=path)
    return packed(stored(sizes.groupBy("key").agg(F.max("tokens").alias("tokens")), "sizes"), specs)
