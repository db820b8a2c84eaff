"""Sliding spans of real time over keys with very many rows.

A frame ``(t - w, t]`` of a dense key may hold most of the key, and may differ
for every row. Here the key's instants are numbered and cut into chunks, and a
frame is put together from three parts, none of which is subtracted from
another, so no digits are lost and minima work like sums:

* what follows the last instant before the frame inside that instant's chunk,
* the whole chunks between, from a tree of dyadic blocks of chunks: every stretch
  of chunks is at most two blocks of each size, and neighbouring rows share it,
* what precedes the row inside its own chunk.

The last instant before each frame is found by one ordered pass over instants
and frame starts together. Frames inside one chunk are range frames over the
chunk. Rows of one instant are added up first, so an instant of any size is one
row. Every task holds chunks, never a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.plans.chunks import last_known
from foldwright.plans.hot import attach
from foldwright.plans.ranks import ordered_index
from foldwright.session import stage

DAY_US = 86_400_000_000
CLOCK = "__fw_us"
#: instants of one chunk; a frame inside a chunk is evaluated row by row, so chunks are short
CHUNK_ROWS = 256
_AT, _CHUNK, _SINCE, _WIDTH, _TURN, _NODE, _LEVEL = "__fw_at", "__fw_c", "__fw_since", "__fw_w", "__fw_turn", "__fw_node", "__fw_level"


@dataclass(frozen=True)
class Sums:
    """What is kept of a set of rows, column by column; any two disjoint sets can be put together.

    Squares are kept of deviations from the key's mean, which keeps them well conditioned.
    """

    cols: Sequence[str]
    stats: Sequence[str]

    @property
    def parts(self) -> list[str]:
        kept = ["n"]
        kept += ["s"] if {"mean", "sum"} & set(self.stats) else []
        kept += ["d", "q"] if "std" in self.stats else []
        kept += ["lo"] if "min" in self.stats else []
        return kept + (["hi"] if "max" in self.stats else [])

    def names(self, mark: str = "") -> list[str]:
        return [f"__fw_{mark}{p}_{c}" for c in self.cols for p in self.parts]

    def of_rows(self) -> list[Column]:
        """Aggregates of the rows themselves."""
        out = []
        for c in self.cols:
            v, off = F.col(c), F.col(c) - F.col(f"__fw_mu_{c}")
            made = {"n": F.count(v), "s": F.sum(v), "d": F.sum(off), "q": F.sum(off * off), "lo": F.min(v), "hi": F.max(v)}
            out += [made[p].alias(f"__fw_{p}_{c}") for p in self.parts]
        return out

    def together(self, mark: str = "", over=None) -> list[Column]:
        """Aggregates of aggregates."""
        out = []
        for c in self.cols:
            for p in self.parts:
                e = {"lo": F.min, "hi": F.max}.get(p, F.sum)(f"__fw_{p}_{c}")
                out.append((e if over is None else e.over(over)).alias(f"__fw_{mark}{p}_{c}"))
        return out

    def merged(self, marks: Sequence[str]) -> list[Column]:
        """Several sets of one row put together."""
        out = []
        for c in self.cols:
            for p in self.parts:
                found = [F.col(f"__fw_{m}{p}_{c}") for m in marks]
                if p in ("lo", "hi"):
                    out.append((F.least if p == "lo" else F.greatest)(*found).alias(f"__fw_{p}_{c}"))
                else:
                    # a set without values has null sums; so has a union of such sets only
                    total = sum((F.coalesce(f, F.lit(0)) for f in found[1:]), F.coalesce(found[0], F.lit(0)))
                    out.append(F.when(F.coalesce(*found).isNotNull(), total).alias(f"__fw_{p}_{c}"))
        return out

    def value(self, c: str, stat: str) -> Column:
        part = {p: F.col(f"__fw_{p}_{c}") for p in self.parts}
        n = F.coalesce(part["n"], F.lit(0)).cast("long")
        if stat == "std":
            spread_sq = F.greatest(part["q"] - part["d"] * F.try_divide(part["d"], n), F.lit(0.0))
            return F.when(n > 1, F.sqrt(F.try_divide(spread_sq, n - 1)))
        return {"count": n, "sum": part.get("s"), "mean": F.try_divide(part.get("s"), n), "min": part.get("lo"), "max": part.get("hi")}[stat]


def _instants(rows: DataFrame, keys: list[str], sums: Sums, chunk_rows: int) -> DataFrame:
    """One row for each key and instant, numbered and dealt into chunks; ``__fw_rows`` counts its rows."""
    if "std" in sums.stats:
        # a row for each hot key
        rows = rows.join(rows.groupBy(*keys).agg(*[F.avg(c).alias(f"__fw_mu_{c}") for c in sums.cols]), keys, "left")
    else:
        rows = rows.withColumns({f"__fw_mu_{c}": F.lit(None).cast("double") for c in sums.cols})
    found = rows.groupBy(*keys, CLOCK).agg(F.count(F.lit(1)).alias("__fw_rows"), *sums.of_rows())
    numbered = ordered_index(stage(found, "instants"), CLOCK, None, keys, name=_AT)
    return stage(numbered.withColumn(_CHUNK, F.floor(F.col(_AT) / chunk_rows).cast("long")), "numbered")


def _tree(chunks: DataFrame, keys: list[str], sums: Sums, levels: int) -> DataFrame:
    """``(keys, level, node, sums)``: every block of ``2 ** level`` chunks that starts at a multiple of its size."""
    level = F.sequence(F.lit(0), F.lit(levels))
    blocks = chunks.withColumn(_LEVEL, F.explode(level))
    node = F.call_function("shiftright", F.col(_CHUNK), F.col(_LEVEL)).alias(_NODE)
    return blocks.groupBy(*keys, _LEVEL, node).agg(*sums.together())


def _blocks(first: Column, stop: Column, levels: int) -> Column:
    """The dyadic blocks ``(level, node)`` that make up the chunks ``first .. stop - 1``, two of a level at most."""

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = F.ceil(first / size), F.floor(stop / size)
        left = F.when((low < high) & (low % 2 == 1), F.struct(level.alias("level"), low.cast("long").alias("node")))
        right = F.when((low < high) & (high % 2 == 1), F.struct(level.alias("level"), (high - 1).cast("long").alias("node")))
        return F.array(left, right)

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))
    return F.filter(every, lambda b: b.isNotNull())


def spanned(
    rows: DataFrame,
    keys: list[str],
    cols: Sequence[str],
    days: Sequence[int],
    stats: Sequence[str],
    name: Callable[[str, int, str], str],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``rows`` without their clock, with ``name(column, days, stat)`` over the last so many days, the row's instant included."""
    sums = Sums(list(cols), list(stats))
    instants = _instants(rows, keys, sums, chunk_rows)
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(CLOCK)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*keys, _CHUNK).orderBy(F.col(CLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    # the last instant before each frame: instants and frame starts in one order, instants first where they meet
    known = instants.select(*keys, CLOCK, _CHUNK, *sums.together("a", after))
    left = [f"__fw_a{n[5:]}" for n in sums.names()]
    marked = known.withColumn(_SINCE, F.lit(None).cast("long")).withColumn(_TURN, F.lit(0)).withColumn("__fw_seen", F.struct(_CHUNK, *left))
    marked = marked.select(*keys, CLOCK, _TURN, _SINCE, "__fw_seen")
    starts = instants.select(*keys, F.col(CLOCK).alias(_SINCE), F.posexplode(F.array(*[F.lit(w) for w in days])).alias(_TURN, _WIDTH))
    starts = starts.select(*keys, (F.col(_SINCE) - F.col(_WIDTH).cast("long") * DAY_US).alias(CLOCK), (F.col(_TURN) + 1).alias(_TURN), _SINCE)
    both = marked.unionByName(starts, allowMissingColumns=True)
    frames = last_known(both, keys, CLOCK, _TURN, {"__fw_last": "__fw_seen"}, hot_rows=0).filter(F.col(_SINCE).isNotNull())
    frames = frames.select(
        *keys, F.col(_SINCE).alias(CLOCK), _TURN, F.coalesce(F.col(f"__fw_last.{_CHUNK}"), F.lit(-1).cast("long")).alias("__fw_from"),
        *[F.col(f"__fw_last.{n}").alias(n) for n in left],
    )
    # what precedes the row inside its chunk, whole and for each width
    own = [*sums.together("b", upto)]
    for i, w in enumerate(days, 1):
        own += [F.struct(*sums.together("", inside.rangeBetween(-(w * DAY_US - 1), 0))).alias(f"__fw_r{i}")]
    here = instants.select(*keys, CLOCK, _CHUNK, *own)
    near = F.element_at(F.array(*[F.col(f"__fw_r{i}") for i in range(1, len(days) + 1)]), F.col(_TURN))
    frames = frames.join(here, [*keys, CLOCK]).withColumn("__fw_near", near).drop(*[f"__fw_r{i}" for i in range(1, len(days) + 1)])
    frames = stage(frames, "frames")
    # whole chunks between, once for each stretch
    chunks = stage(instants.groupBy(*keys, _CHUNK).agg(*sums.together()), "chunks")
    most = chunks.agg(F.max(_CHUNK)).first()[0] or 0
    levels = int(most).bit_length()
    apart = frames.filter(F.col(_CHUNK) - F.col("__fw_from") > 1).select(*keys, "__fw_from", _CHUNK).distinct()
    blocks = apart.withColumn("__fw_block", F.explode(_blocks(F.col("__fw_from") + 1, F.col(_CHUNK), levels)))
    blocks = blocks.select(*keys, "__fw_from", _CHUNK, F.col("__fw_block.level").alias(_LEVEL), F.col("__fw_block.node").alias(_NODE))
    between = blocks.join(_tree(chunks, keys, sums, levels), [*keys, _LEVEL, _NODE]).groupBy(*keys, "__fw_from", _CHUNK).agg(*sums.together("m"))
    frames = frames.join(between, [*keys, "__fw_from", _CHUNK], "left")
    merged = sums.merged(["a", "m", "b"])
    within = F.col("__fw_from") == F.col(_CHUNK)
    chosen = [F.when(within, F.col(f"__fw_near.{n}")).otherwise(e).alias(n) for n, e in zip(sums.names(), merged, strict=True)]
    frames = frames.select(*keys, CLOCK, _TURN, *chosen)
    values = frames.select(*keys, CLOCK, _TURN, *[sums.value(c, s).alias(f"{c}__fw__{s}") for c in cols for s in stats])
    picked = [
        F.max(F.when(F.col(_TURN) == i, F.col(f"{c}__fw__{s}"))).alias(name(c, w, s)) for c in cols for i, w in enumerate(days, 1) for s in stats
    ]
    result = stage(values.groupBy(*keys, CLOCK).agg(*picked), "spans")
    sizes = instants.select(*keys, CLOCK, F.col("__fw_rows").alias("__fw_n"))
    return attach(rows, result, [*keys, CLOCK], sizes=sizes).drop(CLOCK)
