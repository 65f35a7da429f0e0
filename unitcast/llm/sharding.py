"""Sharding by a hierarchical weighted hash tree.

Every row descends region -> rack -> shard.  At each level each child of the
current node draws ``-ln(u) / weight`` with ``u`` hashed from (seed, child
name, row id), and the smallest draw wins: a child is chosen with probability
weight / total.  A draw depends only on its own child, so changing the weight
of a subtree moves rows only into it (weight up) or out of it (weight down);
siblings never exchange rows.  A shard added as a subtree of its own
therefore only takes rows into itself.

Edge cases: null ids are placed like any id (hash of null); a null text has
size = overhead and the checksum of the empty text; repeated rows land in the
same shard and get different slots; an empty table gives an empty result;
children of weight 0 are never drawn; extra input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Racks = dict[str, dict[int, float]]          # rack name -> shard number -> weight

ROW_OVERHEAD = 16        # bytes counted per row besides its text
ROWS_PER_CELL = 2000     # rows numbered together when slots are dealt


@dataclass(frozen=True)
class HashTree:
    """region name -> rack name -> shard number -> weight."""

    regions: dict[str, Racks]
    seed: int = 17

    @staticmethod
    def uniform(shards: int, racks_per_region: int = 2, shards_per_rack: int = 5) -> HashTree:
        """Equal weights; full racks and regions first, so the first shard
        after a full region opens a region of its own."""
        out: dict[str, Racks] = {}
        for s in range(shards):
            rack = s // shards_per_rack
            region = f"region{rack // racks_per_region}"
            out.setdefault(region, {}).setdefault(f"{region}/rack{rack % racks_per_region}", {})[s] = 1.0
        return HashTree(out)

    def draw(self, child: Column, weight: Column, row_id: Column) -> Column:
        h = F.xxhash64(F.lit(self.seed), child, row_id)
        u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return -F.log(u) / weight

    def _pick(self, children: Column, row_id: Column) -> Column:
        """Name of the child with the smallest draw; ``children`` is an array
        of (name, weight)."""
        return F.array_min(F.transform(children, lambda c: F.struct(
            self.draw(c["name"], c["weight"], row_id).alias("draw"), c["name"].alias("name"))))["name"]

    def place(self, df: DataFrame, row_id: str, name: str) -> DataFrame:
        """Append the shard number of each row as ``name``."""
        rid = F.col(row_id)
        racks = {r: k for rs in self.regions.values() for r, k in rs.items()}
        total = lambda shards: float(sum(shards.values()))
        regions = _children([(r, sum(total(s) for s in racks_.values())) for r, racks_ in self.regions.items()])
        by_region = _child_map({r: [(k, total(s)) for k, s in rs.items()] for r, rs in self.regions.items()})
        by_rack = _child_map({r: [(str(s), w) for s, w in shards.items()] for r, shards in racks.items()})
        steps = (df.withColumn("_region", self._pick(regions, rid))
                 .withColumn("_rack", self._pick(F.element_at(by_region, F.col("_region")), rid))
                 .withColumn(name, self._pick(F.element_at(by_rack, F.col("_rack")), rid).cast("int")))
        return steps.drop("_region", "_rack")


def _children(pairs) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in pairs if w > 0])


def _child_map(nodes: dict) -> Column:
    live = {n: p for n, p in nodes.items() if any(w > 0 for _, w in p)}
    return F.create_map(*[x for n, p in live.items() for x in (F.lit(n), _children(p))])


def gapless_slots(df: DataFrame, group: str, order: list[str], name: str,
                  rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Number the rows of each group 0, 1, ... without putting a group into
    one task: rows are numbered inside hashed cells of each group, and the
    cells are laid out by a running sum of their counts."""
    groups = df.select(group).distinct().count()
    cells = max(1, -(-df.count() // (rows_per_cell * max(1, groups))))
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    before = Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy(F.col(group).alias("_g"), F.col("_cell").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_g", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy(group, "_cell").orderBy(*order)
    return (dealt.withColumn("_rank", F.row_number().over(inside) - 1)
            .join(offsets, (F.col(group) == F.col("_g")) & (F.col("_cell") == F.col("_c")))
            .withColumn(name, (F.col("_offset") + F.col("_rank")).cast("long"))
            .drop("_cell", "_rank", "_g", "_c", "_offset"))


def shard_rows(docs: DataFrame, tree: HashTree, grown: HashTree, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Place every row of ``docs`` by its id; only ids, sizes and checksums are
    shuffled, never the texts.  Returns id, size, text_crc32, law, shard, slot
    and the shard under ``grown``."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    thin = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    placed = grown.place(tree.place(thin, "doc_id", "shard"), "doc_id", "grown_shard")
    return gapless_slots(placed, "shard", ["doc_id", "size", "text_crc32"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
