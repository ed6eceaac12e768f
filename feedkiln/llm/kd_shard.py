"""Sharding by a K-d tree over document metadata, with DataFrame operations only.

The tree splits the documents into shards of nearly equal bytes. A node splits
along the dimension that is widest in it (its range as a share of the whole
range), at the weighted quantile that gives both sides their share of the
shards. The quantile comes from byte histograms: all nodes of a level are
counted in one aggregate of at most ``BINS`` bins each, and the bin that holds
the quantile is cut again until it holds less than ``TOLERANCE`` of a shard.

Documents of equal text are one unit, placed at the least metadata of its
members, so copies stay together; a unit above ``PIECE`` of a shard is dealt
into pieces by a hash of the ids, so a hot text cannot outweigh a shard. Ties in
a dimension are broken by a hash of the unit. A string dimension enters the tree as
the rank of its whole value among all distinct values, by a range-partitioned sort.

Defined results: a null text has no bytes and counts 8; null metadata count as
the least value; repeated rows are rows of their own; a very long text counts its
bytes and is read by hash functions only; fewer units than shards
leave some shards empty; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 2048
#: Bytes that a cut may miss its quantile by, and that one unit may hold, as shares of a shard.
TOLERANCE, PIECE = 0.001, 0.02
#: Fixed bytes of a row besides its text, and rows that one slot bucket holds on average.
ROW_BYTES, SLOT_ROWS = 8, 50_000
RANK_BITS, TIE_BITS = 31, 31


def ordered(col: str, kind: T.DataType) -> Column:
    """A number that orders as the column does; strings as they are, to be ranked."""
    if isinstance(kind, T.StringType):
        return F.col(col)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(col).cast("timestamp").cast("double")
    return F.col(col).cast("double")


def ranks_of(rows: DataFrame, dim: str) -> DataFrame:
    """Every distinct value of a string column with its place (``_rank``, gapless
    from 0) in their order: sorted over the cluster, each partition counts on from
    the sizes of those before it (one row per partition)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = rows.select(dim).filter(F.col(dim).isNotNull()).distinct()
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its low 33 bits count within the partition
    order = (values.repartitionByRange(n, dim).sortWithinPartitions(dim)
             .select(dim, F.spark_partition_id().alias("_part"), inside.alias("_in"))).checkpoint()
    before = order.groupBy("_part").agg(F.count("*").alias("_size")).select(
        "_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    return order.join(F.broadcast(before), "_part").select(dim, (F.col("_before") + F.col("_in")).alias("_rank"))


def units_of(rows: DataFrame, dims: list[str], shards: int) -> tuple[DataFrame, DataFrame]:
    """One row per text (or per piece of a hot one): bytes and, for each
    dimension, a key that orders by the metadata and then by a tie hash; and the
    hot texts with their number of pieces, ``shards / PIECE`` rows at most."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = max(1.0, PIECE * total / shards)
    placed = rows
    for d in dims:
        if isinstance(rows.schema[d].dataType, T.StringType):
            placed = placed.join(ranks_of(rows, d), d, "left").drop(d).withColumnRenamed("_rank", d)
    text = placed.groupBy("_a", "_b").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"), *[F.min(d).alias(d) for d in dims]).withColumn(
        "_pieces", F.least(F.ceil(F.col("_bytes") / limit), F.col("_rows")).cast("int")).checkpoint()
    span = text.agg(*[f(d).alias(f"{d}_{n}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]).first()
    rank = []
    for d in dims:
        lo, hi = (float(span[f"{d}_{e}"]) if span[f"{d}_{e}"] is not None else 0.0 for e in ("lo", "hi"))
        scaled = (F.coalesce(F.col(d), F.lit(lo)) - lo) / (hi - lo or 1.0) * float((1 << RANK_BITS) - 1)
        rank.append(F.shiftleft(F.floor(scaled).cast("long"), TIE_BITS).alias(d))
    whole = text.filter("_pieces <= 1").select("_a", "_b", F.lit(0).alias("_piece"), "_bytes", *rank)
    hot = text.filter("_pieces > 1").select("_a", "_b", "_pieces", *rank)
    # every hot text holds more than PIECE of a shard, so their number is bounded
    dealt = (rows.select("_a", "_b", "size", "_id").join(F.broadcast(hot), ["_a", "_b"])
             .withColumn("_piece", piece("_pieces")).groupBy("_a", "_b", "_piece")
             .agg(F.sum("size").alias("_bytes"), *[F.first(d).alias(d) for d in dims]))
    tie = F.shiftrightunsigned(F.xxhash64("_a", "_b", "_piece"), 64 - TIE_BITS)
    both = whole.unionByName(dealt)
    units = both.select("_a", "_b", "_piece", "_bytes", *[(F.col(d) + tie).alias(d) for d in dims]).checkpoint()
    return units, hot.select("_a", "_b", "_pieces")


def piece(pieces: str) -> Column:
    return F.when(F.col(pieces) > 1, F.pmod(F.xxhash64("_id"), F.col(pieces))).otherwise(0).cast("int")


class Node:
    """A box of the tree: conditions (dimension, below or not, cut) and the shards it will hold."""

    def __init__(self, first: int, shards: int, box: list[tuple[str, bool, int]]):
        self.first, self.shards, self.box = first, shards, box

    def holds(self) -> Column:
        tests = [F.col(d) < F.lit(c) if below else F.col(d) >= F.lit(c) for d, below, c in self.box]
        return reduce(lambda a, b: a & b, tests, F.lit(True))


def number(nodes: list[Node]) -> Column:
    """The number of the node that a unit falls into."""
    return F.coalesce(*[F.when(n.holds(), i) for i, n in enumerate(nodes)], F.lit(-1))


def by_node(values: list) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.col("_node"))


def grow(units: DataFrame, dims: list[str], shards: int) -> Column:
    """The tree as an expression over the dimension keys: the shard of a unit.

    The driver holds a row per node and bin of one level, a number bounded by
    the shards; the units are never collected."""
    nodes = [Node(0, shards, [])]
    whole: dict[str, int] = {}
    while any(n.shards > 1 for n in nodes):
        state = units.withColumn("_node", number(nodes))
        stats = {r["_node"]: r for r in state.groupBy("_node").agg(
            F.sum("_bytes").alias("bytes"), *[f(d).alias(f"{d}_{n}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        whole = whole or {d: max(1, stats[0][f"{d}_hi"] - stats[0][f"{d}_lo"]) if stats else 1 for d in dims}
        cuts = []
        for i, n in enumerate(nodes):
            r = stats.get(i)
            if r is None or n.shards < 2:
                cuts.append(Cut(dims[0], 0, 0, 0, 0))
                continue
            d = max(dims, key=lambda x, r=r: ((r[f"{x}_hi"] - r[f"{x}_lo"]) / whole[x], x))
            cuts.append(Cut(d, r[f"{d}_lo"], r[f"{d}_hi"] + 1, r["bytes"] * (n.shards // 2) / n.shards, r["bytes"] * TOLERANCE / n.shards))
        while any(c.low < c.high for c in cuts):
            refine(state, dims, cuts)
        grown = []
        for n, c in zip(nodes, cuts, strict=True):
            if n.shards < 2:
                grown.append(n)
                continue
            half = n.shards // 2
            grown.append(Node(n.first, half, [*n.box, (c.dim, True, c.low)]))
            grown.append(Node(n.first + half, n.shards - half, [*n.box, (c.dim, False, c.low)]))
        nodes = grown
    return by_number(nodes)


def by_number(nodes: list[Node]) -> Column:
    return F.coalesce(*[F.when(n.holds(), n.first) for n in nodes])


class Cut:
    """A quantile being narrowed: it lies in [low, high), ``below`` bytes come
    before low and ``want`` should come before the cut; low == high: found."""

    def __init__(self, dim: str, low: int, high: int, want: float, tolerance: float):
        self.dim, self.low, self.high, self.want, self.tolerance, self.below = dim, low, high, want, tolerance, 0


def refine(state: DataFrame, dims: list[str], cuts: list[Cut]) -> None:
    """One histogram over the open interval of every node, which narrows it to
    the bin that holds the quantile."""
    step = [max(1, -(-(c.high - c.low) // BINS)) for c in cuts]
    key = F.get(F.array(*dims), by_node([dims.index(c.dim) for c in cuts]))
    rows = (state.filter("_node >= 0").select("_node", "_bytes", key.alias("_key"), by_node([c.low for c in cuts]).alias("_low"),
                                              by_node([c.high for c in cuts]).alias("_high"), by_node(step).alias("_step"))
            .filter("_key >= _low and _key < _high")
            .groupBy("_node", F.expr("(_key - _low) div _step").alias("bin")).agg(F.sum("_bytes").alias("bytes")).collect())
    for i, c in enumerate(cuts):
        if c.low == c.high:
            continue
        bins = sorted((r["bin"], r["bytes"]) for r in rows if r["_node"] == i)
        low, high, at = c.low, c.high, c.high
        for b, n in bins:
            if c.below + n < c.want:
                c.below += n
                continue
            start, end = low + b * step[i], min(high, low + (b + 1) * step[i])
            if step[i] > 1 and n > c.tolerance:
                c.low, c.high, at = start, end, None
            else:  # the nearer edge of the bin
                at = start if c.want - c.below <= c.below + n - c.want else end
            break
        if at is not None:
            c.low = c.high = at


def shard(docs: DataFrame, dims: list[str], shards: int, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``ident``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from
    0 within the shard) of every row."""
    own = [f"_dim{i}" for i in range(len(dims))]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(ident).alias("_id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.xxhash64(text).alias("_a"), F.hash(text).alias("_b"),
        *[ordered(d, docs.schema[d].dataType).alias(o) for d, o in zip(dims, own, strict=True)]).checkpoint()
    units, hot = units_of(rows, own, shards)
    units = units.select("_a", "_b", "_piece", grow(units, own, shards).alias("shard"))
    placed = (rows.drop(*own).join(F.broadcast(hot), ["_a", "_b"], "left").withColumn("_piece", piece("_pieces"))
              .join(units, ["_a", "_b", "_piece"]))
    return slotted(placed).select(F.col("_id").alias(ident), "size", "text_crc32", "shard", "slot")


def slotted(placed: DataFrame) -> DataFrame:
    """Gapless slots: rows are numbered within hash buckets of a shard, and the
    buckets' counts (not the rows) add up to where each begins."""
    rows = placed.checkpoint()
    buckets = max(1, -(-rows.count() // SLOT_ROWS))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_id", "text_crc32"), F.lit(buckets)).cast("int"))
    begin = (rows.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
             .withColumn("_begin", F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).drop("_n"))
    inside = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_id", "text_crc32")) - 1
    return rows.withColumn("_k", inside).join(begin, ["shard", "_bucket"]).withColumn("slot", (F.col("_begin") + F.col("_k")).cast("long"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, ident: str = "doc_id") -> None:
    """The documents as one folder per shard."""
    docs.join(placed.select(ident, "shard", "slot"), ident).write.partitionBy("shard").parquet(path)
