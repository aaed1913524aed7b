"""The first lines of every group, ties included in the count: distributed multi-select over encoded pairs, then a range sort of the lines within the cuts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, hot_keys, table, written

#: Pairs are encoded in a long while there are fewer than this many, else in 38 digits.
LONG_PAIRS = 1 << 62


def encoded(first: Column, second: Column, ends: tuple[int | None, int | None, int | None, int | None]) -> tuple[Column, int]:
    """(code, number of codes): a pair's place among all pairs within ``ends`` (least and greatest first, least and greatest second).

    Larger firsts come first, then smaller seconds; a null comes after all values. The code is a long, or a decimal where that is too narrow.
    """
    low1, high1, low2, high2 = (v if v is not None else 0 for v in ends)
    width1, width2 = high1 - low1 + 2, high2 - low2 + 2
    kind = "long" if width1 * width2 < LONG_PAIRS else "decimal(38,0)"

    def whole(value: int) -> Column:
        return F.lit(str(value)).cast(kind)

    a = F.coalesce(whole(high1) - first.cast(kind), whole(width1 - 1))
    b = F.coalesce(second.cast(kind) - whole(low2), whole(width2 - 1))
    return (a * whole(width2) + b).cast(kind), width1 * width2


def top_places(rows: DataFrame, groups: list[str], first: str, second: str, ties: list[str], k: int = 2) -> DataFrame:
    """(groups, first, second, ties, pos, tied) of the first ``k`` lines of each group.

    Lines are ordered by ``first`` (larger first), ``second`` (smaller first), then ``ties`` (ascending); nulls come last and are equal to each other. pos counts
    from 1, equal lines separately. tied: how many lines of the group, returned or not, have the line's pair of first and second. Groups with null keys are groups.
    ``groups`` are whole numbers or text, ``first`` and ``second`` whole numbers whose ranges multiplied stay below 10^38, which holds if one is a 32-bit number. An
    empty table gives no rows. Other columns are not read, and no column name clashes.

    Multi-select: a pair is encoded as one number; for all groups at once a binary search over the codes finds each group's cut, the least code that k lines reach,
    with one exact count pass over the lines for each halving. Lines are dealt out once, by group, and groups with over a quarter of a partition's share by group and
    a salt; a pass counts where the lines are, and only the counts of such groups (at most 4 times the partitions) are summed and broadcast. The lines within the cuts are range-sorted with all ties
    and a running number, so that neither a group nor equal lines meet in one task, and each range passes on its first k lines of a group.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = len(groups)
    text = {f.name for f in rows.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")}
    zero = [F.lit("") if g in text else F.lit(0).cast(rows.schema[g].dataType) for g in groups]
    keys = [f"g{i}" for i in range(m)]
    nulls = reduce(lambda a, b: a + b, [F.col(f"`{g}`").isNull().cast("int") * (1 << i) for i, g in enumerate(groups)], F.lit(0))
    own = [F.coalesce(F.col(f"`{g}`"), z).alias(n) for g, z, n in zip(groups, zero, keys, strict=True)]
    more = [f"t{i}" for i in range(len(ties))]
    lines = rows.select(*own, nulls.alias("nulls"), F.col(f"`{first}`").alias("a"), F.col(f"`{second}`").alias("b"), *[F.col(f"`{c}`").alias(t) for c, t in zip(ties, more, strict=True)])
    seen = lines.agg(F.count("*"), F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    code, codes = encoded(F.col("a"), F.col("b"), tuple(None if v is None else int(v) for v in seen[1:]))

    # tag: the null keys, whether the group is hot, and a hot group's salt
    hot = hot_keys(lines.select(*keys, "nulls"), [*keys, "nulls"], seen[0], parts)
    hot = hot.select(*keys, "nulls", F.ceil(F.col("n") * 4 * parts / max(1, seen[0])).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("salts")).cast("int")
    tag = F.col("nulls") + F.when(F.col("salts").isNull(), 0).otherwise((1 << m) + salt * (2 << m))
    cell = [*keys, "tag"]
    dealt = lines.join(F.broadcast(hot), [*keys, "nulls"], "left").select(*keys, tag.alias("tag"), "a", "b", *more)
    names = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        made, out = bucketed(df, name, parts, *cell)
        names.append(made)
        return out

    try:
        lines = stored(dealt.repartition(parts, *cell), "rank_lines").withColumn("code", code)
        group = F.col("tag").bitwiseAND((2 << m) - 1)

        def whole(counted: DataFrame, **how) -> DataFrame:
            """The counts of hot groups summed over their cells."""
            hot = counted.filter(F.col("tag").bitwiseAND(1 << m) != 0).groupBy(*keys, group.alias("grp")).agg(*[f(c).alias(f"all_{c}") for c, f in how.items()])
            met = counted.withColumn("grp", group).join(F.broadcast(hot), [*keys, "grp"], "left")
            return met.withColumns({c: F.coalesce(f"all_{c}", c) for c in how}).select(*counted.columns)

        counted = stored(lines.groupBy(*cell).agg(F.count("*").alias("n"), F.min("code").alias("low"), F.max("code").alias("high")), "rank_groups")
        state = whole(counted, n=F.sum, low=F.min, high=F.max).withColumn("low", F.when(F.col("n") > k, F.col("low")).otherwise(F.col("high"))).drop("n")
        widest = state.agg(F.max(F.col("high") - F.col("low"))).first()[0] or 0
        mid = (F.col("low") + F.floor((F.col("high") - F.col("low")) / 2)).cast(lines.schema["code"].dataType) if codes >= LONG_PAIRS else F.col("low") + F.shiftright(F.col("high") - F.col("low"), 1)
        for _ in range(int(widest).bit_length()):
            met = lines.select(*cell, "code").join(state.withColumn("mid", mid).hint("shuffle_hash"), cell)
            counted = stored(met.groupBy(*cell, "low", "mid", "high").agg(F.count_if(F.col("code") <= F.col("mid")).alias("n")), "rank_counts")
            open_, enough = F.col("low") < F.col("high"), F.col("n") >= k
            state = whole(counted, n=F.sum).select(
                *cell,
                F.when(open_ & ~enough, F.col("mid") + 1).when(open_ & (F.col("n") == k), F.col("mid")).otherwise(F.col("low")).cast(lines.schema["code"].dataType).alias("low"),
                F.when(open_ & enough, F.col("mid")).otherwise(F.col("high")).alias("high"),
            )
        cut = lines.join(state.select(*cell, F.col("low").alias("cut")).hint("shuffle_hash"), cell).filter(F.col("code") <= F.col("cut"))
        chosen = written(cut.select(*keys, group.alias("grp"), "code", "a", "b", *more), "rank_chosen")
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    order = [F.col("code"), *[F.col(t).asc_nulls_last() for t in more]]
    by = [F.col(c) for c in (*keys, "grp")]
    sorted_ = chosen.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(parts, *by, *order, F.col("nth")).sortWithinPartitions(*by, *order, F.col("nth"))
    places = sorted_.withColumn("pos", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("pos") <= k)
    pairs = chosen.groupBy(*keys, "grp", "code").agg(F.count("*").alias("tied"))
    out = places.join(pairs, [*keys, "grp", "code"])
    back = [F.when(F.col("grp").bitwiseAND(1 << i) == 0, F.col(n)).alias(g) for i, (g, n) in enumerate(zip(groups, keys, strict=True))]
    return out.select(*back, F.col("a").alias(first), F.col("b").alias(second), *[F.col(t).alias(c) for c, t in zip(ties, more, strict=True)], F.col("pos").cast("long").alias("pos"), "tied")


def op11_grouped_ranking(spark, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "sale_lines")

    def rounded(name: str) -> Column:
        v = 100 * F.col(name) + 0.5
        return F.when(~F.isnan(v) & (F.abs(v) < 9e18), F.floor(v)).cast("long")

    together = F.coalesce(F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    month = F.coalesce(100 * F.year("shipped_at") + F.month("shipped_at"), F.lit(-1))
    rows = lines.select(
        F.when(together, -1).otherwise(F.col("vendor_id")).alias("vendor_id"),
        F.when(together, -1).otherwise(F.coalesce(F.col("item_id") % 5, F.lit(-1))).cast("int").alias("part"),
        F.when(together, -1).otherwise(month).cast("int").alias("month"),
        F.floor(F.col("quantity") / 10).cast("int").alias("tens"),
        rounded("discount").alias("percent"),
        "sale_id",
        "line_no",
        "quantity",
        rounded("amount").alias("amount_cents"),
    )
    out = top_places(rows, ["vendor_id", "part", "month"], "tens", "percent", ["sale_id", "line_no", "quantity", "amount_cents"], 2)
    names = ("vendor_id", "part", "month", "pos", "place", "sale_id", "line_no", "quantity", "percent", "amount_cents", "tied")
    return out.withColumn("place", F.col("pos")).select(*[F.col(c).cast("long").alias(c) for c in names])


OP11_SQL = """
WITH step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(9), lambda c, i: CASE WHEN i = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t),
ids AS (
  SELECT sale_id, xor(list_reduce(string_split(CAST(sale_id AS VARCHAR), ''), lambda c, d: xor(c >> 8, t[CAST(xor(c & 255, CAST(ord(d) AS BIGINT)) AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 5 = 0 AS together
  FROM (SELECT DISTINCT sale_id FROM sale_lines WHERE sale_id IS NOT NULL), step),
l AS (
  SELECT CASE WHEN together THEN -1 ELSE vendor_id END AS vendor_id, CASE WHEN together THEN -1 ELSE coalesce(item_id % 5, -1) END AS part,
    CASE WHEN together THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS month, sale_id, line_no, quantity,
    floor(quantity / 10) AS tens, floor(100 * discount + 0.5) AS percent, floor(100 * amount + 0.5) AS cents
  FROM sale_lines LEFT JOIN ids USING (sale_id)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, cents NULLS LAST) AS pos,
    count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied
  FROM l)
SELECT CAST(vendor_id AS BIGINT) AS vendor_id, CAST(part AS BIGINT) AS part, CAST(month AS BIGINT) AS month, CAST(pos AS BIGINT) AS pos, CAST(pos AS BIGINT) AS place, sale_id,
  CAST(line_no AS BIGINT) AS line_no, CAST(quantity AS BIGINT) AS quantity, CAST(percent AS BIGINT) AS percent, CAST(cents AS BIGINT) AS amount_cents, CAST(tied AS BIGINT) AS tied
FROM r WHERE pos <= 2
"""
