"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets in words come from weights, capped at a multiple of each source's size. Equal blocks of words are allocated to
sources by highest quotients, and again to each source's shards; inside a shard a seeded choice of blocks fills the quota.

A shard is a seeded share of a source's documents, about `shard_words` large, so a source with a third of all rows is many
shards; beyond shard_words squared, a source has as many shards as each has words, so that neither grows alone. Rows without
an id are dealt by their text. Documents stand in seeded order in their shard; a block is the next `block_words` words of that row of documents,
so what a document gives follows from its place by arithmetic, without a row per block.

Edge cases: a null source is a source of its own, last in order; null and blank texts have size 0 and give 0 words; equal
rows are interchangeable; no rows give no rows. Columns that are not named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import common

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 16
SEED = 17
SOURCE = ["src_null", "src"]
#: A word and the white space after it; the first has the white space before it too.
SPACED_WORD = r"(?:^[ \x09-\x0D]+)?[^ \x09-\x0D]+[ \x09-\x0D]*"


def sized(documents: DataFrame, carry: list[str] = (), source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    source = F.col(source_col)
    return documents.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("string"), F.md5(common.text_or_empty(F.col(text_col)))).alias("name"), source.isNull().alias("src_null"), F.coalesce(source, F.lit("")).alias("src"),
        F.size(common.words(F.col(text_col))).cast("long").alias("size"), *carry,
    )


def targets(sizes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(src_null, src, source_size, target): weights fill up as water does, until no source is above its cap."""
    by = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(*SOURCE)  # one row per source
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS))
    by = by.withColumn("weight", weight.cast("long")).withColumn("cap", limit * F.col("source_size"))
    full = Window.orderBy(F.col("cap") / F.col("weight"), *SOURCE)
    everything = Window.partitionBy()
    by = by.withColumn("k", F.row_number().over(full))
    by = by.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    by = by.withColumn("level", F.col("left") / F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("k", "level"))
    by = by.withColumn("level", F.min(fits).over(everything)["level"])
    return by.select(*SOURCE, "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def sainte_lague(df: DataFrame, group: list[str], key: list[str], votes: str, seats: str) -> DataFrame:
    """Adds `quota`: the group's seats by the highest quotients votes / (2k - 1), ties by key.

    Only quotients near the share are made. With n keys the rounded shares miss the seats by at most n / 2, so the divisor
    moves by a part of at most 1.5 n / seats, and a key's quota by at most that part of its share, plus one.
    """
    g = Window.partitionBy(*group)
    df = df.withColumn("_share", F.coalesce(F.try_divide(F.col(votes).cast("double") * F.col(seats), F.sum(F.col(votes).cast("double")).over(g)), F.lit(0.0)))
    df = df.withColumn("_slack", F.ceil(1.5 * F.count("*").over(g) * F.col("_share") / F.greatest(F.col(seats), F.lit(1))) + 1)
    df = df.withColumn("_near", F.floor(F.col("_share") + 0.5)).withColumn("_base", F.greatest(F.col("_near") - F.col("_slack"), F.lit(0)))
    df = df.withColumn("_need", F.col(seats) - F.sum("_base").over(g))
    each = df.withColumn("_k", F.explode(F.sequence(F.col("_base") + 1, F.col("_near") + F.col("_slack"))))
    each = each.withColumn("_q", F.col(votes).cast("double") / (2 * F.col("_k") - 1)).where("_q > 0")
    each = each.withColumn("_rank", F.row_number().over(g.orderBy(F.desc("_q"), *key, "_k")))
    won = each.where("_rank <= _need").groupBy(*group, *key).agg(F.count("*").alias("_won"))
    out = df.join(won, [*group, *key], "left")
    return out.withColumn("quota", F.col("_base") + F.coalesce("_won", F.lit(0))).drop("_share", "_slack", "_near", "_base", "_need", "_won")


def mix(sizes: DataFrame, seed: int = SEED, block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, limit: int = LIMIT) -> DataFrame:
    """sizes, from sized(), with source_size, target and taken added; taken is how many words the mix takes from the row."""
    aims = targets(sizes, limit).withColumn("shards", F.greatest(F.lit(1), F.least(F.ceil(F.col("source_size") / shard_words), F.ceil(F.sqrt("source_size")))).cast("long"))
    aims = aims.withColumn("blocks", F.round(F.sum("source_size").over(Window.partitionBy()) / block).cast("long"))
    aims = sainte_lague(aims, [], SOURCE, "target", "blocks").withColumnRenamed("quota", "source_quota")
    aims = common.written(aims, "aims")
    place = F.md5(F.concat(F.lit(f"{seed}:"), "name"))
    docs = sizes.join(aims, SOURCE).withColumn("place", place)
    docs = docs.withColumn("shard", F.conv(F.substring("place", 1, 8), 16, 10).cast("long") % F.col("shards"))
    shards = docs.groupBy(*SOURCE, "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    shards = sainte_lague(shards, SOURCE, ["shard"], "shard_size", "source_quota")
    shards = shards.withColumn("n", F.ceil(F.col("shard_size") / block)).withColumn("quota", F.least("quota", limit * F.col("n")))
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}"), "src", F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long")
    shards = shards.select(*SOURCE, "shard", "n", "quota", (start % F.greatest("n", F.lit(1))).alias("start"))
    row = Window.partitionBy(*SOURCE, "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("at", F.coalesce(F.sum("size").over(row), F.lit(0))).join(shards, [*SOURCE, "shard"])

    # blocks j with (j * r + start) div n < ((j + 1) * r + start) div n are taken once more than all others: r of n
    def before(x: str) -> str:
        picked = "(({0}) * (quota % n) + start) div n"
        j = f"(({x}) div {block})"
        now, after = picked.format(j), picked.format(f"{j} + 1")
        return f"(({now}) * {block} + (({after}) - ({now})) * (({x}) % {block}))"

    taken = F.expr(f"case when n = 0 then 0L else (quota div n) * size + {before('at + size')} - {before('at')} end")
    return docs.withColumn("taken", taken)


def ranges(block: int = BLOCK_WORDS) -> Column:
    """Of a row of mix(): the runs of words taken once more than the quota div n whole copies, as an array of (first, many)."""
    picked = "(({0}) * (quota % n) + start) div n"
    chosen = f"filter(sequence(at div {block}, (at + size - 1) div {block}), j -> {picked.format('j + 1')} > {picked.format('j')})"
    run = f"struct(int(greatest(j * {block}, at) - at) as first, int(least((j + 1) * {block}, at + size) - greatest(j * {block}, at)) as many)"
    return F.expr(f"transform(case when n > 0 and size > 0 then {chosen} else array() end, j -> {run})")


def excerpt(text: Column, runs: Column) -> Column:
    """The text's words in the runs, each with the white space that follows it in the text."""
    split = F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0))
    # the array of one holds the words, so that they are split once and not for each run
    return F.get(F.transform(F.array(split), lambda w: F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(w, r["first"] + 1, r["many"]))), "")), F.lit(0))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = common.written(sized(common.table(spark, sf_dir, "documents")), "sizes")
    return mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


def _apportion(name: str, given: str, group: str, key: str, votes: str, seats: str) -> str:
    over = f"partition by {group}" if group else ""
    by = f"{group}, {key}" if group else key
    return f"""
{name}_1 as (select *, coalesce({votes}::double * {seats} / nullif(sum({votes}::double) over ({over}), 0), 0.0) as _share, count(*) over ({over}) as _n from {given}),
{name}_2 as (select *, floor(_share + 0.5)::bigint as _near, ceil(1.5::double * _n * _share / greatest({seats}, 1))::bigint + 1 as _slack from {name}_1),
{name}_3 as (select *, greatest(_near - _slack, 0) as _base from {name}_2),
{name}_4 as (select *, {seats} - sum(_base) over ({over}) as _need from {name}_3),
{name}_5 as (select *, unnest(range(_base + 1, _near + _slack + 1)) as _k from {name}_4),
{name}_6 as (select *, row_number() over ({over} order by {votes}::double / (2 * _k - 1) desc, {key}, _k) as _rank from {name}_5 where {votes} > 0),
{name}_7 as (select {by}, count(*) as _won from {name}_6 where _rank <= _need group by all),
{name} as (select a.*, a._base + coalesce(b._won, 0) as quota from {name}_4 a left join {name}_7 b using ({by}))"""


def op5_sql() -> str:
    b = BLOCK_WORDS
    picked = "(({0}) * (quota % n) + start) // n"

    def before(x: str) -> str:
        j = f"(({x}) // {b})"
        now, after = picked.format(j), picked.format(f"{j} + 1")
        return f"(({now}) * {b} + (({after}) - ({now})) * (({x}) % {b}))"

    return f"""
with sizes as (select doc_id, coalesce(doc_id::varchar, md5(coalesce(text, ''))) as name, source is null as src_null, coalesce(source, '') as src,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::bigint as size from documents),
by_source as (select src_null, src, sum(size)::bigint as source_size from sizes group by all),
weighed as (select *, ([{", ".join(map(str, WEIGHTS))}])[((row_number() over (order by src_null, src) - 1) % {len(WEIGHTS)} + 1)::int] as weight, {LIMIT} * source_size as cap from by_source),
filled as (select *, row_number() over f as k,
    (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, src_null, src rows between unbounded preceding and 1 preceding), 0)) as left_over,
    sum(weight) over (order by cap / weight, src_null, src rows between current row and unbounded following) as w
    from weighed window f as (order by cap / weight, src_null, src)),
levels as (select *, left_over::double / w::double as lv from filled),
level as (select arg_min(lv, k) as level from levels where lv * weight <= cap),
aims0 as (select src_null, src, source_size, least(cap::double, level * weight) as target,
    greatest(1, least(ceil(source_size / {SHARD_WORDS}), ceil(sqrt(source_size))))::bigint as shards, round(sum(source_size) over () / {b})::bigint as blocks from levels, level),
{_apportion("aims", "aims0", "", "src_null, src", "target", "blocks")},
docs as (select s.*, a.source_size, a.target, a.shards, a.quota as source_quota, md5('{SEED}:' || s.name) as place from sizes s join aims a using (src_null, src)),
placed as (select *, ('0x' || place[1:8])::bigint % shards as shard from docs),
shards0 as (select src_null, src, shard, sum(size)::bigint as shard_size, first(source_quota)::bigint as source_quota from placed group by all),
{_apportion("quotas", "shards0", "src_null, src", "shard", "shard_size", "source_quota")},
shards1 as (select src_null, src, shard, ceil(shard_size / {b})::bigint as n, least(quota, {LIMIT} * ceil(shard_size / {b})::bigint)::bigint as quota,
    ('0x' || md5(concat_ws(':', '{SEED}', src, shard::varchar))[1:8])::bigint % greatest(ceil(shard_size / {b})::bigint, 1) as start from quotas),
rows as (select *, coalesce(sum(size) over (partition by src_null, src, shard order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as pos from placed)
select doc_id, size, source_size, target, (case when n = 0 then 0 else (quota // n) * size + {before("pos + size")} - {before("pos")} end)::bigint as taken
from rows join shards1 using (src_null, src, shard)"""
