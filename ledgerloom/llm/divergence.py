"""Source divergence audit: how far the sources of a language differ in their terms, and which terms set a source apart.

Terms are counted by batch in tasks, then by group; a language keeps the terms in at least LEAST_DOCS of its documents. With
count c of a kept term in a group, N the group's sum of counts and V the language's kept terms, p = 1 + floor(10^9 (c + 2) /
(N + 2 V)), and a term costs f(p, q) = floor((p - q)^2 / (p + q)). A pair of sources sums f over all V terms, but no group has
a row for terms that it lacks. By inclusion and exclusion over the supports A and B, with z = p of count 0:

    sum over A of f(p, zB) + sum over B of f(zA, q)                       one-sided, from histograms of counts
    + sum over A and B of f(p, q) - f(p, zB) - f(zA, q) + f(zA, zB)       from a join of the sparse postings
    + (V - |A| - |B|) f(zA, zB)                                           a constant

All of it is whole numbers: exact in longs up to 2^63 / 10^9 kept terms in a language; p is divided out in decimals.

Edge cases: null text, language and source are ''. Rows count as documents, repeated ones too. A group without terms has a
row for each other source of its language; without kept terms in the language all values are 0. A language with one source
has no pairs. Texts of any length are read whole. Ties rank by the item's UTF-8 bytes. Empty tables give no rows. Other
columns are not read. A group's ranked pairs are as many as its language has sources; its terms are cut to the top ranks
before the shuffle, so a source with a third of all rows is one short list there.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import common

common.shipped(__name__)
LEAST_DOCS, RANKS = 10, 10
#: Distinct terms that a task holds at once.
HELD_TERMS = 200_000
LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def counted(batches):
    """(lang, source, term, n, docs) by group and batch, and a row without a term for each group."""
    import pyarrow as pa

    def rows(held):
        made = [(lang, source, term, n, docs[term]) for (lang, source), (total, docs) in held.items() for term, n in total.items()]
        made += [(lang, source, None, 0, 0) for lang, source in held]
        lang, source, term, n, docs = map(list, zip(*made, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

    held, size = {}, 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for start, part in common.text_parts(batch.column("text")):
            for k, text in enumerate(part, start):
                total, docs = held.setdefault((langs[k], sources[k]), (Counter(), Counter()))
                terms, was = text.translate(LOWER).split(), len(total)
                total.update(terms)
                docs.update(set(terms))
                size += len(total) - was
                if size > HELD_TERMS:
                    yield rows(held)
                    held, size = {}, 0
    if held:
        yield rows(held)


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents by group; a row with a null term for each group."""
    read = docs.select(*[common.text_or_empty(F.col(c)).alias(c) for c in ("lang", "source", "text")])
    parts = read.mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(count: str, total: str, kept: str) -> Column:
    """p of a count; divided in decimals, exact beyond longs."""
    return F.expr(f"1 + (cast({count} as decimal(19,0)) + 2) * 1000000000 div (cast({total} as decimal(19,0)) + 2 * cast({kept} as decimal(19,0)))")


def cost(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    found = common.written(counts(docs), "counts")
    kept = found.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(F.col("d") >= least_docs).drop("d")
    kept = common.written(kept, "kept")
    posts = common.written(found.where("term is not null").join(kept, ["lang", "term"]).select("lang", "term", "source", "n", "lang_n"), "postings")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = posts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("support"))
    groups = found.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "support", "v", "lang_total"])
    groups = common.written(groups.withColumn("z", F.when(F.col("v") > 0, price("0", "total", "v"))), "groups")

    own = posts.join(groups.select("lang", "source", "total", "v", "z", "lang_total"), ["lang", "source"])
    own = own.select("lang", "term", "source", "n", "z", price("n", "total", "v").alias("p"), price("lang_n", "lang_total", "v").alias("q"))
    terms = own.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(cost("p", "q")).alias("value"))

    # one-sided: what a source's own terms cost against each other source as if that lacked them all
    histogram = own.groupBy("lang", "source", "p").agg(F.count("*").alias("many"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("y"))
    alone = histogram.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.expr(f"many * {cost('p', 'y')}")).alias("value"))
    # both have it: what was priced twice goes, what holds comes
    a = own.select("lang", "term", "source", "p", "z")
    b = own.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("z").alias("y"))
    overlap = F.expr(f"{cost('p', 'q')} - {cost('p', 'y')} - {cost('z', 'q')} + {cost('z', 'y')}")
    overlap = a.join(b, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(overlap).alias("value"))
    # neither has it
    one = groups.select("lang", "source", "v", "support", "z")
    two = groups.select("lang", F.col("source").alias("item"), F.col("support").alias("support2"), F.col("z").alias("y"))
    neither = one.join(two, "lang").where("source < item").select("lang", "source", "item", F.coalesce(F.expr(f"(v - support - support2) * {cost('z', 'y')}"), F.lit(0)).alias("value"))
    alone = alone.select("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"), "value")
    pairs = common.written(neither.unionByName(overlap).unionByName(alone).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pairs")
    pairs = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    falling = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(falling).alias("rank"))
    return pairs.unionByName(terms.withColumn("rank", F.row_number().over(falling)).where(F.col("rank") <= ranks))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"))


def op12_sql() -> str:
    """The contract spelled out: every pair over every kept term."""
    f = "((p - q) * (p - q) // (p + q))"
    p = "1 + (1000000000::hugeint * (coalesce({0}, 0) + 2) // ({1} + 2 * v))"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, {lower} as text from documents),
        occ as (select r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
        kept as (select lang, term, count(*) as lang_n from occ group by lang, term having count(distinct r) >= {LEAST_DOCS}),
        langs as (select lang, count(*) as v, sum(lang_n) as lang_total from kept group by lang),
        c as (select lang, source, term, count(*) as n from occ semi join kept using (lang, term) group by all),
        g as (select lang, source, coalesce(v, 0) as v, lang_total, coalesce((select sum(n) from c where c.lang = x.lang and c.source = x.source), 0) as total from (select distinct lang, source from d) x left join langs using (lang)),
        full_p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, {p.format("c.n", "total")} as p, {p.format("k.lang_n", "lang_total")} as q
            from g join kept k on k.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
        pair_sum as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value from full_p a join full_p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        parts as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
                left join pair_sum s on s.lang = a.lang and s.source = a.source and s.item = b.source
            union all select lang, source, 'term', term, {f} from full_p where n > 0 and p > q)
        select lang, source, part, item, value::bigint as value, rank::int as rank
        from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from parts) where part = 'pair' or rank <= {RANKS}"""
