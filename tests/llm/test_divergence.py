"""The divergence audit against every pair over every term, on texts that are hard."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, ranks):
    groups, langs, docs = defaultdict(Counter), defaultdict(Counter), Counter()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]
        groups[lang, source].update(terms)
        langs[lang].update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for (lang, source), mine in groups.items():
        kept = [t for t in langs[lang] if docs[lang, t] >= least]

        def prices(n, kept=kept):
            total = sum(n[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (n[t] + 2) // total for t in kept}

        p, q = prices(mine), prices(langs[lang])
        cost = lambda a, b: {t: (a[t] - b[t]) ** 2 // (a[t] + b[t]) for t in a}
        pairs = [(s, sum(cost(p, prices(n)).values())) for (x, s), n in groups.items() if x == lang and s != source]
        terms = [(t, f) for t, f in cost(p, q).items() if mine[t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", terms)):
            order = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, k) for k, (t, v) in enumerate(order[: ranks if part == "term" else None], 1)]
    return sorted(out)


def made(spark, rows):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    for c in ("term", "n", "docs", "v", "z", "p", "q", "value", "item", "rank", "total", "doc_id"):
        df = df.withColumn(c, F.lit(c))
    return df


def test_audit(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 7)  # many parts
    words = ["Ab", "aB", "ÉÉ", "é", "x", "ÄbC", "日本", "don", "t", "q9q", "_z_"]
    rows = [("en", f"s{i % 3}" if i % 4 else None, " ".join(words[(i * k) % 11] for k in range(1, 2 + i % 9))) for i in range(60)]
    rows += [("en", "none", None), ("en", "none", "  12 "), ("en", "huge", "Ab-x " * 30_000), (None, "s0", "one"), (None, "s1", ""), ("fr", "alone", "é é é"), ("", "s0", "one")] + [("fr", "alone", "ab ab")] * 3
    for least in (1, 3):
        got = divergence.audit(made(spark, rows), least, 4).collect()
        assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got) == brute(rows, least, 4)
    assert divergence.audit(made(spark, [])).isEmpty()
    assert [tuple(r) for r in divergence.audit(made(spark, [("en", "a", None), ("en", "b", None)])).orderBy("source").collect()] == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_prices_beyond_longs(spark):
    got = spark.range(1).select(divergence.price("9000000000000000", "9100000000000001", "3")).first()[0]
    assert got == 1 + 10**9 * 9000000000000002 // 9100000000000007
