"""Operator 2: quality rules with thresholds learned per language and source (native DataFrame code only).

Every text gets counts (``base_counts``). Rates derived from them (whole numbers,
per thousand words or lines) go into quantile sketches: log-linear histograms
whose buckets are exact integers, 32 to each power of two, so a value is off by
at most 1/32 of itself. Sketches of partitions, sources and languages merge by
adding bucket counts; the same rows always give the same sketch. A group's upper
fence for a rate lies beyond an upper quantile of its sketch (``Rule.upper``) by ``REACH`` times that
quantile's distance from the median, and what the sketch can't tell apart (one unit and a bucket): ``q + 3 * (q - q50) + 1 + q / 32``;
the lower fence (word length only) mirrors it at the lower quantile. Rates that only junk raises are cut from the 90th
percentile on (so up to a tenth of a group may be junk), rates that good texts raise too from the 99th. Groups of fewer than
``min_rows`` documents use the merged sketch of their language, and languages of
fewer the sketch of all. The fences are joined back to the documents of the group.

Defined results: a null or empty text has only zero counts and fails the base
rule; null languages and sources form groups of their own; repeated rows are
judged one by one, each counting in the sketches; other columns are ignored. On
an empty table the result is empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from appraise.llm.common import saved, words

WINDOW = 8
SUB = 5
"""Bits below the leading one that a bucket keeps (32 buckets to each power of two)."""


REACH = 3


@dataclass(frozen=True)
class Rule:
    rate: str
    upper: int
    """Percentile from which the fence is measured."""
    lower: bool = False
    """Whether there is a lower fence too, from the percentile ``100 - upper``."""


RATES = {
    "word_length": "100 * word_chars div greatest(n_words, 1)",
    "symbols": "1000 * n_symbols div greatest(n_words, 1)",
    "capitals": "1000 * n_capitals div greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "stutters": "1000 * n_stutters div greatest(n_words, 1)",
}
RULES = (
    Rule("word_length", 90, lower=True),
    Rule("symbols", 90),
    Rule("capitals", 99),
    Rule("dup_lines", 99),
    Rule("stutters", 99),
)
PERCENTILES = (10, 50, 90, 99)


def base_counts(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` and the counts of every whole text."""
    text = F.coalesce("text", F.lit(""))
    w, h, n = F.col("_w"), F.col("_h"), F.col("n_words")
    one = docs.select(*keep, text.alias("_t"))
    one = one.withColumn("_w", words(F.col("_t"))).withColumn(
        "_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    two = one.select(
        *keep,
        "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_t", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.size(F.filter("_w", lambda x, i: x == F.get(F.col("_w"), i - 1))).cast("long").alias("n_stutters"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    none = F.array().cast("array<bigint>")
    starts = F.sequence(F.lit(1), (n - (WINDOW - 1)).cast("int"))
    hashed = F.when(n >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))).otherwise(none)
    three = two.withColumn("_h", hashed)
    # Only texts with two equal hashes are looked at further, with a second hash beside the first.
    pairs = F.transform(
        h, lambda x, i: F.struct(x.alias("a"), F.xxhash64(F.lit(7), F.slice(w, i + 1, WINDOW)).alias("b"), i.alias("i"))
    )
    empty = F.array().cast("array<struct<a:bigint,b:bigint,i:int>>")
    four = three.withColumn("_s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(pairs)).otherwise(empty))
    s = F.col("_s")

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    found = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
    at = F.sort_array(F.transform(found, lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        at,
        start,
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"]).cast("long")).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return four.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), "n_capitals", "n_lines", "n_stutters"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def bucket(v: Column) -> Column:
    """The sketch bucket of a whole number >= 0."""
    e = F.length(F.bin(v)) - 1
    sub = F.call_function("shiftright", v, e - SUB) - (1 << SUB)
    return F.when(v < (1 << SUB), v).otherwise(((e - SUB + 1) * (1 << SUB)).cast("long") + sub)


def bucket_low(b: Column) -> Column:
    """The least value of a bucket."""
    e = F.floor(b / (1 << SUB)).cast("int")
    low = F.call_function("shiftleft", F.lit(1 << SUB).cast("long") + F.pmod(b, F.lit(1 << SUB)), e - 1)
    return F.when(b < (1 << SUB), b).otherwise(low)


def sketches(counts: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Mergeable sketches: one row per group, rate and bucket with a count."""
    rates = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rate"), F.expr(sql).alias("v")) for r, sql in RATES.items()])
    )
    return (
        counts.select(*groups, rates.alias("x"))
        .select(*groups, "x.rate", bucket(F.col("x.v")).alias("bucket"))
        .groupBy(*groups, "rate", "bucket")
        .agg(F.count("*").alias("n"))
    )


def merge(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Sketches of coarser groups: bucket counts added."""
    return sketch.groupBy(*groups, "rate", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Per group and rate: number of rows and the lower edges of the buckets that hold ``PERCENTILES``."""
    own = W.partitionBy(*groups, "rate")
    ranked = sketch.select(
        *groups,
        "rate",
        "bucket",
        F.sum("n").over(own).alias("rows"),
        F.sum("n").over(own.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)).alias("upto"),
    )
    at = {p: F.min(F.when(100 * F.col("upto") >= p * F.col("rows"), F.col("bucket"))) for p in PERCENTILES}
    return ranked.groupBy(*groups, "rate").agg(F.max("rows").alias("rows"), *[bucket_low(b).alias(f"q{p}") for p, b in at.items()])


def sides(rule: Rule) -> dict[str, str]:
    """The fences of a rule, in SQL over the percentiles."""
    q, low = f"q{rule.upper}", f"q{100 - rule.upper}"
    out = {"max": f"{q} + {REACH} * ({q} - q50) + 1 + {q} div 32"}
    if rule.lower:
        out["min"] = f"{low} - {REACH} * (q50 - {low}) - 1 - {low} div 32"
    return out


def fences(sketch: DataFrame, lang: str, source: str, min_rows: int) -> DataFrame:
    """One row per language and source with the fences of every rule, from the finest sketch of enough rows."""

    def level(groups: tuple[str, ...], tag: str) -> DataFrame:
        q = quantiles(sketch if groups == (lang, source) else merge(sketch, groups), groups)
        return q.withColumnsRenamed({c: f"{c}_{tag}" for c in ("rows", *(f"q{p}" for p in PERCENTILES))})

    fine, mid, top = level((lang, source), "f"), level((lang,), "m"), level((), "t")
    mid = mid.withColumnsRenamed({lang: "_lang", "rate": "_rate"})
    got = fine.join(mid, fine[lang].eqNullSafe(mid["_lang"]) & (fine["rate"] == mid["_rate"])).join(top, "rate")

    def pick(c: str) -> Column:
        return (
            F.when(F.col("rows_f") >= min_rows, F.col(f"{c}_f"))
            .when(F.col("rows_m") >= min_rows, F.col(f"{c}_m"))
            .otherwise(F.col(f"{c}_t"))
        )

    got = got.select(lang, source, "rate", *[pick(f"q{p}").alias(f"q{p}") for p in PERCENTILES])
    cols = []
    for rule in RULES:
        for side, sql in sides(rule).items():
            cols.append(F.max(F.when(F.col("rate") == rule.rate, F.expr(sql))).alias(f"{side}_{rule.rate}"))
    return got.groupBy(lang, source).agg(*cols)


def judge(docs: DataFrame, key: str = "doc_id", lang: str = "lang", source: str = "source", min_rows: int = 50) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row, with the fences that were applied."""
    spark = docs.sparkSession
    counts = saved(spark, base_counts(docs, (key, lang, source)), "quality-counts")
    counts = counts.withColumn("base_failed", base_failed())
    sketch = sketches(counts.where("not base_failed"), (lang, source))
    table = fences(sketch, lang, source, min_rows).withColumnsRenamed({lang: "_lang", source: "_source"})
    joined = counts.join(
        table, counts[lang].eqNullSafe(table["_lang"]) & counts[source].eqNullSafe(table["_source"]), "left"
    )
    good = ~F.col("base_failed")
    for rule in RULES:
        rate = F.expr(RATES[rule.rate])
        good = good & (rate <= F.col(f"max_{rule.rate}"))
        if rule.lower:
            good = good & (rate >= F.col(f"min_{rule.rate}"))
    bounds = [c for c in table.columns if c[:4] in ("max_", "min_")]
    return joined.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.coalesce(good, F.lit(False)).alias("kept"),
        *bounds,
    )


def oracle(min_rows: int = 50) -> str:
    """The same result in DuckDB's SQL over ``documents``."""
    rates = " UNION ALL ".join(
        f"SELECT lang, source, '{r}' AS rate, {sql.replace('div', '//')} AS v FROM c WHERE NOT base_failed"
        for r, sql in RATES.items()
    )
    level = """SELECT {g} rate, max(tot) AS rows, {lows} FROM (
        SELECT {g} rate, bucket, sum(n) OVER (PARTITION BY {g} rate) AS tot,
               sum(n) OVER (PARTITION BY {g} rate ORDER BY bucket) AS upto
        FROM (SELECT {g} rate, bucket, sum(n) AS n FROM sk GROUP BY {g} rate, bucket)) GROUP BY {g} rate"""

    def low(p: int) -> str:
        b = f"CAST(min(CASE WHEN 100 * upto >= {p} * tot THEN bucket END) AS BIGINT)"
        return f"CASE WHEN {b} < 32 THEN {b} ELSE ((32 + {b} % 32) << ({b} // 32 - 1)) END AS q{p}"

    lows = ", ".join(map(low, PERCENTILES))
    f, m, t = (level.format(g=g, lows=lows) for g in ("lang, source, ", "lang, ", ""))
    pick = "CASE WHEN f.rows >= {k} THEN f.{c} WHEN m.rows >= {k} THEN m.{c} ELSE t.{c} END AS {c}"
    picks = ", ".join(pick.format(k=min_rows, c=f"q{p}") for p in PERCENTILES)
    cols, good, bounds = [], ["NOT base_failed"], []
    for r in RULES:
        rate = RATES[r.rate].replace("div", "//")
        for side, sql in sides(r).items():
            sql = sql.replace("div", "//")
            cols.append(f"max(CASE WHEN rate = '{r.rate}' THEN {sql} END) AS {side}_{r.rate}")
            good.append(f"{rate} {'<=' if side == 'max' else '>='} {side}_{r.rate}")
            bounds.append(f"{side}_{r.rate}")
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
marked AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, CAST(sum(least(8, gap)) AS BIGINT) AS n FROM (
          SELECT doc_id, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 8) AS gap FROM marked) GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals,
             CAST(len(list_filter(ws, lambda x, i: i > 1 AND x = ws[i - 1])) AS BIGINT) AS n_stutters,
             CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
c AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
sk AS (SELECT lang, source, rate, bucket, count(*) AS n FROM (
         SELECT lang, source, rate, CASE WHEN v < 32 THEN v ELSE
                (length(bin(v)) - 5) * 32 + (v >> (length(bin(v)) - 6)) - 32 END AS bucket FROM ({rates}))
       GROUP BY ALL),
f AS ({f}), m AS ({m}), t AS ({t}),
q AS (SELECT f.lang, f.source, f.rate, {picks}
      FROM f JOIN m ON m.lang IS NOT DISTINCT FROM f.lang AND m.rate = f.rate JOIN t ON t.rate = f.rate),
g AS (SELECT lang, source, {', '.join(cols)} FROM q GROUP BY lang, source)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce({' AND '.join(good)}, false) AS kept, {', '.join(f'CAST({x} AS BIGINT) AS {x}' for x in bounds)}
FROM c LEFT JOIN g ON g.lang IS NOT DISTINCT FROM c.lang AND g.source IS NOT DISTINCT FROM c.source"""
