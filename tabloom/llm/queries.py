"""Queries opN_*: each applies an operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import audit, decontaminate, jaccard, katz, mixing, neighbours, private_data, quality, runs, site_tree, substrings, toxicity, url_lists
from tabloom.llm.registry import query, table


def _remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query()
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query(r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
v as (
  select doc_id, i, min(doc_id) over (partition by array_to_string(w[i:i + 12], ' ')) as first
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13)),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as k from v where first < doc_id),
kept as (
  select doc_id, string_agg(x, ' ' order by k) as t
  from (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as k from d)
  anti join gone using (doc_id, k) group by doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id) left join n using (doc_id)
""")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


@query(r"""
with recursive d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + 2], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
l as (
  select a.doc_id as a, b.doc_id as b
  from s a join s b on a.g = b.g and a.doc_id < b.doc_id
  join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n
  having 100 * count(*) >= 90 * (x.n + y.n - count(*))),
e as (select a, b from l union all select b, a from l),
c(node, reached) as (
  select doc_id, doc_id from d
  union
  select c.node, e.b from c join e on e.a = c.reached)
select d.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles,
       min(c.reached) as component_id
from d join c on c.node = d.doc_id left join n on n.doc_id = d.doc_id
group by d.doc_id
""")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_classes(table(spark, sf_dir, "documents"))


@query()
def op3_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = katz.fit(docs.filter(_remainder(10) != 0))
    return katz.score(docs, model).select(
        "doc_id",
        (_remainder(10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query()
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query()
def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.sanitise(table(spark, sf_dir, "documents"), everywhere=True)
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *private_data.counted(spans),
        F.sha2(
            private_data.described(F.filter(spans, lambda s: s["kind"] < 4)), 256
        ).alias("base_sha256"),
        private_data.described(spans).alias("spans"),
    )


@query()
def op4_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def _digest(value: Column, first: int) -> Column:
    """Seven hex digits of the md5 as a number."""
    return F.conv(F.substring(F.md5(value.cast("binary")), first, 7), 16, 10).cast("long")


def _second(number: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + number).cast("timestamp_ntz")


def captures_and_list(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures with fetch times in 2024, and a dated list of their hosts, domains and folders.

    The tables hold no dates and no lists: both follow from digests of ids and names. A third of
    hosts, a seventh of the folders and an eleventh of domains are listed, most are delisted
    later, and some are listed again.
    """
    year = 366 * 86400
    captures = pages.select(
        "page_id",
        "url",
        _second(F.pmod(_digest(F.col("page_id").cast("string"), 1), F.lit(year))).alias("fetched"),
    )
    name, folder = url_lists.host(F.col("url")), F.regexp_extract("url", r"://[^/]*/([a-z]+)/", 1)
    domain = F.regexp_extract(name, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    named = pages.select(
        F.explode(
            F.array(
                F.struct(name.alias("pattern"), F.lit(3).alias("share")),
                F.struct(domain.alias("pattern"), F.lit(11).alias("share")),
                F.struct(
                    F.when(folder != "", F.concat(name, F.lit("/"), folder)).alias("pattern"),
                    F.lit(7).alias("share"),
                ),
            )
        ).alias("e")
    ).select("e.pattern", "e.share")
    listed = named.filter("pattern != ''").distinct()
    listed = listed.filter(_digest(F.col("pattern"), 1) % F.col("share") == 0)
    days = [_digest(F.col("pattern"), at) % 180 for at in (8, 15, 22)]
    steps = [("add", days[0]), ("remove", days[0] + days[1]), ("add", days[0] + days[1] + days[2])]
    entries = listed.select(
        "pattern",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(a).alias("action"), _second(d * 86400).alias("dated"))
                    for a, d in steps
                ]
            )
        ).alias("e"),
    ).select("pattern", "e.action", "e.dated")
    return captures, entries


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"


@query(rf"""
with page as (
  select page_id, url, {_HOST} as host, regexp_extract(url, '://[^/]*/([a-z]+)/', 1) as folder,
         timestamp '2024-01-01' + to_seconds(
           ('0x' || substr(md5(page_id::varchar), 1, 7))::bigint % 31622400) as fetched
  from pages),
named as (
  select host as pattern, 3 as share from page
  union select regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1), 11 from page
  union select host || '/' || folder, 7 from page where folder != ''),
listed as (
  select pattern, timestamp '2024-01-01' as zero,
         ('0x' || substr(md5(pattern), 8, 7))::bigint % 180 as d1,
         ('0x' || substr(md5(pattern), 15, 7))::bigint % 180 as d2,
         ('0x' || substr(md5(pattern), 22, 7))::bigint % 180 as d3
  from named
  where pattern != '' and ('0x' || substr(md5(pattern), 1, 7))::bigint % share = 0),
entry as (
  select pattern, true as is_add, zero + to_days(d1::int) as dated from listed
  union all select pattern, false, zero + to_days((d1 + d2)::int) from listed
  union all select pattern, true, zero + to_days((d1 + d2 + d3)::int) from listed),
latest as (
  select page_id, pattern, bool_and(is_add) as in_force
  from (select p.page_id, e.pattern, e.is_add,
               e.dated = max(e.dated) over (partition by p.page_id, e.pattern) as is_last
        from page p join entry e on e.dated <= p.fetched
         and (p.host = e.pattern or ends_with(p.host, '.' || e.pattern)
              or starts_with(regexp_extract(p.url, '^[A-Za-z][A-Za-z0-9+.-]*://([^?#]*)', 1) || '/',
                             e.pattern || '/') and contains(e.pattern, '/')))
  where is_last group by page_id, pattern)
select p.page_id, count(l.pattern) as n_entries,
       (list(l.pattern order by -length(l.pattern), l.pattern)
         filter (where l.pattern is not null))[1] as pattern
from page p left join latest l on l.page_id = p.page_id and l.in_force
group by p.page_id
""")
def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = captures_and_list(table(spark, sf_dir, "pages"))
    return url_lists.in_force(captures, entries)


@query()
def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    seen = labels.filter(_remainder(5) != 0).select("doc_id", F.col("quality").alias("good"))
    model = quality.fit(docs, seen)
    return quality.score(docs, model).select(
        "doc_id",
        (_remainder(5) == 0).alias("held_out"),
        "score",
        quality.accepted(F.col("score")).alias("predicted"),
    )


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    seen = labels.filter(_remainder(3) != 1).select("doc_id", "toxic")
    model = toxicity.fit(docs, seen)
    return toxicity.score(docs, model).select(
        "doc_id",
        (_remainder(3) == 1).alias("held_out"),
        "score",
        toxicity.toxic(F.col("score")).alias("predicted"),
    )


_PERMUTATIONS = """
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as o
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5)"""


@query(rf"""
with {_PERMUTATIONS.strip()},
t as (
  select doc_id, coalesce(text, '') as text, coalesce(source, '') as part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         min(doc_id) over (partition by coalesce(text, '')) as first
  from documents),
l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id),
f as (
  select part, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic,
         case when len(w) < 200 then 'A' else '' end
         || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
         || case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text)
            then 'C' else '' end
         || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
         || case when doc_id > first then 'E' else '' end as fails
  from t left join l using (doc_id)),
c as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from f group by part, fails),
s as (
  select part, o, step, o[step] as x, fails, n, good, toxic, contains(fails, o[step]) as own,
         len(translate(fails, o[1:step - 1], '')) < len(fails) as earlier
  from c, orders, (select unnest(range(1, 6)) as step)),
r as (
  select part, o as filter_order, step::int as step, x,
         coalesce(sum(n) filter (not own and not earlier), 0)::bigint as kept,
         coalesce(sum(n) filter (own and not earlier), 0)::bigint as removed,
         coalesce(sum(n) filter (own and earlier), 0)::bigint as redundant,
         coalesce(sum(n) filter (fails = x), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (own and not earlier), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (own and not earlier), 0)::bigint as toxic_lost
  from s group by part, o, step, x)
select * exclude (x), (sum(removed) over (partition by part, x))::bigint as shapley from r
""")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.five_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _changed(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, drawn by their ids, repeat themselves from some word on."""
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.split("text", r"[\x20\x09-\x0D]+")
    n = F.size(F.filter(split, lambda w: w != ""))
    some = F.greatest(n, F.lit(1))
    g = F.floor(drawn / 10)
    start = (g % some).cast("int")
    period = (F.floor((n - start) / (g % 8 + 3)) + 1).cast("int")
    repeated = runs.repeat_from(F.col("text"), start, period)
    text = F.when((drawn % 10 == 0) & (n > 0), repeated).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


_CRC32 = """
xor(4294967295::bigint, list_reduce(
  list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
  lambda acc, b: list_reduce(
    list_prepend(xor(acc, b), range(8)),
    lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)))"""


@query(rf"""
with o as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         {_CRC32.strip()} as h
  from documents),
c as (
  select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as changed, h // 10 as g,
         (h // 10) % greatest(len(w), 1) as a
  from o),
e as (select *, 1 + (n - a) // (3 + g % 8) as p from c),
d as (
  select doc_id, n, case when changed then list_transform(
    range(n), lambda i: w[1 + case when i >= a then a + (i - a) % p else i end]) else w end as w
  from e),
g as (
  select doc_id, n, i, array_to_string(w[i + 1:i + 6], ' ') as x
  from (select doc_id, n, w, unnest(range(n - 5)) as i from d where n >= 12)),
m as (
  select a.doc_id, a.i, a.i - b.i as lag
  from g a join g b on a.doc_id = b.doc_id and a.x = b.x and a.i > b.i and 2 * (a.i - b.i) <= a.n),
s as (
  select doc_id, lag, min(i) - lag as start, count(*) + 5 + lag as length
  from (select *, i - row_number() over (partition by doc_id, lag order by i) as island from m)
  group by doc_id, lag, island
  having count(*) + 5 >= greatest(12 - lag, lag)),
r as (select doc_id, start, length, min(lag) as period from s group by doc_id, start, length),
z as (
  select doc_id, count(*) as n_runs,
         list({{'start': start, 'length': length, 'period': period}}
              order by length desc, start, period)[1] as first,
         string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as t
  from r group by doc_id),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as k from r),
kept as (
  select doc_id, string_agg(x, ' ' order by k) as t
  from (select doc_id, unnest(w) as x, generate_subscripts(w, 1) - 1 as k from d)
  anti join gone using (doc_id, k) group by doc_id)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, first.start::bigint as start,
       first.length::bigint as length, first.period::bigint as period,
       (1000 * first.length // first.period)::bigint as exponent_milli,
       sha256(coalesce(z.t, '')) as runs_sha256, sha256(coalesce(kept.t, '')) as collapsed_sha256
from d left join z using (doc_id) left join kept using (doc_id)
""")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse(_changed(table(spark, sf_dir, "documents")))
    held = F.col("runs")
    described = F.transform(
        held, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    ranked = F.transform(
        held, lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))
    )
    first = F.array_max(ranked)["run"]
    return found.select(
        "doc_id",
        F.size(held).cast("long").alias("n_runs"),
        first["start"].alias("start"),
        first["length"].alias("length"),
        first["period"].alias("period"),
        F.floor(first["length"] * 1000 / first["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(described, lambda t: F.concat(t, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = site_tree.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
