"""Operator 9, line dedup, on DataFrame functions alone.

A line that equals the line before is taken out first, so that a run of one line is one line. The lines that are left are hashed,
and a rolling hash over two line hashes chooses where chunks end: where the hash of two neighbouring lines, modulo a prime, is below
those on both sides, never next to the text's first or last line. So every chunk of a text of two lines or more has two lines or more,
and as the choice depends on the neighbourhood alone, a passage that moved within a document, or to another one, falls into the
same chunks but for its edges. Of chunks of two lines or more that are the same byte for byte, the first stays (smallest doc_id,
then earliest) and the others are removed. Hashes pick the candidates; grouping by the chunk's bytes decides.

Chunks are kept as the places where they start and end among the lines, so no text is put together before it is needed. All
texts are cut up once, for a table of slim rows (place and hash of each chunk); after that only texts with a repeated chunk are cut
up again for its bytes, and only texts that change for their result.

Defined cases: null text stays null and has no lines; an empty text has one empty line. Lines and chunks of fewer than `min_chars`
characters stay: by default those that have no character at all. Rows that repeat both doc_id and text count as one document; a null
doc_id comes before all others. An empty table gives an empty result. Columns are kept, but one called like the output is replaced;
those that begin with "__ld_" are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stash

MIN_CHARS = 1
#: Below 2^28, the range of line hashes.
PRIME = 268_435_399


def _line_hash(line: Column) -> Column:
    """28 bits of the line's MD5, which SQL engines share."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _without_repeats(lines: Column, min_chars: int) -> Column:
    """The lines but for those of min_chars characters or more that equal the line before."""
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))))
    return F.array_compact(F.zip_with(lines, before, lambda x, y: F.when(y.isNull() | (x != y) | (F.length(x) < min_chars), x)))


def _pairs(a: Column, f) -> Column:
    inner = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, 1, inner), F.slice(a, 2, inner), f)


def _cut(docs: DataFrame, text: Column, min_chars: int) -> DataFrame:
    """Adds __ld_l, a text's lines without repeats, __ld_a, their hashes, __ld_s and __ld_e, where its chunks start and end (from 1), and __ld_m, whether lines are gone; null for null."""
    d = docs.withColumn("__ld_l", F.split(text, "\n", -1)).withColumn("__ld_a", F.transform("__ld_l", _line_hash))
    d = d.withColumn("__ld_m", F.size("__ld_l")).withColumn("__ld_q", F.exists(_pairs(F.col("__ld_a"), lambda x, y: x == y), lambda x: x))
    # most texts have no two equal neighbours and keep their arrays
    d = d.withColumn("__ld_l", F.when(F.col("__ld_q"), _without_repeats(F.col("__ld_l"), min_chars)).otherwise(F.col("__ld_l")))
    d = d.withColumn("__ld_a", F.when(F.col("__ld_q"), F.transform("__ld_l", _line_hash)).otherwise(F.col("__ld_a")))
    d = d.withColumn("__ld_m", F.col("__ld_m") > F.size("__ld_l")).withColumn("__ld_q", _pairs(F.col("__ld_a"), lambda x, y: F.when(x == y, PRIME).otherwise((x * 31 + y) % PRIME)))
    q = F.col("__ld_q")
    least = F.filter(F.sequence(F.lit(2), F.size(q) - 1), lambda j: q[j - 1] < F.least(q[j - 2], q[j]))
    d = d.withColumn("__ld_q", F.when(F.size(q) >= 3, least).when(q.isNotNull(), F.array().cast("array<int>")))
    starts = F.concat(F.array(F.lit(1)), F.transform("__ld_q", lambda j: j + 1))
    return d.withColumn("__ld_s", starts).withColumn("__ld_e", F.concat("__ld_q", F.array(F.size("__ld_l")))).drop("__ld_q")


def _chunk(p: Column, of: str) -> Column:
    """The lines (or their hashes) of chunk p."""
    start = F.col("__ld_s")[p]
    return F.slice(of, start, F.col("__ld_e")[p] - start + 1)


def _n_lines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


_SAME = "d.i <=> x.i and d.h = x.h"


def changes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """i (doc_id), h (hash of the text), gone (places of the chunks to remove), for documents that lose a chunk or a line of a run."""
    d = docs.select(F.col(doc_id).alias("i"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    place = F.sequence(F.lit(0), F.size("__ld_s") - 1)
    chunks = F.transform(place, lambda p: F.struct(p.alias("p"), F.when(F.col("__ld_e")[p] > F.col("__ld_s")[p], F.xxhash64(_chunk(p, "__ld_a"))).alias("c")))
    cut = _cut(d, F.col("t"), min_chars).where("t is not null").select("i", "h", F.col("__ld_m").alias("m"), F.inline(chunks))
    # chunks that can be compared, and one row for each text that has lost lines of a run
    slim = stash(cut.where("c is not null or (m and p = 0)"), "chunks")
    repeated = stash(slim.where("c is not null").groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c"), "repeated")
    hit = stash(slim.join(small(repeated), "c", "left_semi").groupBy("i", "h").agg(F.collect_set("p").alias("at")), "hit")
    again = d.alias("d").join(small(hit, row_bytes=400).alias("x"), F.expr(_SAME)).select("d.i", "d.h", "d.t", "x.at")
    bytes_of = F.transform("at", lambda p: F.struct(p.alias("p"), F.array_join(_chunk(p, "__ld_l"), "\n").alias("chunk")))
    again = _cut(again, F.col("t"), min_chars).select("i", "h", F.inline(bytes_of)).where(F.length("chunk") - _n_lines(F.col("chunk")) + 1 >= min_chars)
    candidates = stash(again, "candidates")
    first = candidates.groupBy("chunk").agg(F.min(F.struct("i", "h", "p")).alias("f")).select("f.*")
    gone = candidates.select("i", "h", "p").alias("d").join(first.alias("x").hint("merge"), F.expr(_SAME + " and d.p = x.p"), "left_anti")
    both = gone.select("i", "h", "p").unionByName(slim.where("m").select("i", "h", F.lit(None).cast("int").alias("p")))
    return stash(both.groupBy("i", "h").agg(F.collect_set("p").alias("gone")), "changes")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, out: str = "line_dedup") -> DataFrame:
    """docs with repeated chunks and the repeats of runs taken out of the text, and n_lines and n_removed (longs) added as the struct `out`."""
    gone = changes(docs, doc_id, text, min_chars).select(F.col("i").alias("__ld_i"), F.col("h").alias("__ld_k"), F.col("gone").alias("__ld_g"))
    d = docs.join(small(gone, row_bytes=400), F.col(doc_id).eqNullSafe(F.col("__ld_i")) & (F.xxhash64(text) == F.col("__ld_k")), "left")
    d = _cut(d, F.when(F.col("__ld_g").isNotNull(), F.col(text)), min_chars)  # texts that stay as they are aren't cut up
    d = d.withColumn("__ld_p", F.filter(F.sequence(F.lit(0), F.size("__ld_s") - 1), lambda p: ~F.array_contains("__ld_g", p)))
    d = d.withColumn("__ld_r", F.flatten(F.transform("__ld_p", lambda p: _chunk(p, "__ld_l")))).withColumn("__ld_n", F.coalesce(_n_lines(F.col(text)), F.lit(0)).cast("long"))
    counts = F.struct(F.col("__ld_n").alias("n_lines"), F.when(F.col("__ld_g").isNull(), 0).otherwise(F.col("__ld_n") - F.size("__ld_r")).cast("long").alias("n_removed"))
    d = d.withColumn(out, counts).withColumn(text, F.when(F.col("__ld_g").isNull(), F.col(text)).otherwise(F.array_join("__ld_r", "\n")))
    return d.drop("__ld_n", "__ld_r", "__ld_l", "__ld_a", "__ld_s", "__ld_e", "__ld_m", "__ld_p", "__ld_i", "__ld_k", "__ld_g")


ORACLE = f"""
with d as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
l as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as j from d where text is not null),
y as (select *, lag(line) over (partition by doc_id order by j) as above from l),
u as (select doc_id, line, row_number() over (partition by doc_id order by j) as i, ('0x' || substr(md5(line), 1, 7))::bigint as a from y where above is null or line <> above or length(line) < {MIN_CHARS}),
v as (select *, lead(a) over (partition by doc_id order by i) as b from u),
q as (select *, case when b = a then {PRIME} else (a * 31 + b) % {PRIME} end as q from v),
e as (select *, case when q < lag(q) over w and q < lead(q) over w then 1 else 0 end as ends from q window w as (partition by doc_id order by i)),
k as (select *, coalesce(sum(ends) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as p from e),
c as (select doc_id, p, string_agg(line, chr(10) order by i) as chunk, count(*) as n from k group by doc_id, p),
r as (select *, n > 1 and length(chunk) - n + 1 >= {MIN_CHARS} as multi from c),
g as (select *, multi and row_number() over (partition by chunk, multi order by doc_id, p) > 1 as gone from r),
o as (select doc_id, sum(n) filter (where not gone) as kept, string_agg(chunk, chr(10) order by p) filter (where not gone) as t from g group by doc_id),
z as (select doc_id, count(*) as n from l group by doc_id)
select d.doc_id, coalesce(z.n, 0) as n_lines, coalesce(z.n - coalesce(o.kept, 0), 0)::bigint as n_removed, case when d.text is not null then sha256(coalesce(o.t, '')) end as kept_sha256
from d left join z using (doc_id) left join o using (doc_id)
"""
