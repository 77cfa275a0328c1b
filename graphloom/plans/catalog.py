"""The registered queries of the graph operators, each with its DuckDB oracle.

The driver tables carry the operators: documents are texts with chunks, orders and
lineitem are records and their parts, events are monitoring rows, part and customer
names are identifiers to resolve.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from graphloom.functions import redaction as D, text as T
from graphloom.operators import graph as G, relational as R, search as S
from graphloom.streaming import runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}]"
_CHUNK_SQL = f"""
w as (select doc_id, text, unnest(range(0, greatest(length(text), 1), 3800)) o from documents where length(text) > 0),
v as (select doc_id, o, substring(text, o + 1, 4000) x from w where o = 0 or o + 200 < length(text)),
c as (select doc_id, o + length(x) - length(regexp_replace(x, '^{_WS}+', '')) char_offset,
  replace(regexp_replace(regexp_replace(x, '^{_WS}+', ''), '{_WS}+$', ''), chr(0), ' ') chunk from v),
chunked as (select doc_id, row_number() over (partition by doc_id order by char_offset) - 1 idx, char_offset, char_offset + length(chunk) char_end, chunk from c where chunk <> '')
"""


@query(f"with {_CHUNK_SQL} select doc_id, idx, char_offset, char_end, 'chunk:' || substring(sha256('doc:' || doc_id || chr(0) || idx || chr(0) || chunk), 1, 16) chunk_id from chunked")
def chunk_windows(t):
    rows = G.chunks(t("documents"), "doc_id", "text")
    parent = F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))
    return rows.select("doc_id", "idx", "char_offset", "char_end", G.chunk_id(parent, F.col("idx"), F.col("chunk")).alias("chunk_id"))


@query(rf"select doc_id, sha256(regexp_replace(regexp_replace(text, '^{_WS}+', ''), '{_WS}+$', '')) digest from documents where length(text) > 0")
def chunk_stitch(t):
    return G.stitch(G.chunks(t("documents"), "doc_id", "text"), "doc_id").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(f"""with {_CHUNK_SQL}, n as (select distinct doc_id, idx, unnest(string_split_regex(lower(chunk), '[^a-z0-9]+')) word from chunked),
targets as (select distinct lower(word) word from (select unnest(string_split_regex(text, '[^A-Za-z0-9]+')) word from benchmark) where length(word) >= 9)
select doc_id parent, word target, count(distinct idx) via from n join targets using (word) group by all""")
def chunk_rollup(t):
    rows = G.chunks(t("documents"), "doc_id", "text")
    words = rows.select(F.concat_ws("/", "doc_id", "idx").alias("child"), F.explode(F.split(F.lower("chunk"), "[^a-z0-9]+")).alias("target"))
    targets = t("benchmark").select(F.explode(F.split("text", "[^A-Za-z0-9]+")).alias("w")).where(F.length("w") >= 9).select(F.lower("w").alias("target")).distinct()
    contains = rows.select(F.col("doc_id").alias("parent"), F.concat_ws("/", "doc_id", "idx").alias("child"))
    return G.roll_up(contains, words.join(targets, "target", "left_semi").distinct())


@query("""with w as (select distinct doc_id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) word from documents),
k as (select distinct lower(word) word from (select unnest(string_split_regex(text, '[^A-Za-z0-9]+')) word from benchmark) where length(word) >= 9)
select word, count(*) documents from w join k using (word) group by word""")
def known_mentions(t):
    words = t("documents").select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z0-9]+"))).alias("word"))
    known = t("benchmark").select(F.explode(F.split("text", "[^A-Za-z0-9]+")).alias("w")).where(F.length("w") >= 9).select(F.lower("w").alias("word")).distinct()
    return words.join(known, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("documents"))


@query("select event_type, count(*) mentions from (select event_type, unnest(regexp_extract_all(props, '[A-Za-z0-9_]+')) m from events) where length(m) > 1 group by event_type")
def extract_mentions(t):
    found = t("events").select("event_type", F.explode(F.regexp_extract_all("props", F.lit("[A-Za-z0-9_]+"), F.lit(0))).alias("m"))
    return found.where(F.length("m") > 1).groupBy("event_type").agg(F.count(F.lit(1)).alias("mentions"))


@query("""select o_custkey parent, l_partkey target, count(distinct l_orderkey) via from orders join lineitem on o_orderkey = l_orderkey
join part on l_partkey = p_partkey where p_size <= 5 group by all""")
def affects_promotion(t):
    contains = t("orders").select(F.col("o_custkey").alias("parent"), F.col("o_orderkey").alias("child"))
    wanted = t("part").where("p_size <= 5").select(F.col("p_partkey").alias("target"))
    references = t("lineitem").select(F.col("l_orderkey").alias("child"), F.col("l_partkey").alias("target")).join(wanted, "target", "left_semi")
    return G.roll_up(contains, references)


@query("""with r as (select c_custkey cert, c_custkey * 7 run_min, c_custkey * 7 + 12 run_max from customer), p as (select distinct l_orderkey run from lineitem)
select cert, run from r join p on run between run_min and run_max where not exists (select 1 from orders where o_custkey = cert and o_orderkey = run)""")
def run_range_link(t):
    ranges = t("customer").select(F.col("c_custkey").alias("cert"), (F.col("c_custkey") * 7).alias("run_min"), (F.col("c_custkey") * 7 + 12).alias("run_max"))
    points = t("lineitem").select(F.col("l_orderkey").alias("run")).distinct()
    linked = R.range_join(points, ranges, "run", "run_min", "run_max", 64).select("cert", "run")
    return G.without_existing(linked, t("orders").select(F.col("o_custkey").alias("cert"), F.col("o_orderkey").alias("run")), ["cert", "run"])


@query("""with h as (select c_nationkey parent, o_orderkey document, o_orderkey * 10 holder from customer join orders on c_custkey = o_custkey
union all select c_nationkey, o_orderkey, o_orderkey * 10 + l_linenumber from customer join orders on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey),
r as (select l_orderkey * 10 + l_linenumber holder, p_brand target from lineitem join part on l_partkey = p_partkey where p_size = 1
union all select o_orderkey * 10, 'Brand#' || (o_orderkey % 5) from orders where o_orderpriority like '1%')
select parent, target, count(distinct holder) holders, count(distinct document) documents from h join r using (holder) group by all""")
def two_hop_rollup(t):
    orders, lines = t("orders"), t("lineitem")
    parents = t("customer").join(orders, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_nationkey").alias("parent"), (F.col("o_orderkey") * 10).alias("document"))
    children = lines.select((F.col("l_orderkey") * 10).alias("document"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("chunk"))
    small = t("part").where("p_size = 1").select("p_partkey", "p_brand")
    references = lines.join(small, F.col("l_partkey") == F.col("p_partkey")).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("holder"), F.col("p_brand").alias("target"))
    direct = orders.where("o_orderpriority like '1%'").select((F.col("o_orderkey") * 10).alias("holder"), F.concat(F.lit("Brand#"), (F.col("o_orderkey") % 5).cast("string")).alias("target"))
    return G.two_hop_roll_up(parents, children, references.unionByName(direct)).select("parent", "target", "holders", F.size("documents").cast("long").alias("documents"))


@query("""with s as (select p_brand, p_partkey, p_size, lag(p_partkey) over w prev, lag(p_size) over w prev_size from part window w as (partition by p_brand order by p_size, p_partkey))
select p_brand, prev previous, p_partkey as next from s where prev is not null and prev_size <> p_size""")
def tier_chain(t):
    return R.consecutive_pairs(t("part"), ["p_brand"], [F.col("p_size"), F.col("p_partkey")], "p_partkey", "p_size")


@query("""with p as (select 'tag_v' || p_partkey name from part), q as (select name, case when cast(regexp_extract(name, '_v(\\d+)$', 1) as bigint) > 1
then 'tag_v' || (cast(regexp_extract(name, '_v(\\d+)$', 1) as bigint) - 1) end before from p) select q.name src, p.name dst, 'supersedes' edge_type from q join p on q.before = p.name""")
def supersedes(t):
    tags = t("part").select(F.concat(F.lit("tag_v"), F.col("p_partkey").cast("string")).alias("node_id"))
    return R.link(tags, tags, T.previous_version(F.col("node_id")), F.col("node_id"), "supersedes")


@query("""with c as (select event_type, user_id, count(*) n from events group by all), r as (select *, row_number() over (partition by event_type order by n desc, user_id) k, sum(n) over (partition by event_type) total from c)
select event_type, user_id, n doc_count, cast(total - sum(n) over (partition by event_type) as bigint) sum_other_doc_count from r where k <= 5""")
def terms_topn_other(t):
    return R.terms(t("events"), ["user_id"], 5, ["event_type"])


@query("""select event_type, count(*) n, round(sum(value), 2) total, round(avg(value), 4) mean, min(value) low, max(value) high, count(distinct user_id) users from events group by event_type""")
def metric_aggs(t):
    v = F.col("value")
    return t("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(v), 2).alias("total"), F.round(F.avg(v), 4).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"), F.count_distinct("user_id").alias("users")
    )


@query("""with s as (select user_id, case when value > 50 then 'OK' when value > 20 then 'WARNING' else 'CRITICAL' end st from events), a as (select user_id, count(*) total_tests, count(*) filter (st = 'OK') ok_count,
count(*) filter (st = 'WARNING') warning_count, count(*) filter (st = 'CRITICAL') critical_count from s group by user_id)
select *, round(ok_count * 100.0 / total_tests, 2)::double availability_pct, case when ok_count * 100.0 / total_tests >= 90 then 'OK' when ok_count * 100.0 / total_tests >= 70 then 'WARNING' else 'CRITICAL' end status from a""")
def availability(t):
    status = F.when(F.col("value") > 50, "OK").when(F.col("value") > 20, "WARNING").otherwise("CRITICAL")
    return R.availability(t("events").withColumn("st", status), "user_id", "st", "OK", "WARNING", "CRITICAL")


@query("""select l_suppkey, l_partkey, round(sum(l_quantity), 2) l_quantity, round(sum(l_extendedprice), 2) l_extendedprice, round(coalesce(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 0), 9) l_discount from lineitem group by all""")
def weighted_merge(t):
    rows = R.merge_weighted(t("lineitem"), ["l_suppkey", "l_partkey"], "l_quantity", "l_discount", "l_extendedprice")
    return rows.select("l_suppkey", "l_partkey", F.round("l_quantity", 2).alias("l_quantity"), F.round("l_extendedprice", 2).alias("l_extendedprice"), F.round("l_discount", 9).alias("l_discount"))


@query("select o_orderkey, o_custkey from orders where (o_custkey > 20 or (o_custkey = 20 and o_orderkey > 500)) order by o_custkey, o_orderkey limit 50")
def composite_page(t):
    return R.page_after(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], (20, 500), 50).select("o_orderkey", "o_custkey")


@query("select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1")
def top_hit(t):
    return R.first_by(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], F.col("o_totalprice") * -1, F.col("o_orderkey"))


@query("select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by event_id) = 1")
def first_wins(t):
    return R.first_by(t("events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], F.col("event_id"))


@query("select user_id, event_id, value from events qualify row_number() over (partition by user_id order by event_id desc) = 1")
def last_wins(t):
    return R.first_by(t("events").select("user_id", "event_id", "value"), ["user_id"], F.col("event_id") * -1)


@query("""select o_custkey, o_orderkey, o_orderpriority from orders qualify row_number() over (partition by o_custkey order by case substr(o_orderpriority, 1, 1) when '1' then 0 when '2' then 1 else 2 end, o_orderkey) = 1""")
def priority_dedup(t):
    first = F.substring("o_orderpriority", 1, 1)
    rank = F.when(first == "1", 0).when(first == "2", 1).otherwise(2)
    return R.first_by(t("orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], rank, F.col("o_orderkey"))


@query("""select l_orderkey, substring(min(lpad(l_linenumber::varchar, 3, '0') || l_shipmode), 4) first_flag, array_to_string(list_sort(list(distinct l_flag)), ',') flags from (select l_orderkey, l_linenumber, l_returnflag || l_linestatus l_shipmode, l_returnflag l_flag from lineitem) group by l_orderkey""")
def downtime_union(t):
    rows = t("lineitem").withColumn("mode", F.concat("l_returnflag", "l_linestatus"))
    # Several rows of an order may share a line number's mode; the first row is the least (number, mode).
    merged = R.union_sets(rows, "l_orderkey", {"mode": "first_flag"}, ["l_returnflag"], F.struct("l_linenumber", "mode"))
    return merged.select("l_orderkey", "first_flag", F.array_join("l_returnflag", ",").alias("flags"))


_TREE = "select 'n' || p_partkey node, case when p_partkey > 3 then 'n' || (p_partkey // 3) end parent from part"


@query(f"with recursive t as ({_TREE}), b(node, depth) as (select 'n2', 0 union all select t.node, depth + 1 from b join t on t.parent = b.node where depth < 50) select node node_id, depth from b")
def reachability(t):
    key = F.col("p_partkey")
    edges = t("part").where("p_partkey > 3").select(F.concat(F.lit("n"), F.floor(key / 3).cast("string")).alias("src"), F.concat(F.lit("n"), key.cast("string")).alias("dst"))
    seeds = edges.sparkSession.createDataFrame([("n2",)], "node_id string")
    return G.reachable(edges, seeds)


@query(f"with recursive t as ({_TREE}), b(node, depth) as (select 'n2', 0 union all select t.node, depth + 1 from b join t on t.parent = b.node where depth < 2) select node node_id, depth from b")
def bounded_walk(t):
    key = F.col("p_partkey")
    edges = t("part").where("p_partkey > 3").select(F.concat(F.lit("n"), F.floor(key / 3).cast("string")).alias("src"), F.concat(F.lit("n"), key.cast("string")).alias("dst"))
    return G.reachable(edges, edges.sparkSession.createDataFrame([("n2",)], "node_id string"), max_depth=2)


@query(f"with recursive t as ({_TREE}), b(node, depth) as (select 'n3', 0 union all select t.node, depth + 1 from b join t on t.parent = b.node where depth < 50) select node, min(depth) depth from b group by node")
def parent_closure(t):
    key = F.col("p_partkey")
    parents = t("part").select(F.concat(F.lit("n"), key.cast("string")).alias("node"), F.when(key > 3, F.concat(F.lit("n"), F.floor(key / 3).cast("string"))).alias("parent"))
    return G.ancestors_kept(parents, parents.sparkSession.createDataFrame([("n3",)], "node string"))


@query("""select distinct c_custkey start, l_partkey "end" from customer join orders on c_custkey = o_custkey join lineitem on o_orderkey = l_orderkey where c_nationkey = 3""")
def typed_expand(t):
    placed = t("orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"), F.lit("placed").alias("edge_type"))
    held = t("lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.lit("holds").alias("edge_type"))
    nodes = t("customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("node_id"))
    return G.expand(placed.unionByName(held), nodes, [("placed", "out"), ("holds", "out")])


_UNESC = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"
_BARE = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g')"


@query(rf"select page_id, sha256(trim(regexp_replace({_UNESC.format(_BARE)}, '\s+', ' ', 'g'))) digest from pages")
def html_text(t):
    return t("pages").select("page_id", F.sha2(T.html_text(F.col("html")), 256).alias("digest"))


@query(rf"select page_id, trim(regexp_replace({_UNESC.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\s+', ' ', 'g')) title from pages")
def html_title(t):
    return t("pages").select("page_id", T.html_title(F.col("html")).alias("title"))


@query("select event_type, k field, count(*) n from (select event_type, unnest(json_keys(props)) k from events) group by all")
def json_path(t):
    keys = F.explode(F.json_object_keys("props")).alias("field")
    return t("events").select("event_type", keys).groupBy("event_type", "field").agg(F.count(F.lit(1)).alias("n"))


_WRITTEN_SQL = r"select doc_id, sha256(replace(regexp_replace(regexp_replace(text, '(^|[^a-zA-Z0-9._%+-])git@', '\1git' || chr(1), 'g'), '(?i)\b[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}\b', '', 'g'), chr(1), '@')) digest from documents"


@query(_WRITTEN_SQL)
def email_redact(t):
    """The plain written form, as an expression of the engine; ``redact_documents`` knows every form."""
    return t("documents").select("doc_id", F.sha2(T.redact_emails(F.col("text")), 256).alias("digest"))


@query(_WRITTEN_SQL)
def email_redact_all(t):
    """As ``email_redact``, which read part of the documents before."""
    return t("documents").select("doc_id", F.sha2(T.redact_emails(F.col("text")), 256).alias("digest"))


@query()
def anonymise(t):
    """Names are a bounded list that the caller gives: here those of the nations."""
    names = [r.n_name for r in t("nation").select("n_name").limit(100).collect()]
    return t("documents").select("doc_id", F.sha2(D.anonymise(F.col("text"), names), 256).alias("digest"))


@query("select n_nationkey, slug from (select n_nationkey, trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g'), '_') slug from nation)")
def slugs(t):
    return t("nation").select("n_nationkey", T.slug(F.col("n_name")).alias("slug"))


@query("""with a as (select distinct c_nationkey k from customer), b as (select distinct s_nationkey k from supplier)
select 'both' kind, k from (select k from a intersect select k from b) union all select 'customer only', k from (select k from a except select k from b) union all select 'any', k from (select k from a union select k from b)""")
def set_ops(t):
    a, b = t("customer").select(F.col("c_nationkey").alias("k")), t("supplier").select(F.col("s_nationkey").alias("k"))
    named = lambda kind, df: df.select(F.lit(kind).alias("kind"), "k")
    return named("both", a.intersect(b)).unionByName(named("customer only", a.subtract(b))).unionByName(named("any", a.union(b).distinct()))


@query("""select o_orderkey from orders where o_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'F')""")
def scope_retraction(t):
    orders = t("orders")
    return runs.retracted(orders, orders.where("o_orderstatus <> 'F'"), "o_orderkey", True)


@query("""select o_orderkey, o_totalprice from orders where o_orderkey % 3 = 0 and o_totalprice <> 0""")
def progress_changed(t):
    orders = t("orders").select("o_orderkey", "o_totalprice")
    doubled = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
    return runs.changed(doubled, orders, "o_orderkey", ["o_totalprice"]).select("o_orderkey", "o_totalprice")


@query("select count(*) filter (value >= 0) record_count, count(*) filter (value < 0) skipped_count, 'reconcile' as mode, case when count(*) filter (value < 0) > 0 then 'partial' else 'ok' end status, count(*) filter (value < 0) = 0 completed_scope from events")
def run_health(t):
    return runs.health(t("events"), F.col("value") < 0, "reconcile")


_BM25_SQL = """w as (select doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') ws from documents), s as (select count(*) n, avg(len(ws)) a from w),
c as (select doc_id, len(ws) l, q, len(list_filter(ws, lambda x: x = q)) tf from w, (select unnest(['ention', 'there', 'heoron']) q)), d as (select q, count(*) df from c where tf > 0 group by q),
lexical as (select doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / a))) score from c join d using (q), s where tf > 0 group by doc_id)"""


@query(f"with {_BM25_SQL} select doc_id, round(score, 6) score from lexical order by round(score, 6) desc, doc_id limit 20")
def bm25_topk(t):
    return S.bm25(t("documents"), "doc_id", "text", "ention there heoron", 20).select("doc_id", F.round("score", 6).alias("score"))


def _first_vector(t) -> list[float]:
    return t("embeddings").orderBy("vec_id").select("embedding").first()[0]


@query("""with q as (select embedding e from embeddings order by vec_id limit 1) select vec_id, round(list_cosine_similarity(embedding::double[], e::double[]), 6) score from embeddings, q order by list_cosine_similarity(embedding::double[], e::double[]) desc, vec_id limit 20""")
def vector_topk(t):
    return S.vector_top(t("embeddings"), "vec_id", "embedding", _first_vector(t), 20).select("vec_id", F.round("score", 6).alias("score"))


@query(f"""with {_BM25_SQL}, l as (select * from lexical order by score desc, doc_id limit 50), q as (select embedding e from embeddings order by vec_id limit 1),
v as (select vec_id doc_id, list_cosine_similarity(embedding::double[], e::double[]) score from embeddings, q order by 2 desc, 1 limit 50),
b as (select doc_id, score / (select max(score) from l) * 0.6 score from l union all select doc_id, score / (select max(score) from v) * 0.4 from v)
select doc_id, round(sum(score), 6) score from b group by doc_id order by sum(score) desc, doc_id limit 5""")
def hybrid_topk(t):
    lexical = S.bm25(t("documents"), "doc_id", "text", "ention there heoron", 50)
    semantic = S.vector_top(t("embeddings"), "vec_id", "embedding", _first_vector(t), 50).withColumnRenamed("vec_id", "doc_id")
    return S.hybrid_top(lexical, semantic, "doc_id", 5).select("doc_id", F.round("score", 6).alias("score"))


@query("select doc_id from documents where contains(lower(text), 'there') and not contains(lower(text), 'heoron')")
def grep_search(t):
    return S.grep(t("documents"), "text", "there -heoron").select("doc_id")


@query("select event_id from events where (event_type = 'click' or event_type = 'view') and not user_id = 3 and event_type like 'c%'")
def lucene_filter(t):
    condition = S.query_string("type:(click OR view) AND NOT user:3 AND type:c*", {"type": "event_type", "user": "user_id"}, ["props"])
    return t("events").where(condition).select("event_id")


@query("select event_id, user_id from events order by ts desc, event_id limit 10 offset 20")
def search_page(t):
    return t("events").orderBy(F.desc("ts"), "event_id").offset(20).limit(10).select("event_id", "user_id")


@query("select conv_id, turn, lag(role) over w previous_role, lead(role) over w next_role, row_number() over w - 1 idx, count(*) over (partition by conv_id) total from conversations window w as (partition by conv_id order by turn)")
def conversation_order(t):
    over = Window.partitionBy("conv_id").orderBy("turn")
    return t("conversations").select(
        "conv_id", "turn", F.lag("role").over(over).alias("previous_role"), F.lead("role").over(over).alias("next_role"), (F.row_number().over(over) - 1).alias("idx"), F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("total")
    )


@query("select p_brand alias, min(p_mfgr) node_id from (select p_brand, p_type p_mfgr from part) group by p_brand having count(distinct p_mfgr) = 1")
def unique_alias(t):
    return R.unique_only(t("part").select(F.col("p_brand").alias("alias"), F.col("p_type").alias("node_id")), "alias", "node_id")


@query("""select o.o_orderkey src, c.c_custkey dst, 'placed_by' edge_type from orders o join customer c on o.o_custkey = c.c_custkey where o.o_orderkey <> c.c_custkey""")
def declared_link(t):
    return R.link(t("orders"), t("customer"), F.col("o_custkey").cast("string"), F.col("c_custkey").cast("string"), "placed_by", "o_orderkey", "c_custkey")


@query("select l_orderkey, l_linenumber from lineitem where not (l_returnflag in ('A', 'R') and l_linestatus = 'F')")
def narrowing_rejects(t):
    edges = t("lineitem").select("l_orderkey", "l_linenumber", F.lit("returns").alias("edge_type"), F.col("l_returnflag").alias("src_subtype"), F.col("l_linestatus").alias("dst_subtype"))
    narrowings = edges.sparkSession.createDataFrame([("returns", "A", "F"), ("returns", "R", "F")], "edge_type string, src_subtype string, dst_subtype string")
    return R.allowed_edges(edges, narrowings, accept=False).select("l_orderkey", "l_linenumber")


@query("select r_name, n from (select 'ASIA' r_name union all select 'ATLANTIS') left join (select r_name, count(*) n from region group by r_name) using (r_name) where n is null")
def required_missing(t):
    return R.missing_required(t("region"), "r_name", ["ASIA", "ATLANTIS"]).where("violated").select("r_name", F.nullif("n", F.lit(0)).alias("n"))


@query("select user_id, k kind, sum(v)::bigint total from (select user_id, event_type k, 1 v from events) group by all")
def map_sum(t):
    maps = t("events").select("user_id", F.create_map("event_type", F.lit(1).cast("long")).alias("counts"))
    return R.merge_maps(maps, ["user_id"], "counts").select("user_id", F.explode("counts").alias("kind", "total"))


@query("select o_custkey, arg_max(o_totalprice, strftime(o_orderdate, '%Y-%m-%d') || lpad(o_orderkey::varchar, 12, '0')) latest from orders group by o_custkey")
def pledge_latest(t):
    day = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    nested = t("orders").groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct(day.alias("k"), F.create_map(F.lit("all"), F.col("o_totalprice")).alias("v")))).alias("periods"))
    return nested.select("o_custkey", R.latest_nested(F.col("periods")).alias("latest"))


@query("select time_bucket(interval 1 hour, ts) window_start, event_type, count(*) n, round(sum(value), 2) total from events group by all")
def event_windows(t):
    return runs.event_windows(t("events"), "1 hour").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))
