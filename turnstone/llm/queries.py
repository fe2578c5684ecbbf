"""The numbered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.llm import (
    bpe, chat, decontaminate, hard_negatives, html_text, language_model, periodic_runs, quality, simhash, sorted_projections, toxicity, url_filter, warc,
)
from turnstone.llm.common import read, text_crc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)``."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex64("fp").alias("fingerprint"), "component_id")


def byte_bpe() -> tuple[dict[bytes, int], str]:
    """The public 50k byte-level vocabulary and its pattern."""
    import public_tokenizers

    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def token_digests(tokens: DataFrame) -> DataFrame:
    """Columns of ``tokens`` (``ids``, ``decoded``) and their counts and digests."""
    return tokens.select(
        "*",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_byte_bpe")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = byte_bpe()
    tokens = bpe.encode(read(spark, folder, "documents"), ranks, pattern)
    return token_digests(bpe.decode(tokens, ranks)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op6_quality_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(documents, read(spark, folder, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judge(documents, model).select("doc_id", *counts, "base_failed", "kept", "probability")


@query("op2_benchmark_decontamination")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    held_out = text_crc("doc_id", toxicity.FOLDS) == 0
    model = toxicity.train(documents, read(spark, folder, "labels"), keep=~held_out)
    return toxicity.score(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def warc_sql() -> str:
    """The digest in base 32 from twenty bits (five hex digits) at a time."""
    chunk = "('0x' || sha1(payload)[{lo}:{hi}])::int"
    letters = " || ".join(
        f"'{warc.BASE32}'[(({chunk.format(lo=at + 1, hi=at + 5)} >> {shift}) & 31) + 1]" for at in range(0, 40, 5) for shift in (15, 10, 5, 0))
    return f"""
with p as (select page_id, coalesce(html, '') as payload from pages),
d as (select page_id, strlen(payload)::bigint as payload_bytes, {letters} as payload_digest, max(page_id) over (partition by payload) as latest from p)
select page_id, payload_bytes, payload_digest, case when page_id = latest then 'response' else 'revisit' end as record_type,
  case when page_id <> latest then latest end as refers_to from d"""


@query("op5_warc", warc_sql())
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read(spark, folder, "pages"))


#: Fixed rules of the url query.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
#: Hosts of the corpus with one of these words in a label are on the block list.
SPAM_WORDS = ["adult", "ads", "bets", "casino", "pills", "spam"]
SPAM_LABEL = f"(^|[.-])({'|'.join(SPAM_WORDS)})([.-]|$)"

URL_SQL = f"""
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r(rule, rhost, rpath, verdict) as (values ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
f as (select h.*, rule, verdict, row_number() over (partition by page_id order by length(rule) desc) as k
  from h left join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, rule, coalesce(verdict, case when regexp_matches(host, '{SPAM_LABEL}') then 'block' else 'allow' end) as verdict
from f where k = 1"""


@query("op1_url_filter", URL_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).distinct()
    blocked = hosts.where(F.col("host").rlike(SPAM_LABEL))
    return url_filter.judge(pages, URL_RULES, blocked).select("page_id", "host", "path", "rule", "verdict")


@query("op9_html_extraction")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    text = html_text.main_text(pages, html_text.learn(pages)).drop("html")
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def chat_sql() -> str:
    """Lengths count each escaped character: backslashes and control strings grow by one."""
    marks = " + ".join(f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) / {len(c)}" for c in [*chat.CONTROL, "\\"])
    size = "length({0}) + " + marks
    fixed = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
    return f"""
with t as (select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum({fixed} + {size.format('role')} + {size.format('text')})::bigint as formatted_chars
from t group by conv_id"""


@query("op10_chat_formatting", chat_sql())
def op10(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("int").alias("turn"), "role", "text")
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    trees, members = chat.format_conversations(turns.unionByName(probe))
    found = chat.read_back(trees).drop("formatted")
    return members.join(found, "leaf").drop("leaf")


@query("op3_lm_scoring")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    held_out = text_crc("doc_id", language_model.HELD_OUT_FOLDS) == language_model.HELD_OUT
    found = language_model.score(documents, ~held_out)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


NEGATIVES_SQL = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, id, score, row_number() over (partition by anchor_id order by score desc, id) as k from s where same),
n as (select p.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score, s.score as negative_score,
    (row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id))::int as rank
  from p join s using (anchor_id) where p.k <= 5 and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select * from n where rank <= 5"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = lambda x: F.when(F.abs(x.cast("double")) < float("inf"), F.floor(256 * x.cast("double")).cast("double"))
    rows = read(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), label.alias("label"), F.transform("embedding", whole).alias("vector"), (F.col("vec_id") % 100 == 0).alias("is_anchor"))
    return hard_negatives.mine(rows)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: of the ids whose hash ends in 0 the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = documents.select("doc_id", "text", F.floor(h / 10).alias("g"), (h % 10 == 0).alias("planted"))
    rows = rows.withColumn("words", F.when(F.col("planted"), F.expr("filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')")))
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    longer = F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(period, times)))
    planted = F.concat_ws(" ", F.slice(longer, F.lit(1), F.col("n")))
    return rows.select("doc_id", F.when(F.col("planted") & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(read(spark, folder, "documents")))
    return run_digests(found)


def run_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of ``runs`` and ``collapsed``; the longest run by length, start, period."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.withColumn("longest", longest)
    start, length, period = F.col("longest.start"), -F.col("longest.less"), F.col("longest.period")
    text = F.when(F.size("runs") > 0, F.concat(F.concat_ws("\n", lines), F.lit("\n"))).otherwise("")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


COPIES_SQL = """
with recursive v as (select row_number() over () as k, vec_id, embedding::double[] as e from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.k as a, b.k as b, b.vec_id from v a join v b on a.k <> b.k and list_cosine_similarity(a.e, b.e) >= 0.9),
reach(k, node) as (select k, k from v union select reach.k, l.b from reach join l on reach.node = l.a),
c as (select reach.k, min(v.vec_id) as component_id from reach join v on v.k = reach.node group by reach.k),
n as (select v.vec_id, (select count(*) from l where l.a = v.k) as n_links, component_id from v join c using (k))
select vec_id, n_links::bigint as n_links, component_id, vec_id = component_id as kept from n
union all select vec_id, 0, vec_id, true from embeddings
where embedding is null or len(list_filter(embedding, lambda x: x is null or not isfinite(x))) > 0 or len(list_filter(embedding, lambda x: x <> 0)) = 0"""


@query("op13_embedding_near_dedup", COPIES_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = sorted_projections.near_duplicates(rows)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
