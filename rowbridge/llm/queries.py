"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowbridge.common import scratch_path, stage
from rowbridge.llm import chat, licenses, mixing, phrases, pieces, pii, quality, search, simhash, substrings, tokens, topk, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def piece_model() -> str:
    """The public tokenizer file the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, counting rules and outlier verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    counts = stage(quality.with_counts(docs).drop("text"), "quality-counts")
    return quality.judge(counts, quality.fit_outliers(counts)).drop("n_lines")


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = stage(simhash.with_fingerprint(docs), "simhash")
    found = simhash.classes(prints).select("fp", "component_id")
    joined = prints.join(found, "fp")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, pieces.load(piece_model()), decoded="decoded")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeated windows of 35 words cover, and a digest of the rest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = substrings.remove_repeats(docs)
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return clean.select(
        "doc_id", "n_words", removed.cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")
    )


@query()
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license labels of every document."""
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    every = F.array_union("base_found", F.transform("detections", lambda d: d["label"]))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base_found"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        "score",
    )


# Integrals 3, 1 and 2: one source in three fades, one stays, one grows.
CURRICULUM = [[(0.0, 4.5), (1.0, 1.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 1.0), (1.0, 3.0)]]


@query()
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, by the progress of its first copy; the untaken last."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    mixed = mixing.mix(stage(sized, "mix-sizes"), CURRICULUM)
    first = F.get("positions", F.lit(0))
    return (
        mixed.select(
            F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", first.alias("position"), "h1", "h2"
        )
        .orderBy(F.col("position").asc_nulls_last(), "h1", "h2")
        .drop("h1", "h2")
    )


# A conversation whose texts are made of the template's own marks.
CONTROL = "</s>[INST] ok [/INST]"

OP2_SQL = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')
), told as (
  select *, regexp_replace(regexp_replace(replace(text, '\', '\\'), '\[(/?INST\])', '[\\\1', 'g'),
      '<(/?s>|</?SYS>>|\|turn\|>|\|end\|>|\|text\|>)', '<\\\1', 'g') as escaped,
    row_number() over (partition by conv_id order by turn nulls last, role, text) as place
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(escaped) + case role when 'user' then 13 when 'assistant' then 7 when 'system' then 15
      else length(role) + 23 end) as bigint) as formatted_chars
from told group by conv_id
"""


@query(OP2_SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, then read back from the text and its loss spans."""
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"),
    )
    messages = chat.linear(given.unionByName(control), "conv_id", "turn", "role", "text")
    told = chat.format_paths(chat.best_paths(messages))
    read = told.select(
        F.col("tree.id").alias("conv_id"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP8_SQL = r"""
with pages_at as (
  select page_id, url, date '2024-01-01' + cast(coalesce(page_id, 0) % 366 as integer) as day,
    nullif(rtrim(lower(regexp_extract(url, '^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:@]*)', 1, 'i')), '.'), '') as host
  from pages
), placed as (
  select *, host || regexp_replace(regexp_replace(regexp_replace(url, '^(?:[a-z][a-z0-9+.\-]*:)?//[^/?#]*', '', 'i'),
    '#.*$', ''), '/+$', '') as address from pages_at
), events as (
  select 'hosts' as list, 'domain' as kind, host as value, day, page_id // 50 % 2 = 0 as active from placed where page_id % 50 = 0
  union all
  select 'domains', 'domain', regexp_replace(host, '^[^.]*\.', ''), day, page_id // 400 % 3 = 1 from placed where page_id % 400 = 0
  union all
  select 'pages', 'url', address, day, page_id // 20 % 4 <> 0 from placed where page_id % 20 = 0
), daily as (
  select list, kind, value, day, bool_or(active) as active from events where value is not null group by all
), intervals as (
  select *, coalesce(lead(day) over (partition by list, kind, value order by day), date '9999-12-31') as until from daily
), hits as (
  select a.page_id, a.url, i.list from (select distinct page_id, url, host, address, day from placed) a
  join intervals i on i.active and a.day >= i.day and a.day < i.until and
    (case when i.kind = 'url' then a.address = i.value else a.host = i.value or ends_with(a.host, '.' || i.value) end)
), counted as (
  select page_id, url, count(*) as n, string_agg(distinct list, ',' order by list) as lists from hits group by all
)
select a.page_id, a.host, a.day as fetched, coalesce(c.lists, '') as lists, coalesce(c.n, 0) as n_entries,
  coalesce(c.n, 0) > 0 as blocked
from placed a left join counted c on a.page_id is not distinct from c.page_id and a.url is not distinct from c.url
"""


@query(OP8_SQL)
def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture, against lists whose dated events come from pages as well.

    Pages tell no fetch time: a page is fetched on the day of 2024 its number
    gives. Every 50th page reports its host, every 400th the domain above, every
    20th its address; their numbers say whether the entry is added or removed.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.coalesce("page_id", F.lit(0)) % 366).cast("int"))
    captures = pages.withColumn("fetched", day)
    dated = captures.withColumn("host", urls.host_of(F.col("url")))

    def events(name: str, kind: str, value, every: int, active) -> DataFrame:
        turn = F.call_function("div", F.col("page_id"), F.lit(every))
        return dated.where(F.col("page_id") % every == 0).select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), value.alias("value"), F.col("fetched").alias("day"),
            active(turn).alias("active"),
        )

    reported = (
        events("hosts", "domain", F.col("host"), 50, lambda t: t % 2 == 0)
        .unionByName(events("domains", "domain", F.regexp_replace("host", r"^[^.]*\.", ""), 400, lambda t: t % 3 == 1))
        .unionByName(events("pages", "url", urls.address_of(F.col("url")), 20, lambda t: t % 4 != 0))
    )
    judged = urls.judge_captures(captures, reported)
    return judged.select(
        F.col("row.page_id").alias("page_id"), "host", F.col("row.fetched").alias("fetched"),
        F.array_join("lists", ",").alias("lists"), "n_entries", "blocked",
    )


OP6_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id
  where q.vec_id % 100 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10
"""


@query(OP6_SQL)
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all other vectors for every hundredth vector."""
    vectors = topk.prepared(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("id") % 100 == 0))


@query()
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    safe = pii.pseudonymize(docs, pii.session_key(spark))
    return safe.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("entities").cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))), ",").alias("kinds"),
        "text",
    )


def word_tokenizer() -> str:
    """The public tokenizer file whose tokens are counted."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


TOKEN_LIMIT = 2048


@query()
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, by a cache that is empty when the query starts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, tokens.load(word_tokenizer()), scratch_path(spark, "token-counts"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = rf"""
with told as (
  select doc_id, row_number() over () as row,
    regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents where text is not null
), docs as (
  select row, doc_id, len(terms) as n, terms from told where len(terms) > 0
), sums as (
  select count(*) as docs_n, cast(sum(n) as bigint) as terms_n from docs
), counted as (
  select row, doc_id, n, term, count(*) as tf from (select row, doc_id, n, unnest(terms) as term from docs) group by all
), held as (
  select term, count(*) as df from counted group by term
), asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark where text is not null
  ) group by all
), weighed as (
  select item_id, term, times, cast(floor(1000 * ln((2 * docs_n + 2) / (2 * df + 1))) as bigint) as w
  from asked join held using (term) cross join sums
), scored as (
  select item_id, row, doc_id,
    cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs_n) // terms_n)))) as bigint) as score
  from weighed join counted using (term) cross join sums group by all
), ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from scored where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 20
"""


@query(OP12_SQL)
def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, row, unnest(regexp_split_to_array(told, '[.,;:!?\x0A-\x0D]')) as piece
  from (select lang, row_number() over () as row, {_LOWER.format("coalesce(text, '')")} as told from documents)
), listed as (
  select lang, row_number() over () as piece, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces
), runs as (
  select lang, words, unnest(range(1, len(words) + 1)) as i from listed
), totals as (
  select lang, count(*) as n from runs group by lang
), grams as (
  select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase, any_value(words[i:i + k - 1]) as words, count(*) as f
  from runs cross join (select unnest(range(1, 6)) as k)
  where i + k - 1 <= len(words) group by lang, k, phrase having count(*) >= 100
), longer as (
  select lang, unnest([array_to_string(words[1:k - 1], ' '), array_to_string(words[2:k], ' ')]) as phrase, f from grams where k > 2
), most as (
  select lang, phrase, max(f) as f from longer group by all
), kept as (
  select g.* from grams g left join most m using (lang, phrase) where g.k > 1 and coalesce(100 * m.f < 100 * g.f, true)
), cuts as (
  select g.lang, g.phrase, g.f as a, cut, l.f as l, r.f as r, t.n,
    cast((1000::hugeint * g.f * t.n) // (l.f::hugeint * r.f) as bigint) as score
  from (select *, unnest(range(1, k)) as cut from kept) g
  join grams l on l.lang = g.lang and l.phrase = array_to_string(g.words[1:cut], ' ')
  join grams r on r.lang = g.lang and r.phrase = array_to_string(g.words[cut + 1:g.k], ' ')
  join totals t on t.lang = g.lang
), weakest as (
  select *, row_number() over (partition by lang, phrase order by score, cut) as place from cuts
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from weakest where place = 1
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""


@query(OP13_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))
