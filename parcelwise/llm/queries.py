"""Registered queries of the training-data operators, and the SQL that the SQL-expressible ones are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import (
    bpe_fold,
    chat,
    collocations,
    jaccard,
    kneser_ney,
    merkle,
    packing,
    pages,
    pseudonyms,
    rans,
    rules,
    urls,
    winnowing,
)
from parcelwise.llm.scratch import Scratch
from parcelwise.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function of (spark, folder) under its name."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: A conversation whose texts hold control strings of another template.
EXTRA_CONVERSATION = -7
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\-{c[1:]}')"
    return out


@query(f"""
with turns as (
    select conv_id, turn, role, coalesce(text, '') as text from conversations
    union all
    select {EXTRA_CONVERSATION}, 0, 'user', '{EXTRA_TEXT}'
    union all
    select {EXTRA_CONVERSATION}, 1, 'assistant', '{EXTRA_TEXT}'
)
select conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
    cast(sum({len(chat.TURN) + 1 + len(chat.END)} + length({_escaped("role")}) + length({_escaped("text")})) as bigint) as formatted_chars
from turns
group by conv_id
""")
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as an event log, folded, rendered and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(EXTRA_CONVERSATION, 0, "user", EXTRA_TEXT), (EXTRA_CONVERSATION, 1, "assistant", EXTRA_TEXT)],
        "conv_id long, turn long, role string, text string",
    ).select(*[F.col(f.name).cast(f.dataType) for f in turns.schema])
    return chat.read_back(chat.format_log(chat.rows_as_events(turns.unionByName(extra))))


@query(r"""
with item_words as (
    select cast(item_id as varchar) as item,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), windows as (
    select distinct item, least(10, len(w)) as size, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') as t
    from item_words, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as u(s)
    where len(w) > 0
), doc_words as (
    select doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from documents
), doc_windows as (
    select doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') as t
    from doc_words, (select distinct size from windows), unnest(generate_series(1, len(w) - size + 1)) as u(s)
), hits as (
    select doc_id, s, size, item from doc_windows join windows using (size, t)
), hit_words as (
    select doc_id, count(distinct p) as n_hit from hits, unnest(generate_series(s, s + size - 1)) as u(p) group by doc_id
), hit_items as (
    select doc_id, count(distinct item) as n_items, sha256(array_to_string(list_sort(list(distinct item)), ',')) as items_sha256
    from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)
""")
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against all benchmark items."""
    found = winnowing.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in packed sequences of at most 2,048 tokens, by piece."""
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query()
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's perplexity under a model of the trusted ones, and the verdict."""
    return kneser_ney.verdicts(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("tie")


@query()
def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's main text."""
    found = pages.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op6_token_binary(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids written as rANS blocks and read back."""
    path, tokenizer = scratch_dir(spark, "token-binary"), tokenizer_file("byte_bpe_50k.json")
    rans.write(table(spark, folder, "documents"), path, tokenizer)
    return rans.read(spark, path, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


#: Stands for a secret that a deployment reads from its key store.
PSEUDONYM_KEY = b"key of the registered query"


@query()
def op7_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with private values replaced."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


@query(r"""
with words as (
    select doc_id, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents
), windows as (
    select doc_id, s, array_to_string(w[s : s + 4], ' ') as t from words, unnest(generate_series(1, len(w) - 4)) as u(s)
), repeated as (
    select doc_id, s, count(*) over (partition by doc_id, t) as n from windows
), covered as (
    select doc_id, count(distinct p) as n_repeat_words
    from repeated, unnest(generate_series(s, s + 4)) as u(p) where n > 1 group by doc_id
), lines as (
    select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
    from documents, unnest(string_split(text, chr(10))) as u(line)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), counts as (
    select doc_id, cast(len(w) as bigint) as n_words,
        cast(length(array_to_string(w, '')) as bigint) as word_chars,
        cast(coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0) as bigint) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
        coalesce(length(regexp_replace(text, '[^A-Z]', '', 'g')), 0) as upper,
        coalesce(length(regexp_replace(text, '[^a-z]', '', 'g')), 0) as lower,
        coalesce(length(regexp_replace(text, '[^!]', '', 'g')), 0) as bangs
    from words left join covered using (doc_id) left join lines using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or upper > lower or 2 * bangs > n_words
        or word_chars < 2 * n_words or word_chars > 15 * n_words or 10 * n_symbols > n_words
        or 10 * n_dup_lines > 3 * n_lines) as kept
from counts
""")
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document through the cascade."""
    return rules.judge(table(spark, folder, "documents"))


@query(r"""
with recursive words as (
    select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as w
    from documents
), shingles as (
    select distinct doc_id, array_to_string(w[s : s + least(5, len(w)) - 1], ' ') as t
    from words, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) as u(s) where len(w) > 0
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), pairs as (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from shingles a join shingles b on a.t = b.t and a.doc_id <> b.doc_id group by all
), links as (
    select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * common >= 75 * (a.n + b.n - common)
), reached as (
    select doc_id, doc_id as other from documents
    union
    select doc_id, y from reached join links on other = x
)
select doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
from reached left join sizes using (doc_id) group by doc_id
""")
def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its component."""
    return jaccard.join(table(spark, folder, "documents")).drop("class_id")


#: (host, path, verdict)
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query(f"""
with parts as (
    select page_id, url,
        case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages
), split as (
    select page_id,
        translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
    from parts
), rules(r_host, r_path, r_verdict) as (values {", ".join(map(str, URL_RULES))})
select page_id, any_value(host) as host, any_value(path) as path,
    arg_max(r_host || r_path, length(r_host || r_path)) as rule,
    coalesce(arg_max(r_verdict, length(r_host || r_path)), 'allow') as verdict
from split left join rules
    on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
group by page_id
""")
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL against the rules."""
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


def _field(name: str) -> str:
    return f"coalesce(octet_length(encode(cast({name} as varchar)))::varchar || ':' || cast({name} as varchar), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The reflected CRC-32 of the decimal digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295::bigint], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], range(8)),
        lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)))"""


@query(f"""
with recursive leaves as (
    select doc_id, coalesce(source, '') as s, source is not null as named, {_leaf("text")} as leaf,
        case when {_CRC} % 5 = 0
            then {_leaf(_LOWERED)} else {_leaf("text")} end as current
    from documents
), ranked as (
    select *, row_number() over (partition by named, s order by doc_id nulls first, leaf) - 1 as pos,
        dense_rank() over (order by named, s) - 1 as tree
    from leaves
), up as (
    select tree, 0 as level, pos, leaf as d, count(*) over (partition by tree) as n from ranked
    union all
    select tree, level + 1, pos // 16, sha256(string_agg(d, '' order by pos)), (n + 15) // 16
    from up where n > 1 group by tree, level, pos // 16, n
), subroots as (
    select tree, d as subroot from up where n = 1
), top as (
    select 0 as level, tree as pos, subroot as d, count(*) over () as n from subroots
    union all
    select level + 1, pos // 16, sha256(string_agg(d, '' order by pos)), (n + 15) // 16
    from top where n > 1 group by level, pos // 16, n
), runs as (
    select tree, level, pos // 16 as run, list(d order by pos) as ds from up where n > 1 group by all
    union all
    select -1, level, pos // 16, list(d order by pos) from top where n > 1 group by all
), heights as (
    select tree, max(level) as height from up group by tree
), climb as (
    select doc_id, leaf, tree as home, tree, 0 as level, pos, current as d, '' as proof, height
    from ranked join heights using (tree)
    union all
    select doc_id, leaf, home,
        case when c.level + 1 >= height and c.tree >= 0 then -1 else c.tree end,
        case when c.level + 1 >= height and c.tree >= 0 then 0 else c.level + 1 end,
        case when c.level + 1 >= height and c.tree >= 0 then home else c.pos // 16 end,
        case when height = 0 then c.d
            else sha256(array_to_string(list_concat(ds[1 : c.pos % 16], [c.d], ds[c.pos % 16 + 2 :]), '')) end,
        case when height = 0 then proof
            else proof || array_to_string(list_concat(ds[1 : c.pos % 16], ds[c.pos % 16 + 2 :]), '') end,
        case when c.level + 1 >= height and c.tree >= 0 then (select max(level) from top) else height end
    from climb c left join runs r on r.tree = c.tree and r.level = c.level and r.run = c.pos // 16
    where not (c.tree = -1 and c.level = c.height)
)
select doc_id, leaf, subroot, (select d from top where n = 1) as root, sha256(proof) as proof_sha256, climb.d as folded_root,
    climb.d = (select d from top where n = 1) as verified
from climb join subroots on subroots.tree = home where climb.tree = -1 and level = height
""")
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, roots and proof; some texts are tampered with after the manifest was made."""
    docs = table(spark, folder, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    with Scratch(spark) as scratch:
        found = merkle.manifest(docs, F.when(tampered, lowered).otherwise(F.col("text")), scratch)
        out = found.select(
            "doc_id",
            "leaf",
            "subroot",
            "root",
            F.sha2(merkle.proof_text(F.col("steps")), 256).alias("proof_sha256"),
            merkle.folded(F.col("current"), F.col("steps")).alias("folded_root"),
        )
        return scratch.result(out.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest")


@query(r"""
with recursive pieces as (
    select coalesce(lang, 'und') as lang, row_number() over () as doc, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) as piece
    from documents
), words as (
    select lang, regexp_extract_all(piece, '[^ 	]+') as w from pieces
), totals as (
    select lang, sum(len(w)) as n from words group by lang
), phrases as (
    select lang, size, array_to_string(w[s : s + size - 1], ' ') as phrase, count(*) as f
    from words, unnest([1, 2, 3, 4]) as z(size), unnest(generate_series(1, len(w) - size + 1)) as u(s)
    group by all having count(*) >= 30
), candidates as (
    select lang, size, phrase, f as a, string_split(phrase, ' ') as w from phrases where size > 1
), cuts as (
    select c.lang, c.size, c.phrase, a, k, x.f as l, y.f as r, (2000000::hugeint * a) // (x.f + y.f) as score
    from (select *, unnest(generate_series(1, size - 1)) as k from candidates) c
    join phrases x on x.lang = c.lang and x.phrase = array_to_string(w[1 : k], ' ')
    join phrases y on y.lang = c.lang and y.phrase = array_to_string(w[k + 1 :], ' ')
), scored as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_phrases as (
    select lang, array_to_string(w[s : s + z - 1], ' ') as phrase, a as longer
    from candidates, unnest([2, 3]) as t(z), unnest(generate_series(1, size - z + 1)) as u(s) where z < size
), covered as (
    select lang, phrase, max(longer) as longer from inner_phrases group by all
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
    cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from scored join totals using (lang) left join covered using (lang, phrase)
where longer is null or 100::hugeint * longer < 80::hugeint * a
qualify rank <= 2000
""")
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 phrases of each language."""
    with Scratch(spark) as scratch:
        found = collocations.mine(table(spark, folder, "documents"), scratch)
        return scratch.result(collocations.first(found, 2000), "collocations")


@query()
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids by the multilingual ranks, and the texts decoded from them."""
    import public_tokenizers

    path = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    ids = bpe_fold.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe_fold.decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )
