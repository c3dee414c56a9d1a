"""The operators over the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import (
    decontaminate,
    line_dedup,
    packing,
    preferences,
    prefix_trie,
    pseudonyms,
    quality,
    simhash,
    substrings,
    token_counts,
    url_trust,
    vector_codes,
    warc,
)

# Over the supplied tables only; a real key is a secret and comes from outside.
PSEUDONYM_KEY = "supplied tables"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def _url_trust_sql() -> str:
    """The same steps over the whole tables, every iteration a table expression."""
    def fits(host, path, rule):
        cut = rule.index("/")
        return (f"(({host} = '{rule[:cut]}' or ends_with({host}, '.{rule[:cut]}')) and starts_with({path}, '{rule[cut:]}'))")

    def case(host, path, value):
        ordered = sorted(url_trust.RULES, key=lambda r: -len(r[1]))
        return "case " + " ".join(f"when {fits(host, path, r)} then '{value(v, r)}'" for v, r in ordered) + " end"

    lower = f"'{url_trust.UPPER}', '{url_trust.LOWER}'"
    link = url_trust.LINK.replace("'", "''")
    steps = "".join(f"""
    , s{i} as materialized (
        select kind, host, sum(score) as score from (
            select kind, host, score from s0
            union all select kind, way.dest, {url_trust.DAMPING} * score * share from s{i - 1} join way using (kind, host)
        ) group by kind, host
    )""" for i in range(1, url_trust.ITERATIONS + 1))
    return f"""
    with known as materialized (
        select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {lower}) as host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path, html from pages
    ), judged as materialized (
        select page_id, host, path, {case("host", "path", lambda v, r: r)} as rule,
            {case("host", "path", lambda v, r: v)} as verdict from known
    ), pair as materialized (
        select src, dst, count(*) as n from (
            select host as src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) as dst
            from known where host <> '') where src <> dst group by all
    ), seed as (
        select host, 2 * count(*) filter (verdict = 'allow') > count(*) as trust,
            2 * count(*) filter (verdict = 'block') > count(*) as distrust from judged where host <> '' group by host
        union all select host, coalesce(v = 'allow', false), coalesce(v = 'block', false) from (
            select host, {case("host", "'/'", lambda v, r: v)} as v from (select distinct dst as host from pair)
            where host not in (select host from judged))
    ), shares as (
        select src, dst, n / sum(n) over (partition by src) as share from pair
    ), way as materialized (
        select 'trust' as kind, src as host, dst as dest, share from shares
        union all select 'distrust', dst, src, share from shares
    ), s0 as materialized (
        select 'trust' as kind, host, {1 - url_trust.DAMPING} as score from seed where trust
        union all select 'distrust', host, {1 - url_trust.DAMPING} from seed where distrust
    ){steps}, per_host as (
        select host, coalesce(sum(score) filter (kind = 'trust'), 0) as trust,
            coalesce(sum(score) filter (kind = 'distrust'), 0) as distrust from s{url_trust.ITERATIONS} group by host
    )
    select page_id, host, path, rule, coalesce(verdict, case when distrust >= {url_trust.SUSPECT * (1 - url_trust.DAMPING)}
        and distrust > trust then 'block' else 'allow' end) as verdict
    from judged left join per_host using (host)
    """


@query("op1_url_trust", _url_trust_sql())
def _url_trust(table):
    return url_trust.judge_urls(table("pages")).drop("trust", "distrust")


@query("op2_simhash_near_dedup")
def _simhash(table):
    return simhash.near_duplicates(table("documents"))


@query("op3_feistel_pseudonyms")
def _pseudonyms(table):
    return pseudonyms.pseudonymise(table("documents"), PSEUDONYM_KEY)


@query("op4_warc_transactions", r"""
    with hashed as (
        select page_id, octet_length(encode(coalesce(html, ''))) as n, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
    ), lettered as (
        select page_id, n, h, list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 5 * (i // 4)::int + 1, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int, 1) for i in range(32)],
            'string_agg', '') as digest, max(page_id) over (partition by html) as original from hashed
    )
    select page_id, n::bigint as payload_bytes, digest as payload_digest,
        case when page_id = original then 'response' else 'revisit' end as record_type,
        case when page_id <> original then original end as refers_to from lettered
""")
def _warc(table):
    return warc.round_trip(table("pages"))


@query("op5_latent_decontamination")
def _decontamination(table):
    return decontaminate.contaminated(table("documents"), table("benchmark"))


def _preferences_sql() -> str:
    def side(name):
        return f"""
            coalesce(string_agg(head || body, '' order by place) filter (not common and side = '{name}'), '') as {name},
            coalesce(string_agg(span, ',' order by place) filter (not common and trained and side = '{name}'), '') as {name}_mask"""

    def part(name):
        return f"coalesce(strlen({name})::varchar, '-') || ':' || coalesce({name}, '')"

    close = preferences.CLOSE.strip()
    return f"""
    with last as (
        select conv_id, max(turn) as last_turn, arg_max(text, turn) as last_text from conversations
        where role = 'assistant' group by conv_id
    ), pairs as (
        select distinct *, {{'turn': turn, 'digest': md5({part("role")} || {part("text")})}} as place from (
            select 'chosen' as side, conv_id, turn, role, text from conversations
            union all
            select 'rejected', c.conv_id, turn, role, case when turn = l.last_turn then coalesce(o.last_text, '') else text end
            from conversations c left join last l on c.conv_id = l.conv_id left join last o on o.conv_id = c.conv_id + 1)
    ), parting as (
        select conv_id, min(place) as parting from (
            select conv_id, place from pairs group by conv_id, place having count(*) < 2) group by conv_id
    ), said as (
        select side, p.conv_id, turn, place, coalesce(role = 'assistant', false) as trained, parting is null or place < parting as common,
            '{preferences.OPEN}' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10) as head,
            replace(coalesce(text, ''), '<|', '< |') || '{close}' || chr(10) as body
        from pairs p left join parting using (conv_id)
    ), measured as (
        select *, sum(length(head) + length(body)) over (partition by conv_id, side, common, turn // {preferences.SEGMENT_TURNS}
            order by place) as stop from said
    ), spanned as (
        select *, (stop - length(body))::varchar || '-' || stop::varchar as span from measured
    )
    select conv_id as pair_id, turn // {preferences.SEGMENT_TURNS} as segment,
        count(*) filter (common and side = 'chosen') as n_prompt_turns,
        coalesce(string_agg(head || body, '' order by place) filter (common and side = 'chosen'), '') as prompt,
        {side("chosen")}, {side("rejected")}
    from spanned group by conv_id, turn // {preferences.SEGMENT_TURNS}
    """


@query("op6_preference_pairs", _preferences_sql())
def _preferences(table):
    pairs = preferences.format_preferences(*preferences.answers_swapped(table("conversations")))

    def mask(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return pairs.select("pair_id", "segment", "n_prompt_turns", "prompt", "chosen", mask("chosen_spans").alias("chosen_mask"),
                        "rejected", mask("rejected_spans").alias("rejected_mask"))


@query("op7_cost_balanced_packing")
def _packing(table):
    return packing.pack(table("documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op8_line_dedup", r"""
    with lines as (
        select d.rowid as row_no, doc_id, i, line,
            translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from (select row_number() over () as rowid, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents) d,
            unnest(l) with ordinality as u(line, i)
    ), shared as (
        select key, max(doc_id) as stays from lines where length(key) >= 20
        group by key having count(distinct doc_id) >= 3
    ), judged as (
        select row_no, doc_id, i, line, stays is not null and doc_id <> stays as gone
        from lines left join shared using (key)
    )
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
    from judged group by row_no, doc_id
""")
def _line_dedup(table):
    return line_dedup.drop_shared_lines(table("documents"), digest=True)


@query("op9_quality_rules")
def _quality(table):
    return quality.quality_verdicts(table("documents"))


@query("op10_token_counts")
def _token_counts(table):
    return token_counts.count_tokens(table("documents"), tokenizer_path("word_bpe_49k.json"))


# CRC-32 (reflected, polynomial 0xEDB88320) of a decimal number, bit by bit.
_CRC_SQL = """xor(4294967295, list_reduce([4294967295::bigint] || list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda v, bit: xor(v >> 1, 3988292384::bigint * (v & 1)))))"""


@query("op11_prefix_trie", f"""
    with turns as (
        select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(role_bytes || ':' || role || text)) - 1 as pos,
            role_bytes || ':' || role || text as said, strlen(text) as n_bytes
        from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, strlen(coalesce(role, '')) as role_bytes
              from conversations where conv_id is not null)
    ), convs as (
        select conv_id, conv_id - conv_id % 5 as base, count(*) as n, {_CRC_SQL} % 9 as h from turns group by conv_id
    ), rebuilt as (
        select c.conv_id, least(h, coalesce(b.n, 0)) as taken, c.h, c.base from convs c
        left join (select conv_id as base, n from convs) b using (base)
    ), placed as (
        select r.conv_id, pos, said, n_bytes from rebuilt r join turns t on t.conv_id = r.base and pos < h
        union all
        select r.conv_id, pos - h + taken, said, n_bytes from rebuilt r join turns t on t.conv_id = r.conv_id and pos >= h
    ), paths as (
        select conv_id, 0 as depth, 'root' as node, null as parent, 0 as n_bytes from convs
        union all
        select conv_id, pos + 1, sha256(list_reduce(['root'] || said_list[:pos + 1], lambda a, b: sha256(a || b))),
            case when pos = 0 then 'root' else sha256(list_reduce(['root'] || said_list[:pos], lambda a, b: sha256(a || b))) end, n_bytes
        from placed join (select conv_id, list(said order by pos) as said_list from placed group by conv_id) using (conv_id)
    ), nodes as materialized (
        select node, any_value(parent) as parent, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs,
            (count(*) - 1) * any_value(n_bytes) as own from paths group by node
    ), kids as (
        select parent as node, count(*) as n_children from nodes where parent is not null group by parent
    ), lasts as (
        select node, conv_id from paths qualify row_number() over (partition by conv_id order by depth desc) = 1
    ), ends as (
        select node, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends from lasts group by node
    ), above as (
        select distinct p.node as top, q.node from paths p join paths q on p.conv_id = q.conv_id and p.depth <= q.depth
    ), below as (
        select top as node, count(*) filter (n_children is null) as n_leaves, sum(own) as saved
        from above join nodes using (node) left join kids using (node) group by top
    )
    select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
        saved::bigint as saved_tokens, coalesce(ends, sha256('')) as ends_sha256
    from nodes n join below using (node) left join kids using (node) left join ends using (node)
    left join nodes p on p.node = n.parent
""")
def _trie(table):
    return prefix_trie.rebuilt_trie(table("conversations"))


@query("op12_count_min_substrings", r"""
    with w as (
        select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
    ), windows as (
        select rid, doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) as h
        from w, unnest(range(1, len(words) - 18)) as u(i) where len(words) >= 20
    ), firsts as (
        select h, min({'doc_id': doc_id, 'i': i}) as first from windows group by h having count(*) > 1
    ), lost as (
        select rid, i, true as lost from windows join firsts using (h) where {'doc_id': doc_id, 'i': i} > first
    ), marked as (
        select rid, doc_id, word, i, coalesce(bool_or(lost) over (partition by rid order by i rows between 19 preceding and current row), false) as gone
        from (select rid, doc_id, unnest(words) as word, generate_subscripts(words, 1) as i from w) left join lost using (rid, i)
    )
    select w.doc_id, len(words) as n_words, count(*) filter (gone) as n_removed,
        sha256(coalesce(string_agg(word, ' ' order by i) filter (not gone), '')) as kept_sha256
    from w left join marked using (rid) group by w.rid, w.doc_id, words
""")
def _substrings(table):
    return substrings.drop_repeated_passages(table("documents"), digest=True)


def _vector_sql() -> str:
    """Assignment and means over the whole table, every round a table expression."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES

    def assigned(books: str) -> str:
        return f"""select rid, p, x, arg_min(e, d * {entries} + e) as e, min(d) as d from (
            select rid, p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
            from parts join {books} using (p)) group by rid, p, x"""

    rounds = "".join(f"""
    , a{i} as materialized ({assigned(f"books{i}")})
    , books{i + 1} as materialized (
        select p, e, coalesce(m, c) as c from books{i} left join (
            select p, e, list(floor(v / n)::bigint order by k) as m from (
                select p, e, k, sum(v) as v, count(*) as n
                from (select p, e, unnest(x) as v, generate_subscripts(x, 1) as k from a{i}) group by p, e, k)
            group by p, e) using (p, e)
    )""" for i in range(vector_codes.ROUNDS))
    last = vector_codes.ROUNDS
    return f"""
    with kept as (
        select row_number() over (order by vec_id nulls last, embedding) - 1 as rid, vec_id, label,
            list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::double)::bigint) as v
        from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), parts as materialized (
        select rid, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] as x
        from kept, unnest(range({parts})) as u(p)
    ), books0 as materialized (
        select p, rid as e, x as c from parts where rid < {entries}
    ){rounds}, coded as (
        select rid, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from ({assigned(f"books{last}")}) group by rid
    )
    select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
        (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from books{last}) as codebooks_sha256
    from kept join coded using (rid)
    """


@query("op13_vector_codes", _vector_sql())
def _vector_codes(table):
    return vector_codes.compress(table("embeddings"))
