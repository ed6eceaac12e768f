"""DuckDB twins of the registered queries (same column names, same values).

Pitfalls handled here: integer sums are cast to BIGINT, double results are
rounded the same way on both sides, regexp_replace uses the ``'g'`` flag,
whitespace trimming uses regexps on both sides, every ordering tie is broken by
a unique id and no query calls ``now()``.
"""

from __future__ import annotations

from feedkiln.functions import text as TX
from feedkiln.operators import scoring
from feedkiln.plans import queries as Q

_ET = Q.EVENT_TYPES


def _counters(upto: str) -> str:
    cols = ", ".join(f"cast(count(*) filter (where event_type = '{t}') as bigint) as n_{t}" for t in _ET)
    return f"select user_id, {cols} from events where ts < timestamp '{upto}' group by user_id"


def _clean(expr: str) -> str:
    """strip_ends(collapse_ws(x)) then NULL if empty."""
    inner = f"regexp_replace({expr}, '\\s+', ' ', 'g')"
    inner = f"regexp_replace(regexp_replace({inner}, '^\\s+', ''), '\\s+$', '')"
    return f"nullif({inner}, '')"


def _strip_ws(expr: str) -> str:
    inner = f"regexp_replace({expr}, '\\s+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({inner}, '^\\s+', ''), '\\s+$', '')"


def _word_count(c: str) -> str:
    return f"(case when {c} is null then 0 else len(string_split({c}, ' ')) end)"


def _emoji_flag(c: str) -> str:
    num = f"(length({c}) - length(regexp_replace({c}, '{TX.EMOJI_CLASS}', '', 'g')))"
    den = f"length(regexp_replace(regexp_replace({c}, '\\s', '', 'g'), '{TX.JOINER_CLASS}', '', 'g'))"
    return f"coalesce({den} > 0 and {num} * 1000 > {den} * 800, false)"


def _flags_csv(flags: dict[str, str]) -> str:
    parts = ", ".join(f"case when {cond} then '{name}' end" for name, cond in flags.items())
    return f"nullif(concat_ws(',', {parts}), '')"


def _text_flags(c: str) -> dict[str, str]:
    return {
        "too_short": f"{_word_count(c)} < {TX.MIN_WORDS}",
        "url_only": f"coalesce(regexp_matches({c}, '{TX.URL_ONLY_PATTERN}'), false)",
        "high_emoji_ratio": _emoji_flag(c),
    }


def _strip_markup(c: str) -> str:
    return _clean(f"regexp_replace({c}, '<[^>]*>', ' ', 'g')")


def _decode_basic(c: str) -> str:
    for ent, ch in TX.BASIC_ENTITIES:
        ch_sql = ch.replace("'", "''")
        c = f"replace({c}, '{ent}', '{ch_sql}')"
    return c


# the kinds of turn, written out
_TURNS = """(select conv_id, turn, case conv_id % 6 when 0 then ' ' || chr(9) || chr(10) || ' '
  when 1 then regexp_extract(text, '^\\S+\\s+\\S+') when 2 then ' https://example.org/t/' || conv_id || ' '
  when 3 then repeat(chr(128512), 2) || ' ' || repeat(chr(128512), 3) else text end as text from conversations)"""

_ORDERS_TS = f"""
with tgt as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate < timestamp '{Q.ORDERS_TARGET_BEFORE}'),
li as (
  select l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) as total,
         count(*) filter (where l_linestatus = 'F') as f, count(*) as n
  from lineitem group by l_orderkey),
src as (
  select o.o_orderkey, o.o_custkey,
         case when li.f = li.n then 'F' when li.f = 0 then 'O' else 'P' end as o_orderstatus,
         round(li.total, 2) as o_totalprice, o.o_orderdate, o.o_orderpriority
  from orders o join li on li.l_orderkey = o.o_orderkey
  where o.o_orderdate >= timestamp '{Q.ORDERS_SOURCE_FROM}')
"""

_DOC_CANDIDATES = f"""
with d as (select doc_id, text, {_clean('text')} as c from documents),
dup as (select text, count(*) as copies from documents group by text),
cand as (
  select d.doc_id, coalesce(length(d.c) > 0, false) as has_text,
         {_flags_csv({**_text_flags('d.c'), 'duplicate_text': 'dup.copies > 1'})} as quality_flag
  from d join dup on dup.text = d.text),
uns as (select * from cand where doc_id not in (select doc_id from labels where doc_id is not null))
"""

_LABEL_ROWS = """
select doc_id, case when toxic = 1 then 'negative' when quality = 1 then 'positive' else 'neutral' end
       as sentiment_label from labels
"""

_RUN_RESULTS = f"""{_DOC_CANDIDATES},
skipped as (select doc_id, 'skipped' as sentiment_label from uns where not (has_text and quality_flag is null)),
run as ({_LABEL_ROWS} union all select doc_id, sentiment_label from skipped)
"""

_MODEL_VERSIONS = """
with v as (
  select doc_id,
         case when toxic = 1 then 'negative' when quality = 1 then 'positive' else 'neutral' end as sentiment_label,
         case when toxic = 1 or quality = 1 then 0.9 else 0.55 end as confidence_score,
         'labels-v1' as model_name, timestamp '2024-01-10 00:00:00' as analyzed_at
  from labels
  union all
  select l.doc_id, case when toxic = 1 then 'negative' else 'neutral' end,
         round(least(1.0, 0.4 + d.n_chars / 10000.0), 4), 'labels-v2', timestamp '2024-01-20 00:00:00'
  from labels l join documents d on d.doc_id = l.doc_id)
"""


def _lexicon_values() -> str:
    rows = [f"('{w}', 1)" for w in scoring.POSITIVE_WORDS] + [f"('{w}', -1)" for w in scoring.NEGATIVE_WORDS]
    return ", ".join(rows)


def _events_unique(name: str, table: str, cols: list[str]) -> str:
    nn = " and ".join(f"{c} is not null" for c in cols)
    g = ", ".join(cols)
    return (f"select '{name}' as test_name, cast(count(*) as bigint) as failures, count(*) <> 0 as should_warn, "
            f"count(*) <> 0 as should_error from (select {g} from {table} where {nn} group by {g} having count(*) > 1)")


def _not_null(name: str, table: str, col: str) -> str:
    return (f"select '{name}' as test_name, cast(count(*) filter (where {col} is null) as bigint) as failures, "
            f"count(*) filter (where {col} is null) <> 0 as should_warn, "
            f"count(*) filter (where {col} is null) <> 0 as should_error from {table}")


def _accepted(name: str, table: str, col: str, values: list[str]) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return (f"select '{name}' as test_name, cast(count(*) as bigint) as failures, count(*) <> 0 as should_warn, "
            f"count(*) <> 0 as should_error from (select distinct {col} from {table} "
            f"where {col} is not null and {col} not in ({vals}))")


def _orphans(name: str, child: str, ccol: str, parent: str, pcol: str) -> str:
    return (f"select '{name}' as test_name, cast(count(*) as bigint) as failures, count(*) <> 0 as should_warn, "
            f"count(*) <> 0 as should_error from {child} c where c.{ccol} is not null and not exists "
            f"(select 1 from {parent} p where p.{pcol} = c.{ccol})")


def _landing_posts() -> str:
    return f"""
select 'facebook_' || cast(event_id as varchar) as post_id, cast(user_id as varchar) as page_id,
       ts as created_time, cast(json_extract(props, '$.k') as bigint) as reaction_like,
       cast(json_extract(props, '$.k') as bigint) as reaction_total, false as has_attachment,
       cast(cast(ts as date) + interval 1 day as timestamp) as ingested_at
from events
where ts >= timestamp '2004-01-01 00:00:00' and ts <= timestamp '2024-01-31 00:00:00'
  and event_type <> 'error' and user_id % 50 <> 0
"""


ORACLE = {
    "dedup_latest": """
select user_id, event_type, event_id, ts, value from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
""",
    # the expected value and reason of each kind of payload, written out
    "json_extract_default": """
with e as (select *, cast(regexp_extract(props, '[0-9]+') as bigint) as n, user_id % 2 = 0 as varied, event_id % 9 = 0 as cut from events)
select event_id,
       case when not varied then n when cut then 0 when event_type = 'view' then n
            when event_type in ('error', 'signup', 'purchase') then null else 0 end as k,
       case when varied and not cut and event_type = 'purchase' then 4
            when varied and not cut and event_type not in ('view', 'error', 'signup') then 3 else 0 end as m_default,
       case when not varied or cut then null when event_type in ('error', 'signup') then 'not_an_integer:k'
            when event_type = 'purchase' then 'null_value:k' end as k_reason
from e
""",
    "surrogate_key": """
select event_id, cast(user_id as varchar) || '_' || cast(event_id as varchar) as composite_id,
       event_type || '_' || cast(user_id as varchar) || '_' || cast(event_id as varchar) as surrogate_id,
       cast(user_id as varchar) as page_part, cast(event_id as varchar) as post_part
from events
""",
    "unnest_records": """
select l_orderkey,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as bigint) as pos,
       cast(n as bigint) as record_count, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate
from (select *, count(*) over (partition by l_orderkey) as n,
             row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity,
             l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as k from lineitem)
where l_orderkey % 20 <> 0 or k > 1
""",
    "envelope_reconcile": """
select l_orderkey, count(*) as declared_count, count(*) - case when l_orderkey % 20 = 0 then 1 else 0 end as found_count,
       l_orderkey % 20 <> 0 as matches
from lineitem group by l_orderkey
""",
    "layer_reconcile": """
with o as (select year(o_orderdate) as year, count(*) as n from orders group by 1),
     l as (select year(l_shipdate) as year, count(*) as n from lineitem group by 1)
select coalesce(o.year, l.year) as year, cast(coalesce(o.n, 0) as bigint) as n_orders,
       cast(coalesce(l.n, 0) as bigint) as n_lineitem,
       cast(coalesce(l.n, 0) - coalesce(o.n, 0) as bigint) as diff_lineitem
from o full outer join l on o.year = l.year
""",
    "unique_test": " union all ".join([
        _events_unique("unique_orders_o_orderkey", "orders", ["o_orderkey"]),
        _events_unique("unique_events_event_id", "events", ["event_id"]),
        _events_unique("unique_lineitem_order_line", "lineitem", ["l_orderkey", "l_linenumber"]),
        _events_unique("unique_documents_text", "documents", ["text"]),
        _events_unique("unique_conversations_turn", "conversations", ["conv_id", "turn"]),
    ]),
    "not_null_test": " union all ".join([
        _not_null("not_null_orders_o_orderkey", "orders", "o_orderkey"),
        _not_null("not_null_events_event_id", "events", "event_id"),
        _not_null("not_null_lineitem_l_orderkey", "lineitem", "l_orderkey"),
        _not_null("not_null_documents_text", "documents", "text"),
        _not_null("not_null_conversations_text", "conversations", "text"),
        _not_null("not_null_labels_doc_id", "labels", "doc_id"),
        _not_null("not_null_documents_quality", "(select d.doc_id, l.quality from documents d left join labels l using (doc_id))", "quality"),
    ]),
    "accepted_values_test": " union all ".join([
        _accepted("accepted_events_event_type", "events", "event_type", ["view", "click", "purchase", "signup"]),
        _accepted("accepted_conversations_role", "conversations", "role", ["user", "assistant", "system"]),
        _accepted("accepted_documents_lang", "documents", "lang", ["en", "fr", "de", "es"]),
        _accepted("accepted_orders_status", "orders", "o_orderstatus", ["F", "O"]),
    ]),
    "referential_orphans": " union all ".join([
        _orphans("lineitem_to_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _orphans("orders_to_customer", "orders", "o_custkey", "customer", "c_custkey"),
        _orphans("labels_to_documents", "labels", "doc_id", "documents", "doc_id"),
        _orphans("labels_to_english_documents", "labels", "doc_id", "(select * from documents where lang = 'en')", "doc_id"),
        _orphans("lineitem_to_final_orders", "lineitem", "l_orderkey", "(select * from orders where o_orderstatus = 'F')", "o_orderkey"),
        _orphans("customer_without_orders", "customer", "c_custkey", "orders", "o_custkey"),
    ]),
    "merge_upsert": _ORDERS_TS + """
select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
       case when s.o_orderkey is not null then s.o_custkey else t.o_custkey end as o_custkey,
       case when s.o_orderkey is not null then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
       round(case when s.o_orderkey is not null then s.o_totalprice else t.o_totalprice end, 2) as o_totalprice,
       case when s.o_orderkey is not null then s.o_orderdate else t.o_orderdate end as o_orderdate,
       case when s.o_orderkey is not null then s.o_orderpriority else t.o_orderpriority end as o_orderpriority
from tgt t full outer join src s on s.o_orderkey = t.o_orderkey
""",
    "merge_insert_only": _ORDERS_TS + """
select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) as o_totalprice, o_orderdate,
       o_orderpriority, 'target' as origin from tgt
union all
select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2), o_orderdate, o_orderpriority, 'source'
from src where o_orderkey not in (select o_orderkey from tgt)
""",
    "new_vs_known": f"""
with st as ({_counters(Q.STATE_EARLY)}), sn as ({_counters(Q.RUN_TS)})
select sn.user_id, case when st.user_id is null then 'new' else 'known' end as status
from sn left join st on st.user_id = sn.user_id
""",
    "change_detection": f"""
with st as ({_counters(Q.STATE_CUTOFF)}), sn as ({_counters(Q.SNAPSHOT_CUTOFF)})
select sn.* from sn join st on st.user_id = sn.user_id
where {' or '.join(f'coalesce(sn.n_{t}, 0) <> coalesce(st.n_{t}, 0)' for t in _ET)}
""",
    "snapshot_diff": f"""
with o as ({_counters(Q.STATE_CUTOFF)}), n as ({_counters(Q.SNAPSHOT_CUTOFF)})
select coalesce(n.user_id, o.user_id) as user_id, {', '.join(f'n.n_{t}' for t in _ET)},
       case when o.user_id is null then 'new' when n.user_id is null then 'removed'
            when {' and '.join(f'o.n_{t} is not distinct from n.n_{t}' for t in _ET)} then 'unchanged'
            else 'changed' end as status
from o full outer join n on o.user_id = n.user_id
""",
    "active_window": f"""
select event_id, user_id, ts from events
where ts >= timestamp '{Q.RUN_TS}' - interval {Q.ACTIVE_DAYS} day
""",
    "since_buffered": f"""
select event_id, ts from events where ts >= timestamp '{Q.LAST_LOADED_AT}' - interval 10 minute
""",
    "high_water": f"""
select event_id, ts from events
where (select max(ts) from events where ts < timestamp '{Q.HIGH_WATER_CUTOFF}') is null
   or ts > (select max(ts) from events where ts < timestamp '{Q.HIGH_WATER_CUTOFF}')
""",
    "ids_since_excluding": f"""
with r as (select * from events where ts >= timestamp '{Q.IDS_SINCE}'),
x as (select distinct user_id from events where ts < timestamp '2024-01-02 00:00:00' and event_type = 'signup')
select user_id, ts as first_ts, event_id as first_event_id from r
where user_id is not null and user_id not in (select user_id from x)
qualify row_number() over (partition by user_id order by ts, event_id) = 1
""",
    "time_range_reject": f"""
select o_orderkey, o_orderdate,
       case when o_orderdate < timestamp '{Q.ORDERS_LOWER}' then 'before:o_orderdate'
            when o_orderdate > timestamp '{Q.ORDERS_RUN_TS}' then 'after:o_orderdate' end as rejection_reason
from orders
""",
    "reject_reasons": f"""
select event_id,
       case when event_id is null then 'missing_pk'
            when ts is null then 'missing:ts'
            when ts < timestamp '2024-01-03 00:00:00' then 'before:ts'
            when ts > timestamp '2024-01-29 00:00:00' then 'after:ts'
            when varied and event_id % 9 = 0 then 'malformed_json:props'
            when varied and event_type not in ('view', 'error', 'signup', 'purchase') then 'missing:k'
            when varied and event_type in ('error', 'signup') then 'not_an_integer:k'
            when varied and event_type = 'purchase' then 'null_value:k'
            when value < 1 then 'low:value' end as rejection_reason
from (select *, user_id % 2 = 0 as varied from events)
""",
    "clean_text": f"""
select doc_id, {_strip_ws('text')} as text_cleaned, length({_strip_ws('text')}) as n_chars_cleaned from documents
""",
    "null_if_empty": f"""
select conv_id, turn, {_clean('text')} as text_or_null, coalesce(length({_clean('text')}) > 0, false) as has_text
from {_TURNS}
""",
    "truncate_text": f"""
select doc_id, left({_clean('text')}, {TX.MAX_TEXT_CHARS}) as text_truncated,
       coalesce(length({_clean('text')}) > {TX.MAX_TEXT_CHARS}, false) as was_truncated
from documents
""",
    "strip_markup": f"select page_id, {_strip_markup('html')} as text from pages",
    "decode_entities": f"select page_id, {_decode_basic(_strip_markup('html'))} as text_decoded from pages",
    "nfc_normalise": """
select doc_id, nfc_normalize(t) as text_nfc, length(t) as n_before
from (select doc_id, replace(text, chr(233), 'e' || chr(769)) as t from documents)
""",
    "too_short": f"""
select conv_id, turn, {_word_count(_clean('text'))} as n_words, {_word_count(_clean('text'))} < 3 as too_short
from {_TURNS}
""",
    "url_only": "select page_id, strpos(url, '?') = 0 as url_only from pages",
    "quality_flags": f"""
select conv_id, turn, {_flags_csv(_text_flags('c'))} as quality_flag
from (select conv_id, turn, {_clean('text')} as c from {_TURNS})
""",
    "spam_window": """
select event_id, count(*) over (partition by user_id, event_type order by ts
         range between interval 24 hours preceding and interval 24 hours following) > 1 as spam_suspected
from events where event_type is not null
union all select event_id, false from events where event_type is null
""",
    "bot_window": f"""
with t as (
  select event_id, user_id,
         cast(count(*) over (partition by user_id order by ts
              range between interval 1 hour preceding and current row) as bigint) as trailing_count
  from events)
select event_id, user_id, trailing_count,
       max(trailing_count) over (partition by user_id) > {Q.BOT_TEST_THRESHOLD} as bot_suspected
from t
""",
    "foreign_language": """
with c as (select source, lang, count(*) as n from documents where lang is not null group by 1, 2),
m as (select source, lang as page_lang from c
      qualify row_number() over (partition by source order by n desc, lang) = 1)
select d.doc_id, d.source, d.lang, m.page_lang, coalesce(d.lang <> m.page_lang, false) as foreign_language
from documents d left join m on m.source = d.source
""",
    "thread_order": """
select event_id, event_type,
       row_number() over (partition by event_type order by ts nulls first, event_id nulls first) - 1 as thread_pos
from events
""",
    "reply_hierarchy": """
with recursive nodes as (
  select cast(conv_id as varchar) || '_' || cast(turn as varchar) as node_id,
         case when turn > 0 then cast(conv_id as varchar) || '_' || cast(turn - 1 as varchar) end as parent_id
  from conversations),
n2 as (
  select node_id, case when parent_id in (select node_id from nodes) then parent_id end as parent_id,
         parent_id is not null and parent_id not in (select node_id from nodes) as dangling
  from nodes),
walk as (
  select node_id, node_id as root_id, cast(0 as bigint) as depth from n2 where parent_id is null
  union all
  select n2.node_id, walk.root_id, walk.depth + 1 from n2 join walk on n2.parent_id = walk.node_id)
select n2.node_id, walk.root_id, walk.depth, n2.dangling
from n2 left join walk on walk.node_id = n2.node_id
""",
    "reaction_total": f"""
select user_id, {', '.join(f"cast(count(*) filter (where event_type = '{t}') as bigint) as n_{t}" for t in _ET)},
       cast(count(*) filter (where event_type in ({', '.join(f"'{t}'" for t in _ET)})) as bigint) as reaction_total
from events group by user_id
""",
    "reaction_flag": f"""
with c as (
  select user_id, cast(count(*) filter (where event_type = 'error') as bigint) as n_error,
         cast(count(*) filter (where event_type in ({', '.join(f"'{t}'" for t in _ET)})) as bigint) as reaction_total
  from events group by user_id)
select user_id, n_error, reaction_total,
       case when reaction_total = 0 then false else n_error * 5 > reaction_total end as is_reaction_flagged
from c
""",
    "unscored": _DOC_CANDIDATES + "select doc_id from uns where has_text and quality_flag is null",
    "skipped_rows": _DOC_CANDIDATES + """
select doc_id, 'skipped' as sentiment_label, 0.0 as confidence_score,
       'skipped:' || coalesce(quality_flag, case when not has_text then 'no_text' end) as model_name
from uns where not (has_text and quality_flag is null)
""",
    "label_distribution": _RUN_RESULTS + """
select sentiment_label, cast(count(*) as bigint) as n_rows,
       round(count(*) / (select count(*) from run), 6) as share
from run group by sentiment_label
""",
    "negative_alert": _RUN_RESULTS + f"""
select cast(count(*) as bigint) as n_rows,
       round(avg(case when sentiment_label = 'negative' then 1.0 else 0.0 end), 6) as negative_share,
       avg(case when sentiment_label = 'negative' then 1.0 else 0.0 end) > {scoring.NEGATIVE_ALERT_THRESHOLD} as alert
from run
""",
    "mean_confidence": _MODEL_VERSIONS + f"""
select model_name, cast(count(*) as bigint) as n_rows, round(avg(confidence_score), 6) as mean_confidence,
       round(avg(case when confidence_score >= {scoring.CONFIDENCE_THRESHOLD} then 1.0 else 0.0 end), 6)
         as accepted_share
from v where sentiment_label <> 'skipped' group by model_name
""",
    "current_model": _MODEL_VERSIONS + """
select doc_id, model_name, sentiment_label from v
qualify row_number() over (partition by doc_id order by analyzed_at desc, model_name desc) = 1
""",
    "score_lexicon": f"""
with lex(word, polarity) as (values {_lexicon_values()}),
tok as (select doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) as word from documents),
hits as (select doc_id, count(*) filter (where polarity > 0) as pos, count(*) filter (where polarity < 0) as neg
         from tok join lex using (word) group by doc_id),
j as (select d.doc_id, coalesce(h.pos, 0) as pos, coalesce(h.neg, 0) as neg
      from documents d left join hits h on h.doc_id = d.doc_id)
select doc_id, cast(pos as bigint) as pos_hits, cast(neg as bigint) as neg_hits,
       case when pos > neg then 'positive' when neg > pos then 'negative' else 'neutral' end as sentiment_label,
       case when pos + neg = 0 then 0.5 else round(0.5 + 0.5 * abs(pos - neg) / (pos + neg), 4) end
         as confidence_score,
       '{scoring.LEXICON_MODEL}' as model_name
from j
""",
    "stale_pages": f"""
select user_id, max(ts) as last_ts, max(ts) < timestamp '{Q.RUN_TS}' - interval {Q.STALE_HOURS} hour as is_stale
from events group by user_id
""",
    "engagement_daily": """
select cast(ts as date) as day, event_type, cast(count(*) as bigint) as n_rows, round(sum(value), 2) as value_sum
from events group by 1, 2
""",
    "comments_per_post": """
select conv_id, cast(count(*) as bigint) as n_turns,
       cast(count(*) filter (where role = 'user') as bigint) as n_user_turns,
       cast(sum(length(text)) as bigint) as n_chars
from conversations group by conv_id
""",
    "multi_platform_union": """
select 'documents' as platform, 'doc_' || cast(doc_id as varchar) as source_id, cast(null as varchar) as author_name,
       lang, cast(length(text) as bigint) as n_chars from documents
union all
select 'conversations', 'conv_' || cast(conv_id as varchar) || '_' || cast(turn as varchar), role,
       cast(null as varchar), cast(length(text) as bigint) from conversations
""",
    "landing_roundtrip": _landing_posts(),
    "dead_letter": """
select 'bad_timestamp:created_time' as rejection_reason, 'error' as message, count(*) as n_records, cast(null as bigint) as n_pages
from events where user_id % 50 <> 0 and event_type = 'error'
union all
select 'malformed_json', null, null, count(distinct (user_id, cast(ts as date))) from events where user_id % 50 = 0
""",
    "run_audit": f"""
with p as ({_landing_posts()})
select 'files' as stage, cast(count(distinct (user_id, cast(ts as date))) as bigint) as n_rows from events
union all select 'bad_files', cast(count(distinct (user_id, cast(ts as date))) as bigint) from events where user_id % 50 = 0
union all select 'records', cast(count(*) as bigint) from events where user_id % 50 <> 0
union all select 'valid', cast(count(*) as bigint) from p
union all select 'rejected', cast(count(*) as bigint) from events where user_id % 50 <> 0 and event_type = 'error'
union all select 'deduped', cast(count(distinct post_id) as bigint) from p
""",
}

# the streaming twins must equal their batch twins
ORACLE["stream_dedup"] = ORACLE["dedup_latest"]
ORACLE["stream_state"] = f"""
select user_id, {', '.join(f"cast(count(*) filter (where event_type = '{t}') as bigint) as n_{t}" for t in _ET)}
from events group by user_id
"""

# the scorer called in batches gives what the word lists give
ORACLE["score_batch"] = f"select doc_id, sentiment_label, confidence_score, model_name, confidence_score >= 0.6 as is_accepted from ({ORACLE['score_lexicon']})"

# the supplied pages hold these four entities
ORACLE["decode_entities_full"] = f"""
select page_id, replace(replace(replace(replace({_strip_markup('html')}, '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')
  as text_decoded from pages
"""

ORACLE["language_detect"] = r"""
with w as (select doc_id, unnest(string_split(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g'), ' ')) as w from documents),
wc as (select doc_id, ' ' || w || ' ' as p, count(*) as n from w where length(w) > 0 group by all),
g as (select doc_id, substr(p, i, 3) as gram, sum(n) as cnt from (select *, unnest(range(1, length(p) - 1)) as i from wc) group by all),
per as (select lang, gram, sum(cnt) as c from g join documents using (doc_id)
        where lang is not null and doc_id in (select doc_id from labels) group by all),
v as (select count(distinct gram) as v from per),
norm as (select lang, sum(c) + any_value(v) as den from per, v group by lang),
s as (select doc_id, lang, round(sum(cnt * ln((coalesce(c, 0) + 1) / den)), 6) as score
      from g cross join norm left join per using (lang, gram) group by all),
best as (select doc_id, lang as detected from s qualify row_number() over (partition by doc_id order by score desc, lang) = 1)
select d.doc_id, d.lang, b.detected as detected_language from documents d left join best b using (doc_id)
"""

ORACLE.update({
    "composite_split": """
select o_orderkey, case when o_orderstatus = 'F' then cast(o_custkey as varchar) end as page_part,
       case when o_orderstatus = 'F' then cast(o_orderkey as varchar) end as post_part from orders
""",
    "counter_rules": """
select o_orderkey, case when c < 0 then null else least(c, 2147483647) end as counter, c > 2147483647 as was_capped
from (select o_orderkey, cast(trunc((o_totalprice - 100000) * 20000) as bigint) as c from orders)
""",
    "invisible_chars": """
select doc_id, text, length(text) + 3 * (length(text) - length(replace(text, 'e', ''))) as n_before from documents
""",
    "mojibake_repair": "select doc_id, text, strlen(text) as n_before from documents",
    "time_marks": f"select conv_id, turn, {_clean('text')} as text from conversations",
    "granular_reactions": """
select event_id, cast(user_id as varchar) as user_id, event_type as reaction_type from events where event_type <> 'error'
""",
    "legacy_likes": """
select event_id, case when event_type = 'view' then user_id end as like_count, cast(null as varchar) as reason from events
""",
    "video_comments": """
select 'youtube_' || conv_id || '-' || turn as comment_id, 'youtube_' || conv_id as post_id,
       case when turn > 0 then 'youtube_' || conv_id || '-0' end as parent_comment_id, turn > 0 as is_reply,
       turn as reaction_like, text as message
from conversations where role <> 'system'
""",
    "microblog_posts": """
select 'twitter_' || event_id as post_id, cast(user_id as varchar) as page_id, event_type as message,
       date_trunc('second', ts) as created_time, user_id as reaction_like from events
""",
    "page_subset": "select doc_id, source from documents where source in ('src1', 'src3', 'src10')",
})

ORACLE["comment_refresh"] = """
with conv as (select distinct conv_id, timestamp '2024-01-01 00:00:00' + to_days(cast(conv_id % 30 as int)) + to_hours(conv_id % 24) as began from conversations),
bound as (select conv_id, began >= timestamp '2024-01-30 11:50:00' as fresh,
                 conv_id % 3 <> 0 and began >= timestamp '2024-01-24 00:00:00' as known from conv),
talk as (select c.conv_id, c.turn, conv.began + to_hours(c.turn * c.turn * 12) as created_time from conversations c join conv using (conv_id) where c.turn > 0)
select conv_id as post_id, turn, created_time, case when fresh then null else timestamp '2024-01-30 11:50:00' end as since
from talk join bound using (conv_id)
where created_time <= timestamp '2024-01-31 00:00:00' and (fresh or (known and created_time >= timestamp '2024-01-30 11:50:00'))
"""

_THREADS = """conv as (select distinct conv_id, timestamp '2024-01-01 00:00:00' + to_days(cast(conv_id % 30 as int)) + to_hours(conv_id % 24) as began from conversations),
talk as (select * from (select c.conv_id, c.turn, conv.began, conv.began + to_hours(c.turn * c.turn * 12) as created_time
                        from conversations c join conv using (conv_id) where c.turn > 0) where created_time <= timestamp '2024-01-31 00:00:00')"""

ORACLE["stream_landing"] = f"""
with {_THREADS}
select 'post' as kind, cast(conv_id as varchar) as id, cast(conv_id as varchar) as post_id, cast(null as varchar) as reason from conv where conv_id % 10 <> 7
union all select 'comment', conv_id || '-' || turn, cast(conv_id as varchar), null from talk where conv_id % 10 not in (3, 7)
union all select 'rejected', conv_id || '-' || turn, cast(conv_id as varchar), 'orphan:post_id' from talk where conv_id % 10 = 7
union all select 'rejected', null, null, 'malformed_json' from (select distinct conv_id from talk where conv_id % 10 = 3)
"""

ORACLE["late_comments"] = f"""
with {_THREADS},
posts as (select conv_id, began + to_days(cast(case when conv_id % 7 = 0 then 10 else 0 end as int)) as post_time from conv where conv_id % 5 <> 0)
select talk.conv_id as post_id, turn, created_time, post_time
from talk left join posts on posts.conv_id = talk.conv_id and post_time between created_time - interval 30 days and created_time + interval 7 days
"""

ORACLE["keyed_state"] = f"""
select user_id, {', '.join(f"cast(count(*) filter (where event_type = '{t}') as bigint) as n_{t}" for t in _ET)}
from events group by user_id having max(ts) >= timestamp '{Q.STATE_CUTOFF}'
"""

ORACLE["layer_content"] = """
select year(o_orderdate) as year, count(*) as n_landed, count(*) filter (o_orderkey % 8191 <> 5) as n_staged, count(*) as n_served,
       coalesce(bool_or(o_orderkey % 8191 = 5 or (o_orderkey % 8087 = 3 and o_custkey <> 0)), false) as differs_staged,
       coalesce(bool_or(o_orderkey % 7919 = 7), false) as differs_served
from orders group by 1
"""
