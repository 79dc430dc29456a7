"""The queries as SQL over the same whole tables, for checking results in another engine."""

from __future__ import annotations

import re

from pairtables import fixed_values as fixed

TURNS = 2**32
_SPACE = fixed.WHITE_SPACE
_JUDGES = fixed.JUDGE_METRICS


def _tok(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{fixed.TOKEN_PATTERN}')"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


def _blank(text: str) -> str:
    return f"coalesce(not regexp_matches({text}, '[^{_SPACE}]'), true)"


def _words(text: str) -> str:
    return f"regexp_replace({text}, '\\W+', ' ', 'g')"


def _prompt(kind: str) -> str:
    parts = re.split(r"\{(\w+)\}", fixed.PROMPTS[kind])
    terms = [
        f"cast({part} as varchar)" if i % 2 else "'" + part.replace("'", "''") + "'"
        for i, part in enumerate(parts)
        if part
    ]
    return " || ".join(terms)


# Derived tables

QA = f"""
select a.conv_id * {TURNS} + a.turn as record_id, a.text as instruction, b.text as output
from conversations a join conversations b on b.conv_id = a.conv_id and b.turn = a.turn + 1
where a.role = 'user' and b.role = 'assistant'"""

DUAL = f"""
select record_id, instruction,
  case when record_id % 7 = 0 then null when record_id % 11 = 0 then '  ' else output end as gpt_output,
  case when record_id % 5 = 0 then null else output || ' ' || instruction end as gemini_output
from ({QA})"""

EVAL = """
select doc_id as record_id, lang as topic, 'Write ' || lang || ' text like ' || source as inputs,
  text as targets, substr(text, 1 + cast(n_chars % 40 as int)) || ' ' || lang || ' ' || source as outputs
from documents"""

PREDICTIONS = f"""
select record_id, instruction as inputs, output as targets, 'gpt_output' as source, instruction as outputs
from ({QA})
union all
select record_id, instruction, output, 'gemini_output',
  substr(output, length(output) // 2 + 1) || ' ' || substr(output, 1, length(output) // 2)
from ({QA})"""

_RESPONSE = """case when {0} % 13 = 0 then null when {0} % 5 = 0 then 'no score'
  else 'Score: ' || cast({0} % 7 as varchar) || '/5' end"""

JUDGE_RAW = f"select event_id as record_id, event_type as metric, {_RESPONSE.format('event_id')} as response from events"

VERSIONS = """
select case when user_id % 50 <> 7 then 'model_' || cast(user_id % 50 as varchar) end as name,
  case when event_id % 19 = 0 then 'v' || cast(event_id as varchar)
    when event_id % 17 = 0 then cast(event_id + 3000000000 as varchar) else cast(event_id as varchar) end as version,
  event_type as stage
from events"""

COVERAGE = """
select t.topic, coalesce(p.produced, 0) as produced, t.target,
  greatest(0, t.target - coalesce(p.produced, 0)) as shortfall
from (select source as topic, count(*) as target from documents group by 1) t
left join (select source as topic, count(*) as produced from documents
           where doc_id in (select doc_id from labels) group by 1) p using (topic)"""


def _judge_responses(rows: str) -> str:
    return " union all ".join(
        f"select record_id, '{m}' as metric, {_RESPONSE.format(f'(record_id + {i})')} as response from ({rows})"
        for i, m in enumerate(_JUDGES)
    )


def _judged(rows: str) -> str:
    found = ", ".join(
        f"max(case when metric = '{m}' then try_cast(regexp_extract(response, '[1-5]') as double) end) as f{i}"
        for i, m in enumerate(_JUDGES)
    )
    scores = ", ".join(f"coalesce(f{i}, 3.0)::double as {m}" for i, m in enumerate(_JUDGES))
    missing = " + ".join(f"(f{i} is null)::bigint" for i in range(len(_JUDGES)))
    return f"""select record_id, {scores}, {missing} as defaulted
from (select record_id, {found} from ({_judge_responses(rows)}) group by record_id)"""


def _grams(rows: str, key: str, top: int) -> str:
    """CTEs: tokens ``t`` and shared n-grams ``o`` per key and n."""
    leads = ", ".join(f"lead(w1, {n - 1}) over p as w{n}" for n in range(2, top + 1))
    grams = " union all ".join(
        f"select {key}, side, {n} as n, {' || chr(32) || '.join(f'w{i}' for i in range(1, n + 1))} as gram "
        f"from x where w{n} is not null"
        for n in range(1, top + 1)
    )
    return f"""t as (select {key}, {_tok('targets')} as tt, {_tok('outputs')} as ot from ({rows})),
w as (select {key}, 0 as side, unnest(tt) as w1, unnest(range(len(tt))) as i from t
      union all select {key}, 1, unnest(ot), unnest(range(len(ot))) from t),
x as (select {key}, side, w1, {leads} from w window p as (partition by {key}, side order by i)),
g as ({grams}),
c as (select {key}, side, n, gram, count(*) as k from g group by all),
o as (select {key}, n, sum(least(a.k, b.k)) as hit
      from (select * from c where side = 0) a join (select * from c where side = 1) b using ({key}, n, gram)
      group by all)"""


def _prf(name: str, hit: str, out: str, target: str) -> str:
    p = f"(case when {out} > 0 then {hit} / {out} else 0.0 end)"
    r = f"(case when {target} > 0 then {hit} / {target} else 0.0 end)"
    return f"""{p}::double as {name}_precision, {r}::double as {name}_recall,
  (case when {hit} > 0 then 2 * {p} * {r} / ({p} + {r}) else 0.0 end)::double as {name}"""


def _rouge(key: str) -> str:
    """ROUGE-1 and ROUGE-2 from the CTEs of ``_grams``."""
    parts = [
        _prf(
            f"rouge{n}", f"coalesce(o{n}.hit, 0)::double", f"greatest(len(ot) - {n - 1}, 0)",
            f"greatest(len(tt) - {n - 1}, 0)",
        )
        for n in (1, 2)
    ]
    joins = " ".join(
        f"left join (select * from o where n = {n}) o{n} using ({key})" for n in (1, 2)
    )
    return f"select {key}, len(ot) as token_count, {', '.join(parts)} from t {joins}"


def _bleu(by: str) -> str:
    """Corpus BLEU per group from the CTEs of ``_grams``; the key's table is ``t``."""
    key = f"record_id, {by}"
    sums = ", ".join(
        f"sum(coalesce(o{n}.hit, 0)) as h{n}, sum(greatest(len(ot) - {n - 1}, 0)) as m{n}" for n in range(1, 5)
    )
    joins = " ".join(f"left join (select * from o where n = {n}) o{n} using ({key})" for n in range(1, 5))
    logs = " + ".join(f"ln(h{n} / m{n})" for n in range(1, 5))
    hits = ", ".join(f"h{n}" for n in range(1, 5))
    return f"""select {by}, n, case when least({hits}) > 0 then
  100 * (case when c > r then 1.0 else exp(1 - r / c) end) * exp(({logs}) / 4) else 0.0 end as bleu
from (select {by}, count(*) as n, sum(len(tt)) as r, sum(len(ot)) as c, {sums} from t {joins} group by {by})"""


# Longest common subsequence: for every output token in turn, the list ``k`` holds at place j
# the lowest target position at which a common subsequence of length j can end.
_LCS = """ow as (select record_id, source, unnest(ot) as word, unnest(range(1, len(ot) + 1)) as i from t),
tw as (select record_id, source, unnest(tt) as word, unnest(range(1, len(tt) + 1)) as p from t),
hits as (select record_id, source, i, list(p) as ps from ow join tw using (record_id, source, word) group by all),
lcs as (
  select record_id, source, len(tt) as nt, len(ot) as no, 1::bigint as i, []::bigint[] as k from t
  union all
  select l.record_id, l.source, nt, no, l.i + 1,
    case when ps is null then k else list_filter(list_transform(list_zip([0::bigint] || k, k || [null::bigint]),
      lambda z: least(z[2], list_min(list_filter(ps, lambda p: p > z[1])))), lambda v: v is not null) end
  from lcs l left join hits a on a.record_id = l.record_id and a.source = l.source and a.i = l.i
  where l.i <= no),
l as (select record_id, source, len(k)::double as lcs, nt, no from lcs where i = no + 1)"""

_SOURCE_KEY = "record_id, source"
_SCORED = f"""with recursive {_grams(PREDICTIONS, _SOURCE_KEY, 4)}, {_LCS},
rl as (select record_id, source, {_prf('rougeL', 'lcs', 'no', 'nt')} from l),
rn as ({_rouge(_SOURCE_KEY)}),
j as ({_judged(QA)}),
scored as (select record_id, source, outputs, rouge1, rouge2, rougeL, token_count, {', '.join(_JUDGES)}, defaulted
  from rn join rl using ({_SOURCE_KEY}) join j using (record_id) join ({PREDICTIONS}) using ({_SOURCE_KEY})),
b as ({_bleu('source')})"""

_MEAN_NAMES = {name: name for name in ("rouge1", "rouge2", "rougeL", "token_count")}
_MEAN_NAMES |= {f"{m}/v1/mean": m for m in _JUDGES}
_METRICS = _SCORED + ", m as (" + " union all ".join(
    f"select source, '{name}' as metric, avg({col})::double as value, count({col}) as n from scored group by source"
    for name, col in _MEAN_NAMES.items()
) + " union all select source, 'bleu', bleu, n from b)"

_THRESHOLDS = ", ".join(
    f"('{name}', '{fixed.METRIC_OF_THRESHOLD.get(name, name)}', {least}::double)"
    for name, least in fixed.THRESHOLDS.items()
)
_GATE = f"""{_METRICS}, th(threshold_name, metric, threshold) as (values {_THRESHOLDS}),
gate as (select s.source, threshold_name, value, threshold,
    case when value is null then 'N/A' when value >= threshold then 'PASS' else 'FAIL' end as status
  from (select distinct source from m) s cross join th left join m on m.source = s.source and m.metric = th.metric)"""


def _shards(rows: str, size: int = 10) -> str:
    return f"""select *, printf('batch-%07d-%07d', pos // {size} * {size}, least(pos // {size} * {size} + {size}, n)) as shard
from (select *, row_number() over (order by record_id) - 1 as pos, count(*) over () as n from ({rows}))"""


def _subwords(rows: str, key: str, col: str, then: str) -> str:
    """Merges of least rank, one kind of pair per word and round, until no pair has a rank.

    White space is cut as the vocabulary's own pattern cuts it: all but the last character of a run
    that a word follows is a piece of its own. ``t`` holds key, place and symbols of each piece.
    """
    blank = r"\t-\r\x{85}\p{Z}"
    pattern = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{blank}\p{{L}}\p{{N}}]+|[{blank}]+".replace("'", "''")
    return f"""with recursive
f as (select model from read_json('/opt/tokenizers/byte_bpe_50k.json', maximum_object_size=100000000,
  columns={{model: 'STRUCT(merges VARCHAR[][], vocab MAP(VARCHAR, INTEGER))'}})),
m as (select x[1] as l, x[2] as r, k as rank from (select unnest(model.merges) as x, generate_subscripts(model.merges, 1) as k from f)),
v as (select unnest(map_keys(model.vocab)) as s, unnest(map_values(model.vocab)) as id from f),
b as (select lower(printf('%02x', b)) as h, chr(cast(case
    when b between 33 and 126 or b between 161 and 172 or b between 174 and 255 then b
    when b < 33 then 256 + b when b < 161 then 256 + b - 94 else 323 end as int)) as c from range(256) r(b)),
bytes as (select map(list(h), list(c)) as of from b),
parts as (select {key}, unnest(x) as x, generate_subscripts(x, 1) as i from (select {key},
    string_split(regexp_replace({col}, '([{blank}])([{blank}][^{blank}])', '\\1' || chr(57344) || '\\2', 'g'), chr(57344)) as x from ({rows}))),
pieces as (select {key}, i, unnest(regexp_extract_all(x, '{pattern}')) as w, generate_subscripts(regexp_extract_all(x, '{pattern}'), 1) as j from parts),
words as (select w, array_to_string([chr(31) || of[lower(h)][1] || chr(30) for h in
    regexp_extract_all(hex(encode(w)), '..')], '') as s from (select distinct w from pieces), bytes),
e(w, s) as (select w, s from words union all
  select w, replace(any_value(s), chr(31) || arg_min(l, rank) || chr(30) || chr(31) || arg_min(r, rank) || chr(30),
    chr(31) || arg_min(l, rank) || arg_min(r, rank) || chr(30))
  from (select w, s, m.l, m.r, m.rank from (select w, s, y[k] as l, y[k + 1] as r
      from (select w, s, y, unnest(range(1, len(y))) as k from (select w, s,
        regexp_extract_all(s, '[^' || chr(30) || chr(31) || ']+') as y from e))) p join m on m.l = p.l and m.r = p.r) group by w),
done as (select w, arg_min(regexp_extract_all(s, '[^' || chr(30) || chr(31) || ']+'), length(s)) as y from e group by w),
t as (select {key}, i, j, y from pieces join done using (w))
{then}"""


def _json_item(item: str, field: str, missing: str) -> str:
    return f"""case json_type({item}) when 'OBJECT' then coalesce({item} ->> '$.{field}', {missing})
  else coalesce({item} ->> '$', '') end"""


POLY = f"""
select record_id, case
  when record_id % 3 = 0 then '{{"text":"' || {_words('output')} || '"}}'
  when record_id % 3 = 1 then '[{{"text":"' || {_words('output')} || '"}},"' || {_words('instruction')} || '"]'
  else '"' || {_words('output')} || '"' end as output
from ({QA})"""

RESPONSES = f"""
select record_id, case
  when record_id % 4 = 0 then '{{"predictions":[{{"generated_text":"' || {_words('output')} || '"}},"plain"]}}'
  when record_id % 4 = 1 then '{{"outputs":["' || {_words('output')} || '"]}}'
  when record_id % 4 = 2 then '{{"other":1}}'
  else '[{{"generated_text":"' || {_words('output')} || '"}},5,{{"n":1}}]' end as response
from ({QA})"""

RECORD_SETS = f"""
select doc_id as record_id, '{{"records":[{{"model":"m1","topic":"' || lang || '","instruction":"' || {_words('text')}
  || '","temperature":' || case when doc_id % 11 = 0 then '"hot"' else '0.2' end
  || '}},{{"model":"m2","topic":' || case when doc_id % 7 = 0 then 'null' else '"' || source || '"' end
  || ',"instruction":"Explain","temperature":1}}]' || case when doc_id % 13 = 0 then '' else '}}' end as response
from documents"""

_RECORDS = f"""with r as (select record_id, response, json_valid(response) as ok from ({RECORD_SETS})),
i as (select record_id, p as pos, json_extract(response, '$.records[' || p || ']') as item
      from r, range(0, 2) x(p) where ok),
checked as (select *, case
    when json_type(item -> '$.model') is distinct from 'VARCHAR' then 'model is not text'
    when json_type(item -> '$.topic') is distinct from 'VARCHAR' then 'topic is not text'
    when json_type(item -> '$.instruction') is distinct from 'VARCHAR' then 'instruction is not text'
    when try_cast(item ->> '$.temperature' as double) is null then 'temperature is not a number'
    else 'valid' end as status from i)"""

SERVED = """
select source as endpoint, 'model_' || cast(doc_id % 40 as varchar) as name,
  coalesce(try_cast(case when doc_id % 9 = 0 then 'latest' when doc_id % 8 = 0 then null
    else cast(doc_id as varchar) end as bigint), -1) as version
from documents"""

_TEST = "md5(cast({0} as varchar) || ':42') < '33333333'"

ORACLES: dict[str, str] = {
    "o01_read_dataset": "select * from conversations",
    "o02_read_shards": f"select record_id, shard, gpt_output from ({_shards(DUAL)})",
    "o02_shard_index": f"""select *, sum(n_rows) over (order by first_key)::bigint - n_rows as start from (
  select shard, min(record_id) as first_key, max(record_id) as last_key, count(*) as n_rows
  from ({_shards(DUAL, 100)}) group by shard)""",
    "o03_validate_records": f"""{_RECORDS}
select record_id, pos, item ->> '$.model' as model, item ->> '$.topic' as topic, md5(item ->> '$.instruction') as digest,
  cast(item ->> '$.temperature' as double) as temperature, status
from checked where status = 'valid'
union all select record_id, pos, null, null, null, null, status from checked where status <> 'valid'
union all select record_id, null, null, null, null, null, 'no list of records' from r where not ok""",
    "o03_validate_responses": f"""{_RECORDS}
select record_id, case when max(status) filter (status <> 'valid') is null then count(*) else 0 end as n_records,
  coalesce(first(status order by pos) filter (status <> 'valid'), 'valid') as status
from checked group by record_id
union all select record_id, 0, 'no list of records' from r where not ok""",
    "o04_append_dataset": "select * from documents",
    "o05_write_shards": f"""select shard, count(*) as n_rows, min(record_id) as first_id, max(record_id) as last_id
from ({_shards(DUAL)}) group by shard""",
    "o05_resume_shards": f"""select shard, count(*) as n_rows, min(record_id) as first_id, max(record_id) as last_id
from ({_shards(DUAL)}) group by shard""",
    "o06_consolidate": f"""select record_id, instruction,
  case when {_blank('gpt_output')} then instruction else gpt_output end as gpt_output, gemini_output from ({DUAL})""",
    "o07_select_source": f"select record_id, instruction, gemini_output as output from ({DUAL})",
    "o08_build_eval_frame": f"""select record_id, instruction as inputs, gemini_output as targets
from ({DUAL}) where {_TEST.format('record_id')}""",
    "o08_eval_frames": f"""select record_id, instruction as inputs, source, case when source = 'gpt_output'
  then gpt_output else gemini_output end as targets
from ({DUAL}), (values ('gpt_output'), ('gemini_output')) x(source) where {_TEST.format('record_id')}""",
    "o09_flatten_text": f"""select record_id, case json_type(output)
  when 'ARRAY' then array_to_string(list_transform(json_extract(output, '$[*]'),
    lambda x: {_json_item('x', 'text', "''")}), ' ')
  else {_json_item('output', 'text', "''")} end as output
from ({POLY})""",
    "o09_flatten_maps": f"""select record_id, case when record_id % 5 <> 0
    then case when record_id % 3 = 0 then '' else output end end as cell,
  case when record_id % 5 <> 0 and record_id % 3 <> 0 then output else '' end || ' ' || instruction as cells
from ({QA})""",
    "o10_normalize_content": f"""select record_id,
  {_strip("chr(9) || ' ' || instruction || ' ' || output || ' ' || chr(10)")} as content from ({QA})""",
    "o11_chat_format": f"""select record_id, '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10)
  || '<|im_start|>assistant' || chr(10) || output || '<|im_end|>' || chr(10) as text from ({QA})""",
    "o11_training_text": f"""select record_id, '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10)
  || '<|im_start|>assistant' || chr(10) || gpt_output || '<|im_end|>' || chr(10) as text
from ({DUAL}) where gpt_output is not null and record_id % 4 <> 0""",
    "o12_assemble_messages": """select conv_id, 0 as part, 1 as n_parts, count(*) as n_messages,
  string_agg(role || ': ' || text, chr(10) order by turn) as messages
from conversations group by conv_id""",
    "o12_ordered_turns": """select conv_id, row_number() over (partition by conv_id order by turn) - 1 as position,
  role, md5(text) as digest from conversations""",
    "o13_build_vocab": f"""select token, count, row_number() over (order by count desc, token) + 1 as id
from (select unnest({_tok('text')}) as token, count(*) as count from documents group by 1)
order by count desc, token limit 500""",
    "o13_encode": f"""with t as (select doc_id, {_tok('text')} as toks from documents),
v as (select token, row_number() over (order by count(*) desc, token) + 1 as id
      from (select unnest(toks) as token from t) group by token order by count(*) desc, token limit 500),
p as (select doc_id, x.i, coalesce(v.id, 1) as id
      from (select doc_id, unnest(range(1, least(len(toks), 256) + 1)) as i, toks from t) x
      left join v on v.token = x.toks[x.i]),
e as (select doc_id, list(id order by i) as ids from p group by doc_id),
f as (select doc_id, len(toks) > 256 as truncated, coalesce(ids, []) as ids from t left join e using (doc_id))
select doc_id, truncated,
  array_to_string(list_resize(ids, 256, 0), ' ') as input_ids,
  array_to_string(list_resize(list_transform(ids, lambda x: 1), 256, 0), ' ') as attention_mask,
  array_to_string(list_resize(ids, 256, 0), ' ') as labels
from f""",
    "o13_encode_subwords": _subwords(
        "select doc_id, text from documents", "doc_id", "text",
        """, p as (select doc_id, i, j, k, id from (select doc_id, i, j, unnest(y) as s, generate_subscripts(y, 1) as k from t) join v using (s)),
n as (select doc_id, list(id order by i, j, k) as ids from p group by doc_id),
a as (select doc_id, coalesce(ids, []) as ids from documents left join n using (doc_id))
select doc_id, len(ids) > 256 as truncated, array_to_string(list_resize(ids, 256, 50256), ' ') as input_ids,
  array_to_string(list_resize([1 for x in ids], 256, 0), ' ') as attention_mask,
  array_to_string(list_resize(ids, 256, 50256), ' ') as labels from a""",
    ),
    "o14_generation_plan": f"""select topic, round, model, 10::bigint as batch_size
from (select topic, unnest(range(1, cast(ceil(shortfall / 20.0) as bigint) + 1)) as round
      from ({COVERAGE}) where shortfall > 0), (values ('gpt'), ('gemini')) p(model)""",
    "o15_render_prompt": "select kind, id, md5(prompt) as digest, length(prompt) as n_chars from ("
    + " union all ".join(
        [f"select '{m}' as kind, record_id as id, {_prompt(m)} as prompt from ({EVAL})" for m in _JUDGES]
        + [f"select '{p}', record_id, {_prompt(p)} from ({QA})" for p in ("gpt_output", "gemini_output")]
        + [
            f"""select 'instructions', doc_id, {_prompt('instructions')} from (select doc_id, source as topic,
  lang as model, 10 as batch_size, 0.2::double as temperature, 400 as max_tokens from documents)"""
        ]
    )
    + ")",
    "o16_preview": """select doc_id,
  case when length(text) > 80 then substr(text, 1, 80) || '...' else text end as short,
  case when length(text) > 100 then substr(text, 1, 100) || '...' else text end as sample,
  substr(text, 1, 50) || '...' as log
from documents""",
    "o17_slugs": """with s as (select page_id, url,
  replace(replace(replace(url, '/', '_'), '-', '_'), '.', '') as slug from pages)
select page_id, slug || '_v-a.l' as slug, 'models:/main.models.' || slug || '_v1@prod' as registered,
  'models:/' || slug || '_v-a.l/latest' as uri,
  replace(replace(replace(lower(replace(replace(replace(slug || '_v-a.l', ',', ''), '.', '-'), '-', '_')
    || '_v' || page_id), '.', '-'), '/', '-'), '_', '-') as endpoint
from s""",
    "o18_run_name": "select event_id, 'eval_' || event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') as run_name from events",
    "o19_stamp_settings": f"""select record_id, gpt_output, 0.2::double as temperature, 400::bigint as max_tokens
from ({DUAL})""",
    "o20_normalize_prediction": f"""with l as (select record_id, case json_type(response)
    when 'OBJECT' then coalesce(json_extract(response, '$.predictions'), json_extract(response, '$.outputs'), '[]'::json)
    else response::json end as items from ({RESPONSES})),
i as (select record_id, unnest(range(0, cast(json_array_length(items) as bigint))) as pos, items from l),
x as (select record_id, pos, json_extract(items, '$[' || pos || ']') as item from i)
select record_id, pos, {_json_item('item', 'generated_text', 'item::varchar')} as prediction from x""",
    "o21_split_blank": f"select record_id, {_blank('gpt_output')} as blank from ({DUAL})",
    "o22_pending_outputs": f"""select record_id, 'gpt_output' as provider from ({DUAL})
where {_blank('gpt_output')} and not {_blank('instruction')}
union all select record_id, 'gemini_output' from ({DUAL})
where {_blank('gemini_output')} and not {_blank('instruction')}""",
    "o23_fill_missing": "select record_id, instruction, "
    + ", ".join(
        f"""case when {_blank(p)} and not {_blank('instruction')} and record_id % 3 <> 0
  then '{p}: ' || instruction else {p} end as {p}"""
        for p in ("gpt_output", "gemini_output")
    )
    + f" from ({DUAL})",
    "o24_batch_infer": f"""select record_id, provider,
  case when length(prompt) % 17 <> 0 then length(prompt) || ' characters' end as response,
  case when length(prompt) % 17 = 0 then 'ValueError: stand-in failure' end as error
from (select record_id, p as provider, 'instruction:' || instruction as prompt
      from ({DUAL}), (values ('gpt_output'), ('gemini_output')) x(p)
      where not {_blank('instruction')} and ((p = 'gpt_output' and {_blank('gpt_output')})
        or (p = 'gemini_output' and {_blank('gemini_output')})))""",
    "o25_attach_outputs": f"""select record_id, topic,
  case when record_id in (select doc_id from labels) then md5(outputs) end as digest from ({EVAL})""",
    "o26_slice_rows": """select doc_id, position
from (select doc_id, row_number() over (order by doc_id) - 1 as position, count(*) over () as n from documents)
where position >= n // 4 and position < n // 2""",
    "o26_slice_shards": f"""select record_id, gpt_output, shard, pos as position
from ({_shards(DUAL, 100)}) where pos >= n // 4 and pos < n // 2""",
    "o27_train_test_split": f"select doc_id, {_TEST.format('doc_id')} as is_test from documents",
    "o27_exact_split": """select doc_id,
  row_number() over (order by md5(cast(doc_id as varchar) || ':42')) <= ceil(0.2 * count(*) over ()) as is_test
from documents""",
    "o28_pending_rows": f"""select record_id, instruction from ({DUAL})
where {_blank('gpt_output')} or {_blank('gemini_output')}""",
    "o29_with_batches": """select event_id, position, position // 10 as batch, position // 10 * 10 as batch_start,
  least(position // 10 * 10 + 10, n) as batch_end
from (select event_id, row_number() over (order by event_id) - 1 as position, count(*) over () as n from events)""",
    "o30_concat_all": f"""select record_id, gpt_output, null as gemini_output, null as instruction from ({DUAL})
union all select record_id, null, gemini_output, null from ({DUAL})
union all select record_id, gpt_output, null, instruction from ({DUAL})""",
    "o31_existing": f"""select name, version, stage,
  coalesce(name in (select 'model_' || cast(doc_id % 40 as varchar) from labels), false) as registered from ({VERSIONS})""",
    "o32_batch_progress": f"""select (row - 1) // 10 as batch,
  count(*) filter (coalesce(gpt_output, '') <> '') as gpt_output_done,
  count(*) filter (coalesce(gemini_output, '') <> '') as gemini_output_done, count(*) as n_rows
from (select *, row_number() over (order by record_id) as row from ({DUAL})) group by 1""",
    "o33_topic_coverage": COVERAGE,
    "o34_rouge_n": f"""with {_grams(EVAL, 'record_id', 2)}, r as ({_rouge('record_id')})
select record_id, """
    + ", ".join(
        f"round(rouge{n}{part}, 6) as rouge{n}{part}" for n in (1, 2) for part in ("_precision", "_recall", "")
    )
    + " from r",
    "o35_rouge_l": f"""with recursive t as (select record_id, source, {_tok('targets')} as tt, {_tok('outputs')} as ot
  from ({PREDICTIONS})), {_LCS}, r as (select record_id, source, {_prf('rougeL', 'lcs', 'no', 'nt')} from l)
select record_id, source, round(rougeL_precision, 6) as "rougeL_precision",
  round(rougeL_recall, 6) as "rougeL_recall", round(rougeL, 6) as "rougeL" from r""",
    "o36_corpus_bleu": f"""with {_grams(EVAL, 'record_id, topic', 4)}, b as ({_bleu('topic')})
select topic, round(bleu, 6) as bleu, n from b""",
    "o37_subword_count": _subwords(
        EVAL, "record_id", "outputs",
        f"""select record_id, coalesce(n, 0)::bigint as token_count from ({EVAL}) left join
(select record_id, sum(len(y)) as n from t group by record_id) using (record_id)""",
    ),
    "o37_token_count": f"select record_id, len({_tok('outputs')}) as token_count from ({EVAL})",
    "o38_parse_score": f"""select record_id, metric, coalesce(s, 3.0)::double as score, s is null as defaulted
from (select record_id, metric, try_cast(regexp_extract(response, '[1-5]') as double) as s from ({JUDGE_RAW}))""",
    "o39_judge_scores": _judged(EVAL),
    "o40_metric_means": f"{_METRICS} select source, metric, round(value, 6) as value, n from m",
    "o41_check_thresholds": f"""{_GATE}
select source, threshold_name, round(value, 6) as value, threshold, status,
  bool_and(status <> 'FAIL') over (partition by source) as all_pass,
  count(*) filter (status = 'N/A') over (partition by source) as n_missing from gate""",
    "o42_compare_sources": f"{_METRICS} select source, "
    + ", ".join(
        f"""round(max(value) filter (metric = '{name}'), 6) as "{name.split('/')[0]}" """
        for name in [*_MEAN_NAMES, "bleu"]
    )
    + " from m group by source",
    "o42_source_summary": f"""{_GATE}
select source, case when bool_and(status <> 'FAIL') then 'ALL PASSED' else 'SOME FAILED' end as summary
from gate group by source""",
    "o43_eval_results": f"""{_SCORED}
select record_id, source, outputs, round(rouge1, 6) as rouge1, round(rouge2, 6) as rouge2, round(rougeL, 6) as "rougeL",
  token_count, {', '.join(_JUDGES)}, defaulted from scored""",
    "o44_metrics_long": """select event_id, event_id as step, 'loss' as key, event_id % 97 + 0.5::double as value from events
union all select event_id, event_id, 'ok', 1.0 from events
union all select event_id, event_id, 'k', cast(props ->> '$.k' as double) from events where props ->> '$.k' is not null""",
    "o44_params_long": f"""with r as (select source, count(*) as n from ({PREDICTIONS}) group by source)
select source, 'model_name' as key, 'Org_Base_05_' || source as value from r
union all select source, 'source_column', source from r
union all select source, 'num_samples', cast(n as varchar) from r""",
    "o45_latest_version": f"select name, max(try_cast(version as bigint)) as latest from ({VERSIONS}) group by name",
    "o46_retain_versions": f"""select name, version,
  case when row_number() over (partition by name order by coalesce(try_cast(version as bigint), -1) desc, version desc) <= 3 then stage
    else 'Archived' end as stage from ({VERSIONS})""",
    "o47_resolve_endpoint": f"""with s as (select name, version, min(endpoint) as endpoint from ({SERVED}) group by 1, 2),
w as (select name, arg_max(endpoint, version) as endpoint from s group by 1),
q as (select event_id as request_id, 'model_' || cast(user_id % 50 as varchar) as name, event_id % 1000 as version from events)
select request_id, q.name, q.version, coalesce(s.endpoint, w.endpoint) as endpoint,
  case when w.endpoint is null then 'no endpoint serves ' || q.name end as error
from q left join s on s.name = q.name and s.version = q.version left join w on w.name = q.name""",
    "o48_sample_rows": f"select record_id, inputs, outputs from ({EVAL}) order by record_id limit 3",
    "o49_cap_per_topic": """select record_id, topic
from (select doc_id as record_id, nullif(lang, 'es') as topic,
        row_number() over (partition by nullif(lang, 'es') order by md5(cast(doc_id as varchar))) as r from documents)
where r <= 150""",
    "o50_ingest_stream": f"select *, conv_id * {TURNS} + turn as record_id from conversations",
    "o50_ingest_shards": f"select * exclude (pos, n) from ({_shards(DUAL, 100)})",
    "o51_progress_stream": f"""select shard, count(*) filter (coalesce(gpt_output, '') <> '') as gpt_output_done,
  count(*) filter (coalesce(gemini_output, '') <> '') as gemini_output_done, count(*) as n_rows
from ({_shards(DUAL)}) group by shard""",
    "o52_score": f"""select record_id, (outputs = targets)::int::double as exact_match,
  round(length(outputs) / greatest(length(targets), 1), 6) as length_ratio,
  contains(outputs, topic)::int::double as names_source from ({EVAL})""",
    "o53_map_batches": """select doc_id, length(text) as n_text,
  length(text) - length(replace(text, chr(10), '')) + 1 as n_lines from documents""",
    "entry_answers": "select record_id, "
    + ", ".join(
        f"""case when {_blank(p)} and not {_blank('instruction')} and length({_prompt(p)}) % 17 <> 0
  then length({_prompt(p)}) || ' characters' else {p} end as {p}"""
        for p in ("gpt_output", "gemini_output")
    )
    + f", 0.2::double as temperature, 400::bigint as max_tokens from ({DUAL})",
    "entry_training": f"""with s as (select record_id, '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10)
    || '<|im_start|>assistant' || chr(10) || gemini_output || '<|im_end|>' || chr(10) as text
  from ({DUAL}) where gemini_output is not null),
t as (select record_id, {_tok('text')} as toks from s),
v as (select token, row_number() over (order by count(*) desc, token) + 1 as id
      from (select unnest(toks) as token from t) group by token order by count(*) desc, token limit 500),
p as (select record_id, x.i, coalesce(v.id, 1) as id
      from (select record_id, unnest(range(1, least(len(toks), 256) + 1)) as i, toks from t) x
      left join v on v.token = x.toks[x.i]),
e as (select record_id, list(id order by i) as ids from p group by record_id)
select record_id, md5(array_to_string(list_resize(coalesce(ids, []), 256, 0), ' ')) as digest,
  len(toks) > 256 as truncated, {_TEST.format('record_id')} as is_test from t left join e using (record_id)""",
    "entry_instructions": f"""{_RECORDS},
a as (select topic, count(*) as produced from (select distinct item ->> '$.topic' as topic,
  item ->> '$.instruction' as instruction from checked where status = 'valid') group by topic),
g as (select lang as topic, count(*) as target from documents group by lang),
n as (select 1 as planning, topic, target as short from g
      union all select 2, topic, target - coalesce(produced, 0) from g left join a using (topic)),
q as (select planning, topic, unnest(range(1, cast(ceil(short / 20.0) as bigint) + 1)) as round from n where short > 0),
m as (select planning, topic, round, model, 10 as batch_size, 0.2::double as temperature, 400 as max_tokens
      from q, (values ('gpt'), ('gemini')) x(model))
select md5('1:' || planning || length(topic) || ':' || topic || length(cast(round as varchar)) || ':' || round
    || length(model) || ':' || model) as record_id,
  planning::bigint as planning, round, topic, model, {_prompt('instructions')} as prompt from m""",
}
ORACLES["o28_pending_filtered"] = ORACLES["o28_pending_rows"]
# Here the second provider has its own prompt, with a space.
ORACLES["o24_infer_by_chunk"] = ORACLES["o24_batch_infer"].replace(
    "'instruction:' ||", "case p when 'gpt_output' then 'instruction:' else 'instruction: ' end ||"
)
ORACLES["o06_consolidate_shards"] = ORACLES["o06_consolidate"]
ORACLES["o40_means_of_increments"] = ORACLES["o40_metric_means"]

# Whole documents: edit steps (insert or delete a word) from one text to the other, the furthest word
# reached on each diagonal after 0, 1, 2, … steps. The texts are much alike, so few steps do.
_SAME = """coalesce(nullif(list_position(list_transform(list_zip(ot[{x} + 1:], tt[{y} + 1:], true),
  lambda p: p[1] = p[2]), false), 0) - 1, least(greatest(no - {x}, 0), greatest(nt - {y}, 0)))"""
_AT_END = "(d + no - nt) % 2 = 0 and abs(no - nt) <= d and v[(d + no - nt) // 2 + 1] >= no"
ORACLES["o35_rouge_l_documents"] = f"""with recursive w as (
  select record_id, {_tok('targets')} as tt, {_tok('outputs')} as ot from ({EVAL})),
t as (select *, len(tt)::bigint as nt, len(ot)::bigint as no from w),
s as (
  select record_id, 0::bigint as d, v, {_AT_END.replace('d +', '0 +').replace('<= d', '<= 0')} as done
  from (select *, [{_SAME.format(x=0, y=0)}::bigint] as v from t)
  union all
  select record_id, d, v, {_AT_END} from (
    select record_id, d, no, nt, list_transform(xs, lambda x, i:
      x + {_SAME.format(x='x', y='(x + d - 2 * (i - 1))')}) as v
    from (select record_id, d + 1 as d, list_transform(range(0, d + 2), lambda i: greatest(v[i] + 1, v[i + 1])) as xs
      from s where not done) join t using (record_id))),
r as (select record_id, {_prf('rougeL', '((no + nt - d) / 2)::double', 'no', 'nt')}
  from s join t using (record_id) where done)
select record_id, round(rougeL_precision, 6) as "rougeL_precision", round(rougeL_recall, 6) as "rougeL_recall",
  round(rougeL, 6) as "rougeL" from r"""
