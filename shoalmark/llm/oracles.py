"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_warc"] = """
with p as (select page_id, coalesce(html, '') html from pages),
d as (
  select page_id, strlen(html) payload_bytes, sha1(html) h,
    min(page_id) over (partition by sha1(html)) first_id from p)
select page_id, payload_bytes,
  translate(list_aggregate(list_transform(range(8), lambda i:
      to_base(cast('0x' || substr(h, 1 + 5 * i, 5) as bigint), 32, 4)), 'string_agg', ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end record_type,
  case when page_id <> first_id then first_id end refers_to
from d
"""

ORACLES["op2_exact_top_k"] = r"""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id query_id, c.vec_id vec_id,
    cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) as bigint) score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0),
r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""

ORACLES["op4_chat_formatting"] = r"""
with t as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') said from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
l as (
  select *, case when role = 'assistant' then said else '' end learned,
    15 + length(role) + length(said) + length(regexp_replace(role || said, '[^\\<>]', '', 'g')) written
  from t)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || said || chr(10), '' order by turn, role, said)) turns_sha256,
  cast(sum(length(learned)) as bigint) loss_chars,
  sha256(string_agg(learned, '' order by turn, role, said)) loss_sha256,
  cast(sum(written) as bigint) formatted_chars
from l group by conv_id
"""

ORACLES["op10_quality_rules"] = r"""
with d as (
  select doc_id, coalesce(text, '') t,
    chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) spaces from documents),
w as (
  select *,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls
  from d),
g as (select doc_id, ws, unnest(range(1, len(ws) - 1)) p from w),
c as (select doc_id, p, count(*) over (partition by doc_id, ws[p], ws[p + 1], ws[p + 2]) n from g),
q as (select doc_id, unnest([p, p + 1, p + 2]) place from c where n >= 2),
r as (select doc_id, count(distinct place) n_repeat_words from q group by doc_id),
l as (
  select doc_id, word, length(translate(line, spaces, '')) chars,
    regexp_matches(line, '[.!?:;…。！？]["''”’»)\]]*([\x20\x09-\x0D]|\z)')
    and length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) <= 0.05e0 * length(line)
    and length(regexp_replace(line, '[^!?]', '', 'g')) <= 0.05e0 * length(line)
    and length(regexp_replace(line, '[^|>»·•]', '', 'g')) <= 2
    and not (length(line) <= 200 and regexp_matches(line,
      '(?i)javascript|cookie|lorem ipsum|terms of use|terms of service|privacy policy|all rights reserved|licensed under|released under the|sign in|log in|read more|click here|skip to content|subscribe to our|copyright ©')) passes
  from (select doc_id, spaces, unnest(ls) line, true word from w)),
k as (select doc_id, sum(case when passes then chars else 0 end) kept_chars from l group by doc_id),
b as (
  select w.doc_id, len(ws) n_words, length(translate(t, spaces, '')) word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols,
    len(ls) - len(list_distinct(ls)) n_dup_lines, coalesce(n_repeat_words, 0) n_repeat_words,
    coalesce(kept_chars, 0) kept_chars
  from w left join r on w.doc_id = r.doc_id left join k on w.doc_id = k.doc_id),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and kept_chars >= 0.7e0 * word_chars kept
from f
"""

# Each pattern with the text before its matches and the group that must have a least length.
_SECRETS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("private_key", r"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----", 0, 0),
    ("github", "gh[oprsu]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", "xox[abeprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("login_url", r"[a-z]{2,12}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@", 0, 0),
]
_FOUND = " union all ".join(
    f"select doc_id, row_id, {number} k, '{kind}' kind, {least} least, string_split_regex(t, '{pattern}') gaps, "
    f"regexp_extract_all(t, '{pattern}') whole, regexp_extract_all(t, '{pattern}', {group}) part from d"
    for number, (kind, pattern, group, least) in enumerate(_SECRETS))
ORACLES["op11_secret_scans"] = f"""
with d as (select doc_id, row_number() over () row_id, coalesce(text, '') t from documents),
f as ({_FOUND}),
m as (select *, unnest(range(1, len(whole) + 1)) i from f),
s as (
  select row_id, k, kind, whole[i] said, part[i] said_part, least,
    cast(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) as bigint) start
  from m where length(part[i]) >= least),
j as (
  select row_id, count(*) filter (k = 0) n_assign, count(*) filter (k = 1) n_access, count(*) filter (k = 2) n_hex,
    string_agg(kind || ':' || start || ':' || (start + length(said)), ',' order by start, k) filter (k < 3) base,
    string_agg(kind || ':' || start || ':' || (start + length(said)), ',' order by start, k) spans
  from s group by row_id)
select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from d left join j using (row_id)
"""

# Levels that are enough for 8**9 documents of a language and 8**4 languages; levels above a
# tree's top leave it as it is.
_TREE_LEVELS, _TOP_LEVELS = 9, 4


def _levels(name: str, group: str, levels: int) -> str:
    """Tables ``name``0, ``name``1, ... of the nodes (``group``, p, h, n) of each level."""
    steps = []
    for k in range(levels):
        steps.append(f"""{name}_run{k} as (
  select {group}, p // 8 r, any_value(n) n, list(h order by p) hs from {name}{k} group by {group}, p // 8),
{name}{k + 1} as (
  select {group}, r p, case when n = 1 then hs[1] else sha256(array_to_string(hs, '')) end h, (n + 7) // 8 n
  from {name}_run{k})""")
    return ",\n".join(steps)


def _climb(name: str, source: str, group: str, levels: int, prefix: str) -> str:
    """Rows of ``source`` (place ``p``, proof, folded) taken up the levels of their tree."""
    steps = [f"{prefix}0 as (select *, p spot from {source})"]
    for k in range(levels):
        left, right = "array_to_string(hs[1:spot % 8], '')", "array_to_string(hs[spot % 8 + 2:], '')"
        steps.append(f"""{prefix}{k + 1} as (
  select a.* replace (spot // 8 as spot,
    case when r.n = 1 then proof else proof || {left} || {right} end as proof,
    case when r.n = 1 then folded else sha256({left} || folded || {right}) end as folded)
  from {prefix}{k} a join {name}_run{k} r on r.{group} = a.{group} and r.r = a.spot // 8)""")
    return ",\n".join(steps)


_FIELDS = [f"cast({c} as varchar)" for c in ("doc_id", "source", "lang", "n_chars")]


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in [*_FIELDS, text]) + ")"


ORACLES["op12_merkle_manifest"] = f"""
with crc_table as (
  select list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) tab
  from (select unnest(range(256)) i)),
d as (
  select doc_id, coalesce('1' || lang, '0') lang, {_leaf("text")} leaf,
    {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} changed,
    xor(list_reduce(list_concat([cast(4294967295 as bigint)],
        list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
      lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) % 3 = 0 hit
  from documents, crc_table),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 p,
    count(*) over (partition by lang) n from d),
low0 as (select lang, p, leaf h, n from leaves),
{_levels("low", "lang", _TREE_LEVELS)},
subroots as (
  select lang, h, 1 one, row_number() over (order by lang) - 1 p, count(*) over () n from low{_TREE_LEVELS}),
high0 as (select one, p, h, n from subroots),
{_levels("high", "one", _TOP_LEVELS)},
started as (
  select doc_id, lang, leaf, p, '' proof, case when hit then changed else leaf end folded from leaves),
{_climb("low", "started", "lang", _TREE_LEVELS, "a")},
crossed as (
  select a.doc_id, a.leaf, s.h subroot, s.one, s.p, a.proof, a.folded from a{_TREE_LEVELS} a join subroots s on a.lang = s.lang),
{_climb("high", "crossed", "one", _TOP_LEVELS, "b")}
select doc_id, leaf, subroot, h root, sha256(proof) proof_sha256, folded folded_root, folded = h verified
from b{_TOP_LEVELS} b join high{_TOP_LEVELS} t on t.one = b.one
"""

ORACLES["op13_fill_in_middle"] = """
with d as (
  select doc_id, coalesce(text, '') t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) s from documents),
h as (
  select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') u,
    list_transform(range(4), lambda i: cast('0x' || substr(s, 1 + 8 * i, 8) as bigint)) h
  from d),
n as (
  select *, cast(len(u) as bigint) n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) low,
    greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) high,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 90
      then 'plain' when h[4] % 100 < 20 then 'spm' else 'psm' end form
  from h),
c as (
  select *, array_to_string(u[1:low], '') p, array_to_string(u[low + 1:high], '') m,
    array_to_string(u[high + 1:], '') s from n)
select doc_id, n, form, case when form <> 'plain' then length(p) end prefix_chars,
  case when form <> 'plain' then length(m) end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
  sha256(t) restored_sha256
from c
"""
