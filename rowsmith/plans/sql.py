"""Text expressions in DuckDB's SQL, the twins of :mod:`rowsmith.functions`."""

from __future__ import annotations

from ..functions.geo import STATE_NAMES, STATES, ZIP3
from ..functions.text import ADDRESS_WORDS, BLANK_CERTIFIER, BLANK_LIVE, SUFFIXES

WS = r"[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]"
_ANY = "|".join(SUFFIXES)


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def listed(values) -> str:
    return f"[{quoted(values)}]"


def rep(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def text(x: str) -> str:
    return f"coalesce({x}, '')"


def strip(x: str) -> str:
    return rep(text(x), f"^{WS}+|{WS}+$", "")


def squeeze(x: str) -> str:
    return rep(x, f"{WS}+", " ")


def norm_name(x: str) -> str:
    s = rep(rep(strip(f"lower({text(x)})"), "&", " and "), "[-/,]", " ")
    return squeeze(rep(s, r"[^\p{L}\p{M}\p{Nd}\p{Pc}\s\x{A0}]", ""))


def dedup_name(x: str) -> str:
    return strip(rep(strip(norm_name(x)), rf"\s+(?:{_ANY})$", ""))


def match_key(x: str) -> str:
    s = rep(rep(f"lower({text(x)})", "&", " and "), "[-/,]", " ")
    return f"trim({rep(rep(rep(s, '[^a-z0-9 ]', ''), rf'\b(?:{_ANY})\b', ' '), ' +', ' ')})"


def flag_name(x: str) -> str:
    return f"trim({rep(f'lower({text(x)})', '[^a-z0-9 ]', ' ')})"


def cluster_key(x: str) -> str:
    return strip(f"lower(coalesce({x}, 'none'))")


def search_key(x: str) -> str:
    return rep(f"lower({text(x)})", "[^a-z0-9]", "")


def slug(x: str) -> str:
    return rep(rep(f"lower({text(x)})", "[^a-z0-9]+", "-"), "^-+|-+$", "")


def site(x: str) -> str:
    return rep(rep(strip(f"lower({text(x)})"), r"^https?://(?:www\.)?|^www\.", ""), "/+$", "")


def host(x: str) -> str:
    return rep(site(x), "[/?#].*$", "")


def row_key(name: str, website: str) -> str:
    return f"md5({squeeze(strip(f'lower({text(name)})'))} || '|' || {site(website)})"


def digits(x: str) -> str:
    return rep(text(x), "[^0-9]", "")


def is_blank(x: str) -> str:
    return f"lower(trim({text(x)})) in ({quoted(BLANK_LIVE)})"


def live_phone(x: str) -> str:
    d = digits(x)
    return f"(case when {is_blank(x)} then '' else left(case when length({d}) >= 11 and left({d}, 1) = '1' then substr({d}, 2) else {d} end, 10) end)"


def intake_phone(x: str) -> str:
    return f"(case when length({live_phone(x)}) = 10 then {live_phone(x)} else '' end)"


def certifier_clean(x: str) -> str:
    s = f"trim({squeeze(text(x))})"
    return f"(case when lower({s}) in ({quoted(BLANK_CERTIFIER)}) then '' else {s} end)"


def norm_address(x: str) -> str:
    s = rep(rep(rep(f"lower({text(x)})", r"\bn/?a\b", " "), r"(\d)\.0\b", r"\1"), r"[^a-z0-9\s]", " ")
    table = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in ADDRESS_WORDS.items()) + "}"
    words = f"list_filter(string_split_regex({s}, '\\s+'), lambda w: w <> '')"
    return f"coalesce(array_to_string(list_transform({words}, lambda w: coalesce({table}[w], w)), ' '), '')"


def street_number(norm: str) -> str:
    return f"nullif(regexp_extract({norm}, '\\b(\\d{{1,6}})\\b', 1), '')"


def address_quality(x: str) -> str:
    n = norm_address(x)
    types = r"\b(?:st|rd|ave|dr|blvd|ln|ct|pl|pkwy|hwy|cir|way|pike|plaza|broadway|trl|terr?)\b"
    return (
        rf"(case when {n} = '' then 0 when regexp_matches(lower({text(x)}), '\bp\.?\s*o\.?\s*box\b') then 2 "
        rf"when regexp_matches({n}, '^\d{{1,6}}\s+[a-z]') or regexp_matches({n}, '{types}') then 3 else 1 end)"
    )


def website_quality(x: str) -> str:
    return f"(case when {is_blank(x)} then 0 when contains(lower({text(x)}), 'buyblack.org') or contains(lower({text(x)}), 'facebook.com') then 1 else 2 end)"


def items(x: str) -> str:
    return f"list_filter(list_transform(string_split({text(x)}, ','), lambda p: trim(p)), lambda p: p <> '')"


def city_of(x: str) -> str:
    tail = r"regexp_matches(p, '^[A-Za-z]{2}(?:\s+\d{5}(?:-\d{4})?)?$') or regexp_matches(p, '^\d{5}(?:-\d{4})?$')"
    parts = f"list_filter(list_transform(string_split({text(x)}, ','), lambda p: {strip('p')}), lambda p: p <> '')"
    at = f"list_max(list_transform({parts}, lambda p, i: case when {tail} then 0 else i end))"
    return f"(case when len({parts}) >= 2 and {at} > 1 then {parts}[{at}] else '' end)"


def _last_state(tokens: str) -> str:
    return f"list_filter(list_transform({tokens}, lambda t: upper(t)), lambda t: list_contains({listed(STATES)}, t))[-1]"


def bare_country(x: str) -> str:
    t = f"trim({text(x)})"
    for _ in range(3):
        t = "trim(" + rep(t, r"(?i)[\s,]*\b(?:united states of america|united states|u\.?\s?s\.?\s?a\.?|usa)\.?\s*$", "") + ")"
    return t


def states_cte(table: str, key: str, address: str, where: str = "true") -> str:
    """CTEs ``bare``, ``parts`` and ``found`` (key, address, state, method, confident)."""
    names = sorted(STATE_NAMES, key=lambda n: (-len(n), list(STATE_NAMES).index(n)))
    longest = "case " + " ".join(rf"when regexp_matches(lower(t), '\b{n}\b') then '{STATE_NAMES[n]}'" for n in names) + " end"
    z = "try_cast(left(z5, 3) as int)"
    zips = "case " + " ".join(f"when {z} between {a} and {b} then '{s}'" for a, b, s in ZIP3) + " end"
    code = _last_state(r"regexp_extract_all(t, '\b([A-Za-z]{2})\b[\s,.]+\d{4,5}', 1)")
    tail = _last_state(r"regexp_extract_all(string_split(t, ',')[-1], '\b([A-Za-z]{2})\b', 1)")
    return rf"""
bare as (select *, {bare_country(address)} as t from {table} where {where}),
parts as (select *, {code} as s1, {tail} as s2, {longest} as s3, regexp_extract_all(t, '\b(\d{{5}})(?:-\d{{4}})?(?:\.0+)?\b', 1)[-1] as z5 from bare),
found as (select {key}, {address}, kentucky_based, coalesce(s1, s2, s3, {zips}) as state,
  case when s1 is not null then 'abbr_zip' when s2 is not null then 'trailing_token' when s3 is not null then 'full_name' when {zips} is not null then 'zip_prefix' else 'none' end as method,
  t from parts)"""


def verdict(address: str) -> str:
    return (
        f"case when trim({text(address)}) = '' then 'keep_blank' when state is null then 'review' when state = 'KY' then 'keep_ky' "
        "when method <> 'full_name' then 'delete' else 'review' end"
    )


def address_state(address: str) -> str:
    tail = f"lower(string_split(trim({text(address)}), ',')[-1])"
    named = " or ".join(rf"(state = '{s}' and regexp_matches({tail}, '\b{n}\b'))" for n, s in STATE_NAMES.items())
    return (
        f"case when trim({text(address)}) = '' then 'blank' when state = 'KY' then 'in-state' when state is not null and method <> 'full_name' then 'other-state' "
        f"when method = 'full_name' and ({named}) then 'other-state' else 'unclear' end"
    )


def clean_address(x: str) -> str:
    """Neighbours are captured, as there is no lookbehind; twice, since two in a row share one."""
    p = "' ' || p || ' '"
    for _ in range(2):
        p = rep(p, r"(?i)([^A-Za-z0-9])n\s*/\s*a([^A-Za-z0-9])", r"\1 \2")
    each = f"list_transform(string_split({text(x)}, ','), lambda p: trim({rep(p, r'\s+', ' ')}))"
    return f"nullif(coalesce(array_to_string(list_filter({each}, lambda q: q <> ''), ', '), ''), '')"


def contains_any(x: str, words) -> str:
    return f"(len(list_filter({listed(words)}, lambda w: contains({x}, w))) > 0)"


def trigrams(x: str) -> str:
    words = rf"list_filter(string_split({rep(f'lower({x})', r'[^\p{L}\p{N}]+', ' ')}, ' '), lambda w: w <> '')"
    return f"flatten(list_transform({words}, lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))"


def word_similarity(term: str, x: str) -> str:
    q, t = f"list_distinct({trigrams(term)})", trigrams(x)
    at = f"list_filter(range(1, len({t}) + 1), lambda i: list_contains({q}, {t}[i]))"
    part = f"list_distinct({t}[i:j])"
    both = f"len(list_intersect({part}, {q}))"
    best = f"list_max(list_transform(list_filter({at}, lambda j: j >= i), lambda j: {both}::double / (len({part}) + len({q}) - {both})))"
    return f"(case when {x} is null then null else coalesce(list_max(list_transform({at}, lambda i: {best})), 0.0) end)"
