"""The operators' queries as DuckDB SQL over the input tables, where SQL can express them."""

from __future__ import annotations

import string

from starloom.llm import (
    collocations,
    filter_audit,
    license_scan,
    minhash_bbit,
    quality_rules,
    url_filter,
)

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
BLANKS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
LINES = "string_split(coalesce(text, ''), chr(10))"


def ascii_lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def letters(text: str) -> str:
    return rf"regexp_extract_all({ascii_lower(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = f"""
with doc as (select doc_id, {letters("text")} as w from documents),
item as (select cast(item_id as varchar) as item, {letters("text")} as w from benchmark),
starts as (
    select item, w, least(len(w), 10) as s, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
    from item where len(w) > 0),
win as (select distinct item, s, w[i:i + s - 1] as win from starts),
sizes as (select distinct s from win),
placed as (
    select doc_id, s, p, w[p:p + s - 1] as win
    from (select doc_id, w, s, unnest(range(1, len(w) - s + 2)) as p from doc, sizes)),
hit as (select distinct doc_id, p, placed.s, item from placed join win using (s, win)),
covered as (
    select doc_id, count(distinct q) as n_hit
    from (select doc_id, unnest(range(p, p + s)) as q from hit) group by doc_id),
items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
    from (select distinct doc_id, item from hit) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from doc left join covered using (doc_id) left join items using (doc_id)
"""

_SPACED = r"[^\x20\x09-\x0D]+"
_NON_BLANK = f"list_filter({LINES}, lambda x: trim(x, {BLANKS}) <> '')"
METRICS = rf"""
doc as (
    select doc_id, lang, text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as w
    from documents),
win as (
    select doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] as win
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as p from doc)),
twice as (
    select doc_id, p from (
        select doc_id, p, count(*) over (partition by doc_id, win) as n from win) where n > 1),
repeats as (
    select doc_id, count(distinct q) as n
    from (select doc_id, unnest(range(p, p + 3)) as q from twice) group by doc_id),
metrics as (
    select doc_id, coalesce('=' || lang, '-') as stratum, len(w)::bigint as n_words,
        length(array_to_string(w, ''))::bigint as word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        (len({_NON_BLANK}) - len(list_distinct({_NON_BLANK})))::bigint as n_dup_lines,
        coalesce(repeats.n, 0)::bigint as n_repeat_words
    from doc left join repeats using (doc_id))
"""
_VALUES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_words, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "long_words": "word_chars / greatest(n_words, 1)",
    "short_words": "-(word_chars / greatest(n_words, 1))",
}


def _quality() -> str:
    qr = quality_rules
    tail = (
        "(select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)"
        f" + i * ln({qr.ALPHA}) + (n - i) * ln(1 - {qr.ALPHA}::double)))"
        " from (select unnest(range(0, (wrong + 1)::bigint)) as i))"
    )
    grids = ", ".join(
        f"('{rule}', {cutoff}::double)" for rule, grid in qr.GRIDS.items() for cutoff in grid
    )
    values = ", ".join(f"('{rule}', ({value})::double)" for rule, value in _VALUES.items())
    failed = (
        f"(n_words < {qr.MIN_WORDS} or 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words)"
    )
    return f"""
with {METRICS},
labelled as (
    select doc_id, min(quality) > 0 as good from labels
    where doc_id is not null and quality is not null group by doc_id),
held as (
    select metrics.*, good,
        good and (strpos('0123456789abcdef', md5(doc_id::varchar)[1]) - 1) % {qr.SELECT_ONE_IN} = 0 as orders,
        not good and not {failed} as bad
    from metrics join labelled using (doc_id)),
valued as (
    select doc_id, stratum, v.col0 as rule, v.col1 as value
    from metrics, lateral (values {values}) v),
calls as (
    select valued.stratum, rule, g.col1 as cutoff, count_if(orders and value > g.col1) as harm,
        count_if(bad and value > g.col1) as uses
    from valued join held using (doc_id) join (values {grids}) g on g.col0 = rule group by all),
gains as (select *, uses - {qr.GOOD_WEIGHT * qr.SELECT_ONE_IN} * harm as gain from calls),
bests as (
    select *, max(gain) over w as best, first_value(cutoff) over (
        partition by stratum, rule order by gain desc, cutoff desc) as strictest
    from gains window w as (partition by stratum, rule)),
candidates as (
    select stratum, rule, cutoff, row_number() over (
        partition by stratum order by harm, uses desc, cutoff desc, rule) as place
    from bests where best > 0 and cutoff >= strictest and uses > 0),
reached as (
    select doc_id, min(place) as place
    from valued join candidates using (stratum, rule) where value > cutoff group by doc_id),
marked as (
    select stratum, good, bad, good and not orders as proves, coalesce(place, 1000) as place
    from held left join reached using (doc_id)),
sizes as (select stratum, count_if(proves) as n from marked group by stratum),
unions as (
    select c.stratum, c.place, any_value(sizes.n) as n, count_if(proves and m.place <= c.place) as wrong,
        count_if(bad and m.place <= c.place)
            - {qr.GOOD_WEIGHT} * count_if(good and m.place <= c.place) as gain
    from candidates c join sizes using (stratum) join marked m using (stratum) group by all),
proven as (
    select stratum, place, gain from unions
    where wrong <= n * {qr.ALPHA}::double and gain > 0
        and {tail} <= {qr.DELTA}::double / greatest(1, (select count(*) from sizes))),
chosen as (
    select stratum, place as last from proven
    qualify row_number() over (partition by stratum order by gain desc, place) = 1),
rejected as (
    select distinct doc_id from valued join candidates using (stratum, rule)
        join chosen using (stratum) where place <= last and value > cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    {failed} as base_failed,
    not {failed} and doc_id not in (select doc_id from rejected where doc_id is not null) as kept
from metrics
"""


QUALITY = _quality()

LINE_DEDUP = f"""
with line as (
    select doc_id, unnest({LINES}) as line, unnest(range(len({LINES}))) as i from documents),
keyed as (select *, trim({ascii_lower("line")}, {BLANKS}) as key from line),
frequent as (
    select key from (select distinct doc_id, key from keyed) where length(key) >= 1
    group by key having count(*) >= 10),
kept as (
    select doc_id, count(*) as n_kept, string_agg(line, chr(10) order by i) as kept
    from keyed where key not in (select key from frequent) group by doc_id)
select doc_id, len({LINES})::bigint as n_lines,
    (len({LINES}) - coalesce(n_kept, 0))::bigint as n_dropped,
    sha256(coalesce(kept, '')) as kept_sha256
from documents left join kept using (doc_id)
"""


def _canonical(text: str) -> str:
    out = (
        f"regexp_replace(lower({text}), '(?m)^[ \\t#*/;-]*(copyright|\\(c\\)|©)[^\\n]*', '', 'g')"
    )
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for spelling, usual in license_scan.SPELLINGS:
        out = f"regexp_replace({out}, '\\b{spelling}\\b', '{usual}', 'g')"
    return out


def _one_line(text: str) -> str:
    return f"trim(regexp_replace({text}, '[ \\n]+', ' ', 'g'), ' ')"


def _licenses() -> str:
    known = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in license_scan.KNOWN
    )
    return f"""
with known as (
    select sha256(line) as digest, min(license) as license from (
        select col0 as license, {_one_line(_canonical("col1"))} as line from (values {known}) k)
    where line <> '' group by 1),
canon as (select doc_id, {_canonical("coalesce(text, '')")} as canon from documents),
line as (
    select doc_id, sha256(trim(x, ' ')) as digest
    from (select doc_id, unnest(string_split(canon, chr(10))) as x from canon)),
found as (select doc_id, license from line join known using (digest)),
whole as (
    select doc_id, sha256({_one_line("canon")}) as digest from canon),
every as (
    select doc_id, string_agg(license, ',' order by license) as licenses from (
        select doc_id, license from found union
        select doc_id, license from whole join known using (digest)) group by doc_id),
counted as (select doc_id, count(*) as n from found group by doc_id)
select doc_id, digest, license, coalesce(n, 0)::bigint as n_license_lines,
    coalesce(licenses, '') as licenses
from whole left join known using (digest) left join every using (doc_id)
    left join counted using (doc_id)
"""


LICENSES = _licenses()


def _urls() -> str:
    uf = url_filter
    host = f"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)"
    path = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    others, plain, second = (
        ", ".join(f"'{x}'" for x in names)
        for names in (uf.OTHER_SUFFIXES, uf.PLAIN_COUNTRIES, uf.SECOND_LEVEL)
    )
    # The incomplete beta function as a series of positive terms.
    series = (
        "list_sum(list_transform(range(0, 5000 + (4 * (a + b))::bigint), lambda n: exp("
        "lgamma(a + b + n) - lgamma(a + 1 + n) - lgamma(b)"
        f" + (a + n) * ln({uf.MIN_GOOD}::double) + b * ln(1 - {uf.MIN_GOOD}::double))))"
    )
    strength = (
        f"least(greatest(coalesce((select case when beyond > 0 then chance / beyond - 1 end from (select"
        " sum((n - 1) * prior * (1 - prior)) as chance,"
        " sum(n * (g / n - prior) * (g / n - prior) - prior * (1 - prior)) as beyond"
        f" from {{0}} where n > 0)), {uf.MAX_STRENGTH}), {uf.MIN_STRENGTH}), {uf.MAX_STRENGTH})"
    )

    def level(name: str) -> str:
        return (
            f"{name}_s as (select *, {strength.format(name)}::double as s from {name}),\n"
            f"{name}_m as (select *, g + s * prior as a, n - g + s * (1 - prior) as b,"
            f" (g + s * prior) / (n + s) as mean from {name}_s)"
        )

    rules = sorted(uf.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [
        (
            f"(host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '{start}')",
            verdict,
            name + start,
        )
        for verdict, name, start in rules
    ]
    rule = " ".join(f"when {fit} then '{text}'" for fit, _, text in fits)
    verdict = " ".join(f"when {fit} then '{verdict}'" for fit, verdict, _ in fits)
    return f"""
with labelled as (
    select doc_id, min(quality) > 0 as good from labels
    where doc_id is not null and quality is not null group by doc_id),
page as (
    select page_id, translate({host}, '{UPPER}', '{LOWER}') as host, {path} as path from pages),
outcome as (
    select page.*, good from page left join labelled
        on doc_id = try_cast(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1) as bigint)),
named as (
    select host, count(good) as n, count_if(good) as g,
        string_split(regexp_replace(host, ':[0-9]*$', ''), '.') as l
    from outcome group by host),
sized as (
    select *, case when len(l) > 1 and (array_to_string(l[-2:], '.') in ({others})
            or length(l[-1]) = 2 and l[-1] not in ({plain}) and l[-2] in ({second}))
        then 2 else 1 end as k from named),
hosts as (
    select host, n, g, array_to_string(case when len(l) > k then l[-(k + 1):] else l end, '.')
        as domain, array_to_string(l[-k:], '.') as suffix from sized),
root as (
    select (coalesce(sum(g), 0) + {uf.MIN_STRENGTH / 2})
        / (coalesce(sum(n), 0) + {uf.MIN_STRENGTH}) as prior from hosts),
suf as (
    select suffix, sum(n) as n, sum(g) as g, any_value(prior) as prior from hosts, root
    group by suffix),
{level("suf")},
dom as (
    select domain, hosts.suffix, sum(hosts.n) as n, sum(hosts.g) as g, any_value(mean) as prior
    from hosts join suf_m using (suffix) group by domain, hosts.suffix),
{level("dom")},
hst as (select host, hosts.n, hosts.g, mean as prior from hosts join dom_m using (domain)),
{level("hst")},
judged as (select host, {series} as below from hst_m)
select page_id, host, path, case {rule} end as rule,
    case {verdict} when below >= {uf.SURE} then 'block' else 'allow' end as verdict
from page join judged using (host)
"""


URLS = _urls()


def _linked(percent: int) -> str:
    """Each document's set size, or null, and the least id it reaches by links."""
    return f"""
with recursive doc as (
    select doc_id, regexp_extract_all({ascii_lower("text")}, '{_SPACED}') as w from documents),
shingle as (
    select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i
        from doc where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingle group by doc_id),
shared as (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from shingle a join shingle b using (s) where a.doc_id < b.doc_id group by all),
link as (
    select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y
    where 100 * common >= {percent} * (a.n + b.n - common)),
either as (select x, y from link union all select y, x from link),
reach as (
    select doc_id, doc_id as other from sizes
    union
    select reach.doc_id, y from reach join either on x = other)
"""


JACCARD = f"""{_linked(75)}
select documents.doc_id, coalesce(any_value(sizes.n), 0)::bigint as n_shingles,
    coalesce(min(other), documents.doc_id) as component_id
from documents left join sizes using (doc_id) left join reach using (doc_id)
group by documents.doc_id
"""

NEAR_COPIES = f"""{_linked(minhash_bbit.PERCENT)}
select documents.doc_id, coalesce(any_value(sizes.n), 0)::bigint as n_shingles,
    coalesce(min(other), documents.doc_id) as component_id,
    documents.doc_id = coalesce(min(other), documents.doc_id) as kept
from documents left join sizes using (doc_id) left join reach using (doc_id)
group by documents.doc_id
"""


def _filter_audit() -> str:
    fa = filter_audit
    text = "coalesce(text, '')"
    order = "o.filter_order"
    gone = "least(" + ", ".join(
        f"case when {f} then strpos({order}, '{f}') else 9 end" for f in fa.FAILURES
    ) + ")"
    fails = "case substr(o.filter_order, s.step::int, 1) " + " ".join(
        f"when '{f}' then {f}" for f in fa.FAILURES
    ) + " end"
    alone = " + ".join(f"{f}::int" for f in fa.FAILURES)
    return f"""
with worded as (
    select doc_id, coalesce(lang, '') as part, {text} as t,
        regexp_extract_all({text}, '{_SPACED}') as w, min(doc_id) over (partition by {text}) as least
    from documents),
failing as (
    select doc_id, part, len(w) < {fa.MIN_WORDS} as A,
        100 * len(list_distinct(w)) < {fa.DISTINCT_PERCENT} * len(w) as B,
        100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > {fa.CAPITAL_PERCENT} * length(t) as C,
        regexp_matches(t, '[#$%&*|]') as D, coalesce(doc_id > least, false) as E
    from worded),
known as (
    select doc_id, max(quality) = 1 as good, max(toxic) = 1 as toxic from labels group by doc_id),
masks as (
    select part, A, B, C, D, E, count(*) as n, count_if(good) as good, count_if(toxic) as toxic
    from failing left join known using (doc_id) group by all),
letter as (select unnest({list(fa.FAILURES)}) as f),
orders as (
    select a.f || b.f || c.f || d.f || e.f as filter_order
    from letter a, letter b, letter c, letter d, letter e
    where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (select unnest(range(1, 6)) as step),
met as (
    select part, o.filter_order, s.step, n, good, toxic, {gone} as gone, {fails} as fails,
        {alone} = 1 as alone
    from masks, orders o, steps s),
counted as (
    select part, filter_order, step::int as step,
        sum(case when gone > step then n else 0 end)::bigint as kept,
        sum(case when gone = step then n else 0 end)::bigint as removed,
        sum(case when gone < step and fails then n else 0 end)::bigint as redundant,
        sum(case when fails and alone then n else 0 end)::bigint as unique_fails,
        sum(case when gone = step then good else 0 end)::bigint as good_lost,
        sum(case when gone = step then toxic else 0 end)::bigint as toxic_lost
    from met group by all)
select *, (sum(removed) over (partition by part, substr(filter_order, step, 1)))::bigint as shapley
from counted
"""


FILTER_AUDIT = _filter_audit()


def _collocations() -> str:
    co = collocations
    grams = " union all ".join(
        f"select lang, {k} as k, array_to_string(w[i:i + {k - 1}], ' ') as phrase"
        f" from (select lang, w, unnest(range(1, len(w) - {k - 2})) as i from piece where len(w) >= {k})"
        for k in range(1, co.LONGEST + 1)
    )
    return f"""
with piece as (
    select lang, regexp_extract_all(p, '[^\\x20\\x09]+') as w from (
        select coalesce(lang, 'und') as lang,
            unnest(regexp_split_to_array({ascii_lower("text")}, '[.,;:!?\\x0A-\\x0D]')) as p
        from documents)),
total as (select lang, sum(len(w))::bigint as n from piece group by lang),
f as (
    select lang, k, phrase, count(*) as f from ({grams}) group by all
    having count(*) >= {co.MIN_COUNT}),
candidate as (
    select lang, phrase, string_split(phrase, ' ') as w, f as a from f where k > 1),
cut as (select *, unnest(range(1, len(w))) as c from candidate),
valued as (
    select cut.*, x.f as l, y.f as r, ({co.SCALE}::hugeint * a // (x.f + y.f))::bigint as score
    from cut join f x on x.lang = cut.lang and x.phrase = array_to_string(w[1:c], ' ')
        join f y on y.lang = cut.lang and y.phrase = array_to_string(w[c + 1:], ' ')),
low as (
    select * from valued qualify row_number() over (partition by lang, phrase order by score, c) = 1),
span as (select lang, w, a, unnest(range(2, len(w))) as k from candidate where len(w) > 2),
held as (
    select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, max(a) as longer
    from (select *, unnest(range(1, len(w) - k + 2)) as i from span) group by all),
left_over as (
    select low.* from low left join held using (lang, phrase)
    where longer is null or 100::hugeint * longer < {co.COVER_PERCENT}::hugeint * a),
ranked as (
    select *, row_number() over (
        partition by lang order by score desc, a desc, encode(phrase)) as rank
    from left_over)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score
from ranked join total using (lang) where rank <= {co.TOP}
"""


COLLOCATIONS = _collocations()
